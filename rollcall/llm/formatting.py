"""Duplicates hidden by formatting: progressive partition refinement from cheap invariants to exact content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.skew import HOT_ROWS, attach_by_key
from rollcall.session import cut

_NOT_ALNUM = r"[^\p{L}\p{N}]+"
#: groups of characters whose counts are the letter histogram of the first refinement
_LETTERS = ("etao", "insr", "0123456789")


def stripped(value: Column) -> Column:
    """Letters and digits only, lower case; null and missing give the empty text."""
    return F.coalesce(F.regexp_replace(F.lower(value), _NOT_ALNUM, ""), F.lit(""))


def json_fields(record: Column, fields: list[str]) -> tuple[Column, Column]:
    """(validity, stripped fields) of records of JSON text; ``a.b`` names a nested field."""
    nested: dict[str, list[str]] = {}
    for f in fields:
        head, _, tail = f.partition(".")
        nested.setdefault(head, [])
        if tail:
            nested[head].append(tail)
    schema = ", ".join(f"`{h}` struct<{', '.join(f'`{t}`: string' for t in ts)}>" if ts else f"`{h}` string" for h, ts in nested.items())
    options = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    parsed = F.from_json(record, schema + ", `__corrupt` string", options)
    # a parser stops after the first value: what begins and ends otherwise isn't one object
    bare = F.trim(F.translate(record, "\t\r\n\f\u000b", "     "))
    valid = record.isNotNull() & bare.startswith("{") & bare.endswith("}") & parsed.isNotNull() & parsed["__corrupt"].isNull()
    columns = []
    for f in fields:
        c = parsed
        for part in f.split("."):
            c = c[part]
        columns.append(stripped(c))
    return valid, F.array(*columns)


def formatting_duplicates(df: DataFrame, key: str, group: list[str], content: Column, valid: Column | None = None,
                          hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, representatives) of records that are the same but for formatting.

    ``content`` is an array of stripped fields (see ``stripped``); records are the same if ``group`` (nulls
    being equal) and all fields are. ``members``: (``first_id``, ``key``) for every other record of a set of
    several; ``representatives``: (``first_id``, ``copies``) for every set, singletons included with 1 copy.
    ``first_id`` is the smallest key of the set. Rows that aren't ``valid`` or have a null key are left out.
    Repeated rows (the same key again) count as copies but are listed once.

    Refinement. Records are read and stripped once and cut. Classes are first made by what costs little and travels
    as partial counts: group and stripped lengths of the fields; those with several members are split by counts of a few
    letters and digits. Only rows of classes that still have several members get the exact key, and only these keys are
    shuffled further. A set holding a third of all rows is counted by partial aggregation; its rows meet their first id by
    broadcast (see ``attach_by_key``).
    """
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), *group, F.when(valid if valid is not None else F.lit(True), content).alias("content"))
    coarse = rows.withColumn("all", F.array_join("content", "")).withColumn("g", F.xxhash64(*[F.isnull(g) for g in group], *group, F.transform("content", F.length)))
    histogram = [(F.length("all") - F.length(F.translate("all", c, ""))).cast("int") for c in _LETTERS]
    coarse = cut(coarse.withColumn("h", F.xxhash64(*histogram)).drop("all")).filter("content is not null")
    classes = cut(coarse.groupBy("g", "h").agg(F.count("*").alias("n")))
    several = attach_by_key(coarse, classes.filter("n > 1"), ["g", "h"], "n", "left_semi", hot_rows)
    exact = cut(several.select("k", F.unhex(F.sha2(F.to_json(F.struct(*group, "content")), 256)).alias("e")))
    sets = exact.groupBy("e").agg(F.min("k").alias("first_id"), F.count("*").alias("n"))
    members = (attach_by_key(exact, sets.filter("n > 1"), ["e"], "n", "inner", hot_rows)
               .filter("k <> first_id").select("first_id", F.col("k").alias(key)))
    singles = coarse.join(classes.filter("n = 1"), ["g", "h"], "left_semi").select(F.col("k").alias("first_id"), F.lit(1).cast("long").alias("copies"))
    representatives = sets.select("first_id", F.col("n").alias("copies")).unionByName(singles)
    return members, representatives

"""People's records: merging, retiring, loading, summaries and exports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions import validate as V
from rollcall.functions.text import reformat_phone
from rollcall.operators.intervals import is_active

#: fixed values: parties of which a person has one at a time
MAJOR = ("Democratic", "Republican")


def merge_fields(old: DataFrame, new: DataFrame, key: str, scalars: list[str], lists: list[str], renamed: str | None = "name") -> DataFrame:
    """(``key``, field, change, old, new): how new records change old ones, field by field.

    Scalars are replaced where the new one has a value that differs; list items that are missing are appended (the list
    replaced if it was empty); with a new ``renamed`` value the old one is kept among ``other_names``.
    """
    n = new.select(key, *[F.col(c).alias(f"__{c}") for c in (*scalars, *lists)])
    both = old.join(n, key)
    rows = []
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    entry = lambda f, kind, a, b: F.struct(F.lit(f).alias("field"), F.lit(kind).alias("change"), a.cast("string").alias("old"), b.cast("string").alias("new"))
    none = F.lit(None).cast("string")
    for c in scalars:
        differs = ~blank(F.col(f"__{c}")) & ~F.coalesce(F.col(c) == F.col(f"__{c}"), F.lit(False))
        rows.append(F.array(F.when(differs, entry(c, "replace", F.col(c), F.col(f"__{c}")))))
        if c == renamed:
            rows.append(F.array(F.when(differs & ~blank(F.col(c)), entry("other_names", "append", none, F.col(c)))))
    for c in lists:
        was, now = F.coalesce(F.col(c), F.array().cast("array<string>")), F.coalesce(F.col(f"__{c}"), F.array().cast("array<string>"))
        appended = _appended(F.array_except(now, was), entry, c)
        whole = F.array(entry(c, "replace", F.to_json(was), F.to_json(now)))
        rows.append(F.when(F.size(now) == 0, F.expr("array()")).when(F.size(was) == 0, whole).otherwise(appended))
    changes = F.array_compact(F.flatten(F.array(*rows)))
    return both.select(key, F.explode(changes).alias("c")).select(key, "c.*")


def _appended(items: Column, entry, field: str) -> Column:
    return F.transform(items, lambda x: entry(field, "append", F.lit(None).cast("string"), x))


def apply_fields(old: DataFrame, changes: DataFrame, key: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """Old records with the changes of ``merge_fields`` applied; a person's changes are bounded by their fields."""
    c = F.col
    g = changes.groupBy(key).agg(
        *[F.max(F.when((c("field") == f) & (c("change") == "replace"), c("new"))).alias(f"__{f}") for f in scalars],
        *[F.array_sort(F.collect_list(F.when((c("field") == f) & (c("change") == "append"), c("new")))).alias(f"__a_{f}") for f in lists])
    out = old.join(g, key, "left")
    for f in scalars:
        out = out.withColumn(f, F.coalesce(f"__{f}", f)).drop(f"__{f}")
    for f in lists:
        empty = F.array().cast("array<string>")
        out = out.withColumn(f, F.concat(F.coalesce(f, empty), F.coalesce(f"__a_{f}", empty))).drop(f"__a_{f}")
    return out


OFFICES = "array<struct<classification:string,name:string,address:string,voice:string,fax:string>>"
_FIELDS = ("classification", "name", "address", "voice", "fax")


def merge_offices(old: Column, new: Column) -> Column:
    """Offices of two records: those of one name are joined (new values win), then such that say no more than another go.

    Which of two equal ones stays depends on the order, so a person's few offices are walked in Python.
    """
    @F.pandas_udf(OFFICES)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_join_offices(list(x) if x is not None else [], list(y) if y is not None else []) for x, y in zip(a, b, strict=True)])
    return run(old, new)


def _join_offices(old: list[dict], new: list[dict]) -> list[dict]:
    label = lambda o: o.get("name") or f"{(o.get('classification') or '').title()} Office"
    by_label: dict[str, dict] = {label(o): {f: o.get(f) or "" for f in _FIELDS} for o in old}
    for o in new:
        kept = by_label.setdefault(label(o), dict.fromkeys(_FIELDS, ""))
        kept.update({f: o[f] for f in _FIELDS if o.get(f)})
    rows = [by_label[k] for k in sorted(by_label)]
    says = [frozenset((f, o[f]) for f in ("address", "voice", "fax") if o[f]) for o in rows]
    out = []
    for i, o in enumerate(rows):
        beaten = any(says[i] < says[j] or (says[i] == says[j] and ((bool(rows[j]["name"]), -j) > (bool(o["name"]), -i))) for j in range(len(rows)) if j != i)
        if not beaten:
            out.append(o)
    return out


def merge_party(old: Column, new: Column, today: str) -> Column:
    """Party history (array of struct(name, start_date, end_date)) with a new party: an open last one ends today."""
    last = F.element_at(old, -1)
    closed = F.struct(last["name"].alias("name"), last["start_date"].alias("start_date"), F.when(F.coalesce(last["end_date"], F.lit("")) == "", today).otherwise(last["end_date"]).alias("end_date"))
    grown = F.concat(F.slice(old, 1, F.size(old) - 1), F.array(closed), F.array(new))
    return F.when(F.size(old) == 0, F.array(new)).when(last["name"] == new["name"], old).otherwise(grown)


def roles_equalish(a: Column, b: Column) -> Column:
    same = F.lit(True)
    for f in ("type", "jurisdiction", "district", "end_date", "end_reason"):
        same = same & a[f].eqNullSafe(b[f])
    return same


def retire(roles: Column, date: str, reason: str | None = None) -> Column:
    """Roles (array of struct(type, district, start_date, end_date, end_reason)) with active ones ended."""
    def ended(r):
        live = is_active(r["start_date"], r["end_date"], date)
        return F.struct(r["type"].alias("type"), r["district"].alias("district"), r["start_date"].alias("start_date"), F.when(live, date).otherwise(r["end_date"]).alias("end_date"), F.when(live, F.lit(reason)).otherwise(r["end_reason"]).alias("end_reason"))
    return F.transform(roles, ended)


def retire_people(df: DataFrame, date: str, reason: str | None = None, death: bool = False) -> DataFrame:
    """People with their active roles ended, without offices, with the date of death if that is why; ``n_ended`` roles were ended."""
    live = F.size(F.filter("roles", lambda r: is_active(r["start_date"], r["end_date"], date)))
    out = df.withColumn("n_ended", live).withColumn("roles", retire(F.col("roles"), date, reason)).withColumn("offices", F.slice("offices", 1, 0))
    return out.withColumn("death_date", F.lit(date)) if death else out


def check_people(df: DataFrame, path: str, today: str) -> DataFrame:
    """(id, errors, warnings, fixes) of people's records: what is wrong with each and, among all, ids given twice.

    The record's file must be named after its id; somebody without an active role belongs among the retired; phones that
    only need other dashes are fixes.
    """
    c = F.col
    own = V.person_problems(c("name"), c("given_name"), c("family_name"), c("id"), F.coalesce("birth_date", F.lit("")), F.coalesce("death_date", F.lit("")), F.coalesce("email", F.lit("")))
    bare = F.element_at(F.split("id", "/"), -1)
    role = F.flatten(F.transform("roles", lambda r: V.role_problems(r["type"], r["district"], r["end_date"])))
    active = F.exists("roles", lambda r: is_active(r["start_date"], r["end_date"], today))
    retired = F.col(path).contains("/retired/")
    warnings = F.filter(own, lambda m: m.startswith("missing "))
    errors = F.concat(F.filter(own, lambda m: ~m.startswith("missing ")), role, V.problems(V.rule(F.col(path).contains(bare), "id isn't in the file's name"), V.rule(active | retired, "no active roles"), V.rule(~active | ~retired, "retired with active roles")),
                      V.office_problems(c("offices")))
    voices = F.filter(F.transform("offices", lambda o: o["voice"]), lambda v: F.coalesce(v, F.lit("")) != "")
    fixes = F.transform(F.filter(voices, lambda v: reformat_phone(v) != v), lambda v: F.concat(F.lit("phone "), v, F.lit(" to "), reformat_phone(v)))
    twice = df.groupBy("id").agg(F.count("*").alias("__n")).filter("__n > 1")
    return df.select("id", errors.alias("errors"), warnings.alias("warnings"), fixes.alias("fixes")).join(twice, "id", "left").withColumn("errors", F.when(c("__n") > 1, F.concat("errors", F.array(F.lit("duplicate id")))).otherwise(c("errors"))).drop("__n")


def primary_party(parties: Column, today: str) -> Column:
    """struct(party, error): the last active party, but a major one once seen stays; two majors are an error."""
    start = F.struct(F.lit("").alias("party"), F.lit(False).alias("error"))

    def step(acc, p):
        major, held = p["name"].isin(*MAJOR), acc["party"].isin(*MAJOR)
        return F.struct(F.when(held, acc["party"]).otherwise(p["name"]).alias("party"), (acc["error"] | (held & major)).alias("error"))
    active = F.filter(parties, lambda p: is_active(p["start_date"], p["end_date"], today))
    return F.aggregate(active, start, step)


def current_role(roles: Column, today: str) -> Column:
    """The last active role as struct(type, district, number): the number for sorting numbered districts."""
    last = F.try_element_at(F.filter(roles, lambda r: is_active(r["start_date"], r["end_date"], today)), F.lit(-1))
    return F.when(last.isNotNull(), F.struct(last["type"].alias("type"), last["district"].alias("district"), last["district"].try_cast("int").alias("number")))


def summarize(df: DataFrame, columns: list[str], optional: list[str]) -> DataFrame:
    """(kind, value, n, percent): how often each value of ``columns`` occurs and each of ``optional`` is filled."""
    total = df.agg(F.count("*").alias("total"))
    pairs = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.lit(c).alias("kind"), F.col(c).alias("value"))) for c in columns],
                                    *[F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.lit(c).alias("kind"), F.lit("filled").alias("value"))) for c in optional]))
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.kind", "p.value").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(total)).select("kind", "value", "n", F.round(F.col("n") * 100 / F.col("total"), 1).alias("percent"))  # one row


def export_rows(people: DataFrame, offices: DataFrame, key: str, columns: list[str], kinds: list[str], links: DataFrame | None = None) -> DataFrame:
    """One flat row a person: columns, each kind of office spread over columns, links joined by semicolons."""
    spread = offices.groupBy(key).agg(*[F.max(F.when(F.col("classification") == k, F.col(f))).alias(f"{k}_{f}") for k in kinds for f in ("address", "voice", "fax")])
    out = people.select(key, *columns).join(spread, key, "left")
    if links is not None:
        joined = links.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("url")), ";").alias("links"))
        out = out.join(joined, key, "left")
    return out


def terms_to_roles(df: DataFrame, key: str, terms: str) -> tuple[DataFrame, DataFrame]:
    """(roles, parties) of people with an array of terms (type, state, district, party, start, end): each term is a role, a party spans its terms."""
    t = df.select(key, F.posexplode(terms).alias("term_no", "t"))
    senate = F.col("t.type") == "sen"
    district = F.when(senate, F.col("t.state")).when(F.col("t.district") == 0, F.concat_ws("-", "t.state", F.lit("AL"))).otherwise(F.concat_ws("-", "t.state", "t.district"))
    roles = t.select(key, "term_no", F.when(senate, "upper").otherwise("lower").alias("type"), district.alias("district"), F.col("t.start").alias("start_date"), F.col("t.end").alias("end_date"))
    parties = t.groupBy(key, F.col("t.party").alias("party")).agg(F.min("t.start").alias("start_date"), F.max("t.end").alias("end_date"))
    return roles, parties

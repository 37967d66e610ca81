"""Parents and children: missing, present and nested children, delete rules, computed reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.hierarchy import descendants, resolve_hierarchy



def missing_children(parents: DataFrame, children: DataFrame, key: str, foreign: str) -> DataFrame:
    return parents.join(children.select(F.col(foreign).alias(key)), key, "left_anti")


def with_children(parents: DataFrame, children: DataFrame, key: str, foreign: str) -> DataFrame:
    return parents.join(children.select(F.col(foreign).alias(key)), key, "left_semi")


def nest(parents: DataFrame, children: DataFrame, key: str, foreign: str, order: list[str], name: str) -> DataFrame:
    """Children as a sorted array on their parent; parents without any have the empty array."""
    fields = [*order, *[c for c in children.columns if c not in (*order, foreign)]]
    packed = children.groupBy(F.col(foreign).alias(key)).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
    return parents.join(packed, key, "left").withColumn(name, F.coalesce(name, F.expr(f"filter({name}, x -> false)"), F.array()))


def with_order(df: DataFrame, array: str, key: list[str], position: str = "order") -> DataFrame:
    """One row an element with its place in the array."""
    return df.select(*key, F.posexplode(array).alias(position, "item"))


def cascade(children: DataFrame, deleted: DataFrame, foreign: str, key: str) -> DataFrame:
    """Children that stay when parents are deleted with theirs."""
    return children.join(deleted.select(F.col(key).alias(foreign)), foreign, "left_anti")


def set_null(children: DataFrame, deleted: DataFrame, foreign: str, key: str) -> DataFrame:
    """Children of deleted parents lose the reference."""
    gone = deleted.select(F.col(key).alias(foreign)).distinct().withColumn("__gone", F.lit(True))
    out = children.join(gone, foreign, "left")
    return out.withColumn(foreign, F.when(F.col("__gone").isNull(), F.col(foreign))).drop("__gone").select(children.columns)


def protected(children: DataFrame, deleted: DataFrame, foreign: str, key: str) -> DataFrame:
    """The children that forbid the deletion; it may go on only if there are none."""
    return children.join(deleted.select(F.col(key).alias(foreign)), foreign, "left_semi")


def children_of(df: DataFrame, path: str, of: str, depth: int = 1, kind: str | None = None) -> DataFrame:
    """Rows whose hierarchical id is 1 to ``depth`` levels below ``of``; ``kind`` asks for that kind at the last level."""
    level = of.count("/") + 1
    parts = F.split(F.col(path), "/")
    out = df.filter(F.col(path).startswith(of + "/") & F.size(parts).between(level + 1, level + depth))
    return out.filter(F.element_at(parts, -1).startswith(kind + ":")) if kind else out


def ancestors(df: DataFrame, key: str, parent: str) -> DataFrame:
    """(``key``, ``ancestor``, ``distance``) through parent links of any depth, each ancestor once, by the hierarchy operator.

    Parents that are no row of the table are none; nodes of a ring have each other.
    """
    kind = df.schema[key].dataType
    linked = resolve_hierarchy(df.select(F.col(key).cast("string").alias("k"), F.col(parent).cast(kind).cast("string").alias("p")), "k", "p")
    return descendants(linked).select(F.col("descendant").cast(kind).alias(key), F.col("ancestor").cast(kind).alias("ancestor"), "distance")


def entity_name(kind: Column, names: dict[str, Column]) -> Column:
    """The name of whichever related thing ``kind`` says."""
    out = None
    for k, c in names.items():
        out = F.when(kind == k, c) if out is None else out.when(kind == k, c)
    return out


def group_links(df: DataFrame, collection: list[str], url: str, group: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """(links by group, dropped): the first of each address in a collection counts, whatever group later ones are in."""
    first = df.groupBy(*collection, url).agg(F.min(order).alias("__first"))
    marked = df.join(first, [*collection, url])
    kept = marked.filter(F.col(order) == F.col("__first")).groupBy(*collection, *group).agg(F.array_sort(F.collect_list(F.struct(order, url))).alias("links"))
    return kept, marked.filter(F.col(order) != F.col("__first")).drop("__first")


def district_of(df: DataFrame, division: str, districts: DataFrame) -> DataFrame:
    """State, chamber and name of the district a division is: ``districts`` (division_id, state, chamber, name) has each once."""
    kind = F.when(F.col(division).contains("/sldl:"), "lower").when(F.col(division).contains("/sldu:"), "upper")
    return df.withColumn("division_chamber", kind).join(districts.withColumnRenamed("division_id", division), division, "left")


def lookup(refs: DataFrame, value: str, dimension: DataFrame, keys: list[str], out: list[str]) -> DataFrame:
    """A dimension row by any of its keys; a value that fits none has nulls and ``found`` false."""
    parts = [dimension.select(F.col(k).alias(value), *out) for k in keys]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return refs.join(union.filter(F.col(value).isNotNull()).dropDuplicates([value]).withColumn("found", F.lit(True)), value, "left").fillna(False, ["found"])

"""Comparisons of keyed sets, multisets and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.ids import canonical_hash


def merge_plan(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Each key as ``add``, ``remove``, ``same`` or ``merge``."""
    o = old.select(*key, canonical_hash(*[F.col(c) for c in columns]).alias("__o"))
    n = new.select(*key, canonical_hash(*[F.col(c) for c in columns]).alias("__n"))
    plan = F.when(F.col("__o").isNull(), "add").when(F.col("__n").isNull(), "remove").when(F.col("__o") == F.col("__n"), "same").otherwise("merge")
    return o.join(n, key, "full_outer").select(*key, plan.alias("plan"))


def multiset_equal(a: Column, b: Column, ordered: bool = False) -> Column:
    """Whether two arrays hold the same items as often; with ``ordered`` in the same order too. Null is the empty array."""
    x, y = F.coalesce(a, F.expr("array()")), F.coalesce(b, F.expr("array()"))
    if ordered:
        return x.eqNullSafe(y)
    return F.when(F.size(x) != F.size(y), F.lit(False)).otherwise(F.array_sort(x).eqNullSafe(F.array_sort(y)))


def set_equal(df: DataFrame, other: DataFrame, by: list[str], items: list[str]) -> DataFrame:
    """Per group whether both tables hold the same set of item tuples (nulls equal): each item is counted, none gathered."""
    sides = df.select(*by, *items, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(other.select(*by, *items, F.lit(0).alias("__a"), F.lit(1).alias("__b")))
    return sides.groupBy(*by, *items).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b")).groupBy(*by).agg(F.bool_and(F.col("__a") == F.col("__b")).alias("equal"))


def multiset_differences(df: DataFrame, by: list[str], item: Column, side: Column) -> DataFrame:
    """(``by``, only_old, only_new): how many items more one side holds; ``side`` is true for new rows. Counted by item."""
    counts = df.groupBy(*by, item.alias("__item")).agg(F.sum(F.when(side, 1).otherwise(-1)).alias("__d"))
    return counts.groupBy(*by).agg(F.sum(F.greatest(-F.col("__d"), F.lit(0))).alias("only_old"), F.sum(F.greatest("__d", F.lit(0))).alias("only_new"))


def replaced(stored: Column, given: Column, multiset: bool = False) -> Column:
    """Whether stored items must be replaced by given ones: another count, or a stored item that isn't given.

    As a set test it misses a changed count of equal items; ``multiset`` sees that too.
    """
    if multiset:
        return ~multiset_equal(stored, given)
    return (F.size(stored) != F.size(given)) | (F.size(F.array_except(stored, given)) > 0)


def keyed_list_union(old: DataFrame, new: DataFrame, by: list[str], key: str, position: str) -> DataFrame:
    """Old items in their order, replaced by new ones of the same key, then the other new ones."""
    o = old.withColumn("__side", F.lit(0))
    n = new.withColumn("__side", F.lit(1))
    w = Window.partitionBy(*by, key)
    both = o.unionByName(n).withColumn("__first", F.min(F.struct("__side", position)).over(w)).withColumn("__newest", F.max("__side").over(w))
    kept = both.filter(F.col("__side") == F.col("__newest"))
    return kept.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy("__first", position)) - 1).drop("__side", "__first", "__newest")


def append_missing(old: Column, new: Column) -> Column:
    return F.concat(old, F.array_except(new, old))


def map_union(left: Column, right: Column) -> Column:
    """Entries of both, the right ones where both have a key."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def set_count(counts: Column, option: Column, value: Column) -> Column:
    """An array of struct(option, value) with one option's value set, whether it was there or not."""
    return F.concat(F.filter(counts, lambda x: x["option"] != option), F.array(F.struct(option.alias("option"), value.alias("value"))))


def unaccounted(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return found.select(key).distinct().join(known.select(key), key, "left_anti")

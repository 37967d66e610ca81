"""The write side: snapshot merges with outcomes, keyed merges, soft and stale deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.ids import canonical_hash
from rollcall.operators.rollup import latest_by


def match_key(parts: list[tuple[str, list[Column]]]) -> Column:
    """The first kind of key whose columns are all there, named by its kind; null if none is."""
    out = F.lit(None).cast("string")
    for kind, cols in reversed(parts):
        there = F.lit(True)
        for c in cols:
            there = there & c.isNotNull()
        out = F.when(there, F.concat_ws("\u0001", F.lit(kind), *[c.cast("string") for c in cols])).otherwise(out)
    return out


def outcomes(stored: DataFrame, arrived: DataFrame, key: list[str], columns: list[str], order: list[str] | None = None) -> DataFrame:
    """(key, what): ``insert``, ``update`` or ``noop`` of each arrived row; several rows of a key count by the last."""
    fresh = latest_by(arrived, key, order) if order else arrived
    h = canonical_hash(*[F.col(c) for c in columns])
    both = fresh.select(*key, h.alias("__n")).join(stored.select(*key, h.alias("__o"), F.lit(True).alias("__there")), key, "left")
    return both.select(*key, F.when(F.col("__there").isNull(), "insert").when(F.col("__o") == F.col("__n"), "noop").otherwise("update").alias("what"))


def merged(stored: DataFrame, arrived: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """The table after the import: arrived rows replace stored ones of their key, the others stay."""
    fresh = latest_by(arrived, key, order) if order else arrived
    return stored.join(fresh.select(key), key, "left_anti").unionByName(fresh.select(stored.columns))


def keyed_merge(stored: DataFrame, arrived: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Fields updated where an arrived row has a value, new rows added, nothing deleted; ``what`` is ``noop`` if rows were only added."""
    n = arrived.select(*key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__new"))
    both = stored.withColumn("__old", F.lit(True)).join(n, key, "full_outer")
    differs = F.lit(False)
    for c in columns:
        differs = differs | (F.col(f"__{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"__{c}")))
    what = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNotNull() & differs, "update").otherwise("noop")
    return both.select(*key, *[F.coalesce(f"__{c}", c).alias(c) for c in columns], what.alias("what"))


def duplicate_targets(arrived: DataFrame, key: list[str]) -> DataFrame:
    """Keys that several arrived rows would write."""
    return arrived.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def soft_delete(stored: DataFrame, seen: DataFrame, key: str, flag: str = "deleted") -> DataFrame:
    """Rows not seen are flagged, seen ones are revived; an empty batch changes nothing."""
    s = seen.select(F.col(key)).distinct().withColumn("__seen", F.lit(True))
    any_seen = s.agg(F.count("*").alias("__n"))
    out = stored.join(s, key, "left").crossJoin(F.broadcast(any_seen))  # one row
    return out.withColumn(flag, F.when(F.col("__n") == 0, F.col(flag)).otherwise(F.col("__seen").isNull())).drop("__seen", "__n").select(stored.columns)


def stale_delete(stored: DataFrame, imported: DataFrame, parent: str, key: str) -> DataFrame:
    """What stays: rows of parents the batch touches are dropped unless imported by it."""
    touched = imported.select(parent).distinct()
    stale = stored.join(touched, parent, "left_semi").join(imported.select(key), key, "left_anti").select(key)
    return stored.join(stale, key, "left_anti")


def insert_absent(stored: DataFrame, arrived: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """New rows by natural key, each once: the least in ``order``."""
    first = arrived.groupBy(*key).agg(F.min_by(F.struct(*[c for c in arrived.columns if c not in key]), F.struct(*order)).alias("r"))
    flat = first.select(*key, *[F.col(f"r.{c}").alias(c) for c in arrived.columns if c not in key])
    return flat.join(stored.select(*key), key, "left_anti").select(arrived.columns)


def touched(parents: DataFrame, rows: DataFrame, key: str, stamp: Column, column: str) -> DataFrame:
    """Parents of changed rows get the stamp."""
    t = rows.select(key).distinct().withColumn("__t", F.lit(True))
    return parents.join(t, key, "left").withColumn(column, F.when(F.col("__t"), stamp).otherwise(F.col(column))).drop("__t").select(parents.columns)


def replace_partition(df: DataFrame, path: str, by: str) -> None:
    """Write a report so that only the partitions it holds are replaced, each at once."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)

"""Joins and groupings that stay even when one key holds a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot from this many rows on. At most (rows / HOT_ROWS) keys can be hot, which bounds what is broadcast.
HOT_ROWS = 200_000
#: More hot keys than this aren't broadcast but joined by salting.
MAX_BROADCAST_KEYS = 50_000


def attach_by_key(rows: DataFrame, keyed: DataFrame, on: list[str], count: str, how: str = "inner",
                  hot_rows: int = HOT_ROWS, max_broadcast: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Join ``rows`` to ``keyed`` (one row a key, with ``count`` = rows of that key), splitting hot keys off.

    Keys of at least ``hot_rows`` rows go through a broadcast of just those keys, so their rows are never
    shuffled to one task; all other keys go through a shuffle join whose largest group is below ``hot_rows``.
    If there are more than ``max_broadcast`` hot keys, all goes through the shuffle join with a salt.
    Null keys match nothing. ``how`` is ``inner`` or ``left_semi``.
    """
    hot = keyed.filter(F.col(count) >= hot_rows)
    n_hot = hot.select(F.lit(1)).limit(max_broadcast + 1).count()
    if n_hot == 0:
        return rows.join(keyed.drop(count), on, how)
    if n_hot > max_broadcast:
        return salted_join(rows, keyed.drop(count), on, how)
    hot_flags = F.broadcast(hot.select(*on, F.lit(True).alias("__hot")))
    flagged = rows.join(hot_flags, on, "left")
    out_hot = flagged.filter(F.col("__hot")).drop("__hot").join(F.broadcast(hot.drop(count)), on, how)
    cold = keyed.filter(F.col(count) < hot_rows).drop(count)
    out_cold = flagged.filter(F.col("__hot").isNull()).drop("__hot").join(cold, on, how)
    return out_hot.unionByName(out_cold)


def salted_join(rows: DataFrame, keyed: DataFrame, on: list[str], how: str, salts: int = 16) -> DataFrame:
    """Equi join whose right side is copied ``salts`` times, so a hot left key is spread over as many tasks."""
    left = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    right = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def row_hash(*cols: Column) -> list[Column]:
    """Two 64-bit hashes that also tell nulls from values and null positions from each other."""
    flagged = [c for col in cols for c in (F.isnull(col), col)]
    return [F.xxhash64(*flagged), F.xxhash64(F.lit("second"), *flagged)]

"""What changed between consecutive full snapshots, by content-defined chunks of key-sorted snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.operators.skew import row_hash
from rollcall.session import cut


def snapshot_changes(df: DataFrame, snapshot: str, key: str, content: list[Column], latest_by: list[str] | None = None,
                     chunk_rows: int = 8, range_rows: int = 4096) -> DataFrame:
    """Rows (``snapshot_no``, ``record_id``, ``change_kind``) for each snapshot but the first.

    ``content`` are the compared columns (an order-free array is given as ``sort_array`` of it); two records
    are the same if every one is equal, a null being equal to a null only. Of repeated deliveries of a key in
    a snapshot the one with the greatest ``latest_by`` counts; rows that tie there are ordered by their
    content hash. Snapshots compare with the one before them that exists. Rows with a null key or snapshot
    are ignored, an empty table gives an empty result, other columns are ignored.

    Method. Keys are cut into ranges of about ``range_rows`` keys by the key's value, every snapshot by the
    same bounds. In a range the rows of a snapshot are taken in key order, and a chunk ends at each key whose
    hash is 0 modulo ``chunk_rows``: the bounds depend on keys alone, so an added or removed key moves no
    other chunk. Chunks whose digest (count and xor of 128-bit row hashes) is the same in two consecutive
    snapshots are dropped; only rows of other chunks are joined on the key.
    """
    h1, h2 = row_hash(F.col(key), *content)
    order = [F.col(c) for c in latest_by or []]
    rows = (df.filter(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
            .select(F.col(snapshot).alias("s"), F.col(key).alias("k"), *[o.alias(f"o{i}") for i, o in enumerate(order)],
                    h1.alias("h1"), h2.alias("h2"))
            .groupBy("s", "k")
            .agg(F.max(F.struct(*[f"o{i}" for i in range(len(order))], "h1", "h2")).alias("m"))
            .select("s", "k", F.col("m.h1").alias("h1"), F.col("m.h2").alias("h2")))

    # one row a snapshot: a few numbers, whatever the size of the snapshots
    sizes = rows.groupBy("s").agg(F.count("*").alias("n"))
    steps = sizes.select("s", F.lag("s").over(Window.orderBy("s")).alias("before"), F.lead("s").over(Window.orderBy("s")).alias("after"))

    bucket, key_order = _range_of(df, key, range_rows)
    in_range = Window.partitionBy("b", "s").orderBy(*key_order)
    boundary = F.pmod(F.xxhash64(F.lit("chunk"), "k"), F.lit(chunk_rows)) == 0
    chunked = cut(rows.withColumn("b", bucket)
                  .withColumn("c", F.last(F.when(boundary, F.col("k")), ignorenulls=True).over(in_range)))

    digests = chunked.groupBy("b", "c", "s").agg(F.count("*").alias("n"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    over_time = Window.partitionBy("b", "c").orderBy("s")
    before = F.lag(F.struct("s", "n", "x1", "x2")).over(over_time)
    after = F.lead(F.struct("s", "n", "x1", "x2")).over(over_time)
    flagged = (digests.join(F.broadcast(steps), "s")
               .withColumn("p", before).withColumn("q", after)
               .select("b", "c", "s", "before", "after",
                       (F.col("before").isNotNull() & ~F.coalesce((F.col("p.s") == F.col("before")) & (F.col("p.n") == F.col("n")) & (F.col("p.x1") == F.col("x1")) & (F.col("p.x2") == F.col("x2")), F.lit(False))).alias("new_side"),
                       (F.col("after").isNotNull() & ~F.coalesce((F.col("q.s") == F.col("after")) & (F.col("q.n") == F.col("n")) & (F.col("q.x1") == F.col("x1")) & (F.col("q.x2") == F.col("x2")), F.lit(False))).alias("old_side"))
               .filter("new_side or old_side"))

    open_rows = (chunked.alias("r")
                 .join(flagged.alias("f"), (F.col("r.b") == F.col("f.b")) & F.col("r.c").eqNullSafe(F.col("f.c")) & (F.col("r.s") == F.col("f.s")))
                 .select("r.s", "r.k", "r.h1", "r.h2", "before", "after", "new_side", "old_side"))
    # a row takes part once for the step that ends at its snapshot and once for the step that begins there
    sides = open_rows.select(
        "k", "h1", "h2",
        F.explode(F.array_compact(F.array(
            F.when(F.col("new_side"), F.struct(F.col("s").alias("step"), F.lit(1).alias("is_new"))),
            F.when(F.col("old_side"), F.struct(F.col("after").alias("step"), F.lit(0).alias("is_new")))))).alias("side")
    ).select("k", F.col("side.step").alias("step"), F.col("side.is_new").alias("is_new"), "h1", "h2")
    pairs = sides.groupBy("step", "k").agg(
        F.max("is_new").alias("in_new"), F.min("is_new").alias("not_old"),
        F.min("h1").alias("h1a"), F.max("h1").alias("h1b"), F.min("h2").alias("h2a"), F.max("h2").alias("h2b"))
    kind = (F.when(F.col("not_old") == 1, "added").when(F.col("in_new") == 0, "removed")
            .when((F.col("h1a") != F.col("h1b")) | (F.col("h2a") != F.col("h2b")), "changed"))
    return (pairs.select(F.col("step").alias("snapshot_no"), F.col("k").alias("record_id"), kind.alias("change_kind"))
            .filter(F.col("change_kind").isNotNull()))


def _range_of(df: DataFrame, key: str, range_rows: int) -> tuple[Column, list[Column]]:
    """The range a key falls into and the key order: by value for whole numbers, else by the key's hash.

    A range of whole numbers holds at most ``range_rows`` keys a snapshot; hashed keys spread evenly.
    """
    if df.schema[key].dataType.typeName() in ("long", "integer", "short", "byte"):
        return F.floor(F.col("k") / F.lit(range_rows)).cast("long"), [F.col("k")]
    ranges = max(1, df.count() // range_rows)
    hashed = F.xxhash64("k")
    return F.pmod(hashed, F.lit(ranges)), [hashed, F.col("k")]

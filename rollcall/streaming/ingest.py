"""Micro-batch ingest: file streams, windowed counts, replay-safe merging and soft deletes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str, schema: StructType | str, files_a_batch: int = 500) -> DataFrame:
    """A stream of JSON lines as they are appended to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def windowed_counts(df: DataFrame, ts: str, by: list[str], width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Counts in event-time windows; on a stream, rows later than ``late`` are given up."""
    source = df.withWatermark(ts, late) if df.isStreaming else df
    counted = source.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), *by, "n")


def without_replays(df: DataFrame, key: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Each key once: rows that are sent again within ``late`` are dropped."""
    if df.isStreaming:
        return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(key)
    return df.dropDuplicates(key)


def buffered(df: DataFrame, path: str, checkpoint: str, every: str = "15 minutes", by: list[str] | None = None, once: bool = False) -> StreamingQuery:
    """Append to JSON files by class at a fixed pace; ``once`` takes what is there and ends."""
    writer = df.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    if by:
        writer = writer.partitionBy(*by)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def merge_batches(df: DataFrame, key: list[str], order: str, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], checkpoint: str,
                  after: Callable[[DataFrame, int], None] | None = None, once: bool = True) -> StreamingQuery:
    """Upsert every batch into a table: new keys added, known ones replaced by later rows, a batch sent again changes nothing.

    ``read`` and ``write`` give and take the table; ``after`` is called with what each batch changed.
    """
    from rollcall.operators.rollup import latest_by

    def run(batch: DataFrame, number: int) -> None:
        stored = read()
        fresh = latest_by(batch, key, [order])
        newer = fresh.join(stored.select(*key, F.col(order).alias("__had")), key, "left").filter(F.col("__had").isNull() | (F.col(order) > F.col("__had"))).drop("__had")
        write(stored.join(newer.select(key), key, "left_anti").unionByName(newer.select(stored.columns)))
        if after is not None:
            after(newer, number)

    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def only_new(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What the state table doesn't hold yet."""
    return df.join(done.select(key), key, "left_anti")

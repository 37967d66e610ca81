"""First-wins de-duplication by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.skew import attach_by_key


def content_key(content: Column) -> Column:
    """256-bit digest of a content; only digests are shuffled, whatever the length of texts. Null stays null."""
    return F.unhex(F.sha2(content.cast("string"), 256))


def first_by_hash(df: DataFrame, content: Column, order: list[str]) -> DataFrame:
    """The first row in order of each content (null is one), by aggregation: no group is sorted or gathered, and a hot content is pre-aggregated."""
    keyed = df.withColumn("__h", content_key(content))
    first = keyed.groupBy("__h").agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r"), F.count("*").alias("copies"))
    return first.select("r.*", "copies")


def duplicate_map(df: DataFrame, content: Column, key: str) -> DataFrame:
    """(``copy``, ``kept``) of every row but the one with the least key of its content; a content of very many rows is split off."""
    keyed = df.select(F.col(key).alias("copy"), content_key(content).alias("__h")).filter("__h is not null")
    kept = keyed.groupBy("__h").agg(F.min("copy").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    return attach_by_key(keyed, kept, ["__h"], "n").filter("copy <> kept").select("copy", "kept")

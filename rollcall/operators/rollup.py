"""Ordered roll-ups and windows: first, latest, previous non-null, preferred, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.versions import UNKNOWN, sort_key


def action_rollup(actions: DataFrame, key: str, order: str, date: str, description: str, classes: str, passage: str = "passage") -> DataFrame:
    """Per bill: first and latest action date, the latest's description, and the latest passage date.

    Of equal dates the later in order counts as latest. Blank dates are no dates as long as another action follows.
    Aggregates only, so a bill of any number of actions is pre-aggregated before the shuffle.
    """
    d = F.when(F.col(date) != "", F.col(date))
    passed = F.when(F.array_contains(classes, passage), d)
    return actions.groupBy(key).agg(
        F.min(d).alias("first_action_date"), F.max(d).alias("latest_action_date"),
        F.coalesce(F.max_by(F.col(description), F.when(d.isNotNull(), F.struct(d, F.col(order)))), F.lit("")).alias("latest_action_description"),
        F.max(passed).alias("latest_passage_date"))


def changed_only(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``new`` whose columns differ from the stored ones, nulls being equal; others need no write."""
    stored = old.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return new.join(stored, key, "left").filter(~same).select(new.columns)


def latest_by(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The row of each group that is greatest in ``order``, by aggregation (no sort of whole groups)."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*by, *[F.col(f"r.{c}").alias(c) for c in rest]).select(df.columns)


def preferred(df: DataFrame, by: list[str], value: str, kind: str, order: list[str], tiebreak: str) -> DataFrame:
    """Per group the non-empty value of the most preferred kind."""
    rank = F.lit(len(order))
    for i, k in reversed(list(enumerate(order))):
        rank = F.when(F.col(kind) == k, i).otherwise(rank)
    usable = F.coalesce(F.col(value).cast("string"), F.lit("")) != ""
    return df.groupBy(*by).agg(F.min_by(F.col(value), F.when(usable, F.struct(rank, F.col(tiebreak)))).alias(value))


def previous_non_null(df: DataFrame, by: list[str], order: list[str], value: Column, out: str = "previous") -> DataFrame:
    """The last value before each row that isn't null."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def version_order(df: DataFrame, by: list[str], note: str, date: str, tiebreak: str) -> DataFrame:
    """Versions with ``stage``, ``ordinal`` and their ``position``; those of unknown stage have none."""
    keyed = df.withColumn("__k", sort_key(F.col(note), F.col(date)))
    known = F.col("__k.stage") != UNKNOWN
    w = Window.partitionBy(*by, known).orderBy("__k", tiebreak)
    return keyed.withColumn("position", F.when(known, F.row_number().over(w))).withColumn("stage", F.col("__k.stage")).withColumn("ordinal", F.col("__k.ordinal")).drop("__k")


def previous_version_text(df: DataFrame, by: list[str], note: str, date: str, kind: str, text: str, tiebreak: str, prefer: list[str]) -> DataFrame:
    """Each document with the text of the version before its own: the preferred document of the last version that has text.

    Versions (note, date) are ordered by stage; those of unknown stage neither read nor give a text.
    A null date or note is the empty one. Versions are ordered and matched by the ids of their documents; the texts
    themselves are joined once.
    """
    rows = df.withColumns({"__note": F.coalesce(note, F.lit("")), "__date": F.coalesce(date, F.lit(""))})
    version = [*by, "__note", "__date"]
    rank = F.lit(len(prefer))
    for i, k in reversed(list(enumerate(prefer))):
        rank = F.when(F.col(kind) == k, i).otherwise(rank)
    best = F.min(F.when(F.coalesce(text, F.lit("")) != "", F.struct(rank.alias("rank"), F.col(tiebreak).alias("id"))))["id"]
    versions = rows.groupBy(*version).agg(best.alias("__text_id"), F.min(tiebreak).alias("__id"))
    ordered = version_order(versions, by, "__note", "__date", "__id")
    w = Window.partitionBy(*by).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("position").isNotNull()
    prior = ordered.withColumn("__from", F.when(known, F.last(F.when(known, F.col("__text_id")), ignorenulls=True).over(w)))
    texts = df.select(F.col(tiebreak).alias("__from"), F.col(text).alias("previous_text"))
    placed = prior.select(*version, "position", "__from").join(texts, "__from", "left").drop("__from")
    return rows.join(placed, version, "left").drop("__note", "__date")


def longest_run(df: DataFrame, by: list[str], order: list[str], failed: Column) -> DataFrame:
    """The longest run of consecutive failures per group (gaps and islands)."""
    w = Window.partitionBy(*by).orderBy(*order)
    islands = df.withColumn("__f", failed.cast("int")).withColumn("__i", F.sum(1 - F.col("__f")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy(*by, "__i").agg(F.sum("__f").alias("n"))
    return runs.groupBy(*by).agg(F.max("n").alias("longest_run"))


def trips(df: DataFrame, by: list[str], order: list[str], failed: Column, limit: int) -> DataFrame:
    """The first row of each group at which ``limit`` failures in a row are reached."""
    w = Window.partitionBy(*by).orderBy(*order)
    islands = df.withColumn("__f", failed.cast("int")).withColumn("__i", F.sum(1 - F.col("__f")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    counted = islands.withColumn("__n", F.sum("__f").over(Window.partitionBy(*by, "__i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return latest_first(counted.filter((F.col("__n") == limit) & (F.col("__f") == 1)), by, order).drop("__f", "__i", "__n")


def latest_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The row of each group that is least in ``order``."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select(*by, *[F.col(f"r.{c}").alias(c) for c in rest]).select(df.columns)

"""Counts and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def conditional_counts(df: DataFrame, by: list[str], options: dict[str, Column]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(c).alias(k) for k, c in options.items()])


def tally_check(declared: DataFrame, observed: DataFrame, key: str, options: list[str]) -> DataFrame:
    """Per vote, declared counts against counted ones; a missing declaration is 0, only ``options`` are compared.

    ``declared`` (key, option, value) must hold an option once a vote: a second one gives ``duplicated``.
    """
    spread = declared.groupBy(key).agg(
        *[F.max(F.when(F.col("option") == o, F.col("value"))).alias(f"declared_{o}") for o in options],
        F.max(F.when(F.col("option").isin(options), 1).otherwise(0)).alias("any"),
        (F.count_if(F.col("option").isin(options)) != F.count_distinct(F.when(F.col("option").isin(options), F.col("option")))).alias("duplicated"))
    both = observed.join(spread.drop("any"), key, "left")
    bad = F.lit(False)
    for o in options:
        bad = bad | (F.coalesce(F.col(f"declared_{o}"), F.lit(0)) != F.col(o))
    return both.withColumn("duplicated", F.coalesce("duplicated", F.lit(False))).withColumn("bad_counts", bad)


def name_counts(df: DataFrame, name: str, unresolved: Column, by: list[str] | None = None, out: str = "names") -> DataFrame:
    """Map of name to count of unresolved rows, per group."""
    by = by or []
    counts = df.filter(unresolved).groupBy(*by, name).agg(F.count("*").alias("n"))
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias(out))


def quality_report(bills: DataFrame, key: str, children: dict[str, DataFrame], foreign: str, votes: DataFrame | None = None, by: list[str] | None = None) -> DataFrame:
    """One row a session: bills without each kind of child, and from ``votes`` (a tally check) their counters.

    ``by`` are the columns of ``bills`` (and ``votes``) that name the session; everything is one grouped pass a
    child table, joined on the session.
    """
    by = by or []
    base = bills
    for name, child in children.items():
        has = child.select(F.col(foreign).alias(key)).distinct().withColumn(f"__{name}", F.lit(1))
        base = base.join(has, key, "left")
    report = base.groupBy(*by).agg(F.count("*").alias("bills"), *[F.count_if(F.col(f"__{n}").isNull()).alias(f"bills_missing_{n}") for n in children])
    if votes is None:
        return report
    counters = votes.groupBy(*by).agg(
        F.count_if(F.col("voters") == 0).alias("votes_missing_voters"), F.count_if(F.col("declared_yes").isNull()).alias("votes_missing_yes_count"),
        F.count_if(F.col("declared_no").isNull()).alias("votes_missing_no_count"), F.count_if("bad_counts").alias("votes_with_bad_counts"))
    return report.join(counters, by, "left") if by else report.crossJoin(F.broadcast(counters))  # one row each


#: the three maps of a report and what they count
UNMATCHED = ("unmatched_sponsor_people", "unmatched_sponsor_organizations", "unmatched_voters")


def session_report(bills: DataFrame, key: str, children: dict[str, DataFrame], foreign: str, votes: DataFrame, unmatched: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """The whole report a session: the counters of ``quality_report``, ``votes_missing_bill`` and a map of name to count for each of ``unmatched``.

    ``votes`` has ``bill``; each table of ``unmatched`` has ``by`` and ``name``, one row an unresolved reference. Sessions
    without votes count 0, without unresolved names have an empty map. Written by ``upsert.replace_partition``, it takes
    the place of the session's report before.
    """
    report = quality_report(bills, key, children, foreign, votes, by)
    report = report.join(votes.groupBy(*by).agg(F.count_if(F.col("bill").isNull()).alias("votes_missing_bill")), by, "left")
    report = report.fillna(0, [c for c in report.columns if c.startswith("votes_")])
    for name, rows in unmatched.items():
        report = report.join(name_counts(rows, "name", F.col("name").isNotNull(), by, name), by, "left").withColumn(name, F.coalesce(name, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))))
    return report


def retried(df: DataFrame, was_error: str, text: str, reason: str) -> DataFrame:
    """(what, n): how documents that had errors fare when they are read again: ``now_fixed``, ``still_error`` or ``skipped: `` and why."""
    what = F.when(F.col(reason).isNotNull(), F.concat(F.lit("skipped: "), reason)).when(F.coalesce(F.trim(text), F.lit("")) != "", "now_fixed").otherwise("still_error")
    return df.filter(was_error).groupBy(what.alias("what")).agg(F.count("*").alias("n"))


def coverage(df: DataFrame, by: list[str], missing: Column, error: Column) -> DataFrame:
    """Totals and rounded-up percentages of missing and erroneous rows; null percentages for empty groups."""
    total = F.count("*")
    percent = lambda c: F.ceil(F.count_if(c) * 100 / total).cast("long")
    return df.groupBy(*by).agg(total.alias("total"), F.count_if(missing).alias("missing"), F.count_if(error).alias("errors"), percent(missing).alias("missing_percent"), percent(error).alias("error_percent"))


def status_light(errors: Column, conflicts: Column) -> Column:
    return F.when(conflicts > 0, "red").when(errors > 0, "yellow").otherwise("green")


def without_large_groups(df: DataFrame, by: list[str], most: int) -> DataFrame:
    """Rows of groups of at most ``most`` rows; larger groups wait for another run."""
    large = df.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") > most)
    return df.join(large.drop("n"), by, "left_anti")


def without_dominant_groups(df: DataFrame, by: list[str], share: float) -> DataFrame:
    """Rows of groups that hold at most ``share`` of all rows, whatever the size of the table; null groups are groups."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("__n"))
    total = sizes.agg(F.sum("__n").alias("__all"))
    large = sizes.crossJoin(F.broadcast(total)).filter(F.col("__n") > F.col("__all") * F.lit(share)).select(*[F.col(c).alias(f"__{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    # fewer than 1 / share groups
    return df.join(F.broadcast(large), same, "left_anti")


def duplicate_values(df: DataFrame, value: list[str], owner: str, shown: int = 3) -> DataFrame:
    """Values held by several owners: how many, the first few, and how many more.

    Owners are made distinct, then counted by partial aggregates; of a value only the first ``shown`` are ranked (a
    limit that is applied before the shuffle too), so no row ever holds all owners of a value.
    """
    pairs = df.select(*value, owner).distinct()
    counts = pairs.groupBy(*value).agg(F.count("*").alias("owners"), F.min(owner).alias("first_owner")).filter("owners > 1")
    first = first_of(pairs, value, [owner], shown).groupBy(*value).agg(F.array_join(F.array_sort(F.collect_list(owner)), ", ").alias("__first"))
    text = F.concat("__first", F.when(F.col("owners") > shown, F.format_string(" and %d more", F.col("owners") - shown)).otherwise(""))
    return counts.join(first, value).select(*value, "owners", text.alias("held_by"))


def first_of(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group in order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__rank") <= n).drop("__rank")


def listed(df: DataFrame, by: list[str], order: list, text: Column, shown: int) -> DataFrame:
    """(``by``, listed): the first few of each group in order as one text, and how many more there are; only those are gathered."""
    counts = df.groupBy(*by).agg(F.count("*").alias("__n"))
    ranked = df.withColumn("__text", text).withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__rank") <= shown)
    first = ranked.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__rank", "__text"))), lambda x: x["__text"]), ", ").alias("__first"))
    more = F.when(F.col("__n") > shown, F.format_string(" and %d more", F.col("__n") - shown)).otherwise("")
    return counts.join(first, by).select(*by, F.concat("__first", more).alias("listed"))


def top_counts(df: DataFrame, by: str, n: int = 10) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(by)).limit(n)


def key_counts(df: DataFrame, entries: Column, total: int | None = None) -> DataFrame:
    """How many rows have each key of a map, and their share in percent."""
    all_rows = df.agg(F.count("*").alias("__rows"))
    keys = df.select(F.explode(F.map_keys(entries)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return keys.crossJoin(F.broadcast(all_rows)).select("key", "n", F.round(F.col("n") * 100 / F.col("__rows"), 1).alias("percent"))  # one row


def tally_text(yes: Column, no: Column, total: Column) -> Column:
    return F.format_string("%d-%d-%d", yes, no, total - yes - no)


def seat_coverage(expected: DataFrame, actual: DataFrame, key: list[str], seats: str, holder: str) -> DataFrame:
    """Expected against held seats: ``missing``, ``extra``, ``under``, ``over`` or ``ok``; seats of 0 may be empty."""
    held = actual.groupBy(*key).agg(F.count_distinct(holder).alias("held"))
    both = expected.select(*key, F.col(seats).alias("seats")).join(held, key, "full_outer")
    h, s = F.coalesce("held", F.lit(0)), F.col("seats")
    verdict = (F.when(s.isNull(), "extra").when((h == 0) & (s > 0), "missing").when(h < s, "under").when(h > s, "over").otherwise("ok"))
    return both.select(*key, F.coalesce("seats", F.lit(0)).cast("long").alias("seats"), h.cast("long").alias("held"), verdict.alias("verdict"))


def run_counts(parts: DataFrame, kind: str) -> DataFrame:
    """Partial run reports put together: counts added, earliest start, latest end."""
    return parts.groupBy(kind).agg(F.sum("insert_count").alias("inserted"), F.sum("update_count").alias("updated"), F.sum("noop_count").alias("unchanged"), F.min("start_time").alias("started"), F.max("end_time").alias("ended"))

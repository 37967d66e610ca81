"""Queries of the general training-data operators over the domain tables, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.operators.hierarchy import descendants, resolve_hierarchy
from rollcall.operators.profile import findings, profile, value_counts, with_changes
from rollcall.operators.snapshots import snapshot_changes
from rollcall.operators.timestamps import Rules, normalise_times
from rollcall.session import table

COUNTERS = ["bills_missing_actions", "bills_missing_sponsors", "bills_missing_versions", "votes_missing_voters",
            "votes_missing_bill", "votes_missing_yes_count", "votes_missing_no_count", "votes_with_bad_counts"]
PATTERNS = {"jurisdiction_id": r"^ocd-jurisdiction/country:us/(state|territory):[a-z]{2}/government\z",
            "legislative_session": r"^[0-9]+-(R|S[0-9])\z"}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    bills = snapshot_changes(
        table(spark, sf, "bill_snapshot"), "snapshot_no", "bill_id",
        [F.col("jurisdiction_id"), F.col("legislative_session"), F.col("identifier"), F.col("title"), F.col("from_organization"),
         _bag("classification"), _bag("subject")],
        latest_by=["delivered_at"])
    log = table(spark, sf, "import_objects_snapshot")
    entries = snapshot_changes(log, "snapshot_no", "import_id", [F.col(c) for c in log.columns if c not in ("snapshot_no", "import_id")])
    return (bills.withColumn("table_name", F.lit("bill_snapshot"))
            .unionByName(entries.withColumn("table_name", F.lit("import_objects_snapshot")))
            .select("table_name", "snapshot_no", "record_id", "change_kind"))


def _bag(column: str):
    """Array whose order doesn't count; a null element differs from every text."""
    return F.array_sort(F.transform(F.col(column), lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit(""))))


def p4_found(spark: SparkSession, sf: str, **how) -> DataFrame:
    solved = resolve_hierarchy(table(spark, sf, "division"), "id", "redirect", with_path=False, **how)
    return solved.filter("parent is not null").select(F.col("node").alias("id"), F.col("root").alias("root_id"), "depth", "kind")


def p4_peeled(spark: SparkSession, sf: str) -> DataFrame:
    """The same without a task that ends the peeling: rounds and contraction to the last node."""
    return p4_found(spark, sf, local_nodes=0)


def p4_paths(spark: SparkSession, sf: str) -> DataFrame:
    solved = resolve_hierarchy(table(spark, sf, "division"), "id", "redirect")
    return solved.select(F.col("node").alias("id"), F.col("root").alias("root_id"), "depth", "kind", F.array_join("path", " > ").alias("path"), "subtree")


def p4_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """All divisions that redirect to a division, directly or through others."""
    return descendants(resolve_hierarchy(table(spark, sf, "division"), "id", "redirect")).select(F.col("ancestor").alias("id"), F.col("descendant").alias("descendant_id"), "distance")


def _times(spark: SparkSession, sf: str, prior: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Times of events (both fields in one pass) and birth dates, each with its status."""
    zones = table(spark, sf, "jurisdiction").select("jurisdiction_id", "time_zone").dropDuplicates(["jurisdiction_id"])
    both = F.inline(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("value")) for c in ("start_date", "end_date")]))
    events = (table(spark, sf, "event_listing").select(F.lit("event_listing").alias("table_name"), F.col("listing_id").alias("record_id"), "jurisdiction_id", both)
              .join(F.broadcast(zones), "jurisdiction_id", "left"))  # fixed, 51 rows
    people = table(spark, sf, "person").select(F.lit("person").alias("table_name"), F.col("person_no").alias("record_id"), "jurisdiction_id", F.lit("birth_date").alias("field_name"), F.col("birth_date").alias("value"))
    return (normalise_times(events, "value", ["jurisdiction_id"], F.col("time_zone"), Rules(century=20, prior=prior or {})),
            normalise_times(people, "value", ["jurisdiction_id"], None, Rules(century=19, prior=prior or {})))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    events, births = _times(spark, sf)
    form = lambda df, c: df.filter(F.col("time_status").isin("resolved", "ambiguous")).select("table_name", "record_id", "field_name", F.col(c).alias("normal_form"))
    return form(events, "time_utc").unionByName(form(births, "fuzzy_date"))


def p5_status(spark: SparkSession, sf: str) -> DataFrame:
    """What each value came to if month and day may come in either order: sources decide by their other values, or it stays ambiguous."""
    even = {"mdy": 1.0, "dmy": 1.0}
    events, births = _times(spark, sf, even)
    columns = ["table_name", "record_id", "field_name", "time_status", "time_layout", F.round("time_posterior", 6).alias("time_posterior")]
    return events.select(*columns).unionByName(births.select(*columns))


def p7_profile(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """Profile of all columns of the table, or of ``columns``: a column's rows don't depend on the others."""
    path = f"{sf}/session_quality_report.parquet"
    whole = [c for c, kind in spark.read.parquet(path).dtypes if kind in ("tinyint", "smallint", "int", "bigint")]
    profiled = profile(value_counts(spark, path, "load_no", columns, COUNTERS, PATTERNS), COUNTERS, (0, 100_000), PATTERNS, whole)
    return with_changes(profiled).withColumnRenamed("grp", "load_no")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    found = findings(p7_profile(spark, sf, [*COUNTERS, *PATTERNS]).withColumnRenamed("load_no", "grp"), COUNTERS, list(PATTERNS))
    return found.select(F.col("grp").cast("int").alias("load_no"), "column_name", "finding")


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_peeled": p4_peeled, "p4_paths": p4_paths, "p4_descendants": p4_descendants, "p5_found": p5_found, "p5_status": p5_status, "p7_found": p7_found, "p7_profile": p7_profile}

_BILL = "jurisdiction_id, legislative_session, identifier, title, from_organization, list_sort(classification), list_sort(subject)"
_LOG = "report_id, jurisdiction_id, object_type, insert_count, update_count, noop_count, start_time, end_time"


def _changes(name: str, key: str, content: str, order: str) -> str:
    return f"""SELECT '{name}' AS table_name, coalesce(b.snapshot_no, a.snapshot_no + 1) AS snapshot_no, coalesce(b.k, a.k) AS record_id,
      CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
    FROM (SELECT snapshot_no, {key} AS k, row({content})::VARCHAR AS v FROM {name} QUALIFY row_number() OVER (PARTITION BY snapshot_no, {key} ORDER BY {order}) = 1) b
    FULL JOIN (SELECT snapshot_no, {key} AS k, row({content})::VARCHAR AS v FROM {name} QUALIFY row_number() OVER (PARTITION BY snapshot_no, {key} ORDER BY {order}) = 1) a
      ON a.k = b.k AND a.snapshot_no + 1 = b.snapshot_no
    WHERE coalesce(b.snapshot_no, a.snapshot_no + 1) BETWEEN 2 AND (SELECT max(snapshot_no) FROM {name}) AND (a.k IS NULL OR b.k IS NULL OR a.v <> b.v)"""


_P4 = """WITH RECURSIVE d AS (SELECT id, min(redirect) AS redirect FROM division WHERE id IS NOT NULL GROUP BY id),
 linked AS (SELECT d.id, d.redirect AS stated, CASE WHEN p.id IS NULL THEN NULL ELSE d.redirect END AS parent FROM d LEFT JOIN d p ON p.id = d.redirect),
 walk AS (SELECT id, id AS cur, 0 AS steps, [id] AS seen FROM linked WHERE stated IS NOT NULL
   UNION ALL SELECT w.id, l.parent, w.steps + 1, list_append(w.seen, l.parent) FROM walk w JOIN linked l ON l.id = w.cur
   WHERE l.parent IS NOT NULL AND list_position(w.seen[:-2], w.cur) IS NULL AND (len(w.seen) < 2 OR w.seen[-1] <> w.seen[-2])),
 longest AS (SELECT id, arg_max(seen, steps) AS seen FROM walk GROUP BY id),
 ends AS (SELECT id, seen, seen[-1] AS cur, list_position(seen[:-2], seen[-1]) AS first_at FROM longest)
SELECT id, CASE WHEN first_at IS NULL OR first_at = 0 THEN cur ELSE list_min(seen[first_at:-2]) END AS root_id,
 CAST(CASE WHEN first_at IS NULL OR first_at = 0 THEN len(seen) - 1 ELSE first_at - 1 END AS INTEGER) AS depth,
 CASE WHEN first_at IS NULL OR first_at = 0 THEN 'tree' WHEN first_at = 1 THEN 'cycle' ELSE 'into_cycle' END AS kind FROM ends"""


_P4_PATHS = """WITH RECURSIVE d AS (SELECT id, min(redirect) AS redirect FROM division WHERE id IS NOT NULL GROUP BY id),
 links AS (SELECT d.id, p.id AS parent FROM d LEFT JOIN d p ON p.id = d.redirect),
 walk AS (SELECT id, id AS cur, [id] AS seen FROM links
   UNION ALL SELECT w.id, l.parent, list_append(w.seen, l.parent) FROM walk w JOIN links l ON l.id = w.cur WHERE l.parent IS NOT NULL AND NOT list_contains(w.seen, l.parent)),
 whole AS (SELECT id, arg_max(seen, len(seen)) AS seen FROM walk GROUP BY id),
 closed AS (SELECT w.id, w.seen, list_position(w.seen, l.parent) AS pos FROM whole w JOIN links l ON l.id = w.seen[-1]),
 sizes AS (SELECT cur AS id, count(*) AS subtree FROM walk GROUP BY 1)
SELECT id, CASE WHEN pos > 0 THEN list_min(seen[pos:]) ELSE seen[-1] END AS root_id, CAST(CASE WHEN pos > 0 THEN pos - 1 ELSE len(seen) - 1 END AS INTEGER) AS depth,
 CASE WHEN pos IS NULL OR pos = 0 THEN 'tree' WHEN pos = 1 THEN 'cycle' ELSE 'into_cycle' END AS kind, array_to_string(list_reverse(CASE WHEN pos > 0 THEN seen[1:pos] ELSE seen END), ' > ') AS path, subtree FROM closed JOIN sizes USING (id)"""


_P4_DESCENDANTS = """WITH RECURSIVE d AS (SELECT id, min(redirect) AS redirect FROM division WHERE id IS NOT NULL GROUP BY id),
 links AS (SELECT d.id, d.redirect AS parent FROM d JOIN d p ON p.id = d.redirect),
 walk AS (SELECT id, id AS cur, 0 AS steps, [id] AS seen FROM links
   UNION ALL SELECT w.id, l.parent, w.steps + 1, list_append(w.seen, l.parent) FROM walk w JOIN links l ON l.id = w.cur WHERE NOT list_contains(w.seen, l.parent))
SELECT cur AS id, id AS descendant_id, CAST(steps AS INTEGER) AS distance FROM walk WHERE steps > 0"""


def _p7() -> str:
    columns = "UNION ALL ".join(
        f"SELECT load_no, '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS d, "
        f"count(*) FILTER ({c} < 0 OR {c} > 100000) AS o, avg({c}) FILTER ({c} BETWEEN 0 AND 100000) AS m FROM session_quality_report GROUP BY load_no " for c in COUNTERS)
    both = ("SELECT b.*, a.n AS n0, a.nulls AS nulls0, a.d AS d0, a.m AS m0 FROM c b LEFT JOIN c a ON a.column_name = b.column_name AND a.load_no = b.load_no - 1")
    return f"""WITH c AS ({columns}), x AS ({both})
 SELECT load_no, column_name, 'value_range' AS finding FROM x WHERE o > 0
 UNION ALL SELECT load_no, column_name, 'null_rate' FROM x WHERE abs(nulls * n0 - nulls0 * n) * 10 > n * n0
 UNION ALL SELECT load_no, column_name, 'distinct' FROM x WHERE d * 2 < d0
 UNION ALL SELECT load_no, column_name, 'shift' FROM x WHERE m > 2 * m0 OR m * 2 < m0
 UNION ALL SELECT DISTINCT load_no, 'jurisdiction_id', 'pattern' FROM session_quality_report WHERE NOT regexp_full_match(jurisdiction_id, 'ocd-jurisdiction/country:us/(state|territory):[a-z][a-z]/government')
 UNION ALL SELECT DISTINCT load_no, 'legislative_session', 'pattern' FROM session_quality_report WHERE NOT regexp_full_match(legislative_session, '[0-9]+-(R|S[0-9])')"""


SQL = {
    "p2_found": f"{_changes('bill_snapshot', 'bill_id', _BILL, 'delivered_at DESC')} UNION ALL {_changes('import_objects_snapshot', 'import_id', _LOG, _LOG)}",
    "p4_found": _P4,
    "p4_peeled": _P4,
    "p4_paths": _P4_PATHS,
    "p4_descendants": _P4_DESCENDANTS,
    "p7_found": _p7(),
}

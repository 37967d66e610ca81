"""Probes of reports, resolution, loaders, sources and small functions over whole tables, with the SQL that must agree."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions import ids, text as T, times
from rollcall.operators import diffing, documents, loaders, people, relations, reports, resolve, rollup, upsert
from rollcall.plans import relational
from rollcall.session import scratch_root, table
from rollcall.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SCOPE = ["jurisdiction_id", "legislative_session"]


def probe(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


def _map_sql(rows: str, name: str) -> str:
    """A map of name to count as JSON text with sorted names, per o_orderstatus."""
    return (f"(SELECT o_orderstatus, '{{' || string_agg('\"' || name || '\":' || n, ',' ORDER BY name) || '}}' AS {name} FROM (SELECT o_orderstatus, name, count(*) AS n FROM ({rows}) GROUP BY 1, 2) GROUP BY 1)")


_LINES = "FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE"
_MAPS = {"unmatched_sponsor_people": f"SELECT o_orderstatus, 'line ' || l_linenumber AS name {_LINES} l_linestatus = 'O' AND l_partkey % 5 = 0",
         "unmatched_sponsor_organizations": f"SELECT o_orderstatus, 'line ' || l_linenumber AS name {_LINES} l_linestatus = 'F' AND l_partkey % 5 = 0",
         "unmatched_voters": f"SELECT o_orderstatus, 'supplier ' || l_suppkey AS name {_LINES} l_partkey % 7 = 0"}


@probe(f"""WITH {relational._VOTES_SQL}, v AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, obs.*, dec.* FROM orders o LEFT JOIN obs ON obs.l_orderkey = o.o_orderkey LEFT JOIN dec ON dec.l_orderkey = o.o_orderkey),
 r AS (SELECT o_orderstatus, count(*) AS bills, count(*) FILTER (yes IS NULL) AS bills_missing_actions, count(*) FILTER (o_orderkey % 2 = 0) AS bills_missing_sponsors, count(*) FILTER (o_orderkey % 3 > 0) AS bills_missing_versions,
  count(*) FILTER (yes IS NULL) AS votes_missing_voters, CAST(0 AS BIGINT) AS votes_missing_yes_count, count(*) FILTER (dn IS NULL) AS votes_missing_no_count, count(*) FILTER (o_custkey % 11 = 0) AS votes_missing_bill,
  count(*) FILTER (coalesce(yes,0) <> dy OR coalesce(no,0) <> coalesce(dn,0) OR coalesce(other,0) <> d_o) AS votes_with_bad_counts FROM v GROUP BY 1)
 SELECT r.*, {', '.join(f"coalesce({m}, '{{}}') AS {m}" for m in _MAPS)} FROM r {' '.join(f'LEFT JOIN {_map_sql(q, m)} USING (o_orderstatus)' for m, q in _MAPS.items())}""")
def q01c_session_report(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    declared, observed = relational._line_votes(spark, sf)
    votes = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("bill")).join(observed, "l_orderkey", "left").fillna(0, ["yes", "no", "other"])
    votes = reports.tally_check(declared, votes, "l_orderkey", ["yes", "no", "other"]).withColumn("voters", F.col("yes") + F.col("no") + F.col("other"))
    every = lambda k, r: orders.filter(f"o_orderkey % {k} = {r}").select(F.col("o_orderkey").alias("fk"))
    named = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")
    unresolved = {"unmatched_sponsor_people": named.filter("l_linestatus = 'O' and l_partkey % 5 = 0").withColumn("name", F.concat(F.lit("line "), "l_linenumber")),
                  "unmatched_sponsor_organizations": named.filter("l_linestatus = 'F' and l_partkey % 5 = 0").withColumn("name", F.concat(F.lit("line "), "l_linenumber")),
                  "unmatched_voters": named.filter("l_partkey % 7 = 0").withColumn("name", F.concat(F.lit("supplier "), "l_suppkey"))}
    report = reports.session_report(orders, "o_orderkey", {"actions": lines.select(F.col("l_orderkey").alias("fk")), "sponsors": every(2, 1), "versions": every(3, 0)}, "fk", votes, unresolved, ["o_orderstatus"])
    return report.withColumns({m: F.to_json(m) for m in _MAPS})


@probe("""SELECT o_orderstatus, count(*) AS bills FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1 UNION ALL SELECT 'F', CAST(-1 AS BIGINT)""")
def q01d_replaced_report(spark, sf):
    """A session's report written again takes the place of the one before; the others stay."""
    out = f"{scratch_root(spark)}/report-{uuid.uuid4().hex}"
    report = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("bills"))
    upsert.replace_partition(report, out, "o_orderstatus")
    upsert.replace_partition(spark.range(1).select(F.lit(-1).cast("long").alias("bills"), F.lit("F").alias("o_orderstatus")), out, "o_orderstatus")
    return spark.read.schema("bills bigint, o_orderstatus string").parquet(out)


@probe("""WITH k AS (SELECT DISTINCT jurisdiction_id, legislative_session, lower(trim(n)) AS key, person_no FROM (
   SELECT jurisdiction_id, legislative_session, name AS n, person_no FROM person UNION ALL SELECT jurisdiction_id, legislative_session, family_name, person_no FROM person
   UNION ALL SELECT jurisdiction_id, legislative_session, unnest(other_names).name, person_no FROM person) WHERE trim(n) <> ''),
 seat AS (SELECT *, CASE WHEN person_no % 3 = 0 THEN '' ELSE '2010-01-01' END AS st, CASE WHEN person_no % 4 = 0 THEN '2012-01-01' ELSE '' END AS en FROM person),
 r AS (SELECT scrape_id, jurisdiction_id, legislative_session, lower(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS key, CASE WHEN scrape_id % 2 = 0 THEN chamber END AS ch, CASE WHEN scrape_id % 5 = 0 THEN email END AS ident,
   CASE WHEN scrape_id % 3 > 0 THEN '2012-06-01' ELSE '' END AS s0, CASE WHEN scrape_id % 7 > 0 THEN '2013-06-01' ELSE '' END AS e0 FROM scrape_person),
 ok AS (SELECT r.*, p.person_no, coalesce(p.death_date, '') = '' AS live, p.email AS pid FROM r JOIN seat p USING (jurisdiction_id, legislative_session)
   WHERE (CASE WHEN coalesce(ch, '') <> '' THEN p.chamber = ch ELSE p.chamber IN ('upper', 'lower', 'legislature') END) AND (s0 = '' OR en = '' OR en > s0) AND (e0 = '' OR st = '' OR st < e0)),
 n AS (SELECT scrape_id, count(DISTINCT person_no) AS n, min(person_no) AS one, count(DISTINCT person_no) FILTER (live) AS nl, min(person_no) FILTER (live) AS l FROM ok JOIN k USING (jurisdiction_id, legislative_session, key, person_no) GROUP BY 1),
 i AS (SELECT scrape_id, count(DISTINCT person_no) AS n, min(person_no) AS one, count(DISTINCT person_no) FILTER (live) AS nl, min(person_no) FILTER (live) AS l FROM ok WHERE ident <> '' AND ident = pid GROUP BY 1),
 f AS (SELECT scrape_id, coalesce(CASE WHEN i.n = 1 THEN i.one WHEN i.nl = 1 THEN i.l END, CASE WHEN n.n = 1 THEN n.one WHEN n.nl = 1 THEN n.l END) AS resolved_id, n.n AS n FROM r LEFT JOIN n USING (scrape_id) LEFT JOIN i USING (scrape_id))
 SELECT scrape_id, resolved_id, CASE WHEN resolved_id IS NOT NULL THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM f""".replace("\\\\", "\\"))
def q14b_resolve_person(spark, sf):
    p = table(spark, sf, "person")
    living = p.select(*SCOPE, "person_no", "name", "family_name", "other_names", F.when(F.coalesce("death_date", F.lit("")) == "", F.col("chamber")).alias("x"), F.when(F.coalesce("death_date", F.lit("")) == "", F.lit("member")).alias("current_role"),
                      F.array_compact(F.array("email")).alias("identifiers"))
    seats = p.select(*SCOPE, "person_no", F.col("chamber").alias("classification"), F.when(F.col("person_no") % 3 == 0, "").otherwise("2010-01-01").alias("start_date"), F.when(F.col("person_no") % 4 == 0, "2012-01-01").otherwise("").alias("end_date"))
    refs = table(spark, sf, "scrape_person").select("scrape_id", *SCOPE, "name", F.when(F.col("scrape_id") % 5 == 0, F.col("email")).alias("identifier"), F.when(F.col("scrape_id") % 2 == 0, F.col("chamber")).alias("chamber"),
                                                    F.when(F.col("scrape_id") % 3 > 0, "2012-06-01").otherwise("").alias("start"), F.when(F.col("scrape_id") % 7 > 0, "2013-06-01").alias("end"))
    return resolve.resolve_person(refs, living, seats, "person_no", (["name", "family_name"], ["other_names"]), SCOPE).select("scrape_id", "resolved_id", "status")


@probe("""WITH o AS (SELECT n_nationkey, n_regionkey, lower(n_name) AS k, n_nationkey % 2 AS kind FROM nation UNION ALL SELECT n_nationkey, n_regionkey, 'land of ' || lower(n_name), n_nationkey % 2 FROM nation),
 r AS (SELECT c_custkey, (c_nationkey + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END) % 25 AS nk, n_regionkey, lower(CASE WHEN c_custkey % 4 = 0 THEN 'Land of ' || n_name ELSE n_name END) AS k, c_custkey % 3 AS c3, c_custkey % 5 AS c5 FROM customer JOIN nation ON n_nationkey = c_nationkey)
 SELECT c_custkey, CASE WHEN kind IS NOT NULL AND (c3 > 0 OR kind = 1) AND c5 > 0 THEN o.n_nationkey END AS resolved_id FROM r LEFT JOIN o ON o.k = r.k AND o.n_regionkey = r.n_regionkey""")
def q16b_resolve_organization(spark, sf):
    """Nations as committees of two chambers, found by name or alternative name, class of their own and of what they belong to."""
    n = table(spark, sf, "nation")
    committees = n.select("n_regionkey", F.concat(F.lit("c"), "n_nationkey").alias("id"), F.col("n_name").alias("name"), F.array(F.struct(F.concat(F.lit("Land of "), "n_name").alias("name"))).alias("other_names"), F.lit("committee").alias("classification"),
                          F.when(F.col("n_nationkey") % 2 == 1, "upper").otherwise("lower").alias("parent_id"))
    chambers = spark.range(2).select(F.lit(-1).alias("n_regionkey"), F.when(F.col("id") == 0, "upper").otherwise("lower").alias("id")).select("n_regionkey", "id", F.concat(F.lit("chamber "), "id").alias("name"), F.array().cast("array<struct<name:string>>").alias("other_names"),
                                                                                                                                            F.col("id").alias("classification"), F.lit(None).cast("string").alias("parent_id"))
    refs = table(spark, sf, "customer").join(F.broadcast(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")), "c_nationkey").select(  # 25 rows
        "c_custkey", "n_regionkey", F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("LAND OF "), "n_name")).otherwise(F.col("n_name")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, "upper").alias("chamber"), F.when(F.col("c_custkey") % 5 > 0, "committee").otherwise("party").alias("classification"))
    found = resolve.resolve_organization(refs, committees.unionByName(chambers), "id", ["n_regionkey"], T.org_name)
    return found.select("c_custkey", F.substring("resolved_id", 2, 9).cast("bigint").alias("resolved_id"))


_VOTES = """votes AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS bill, CASE WHEN o_orderkey % 2 = 0 THEN 'v' || o_orderkey END AS identifier, o_orderstatus, o_orderdate FROM orders),
 ok AS (SELECT * FROM votes WHERE bill IS NOT NULL OR identifier IS NOT NULL), a AS (SELECT * FROM ok WHERE o_orderdate < '1997-01-01'),
 b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus) FROM ok WHERE o_orderdate >= '1995-01-01')"""


def _votes(spark, sf):
    o = table(spark, sf, "orders")
    c = F.col
    v = o.select(c("o_orderkey").alias("_id"), F.lit("S").alias("session"), F.when(c("o_orderkey") % 7 > 0, c("o_custkey")).alias("bill"), F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("v"), "o_orderkey")).alias("identifier"),
                 F.concat(F.lit("motion "), "o_orderkey").alias("motion"), c("o_orderdate").cast("string").alias("date"), F.lit("org").alias("organization"), F.when(c("o_orderkey") % 5 == 0, F.concat(F.lit("d"), "o_orderkey")).alias("dedupe_key"), c("o_orderstatus").alias("result"), "o_orderdate")
    stored = v.filter("o_orderdate < '1997-01-01' and (bill is not null or identifier is not null)")
    arrived = v.filter("o_orderdate >= '1995-01-01'").withColumn("result", F.when(c("_id") % 10 == 0, "P").otherwise(c("result")))
    return loaders.load_votes(stored.drop("o_orderdate"), arrived.drop("o_orderdate"), ["result"], ["_id"])


@probe(f"""WITH {_VOTES} SELECT o_orderkey AS _id, CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderstatus = b.o_orderstatus THEN 'noop' ELSE 'update' END AS what FROM b LEFT JOIN a USING (o_orderkey)
 UNION ALL SELECT o_orderkey, 'invalid' FROM votes WHERE bill IS NULL AND identifier IS NULL AND o_orderdate >= '1995-01-01'""")
def q84_vote_outcomes(spark, sf):
    return _votes(spark, sf).outcome


@probe(f"""WITH {_VOTES} SELECT o_orderkey AS _id, o_orderstatus AS result FROM b UNION ALL SELECT o_orderkey, o_orderstatus FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
 AND (bill IS NULL OR bill NOT IN (SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END FROM orders WHERE o_orderdate >= '1995-01-01' AND o_orderkey % 7 > 0))""")
def q84b_votes_after_load(spark, sf):
    return _votes(spark, sf).table.select("_id", "result")


_EVENTS = """e AS (SELECT *, jurisdiction_id || '|' || coalesce(upstream_id, name || '|' || coalesce(description, '') || '|' || start_date || '|' || coalesce(end_date, '')) AS k FROM event_listing)"""


def _listings(spark, sf):
    c = F.col
    return table(spark, sf, "event_listing").select(c("listing_id").alias("_id"), c("jurisdiction_id").alias("jurisdiction"), "name", "description", c("start_date").alias("start"), c("end_date").alias("end"), c("upstream_id").alias("dedupe_key"), "status")


def _events(spark, sf):
    e = _listings(spark, sf)
    return loaders.load_events(e.limit(0).withColumn("deleted", F.lit(False)), e, ["status"], ["_id"])


@probe(f"""WITH {_EVENTS} SELECT what, count(*) AS n FROM (SELECT CASE WHEN k IS NULL THEN 'invalid' WHEN listing_id = max(listing_id) OVER (PARTITION BY upstream_id IS NULL, k) THEN 'insert' ELSE 'duplicate' END AS what FROM e) GROUP BY 1""")
def q85_event_outcomes(spark, sf):
    return _events(spark, sf).outcome.groupBy("what").agg(F.count("*").alias("n"))


@probe(f"""WITH {_EVENTS}, s AS (SELECT listing_id, k, upstream_id IS NULL AS l FROM e WHERE k IS NOT NULL QUALIFY listing_id = max(listing_id) OVER (PARTITION BY upstream_id IS NULL, k)),
 a AS (SELECT listing_id, k, upstream_id IS NULL AS l FROM e WHERE k IS NOT NULL AND listing_id % 3 > 0 QUALIFY listing_id = max(listing_id) OVER (PARTITION BY upstream_id IS NULL, k)),
 t AS (SELECT listing_id FROM s WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = s.k AND a.l = s.l) UNION ALL SELECT listing_id FROM a) SELECT listing_id AS _id, listing_id % 3 = 0 AS deleted FROM t""")
def q85b_events_again(spark, sf):
    """A second batch with two thirds of the listings: the others are flagged."""
    first = _events(spark, sf)
    second = _listings(spark, sf).filter("_id % 3 > 0")
    return loaders.load_events(first.table, second, ["status"], ["_id"]).table.select("_id", "deleted")


_PEOPLE = "a AS (SELECT * FROM person WHERE person_no % 5 > 0), b AS (SELECT * REPLACE (CASE WHEN person_no % 3 = 0 THEN 'x' ELSE email END AS email) FROM person WHERE person_no % 7 > 0)"


def _people(spark, sf, purge=True):
    c = F.col
    p = table(spark, sf, "person")
    docs = p.select(c("person_no").alias("id"), "name", "given_name", "email", "other_names", F.create_map(F.lit("legacy"), F.coalesce("id", F.lit(""))).alias("ids"), F.array().cast("array<struct<scheme:string,identifier:string>>").alias("other_identifiers"),
                    F.when(F.coalesce("primary_party", F.lit("")) == "", F.array().cast("array<struct<name:string,start_date:string,end_date:string>>")).otherwise(F.array(F.struct(c("primary_party").alias("name"), F.lit("").alias("start_date"), F.lit("").alias("end_date")))).alias("party"),
                    F.array(F.struct(c("chamber").alias("type"), "district", F.lit("").alias("start_date"), F.when(c("person_no") % 2 == 0, "2000-01-01").otherwise("").alias("end_date"))).alias("roles"))
    rows = loaders.person_row(docs, "2020-01-01")
    columns = ["name", "given_name", "email", "other_names", "identifiers", "memberships", "primary_party", "current_role"]
    arrived = rows.filter("id % 7 > 0").withColumn("email", F.when(c("id") % 3 == 0, "x").otherwise(c("email")))
    return rows, loaders.load_people(rows.filter("id % 5 > 0"), arrived, columns, purge)


@probe(f"WITH {_PEOPLE} SELECT b.person_no AS id, CASE WHEN a.person_no IS NULL THEN 'insert' WHEN a.email IS NOT DISTINCT FROM b.email THEN 'noop' ELSE 'update' END AS what FROM b LEFT JOIN a USING (person_no)")
def q86_people_outcomes(spark, sf):
    return _people(spark, sf)[1].outcome


@probe(f"WITH {_PEOPLE} SELECT person_no AS id FROM a WHERE person_no NOT IN (SELECT person_no FROM b)")
def q86b_people_missing(spark, sf):
    return _people(spark, sf)[1].missing.select("id")


@probe("""SELECT person_no AS id, coalesce(primary_party, '') AS primary_party, CASE WHEN person_no % 2 = 1 THEN chamber END AS role, CAST(1 + CASE WHEN coalesce(primary_party, '') <> '' THEN 1 ELSE 0 END AS INTEGER) AS memberships, CAST(CASE WHEN coalesce(id, '') <> '' THEN 1 ELSE 0 END AS INTEGER) AS identifiers FROM person""")
def q86c_person_rows(spark, sf):
    return _people(spark, sf)[0].select("id", "primary_party", F.col("current_role.type").alias("role"), F.size("memberships").alias("memberships"), F.size("identifiers").alias("identifiers"))


@probe("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 = 1 THEN 0 ELSE 1 END AS level, CASE WHEN s_suppkey % 10 = 2 THEN 'orphan' WHEN s_suppkey % 4 = 0 THEN 'insert' WHEN s_suppkey % 3 = 0 THEN 'update' WHEN s_suppkey % 10 > 2 OR s_suppkey % 10 = 0 THEN 'noop' ELSE 'noop' END AS what,
 s_suppkey % 4 <> 0 AND s_suppkey % 3 = 0 AS name_changed FROM supplier""")
def q87_committees(spark, sf):
    """Suppliers as committees: each tenth is a parent, one in ten names a parent that isn't there."""
    c = F.col
    s = table(spark, sf, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), F.when(c("s_suppkey") % 10 == 2, "nobody").when(c("s_suppkey") % 10 != 1, "Supplier top").alias("parent_name"), F.lit("committee").alias("classification"), F.array(c("s_nationkey").cast("string")).alias("members"))
    top = spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit("Supplier top").alias("name"), F.lit(None).cast("string").alias("parent_name"), F.lit("committee").alias("classification"), F.array(F.lit("m")).alias("members"))
    docs = s.unionByName(top)
    stored = (docs.filter("id < 0 or id % 4 > 0").withColumn("name", F.when(c("id") % 3 == 0, F.concat(F.lit("Old "), "name")).otherwise(c("name"))).withColumn("parent_id", F.when(c("parent_name").isNotNull(), F.lit(-1).cast("long"))).drop("parent_name"))
    return loaders.load_committees(stored, docs, purge=True).outcome.filter("id >= 0").select("id", "level", "what", "name_changed")


@probe("""SELECT p_partkey, unnest(CASE WHEN p_size % 3 = 0 THEN ['North', 'South'] WHEN p_size % 3 = 1 THEN ['A', 'B'] ELSE list_transform(range(1, p_size + 1), lambda i: CAST(i AS VARCHAR)) END) AS district,
 unnest(CASE WHEN p_size % 3 = 0 THEN [1, 1] WHEN p_size % 3 = 1 THEN [2, 3] ELSE list_transform(range(1, p_size + 1), lambda i: 1) END) AS num_seats FROM part""")
def q78b_seats(spark, sf):
    size = F.col("p_size")
    p = table(spark, sf, "part").select("p_partkey", size.cast("int").alias("n"), F.when(size % 3 == 0, F.array(F.lit("North"), F.lit("South"))).alias("names"), F.when(size % 3 == 1, F.create_map(F.lit("A"), F.lit(2), F.lit("B"), F.lit(3))).alias("map"))
    return loaders.seats(p, "p_partkey", "n", "names", "map")


@probe("""SELECT jurisdiction_id, name, 'legislature' AS classification, NULL AS parent_name FROM jurisdiction UNION ALL SELECT jurisdiction_id, name || ' Senate', 'upper', name FROM jurisdiction WHERE abbr <> 'ne' UNION ALL SELECT jurisdiction_id, name || ' House', 'lower', name FROM jurisdiction WHERE abbr <> 'ne'""")
def q88_organizations(spark, sf):
    j = table(spark, sf, "jurisdiction")
    return loaders.organizations_of(j, "jurisdiction_id", "name", F.col("abbr") == "ne", F.concat("name", F.lit(" Senate")), F.concat("name", F.lit(" House")))


@probe("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS instant, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def q89_instants(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", times.json_instant(F.col("ts")).alias("instant"), times.iso_day(times.json_instant(F.col("ts"))).alias("day"))


@probe("""SELECT event_id, strftime((ts AT TIME ZONE 'America/Chicago'), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS utc FROM events WHERE day(ts) > 15 OR month(ts) NOT IN (3, 11)""")
def q89b_localised(spark, sf):
    """Local times with their zone's offset say the same instants (days of the clock changes left to a unit test)."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")).filter("day(ts) > 15 or month(ts) not in (3, 11)")
    return e.select("event_id", times.json_instant(times.localised(F.col("ts"), F.lit("America/Chicago")).cast("timestamp")).alias("utc"))


@probe("SELECT row_id, identifier FROM bill_snapshot WHERE identifier NOT LIKE '% %'")
def q25b_without_blank(spark, sf):
    return table(spark, sf, "bill_snapshot").filter(T.lacks(F.col("identifier"), " ")).select("row_id", "identifier")


@probe("""SELECT what, count(*) AS n FROM (SELECT CASE WHEN media_type IS NULL THEN 'skipped: no media type' WHEN length(trim(coalesce(raw_text, ''), ' ')) > 0 THEN 'now_fixed' ELSE 'still_error' END AS what FROM bill_version_document WHERE is_error) GROUP BY 1""")
def q90_retried(spark, sf):
    d = table(spark, sf, "bill_version_document").withColumn("reason", F.when(F.col("media_type").isNull(), "no media type"))
    return reports.retried(d, "is_error", "raw_text", "reason")


_STAGE = """k AS (SELECT version_doc_id, bill_id, coalesce(version_note, '') AS version_note, coalesce(version_date, '') AS version_date, media_type, raw_text FROM bill_version_document),
 v AS (SELECT bill_id, version_note, version_date, min(version_doc_id) AS id, arg_min(raw_text, (CASE media_type WHEN 'text/xml' THEN 0 WHEN 'application/pdf' THEN 1 ELSE 2 END, version_doc_id)) FILTER (coalesce(raw_text, '') <> '') AS t FROM k GROUP BY 1, 2, 3),
 s AS (SELECT *, CASE WHEN version_note IN ('Enrolled') THEN 3 WHEN version_note = 'Chaptered' THEN 4 WHEN contains(lower(version_note), 'engross') OR contains(lower(version_note), 'as passed') THEN 2 WHEN contains(lower(version_note), 'amend') OR contains(lower(version_note), 'substitute') THEN 1
   WHEN contains(lower(version_note), 'introduced') OR lower(version_note) IN ('bill text', 'bill') THEN 0 ELSE 99 END AS stage, CASE WHEN regexp_full_match(version_date, '\\d{4}(-\\d{2}(-\\d{2})?)?') THEN version_date ELSE '' END AS d,
   CASE WHEN version_note IN ('Enrolled', 'Bill Text') THEN 0 WHEN contains(lower(version_note), 'as passed') THEN 0.25 ELSE coalesce(TRY_CAST(regexp_extract(version_note, '(\\d+)\\s*$', 1) AS DOUBLE), 0) END AS o FROM v),
 p AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY bill_id ORDER BY stage, d, o, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM s WHERE stage <> 99),
 w AS (SELECT k.version_doc_id, k.raw_text, p.prior FROM k JOIN p USING (bill_id, version_note, version_date) WHERE prior IS NOT NULL AND k.raw_text IS NOT NULL)""".replace("\\\\", "\\")


def _with_prior(spark, sf):
    return rollup.previous_version_text(table(spark, sf, "bill_version_document"), ["bill_id"], "version_note", "version_date", "media_type", "raw_text", "version_doc_id", ["text/xml", "application/pdf"])


@probe(f"WITH {_STAGE} SELECT version_doc_id, md5(prior) AS prior, raw_text = prior AS same FROM w")
def q48c_previous_text(spark, sf):
    d = _with_prior(spark, sf).filter("previous_text is not null and raw_text is not null")
    return d.select("version_doc_id", F.md5(F.encode("previous_text", "UTF-8")).alias("prior"), (F.col("raw_text") == F.col("previous_text")).alias("same"))


@probe(f"""WITH {_STAGE}, l AS (SELECT version_doc_id, unnest(string_split(raw_text, chr(10))) AS x, 1 AS d FROM w UNION ALL SELECT version_doc_id, unnest(string_split(prior, chr(10))), -1 FROM w),
 c AS (SELECT version_doc_id, x, sum(d) AS d FROM l GROUP BY 1, 2) SELECT version_doc_id, CAST(sum(greatest(-d, 0)) AS BIGINT) AS only_old, CAST(sum(greatest(d, 0)) AS BIGINT) AS only_new FROM c GROUP BY 1""")
def q48d_changed_lines(spark, sf):
    """How many lines more either version has, whatever their order: no text is walked in Python."""
    d = _with_prior(spark, sf).filter("previous_text is not null and raw_text is not null")
    side = lambda c, new: d.select("version_doc_id", F.explode(F.split(c, "\n")).alias("line"), F.lit(new).alias("new"))
    return diffing.multiset_differences(side("raw_text", True).unionByName(side("previous_text", False)), ["version_doc_id"], F.col("line"), F.col("new"))


@probe("""SELECT listing_id, trim(name, ' ') AS name, trim(location.name, ' ') AS place, CASE WHEN coalesce(name, '') <> '' THEN name ELSE 'Capitol Office' END AS office, replace(replace(coalesce(description, ''), chr(9), ' '), chr(160), ' ') AS plain, list_sort([coalesce(status, ''), coalesce(classification, '')]) AS kinds FROM event_listing""")
def q91_texts(spark, sf):
    """Small text functions: a tree of transformers, office names, clean blanks, sorted lists."""
    e = table(spark, sf, "event_listing").select("listing_id", "name", "location", "description", "status", "classification")
    blanks = lambda c: F.trim(c)
    place = T.apply_tree(F.col("location"), e.schema["location"].dataType, {"name": blanks})
    kinds = T.cleanup_list(F.array(F.coalesce("status", F.lit("")), F.coalesce("classification", F.lit(""))))
    return e.select("listing_id", T.apply_tree(F.col("name"), e.schema["name"].dataType, blanks).alias("name"), place["name"].alias("place"), T.office_name(F.col("name"), F.lit("capitol")).alias("office"),
                    T.drop_nul(T.clean_text(F.regexp_replace(F.coalesce("description", F.lit("")), "\r", "\n"))).alias("plain"), kinds.alias("kinds"))


@probe(r"""SELECT doc_id, coalesce(array_to_string(list_transform(list_filter(string_split(CASE WHEN text LIKE '%' || chr(10) THEN text[:-2] ELSE text END, chr(10)), lambda x: regexp_matches(x, '^\s*[0-9]+\.? +\S')), lambda x: regexp_extract(x, '^\s*[0-9]+\.? +(\S[^\n]*)$', 1)), chr(10)), '') AS kept
 FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]')""")
def q92_numbered_lines(spark, sf):
    """Text beside numbers at the beginning of lines; texts with other line ends are held by unit tests."""
    d = table(spark, sf, "documents").filter(F.col("text").isNotNull() & ~F.col("text").rlike("[\r\u000b\f\u001c-\u001e\u0085  ]"))
    return d.select("doc_id", T.keep_matching_lines(F.col("text"), r"^\s*[0-9]+\.? +(\S[^\n]*)$").alias("kept"))


@probe("""WITH m AS (SELECT person_no, [primary_party] AS l, ['x'] AS r FROM person) SELECT person_no, CASE WHEN coalesce(primary_party, '') = 'Republican' THEN 1 ELSE 2 END AS parties, 'ocd-person/' || person_no AS typed, coalesce(chamber, '') = coalesce(chamber, '') AND person_no % 2 = 0 AS same_role,
 list_sort(list_distinct(['a', 'b', coalesce(chamber, 'c')])) AS keys FROM person""")
def q93_histories(spark, sf):
    """Party histories, equal roles, united maps."""
    c = F.col
    p = table(spark, sf, "person")
    period = lambda name, end: F.struct(name.alias("name"), F.lit("").alias("start_date"), F.lit(end).alias("end_date"))
    parties = people.merge_party(F.array(period(F.coalesce("primary_party", F.lit("")), "")), period(F.lit("Republican"), ""), "2020-01-01")
    role = lambda end: F.struct(F.coalesce("chamber", F.lit("")).alias("type"), c("jurisdiction_id").alias("jurisdiction"), c("district"), end.alias("end_date"), F.lit(None).cast("string").alias("end_reason"))
    same = people.roles_equalish(role(F.lit("")), role(F.when(c("person_no") % 2 == 0, "").otherwise("2020")))
    united = diffing.map_union(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(1)), F.create_map(F.coalesce("chamber", F.lit("c")), F.lit(2)))
    return p.select("person_no", F.size(parties).alias("parties"), F.concat(F.lit("ocd-person/"), "person_no").alias("typed"), same.alias("same_role"), F.array_sort(F.map_keys(united)).alias("keys"))


@probe("""SELECT jurisdiction_id AS id, name, abbr, true AS found FROM jurisdiction UNION ALL SELECT abbr, name, abbr, true FROM jurisdiction UNION ALL SELECT 'nowhere ' || abbr, NULL, NULL, false FROM jurisdiction""")
def q94_lookup(spark, sf):
    j = table(spark, sf, "jurisdiction")
    refs = j.select(F.explode(F.array(F.col("jurisdiction_id"), F.col("abbr"), F.concat(F.lit("nowhere "), "abbr"))).alias("id"))
    return relations.lookup(refs, "id", j.select("jurisdiction_id", "abbr", "name").withColumn("abbr_key", F.col("abbr")), ["jurisdiction_id", "abbr_key"], ["name", "abbr"])


@probe("""SELECT id, CASE WHEN contains(id, '/sldl:') THEN 'lower' WHEN contains(id, '/sldu:') THEN 'upper' END AS division_chamber FROM (SELECT DISTINCT id FROM division)""")
def q94b_districts(spark, sf):
    d = table(spark, sf, "division").select("id").distinct()
    none = spark.createDataFrame([], "division_id string, state string, chamber string, name string")
    return relations.district_of(d, "id", none).select("id", "division_chamber")


@probe(r"""SELECT version_doc_id, md5(regexp_replace(regexp_replace(raw_text, '\r\n|\r', chr(10), 'g'), '[\x{a0}\t]', ' ', 'g')) AS text FROM bill_version_document WHERE raw_text IS NOT NULL AND lower(trim(split_part(coalesce(media_type, ''), ';', 1))) = 'text/plain'""")
def q95_dispatch(spark, sf):
    """Texts by their medium; here those that are plain text already."""
    d = table(spark, sf, "bill_version_document").select("version_doc_id", "media_type", "raw_text")
    plain = F.lower(F.trim(F.split(F.coalesce("media_type", F.lit("")), ";")[0])) == "text/plain"
    return documents.extract_text(d, "raw_text", "media_type").filter(plain & ~F.col("is_error")).select("version_doc_id", F.md5(F.encode("text", "UTF-8")).alias("text"))


@probe("SELECT jurisdiction_id AS arrival, name, division_id FROM jurisdiction")
def q96_entity_files(spark, sf):
    """Records written as one JSON object a line, read again and told apart by kind."""
    out = f"{scratch_root(spark)}/entities-{uuid.uuid4().hex}"
    j = table(spark, sf, "jurisdiction").select(F.col("jurisdiction_id").alias("arrival"), "name", "division_id")
    files.write_through(j, None, out)
    return spark.read.schema("arrival string, name string, division_id string").json(out)


@probe("SELECT bill_id, CAST(min(x) AS BIGINT) AS first_row, count(*) AS n FROM (SELECT bill_id, source_url, min(version_doc_id) AS x FROM bill_version_document WHERE source_url IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def q44b_group_links(spark, sf):
    d = table(spark, sf, "bill_version_document").filter("source_url is not null").select("bill_id", "source_url", "version_doc_id")
    kept, _ = relations.group_links(d, ["bill_id"], "source_url", [], "version_doc_id")
    return kept.select("bill_id", F.col("links")[0]["version_doc_id"].alias("first_row"), F.size("links").cast("bigint").alias("n"))


@probe("SELECT version_doc_id FROM bill_version_document ORDER BY sha256('7' || CAST(version_doc_id AS VARCHAR)), version_doc_id LIMIT 50")
def q53_random_sample(spark, sf):
    """A sample that anyone can draw again: the first by a hash of the key."""
    return files.sample(table(spark, sf, "bill_version_document").select("version_doc_id"), "version_doc_id", 50, 7)


@probe("""SELECT listing_id, trim(name, ' ') || chr(10) || 'second' AS text, false AS is_error, CAST(NULL AS VARCHAR) AS skipped FROM event_listing WHERE regexp_full_match(name, '[A-Za-z0-9 ,.:-]+') UNION ALL
 SELECT listing_id, NULL, true, 'do not download' FROM event_listing WHERE name IS NULL OR NOT regexp_full_match(name, '[A-Za-z0-9 ,.:-]+')""")
def q47d_conversions(spark, sf):
    """A state's own converter for its pages, and media that aren't read on purpose."""
    plain = F.coalesce(F.col("name").rlike(r"^[A-Za-z0-9 ,.:-]+\z"), F.lit(False))
    e = table(spark, sf, "event_listing").select("listing_id", F.concat(F.lit("<p>"), "name", F.lit("</p><div>out</div><p>second</p>")).alias("page"), F.when(plain, "va").otherwise("zz").alias("state"), F.lit("text/html").alias("media"))
    conversions = documents.standard_conversions().skip("zz", "text/html")
    return documents.extract_text(e, "page", "media", "text", "state", None, conversions).select("listing_id", "text", "is_error", "skipped")


@probe("""SELECT person_no, CAST(person_no % 2 AS INTEGER) AS n_ended, CASE WHEN person_no % 2 = 1 THEN '2020-01-01' ELSE '2000-01-01' END AS end_date, CAST(0 AS INTEGER) AS offices, '2020-01-01' AS death_date FROM person""")
def q72b_retired(spark, sf):
    p = table(spark, sf, "person").select("person_no", F.array(F.struct(F.col("chamber").alias("type"), F.col("district"), F.lit("").alias("start_date"), F.when(F.col("person_no") % 2 == 0, "2000-01-01").otherwise("").alias("end_date"), F.lit("").alias("end_reason"))).alias("roles"),
                                            F.array(F.struct(F.lit("capitol").alias("classification"))).alias("offices"), "death_date")
    return people.retire_people(p, "2020-01-01", "left", death=True).select("person_no", "n_ended", F.col("roles")[0]["end_date"].alias("end_date"), F.size("offices").alias("offices"), "death_date")


@probe("""WITH p AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM person WHERE id IS NOT NULL) SELECT person_no, person_no % 2 = 0 AS inactive, n > 1 AS twice, coalesce(district, '') = '' AS no_district FROM p""")
def q71b_checked_people(spark, sf):
    """Findings of the record checks: no active role, the same id again, a role without a district."""
    p = table(spark, sf, "person").filter("id is not null").select("person_no", "id", "name", "given_name", "family_name", "birth_date", "death_date", "email", F.lit("data/legislature/x.yml").alias("path"),
                                                                     F.array(F.struct(F.lit("upper").alias("type"), F.col("district"), F.lit("").alias("start_date"), F.when(F.col("person_no") % 2 == 0, "2000-01-01").otherwise("").alias("end_date"))).alias("roles"),
                                                                     F.array().cast("array<struct<classification:string,name:string,address:string,voice:string,fax:string>>").alias("offices"))
    has = lambda m: F.array_contains("errors", m)
    rows = people.check_people(p, "path", "2020-01-01")
    flat = rows.select("id", has("no active roles").alias("inactive"), has("duplicate id").alias("twice"), has("role needs a district").alias("no_district"))
    return p.select("person_no", "id").join(flat, "id").select("person_no", "inactive", "twice", "no_district")

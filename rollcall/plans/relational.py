"""Probes of joins, aggregates, windows, set comparisons and the write side, each with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions import text as T
from rollcall.functions.ids import canonical_hash, pseudo_id, read_pseudo_id
from rollcall.operators import dedupe, diffing, intervals, relations, reports, resolve, rollup, upsert
from rollcall.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def probe(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


def _line_votes(spark, sf):
    """Lineitems as votes of an order: R is yes, A is no, N is other; what an order declares is made from its key."""
    lines = table(spark, sf, "lineitem")
    observed = reports.conditional_counts(lines, ["l_orderkey"], {"yes": F.col("l_returnflag") == "R", "no": F.col("l_returnflag") == "A", "other": F.col("l_returnflag") == "N"})
    orders = table(spark, sf, "orders").select("o_orderkey")
    declared = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.expr(
        "filter(array(struct('yes' as option, o_orderkey % 3 as value), struct('no' as option, o_orderkey % 2 as value), struct('other' as option, o_orderkey % 4 as value)), x -> o_orderkey % 7 <> 0 or x.option <> 'no')")).alias("d")).select("l_orderkey", "d.*")
    return declared, observed


_VOTES_SQL = """obs AS (SELECT l_orderkey, count(*) FILTER (l_returnflag='R') AS yes, count(*) FILTER (l_returnflag='A') AS no, count(*) FILTER (l_returnflag='N') AS other FROM lineitem GROUP BY 1),
 dec AS (SELECT o_orderkey AS l_orderkey, o_orderkey % 3 AS dy, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 2 END AS dn, o_orderkey % 4 AS d_o FROM orders)"""


@probe(f"""WITH {_VOTES_SQL}, v AS (SELECT o.o_orderkey, o.o_orderstatus, obs.*, dec.* FROM orders o LEFT JOIN obs ON obs.l_orderkey = o.o_orderkey LEFT JOIN dec ON dec.l_orderkey = o.o_orderkey)
 SELECT o_orderstatus, count(*) AS bills, count(*) FILTER (yes IS NULL) AS bills_missing_lines, count(*) FILTER (o_orderkey % 2 = 0) AS bills_missing_odd,
  count(*) FILTER (yes IS NULL) AS votes_missing_voters, CAST(0 AS BIGINT) AS votes_missing_yes_count, count(*) FILTER (dn IS NULL) AS votes_missing_no_count,
  count(*) FILTER (coalesce(yes,0) <> dy OR coalesce(no,0) <> coalesce(dn,0) OR coalesce(other,0) <> d_o) AS votes_with_bad_counts FROM v GROUP BY 1""")
def q01_quality_report(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    declared, observed = _line_votes(spark, sf)
    all_votes = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus").join(observed, "l_orderkey", "left").fillna(0, ["yes", "no", "other"])
    votes = reports.tally_check(declared, all_votes, "l_orderkey", ["yes", "no", "other"]).withColumn("voters", F.col("yes") + F.col("no") + F.col("other"))
    odd = orders.filter("o_orderkey % 2 = 1")
    return reports.quality_report(orders, "o_orderkey", {"lines": lines.select(F.col("l_orderkey").alias("fk")), "odd": odd.select(F.col("o_orderkey").alias("fk"))}, "fk", votes, ["o_orderstatus"])


@probe(f"WITH {_VOTES_SQL} SELECT obs.l_orderkey, yes, no, other, (yes <> dy OR no <> coalesce(dn, 0) OR other <> d_o) AS bad_counts FROM obs JOIN dec USING (l_orderkey)")
def q01b_tally_check(spark, sf):
    declared, observed = _line_votes(spark, sf)
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return reports.tally_check(declared, observed.join(orders, "l_orderkey", "left_semi"), "l_orderkey", ["yes", "no", "other"]).select("l_orderkey", "yes", "no", "other", "bad_counts")


@probe("SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def q02_missing_children(spark, sf):
    return relations.missing_children(table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@probe("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')")
def q03_has_children(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
    return relations.with_children(table(spark, sf, "customer"), urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@probe("""SELECT s.jurisdiction_id, coalesce(s.party, '') AS party, count(*) AS n FROM scrape_person s WHERE NOT EXISTS
 (SELECT 1 FROM person p WHERE p.jurisdiction_id = s.jurisdiction_id AND p.legislative_session = s.legislative_session AND lower(p.name) = lower(s.name)) GROUP BY 1, 2""")
def q04_unmatched_names(spark, sf):
    scope = ["jurisdiction_id", "legislative_session"]
    people = table(spark, sf, "person").select(*scope, F.lower("name").alias("k")).filter("k is not null").distinct()
    refs = table(spark, sf, "scrape_person").withColumn("k", F.lower("name"))
    left = refs.join(people, [*scope, "k"], "left_anti").withColumn("party", F.coalesce("party", F.lit("")))
    maps = reports.name_counts(left, "party", F.lit(True), ["jurisdiction_id"])
    return maps.select("jurisdiction_id", F.explode("names").alias("party", "n"))


@probe("""SELECT o_custkey, min(o_orderdate) AS first_action_date, max(o_orderdate) AS latest_action_date, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS latest_action_description,
 max(o_orderdate) FILTER (o_orderstatus = 'F') AS latest_passage_date FROM (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, o_orderstatus FROM orders) GROUP BY 1""")
def q05_action_rollup(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("cls", F.array("o_orderstatus"))
    return rollup.action_rollup(o, "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "cls", passage="F")


@probe("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def q06_latest_by_keys(spark, sf):
    return rollup.latest_by(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderpriority")


@probe("""SELECT event_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM events""")
def q07_previous_non_null(spark, sf):
    good = F.when(F.col("event_type") != "error", F.col("value"))
    return rollup.previous_non_null(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], good).select("event_id", "previous")


@probe("""SELECT user_id, day, arg_min(event_id, (CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id)) AS event_id FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events) GROUP BY 1, 2""")
def q08_preferred(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("tie", F.col("event_id"))
    return rollup.preferred(e, ["user_id", "day"], "event_id", "event_type", ["purchase", "click"], "tie")


@probe("""SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS "order" FROM orders""")
def q09_positional_order(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    nested = relations.nest(o.select("o_custkey").distinct(), o, "o_custkey", "o_custkey", ["o_orderdate", "o_orderkey"], "bills")
    return relations.with_order(nested, "bills", ["o_custkey"]).select(F.col("item.o_orderkey").alias("o_orderkey"), "order")


@probe("""WITH i AS (SELECT user_id, event_type = 'error' AS f, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
 r AS (SELECT user_id, g, count(*) FILTER (f) AS n FROM i GROUP BY 1, 2) SELECT user_id, max(n) AS longest_run FROM r GROUP BY 1""")
def q10_consecutive_failures(spark, sf):
    return rollup.longest_run(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


@probe("""WITH i AS (SELECT *, event_type = 'error' AS f, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
 r AS (SELECT *, count(*) FILTER (f) OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS n FROM i) SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM r WHERE n = 2 AND f GROUP BY 1""")
def q10b_breaker_trips(spark, sf):
    return rollup.trips(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 2).select("user_id", "event_id")


@probe("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text")
def q11_first_by_hash(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text").filter("text is not null")
    return dedupe.first_by_hash(d.select("doc_id", "text"), F.col("text"), ["doc_id"]).select("doc_id", "copies")


@probe("SELECT doc_id AS copy, kept FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS kept FROM documents WHERE text IS NOT NULL) WHERE doc_id <> kept")
def q12_duplicate_map(spark, sf):
    return dedupe.duplicate_map(table(spark, sf, "documents"), F.col("text"), "doc_id")


@probe("""WITH t AS (SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2), refs AS (SELECT o_orderkey AS l_orderkey, CAST(o_orderkey % 7 + 1 AS INTEGER) AS l_linenumber FROM orders)
 SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN p END AS resolved_id, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM refs LEFT JOIN t USING (l_orderkey, l_linenumber)""")
def q13_resolve_unique(spark, sf):
    refs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderkey") % 7 + 1).cast("int").alias("l_linenumber"))
    return resolve.resolve_unique(refs, table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")


@probe("""WITH k AS (SELECT DISTINCT jurisdiction_id, legislative_session, lower(trim(n)) AS key, person_no FROM (
   SELECT jurisdiction_id, legislative_session, name AS n, person_no FROM person UNION ALL SELECT jurisdiction_id, legislative_session, family_name, person_no FROM person
   UNION ALL SELECT jurisdiction_id, legislative_session, unnest(other_names).name, person_no FROM person) WHERE trim(n) <> ''),
 r AS (SELECT scrape_id, jurisdiction_id, legislative_session, lower(trim(regexp_replace(name, '\\s+', ' ', 'g'))) AS key FROM scrape_person),
 m AS (SELECT scrape_id, count(DISTINCT person_no) AS n, min(person_no) AS one, count(DISTINCT CASE WHEN coalesce(death_date, '') = '' THEN person_no END) AS nl, min(CASE WHEN coalesce(death_date, '') = '' THEN person_no END) AS live
   FROM r JOIN k USING (jurisdiction_id, legislative_session, key) JOIN person p USING (person_no) GROUP BY 1)
 SELECT scrape_id, CASE WHEN n = 1 THEN one WHEN nl = 1 THEN live END AS resolved_id, CASE WHEN n = 1 OR nl = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status
 FROM scrape_person LEFT JOIN m USING (scrape_id)""")
def q14_resolve_by_names(spark, sf):
    scope = ["jurisdiction_id", "legislative_session"]
    p = table(spark, sf, "person")
    keys = resolve.names_of(p, "person_no", ["name", "family_name"], ["other_names"], scope)
    people = p.select(*scope, "person_no", (F.coalesce("death_date", F.lit("")) == "").alias("serving"))
    return resolve.resolve_by_names(table(spark, sf, "scrape_person").select("scrape_id", *scope, "name"), "name", people, "person_no", keys, scope, current="serving").select("scrape_id", "resolved_id", "status")


@probe(r"""WITH s AS (SELECT DISTINCT legislative_session AS sid, CAST(2008 + CAST(left(legislative_session, 3) AS INTEGER) - 100 AS VARCHAR) || '-01-01' AS st, CASE WHEN legislative_session LIKE '%R' THEN '' ELSE CAST(2009 + CAST(left(legislative_session, 3) AS INTEGER) - 100 AS VARCHAR) || '-06-30' END AS en FROM person WHERE regexp_full_match(legislative_session, '\d{3}-.*')),
 f AS (SELECT row_id, strftime(scraped_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS d FROM bill_snapshot), newest AS (SELECT arg_max(sid, (st, sid)) AS sid FROM s),
 j AS (SELECT row_id, count(sid) AS n, min(sid) AS one FROM f LEFT JOIN s ON d >= st AND (en = '' OR d <= en) GROUP BY 1)
 SELECT row_id, CASE WHEN n = 1 THEN one ELSE (SELECT sid FROM newest) END AS session_id, n = 1 AS exact FROM j""")
def q15_session_of_date(spark, sf):
    sid = F.col("legislative_session")
    number = F.substring(sid, 1, 3).cast("int") - 100
    s = (table(spark, sf, "person").filter(sid.rlike(r"^\d{3}-.*$")).select(sid.alias("sid")).distinct()
         .withColumn("legislative_session", F.col("sid"))
         .select("sid", F.concat((number + 2008).cast("string"), F.lit("-01-01")).alias("start"), F.when(sid.endswith("R"), "").otherwise(F.concat((number + 2009).cast("string"), F.lit("-06-30"))).alias("end")))
    facts = table(spark, sf, "bill_snapshot").select("row_id", F.date_format("scraped_at", "yyyy-MM-dd").alias("d"))
    return resolve.session_of_date(facts, "d", s, "start", "end", "sid").select("row_id", "session_id", "exact")


@probe("""WITH c AS (SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS st, strftime(max(o_orderdate), '%Y-%m-%d') AS en FROM orders GROUP BY 1), y AS (SELECT DISTINCT strftime(o_orderdate, '%Y') AS y FROM orders)
 SELECT o_custkey, y AS year FROM c JOIN y ON en > y || '-01-01' AND st < y || '-12-31'""")
def q16_interval_overlap(spark, sf):
    o = table(spark, sf, "orders")
    spans = o.groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("start"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("end"))
    # the years a span touches are made from the span, so the join is an equi join
    years = o.select(F.date_format("o_orderdate", "yyyy").alias("year")).distinct()
    touched = spans.withColumn("year", F.explode(F.transform(F.sequence(F.substring("start", 1, 4).cast("int"), F.substring("end", 1, 4).cast("int")), lambda y: y.cast("string"))))
    low, high = F.concat("year", F.lit("-01-01")), F.concat("year", F.lit("-12-31"))
    return touched.join(years, "year").filter(intervals.overlaps(F.col("start"), F.col("end"), low, high)).select("o_custkey", "year")


@probe("""WITH t AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS m, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS x FROM orders GROUP BY 1, 2)
 SELECT o.o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o.o_orderkey ELSE t.x END AS linked FROM orders o LEFT JOIN t ON t.o_custkey = o.o_custkey AND t.m = strftime(o.o_orderdate, '%Y-%m')""")
def q17_link_last_wins(spark, sf):
    o = table(spark, sf, "orders").withColumn("m", F.date_format("o_orderdate", "yyyy-MM"))
    source = o.select("o_orderkey", "o_custkey", "m", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("linked"))
    return resolve.link_last(source, o.withColumnRenamed("o_orderkey", "target"), ["o_custkey", "m"], "target", ["o_orderdate", "target"], "linked").select("o_orderkey", "linked")


@probe("""WITH r AS (SELECT l_orderkey, strftime(l_shipdate, '%Y') AS y, count(DISTINCT l_partkey) AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2), l AS (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y, o_orderdate FROM orders),
 j AS (SELECT l.*, n, p FROM l LEFT JOIN r ON r.l_orderkey = l.o_orderkey AND r.y = l.y), f AS (SELECT p, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM j WHERE n = 1 GROUP BY 1)
 SELECT o_orderkey, CASE WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'several' WHEN k <> o_orderkey THEN 'taken' ELSE 'matched' END AS status, CASE WHEN n = 1 AND k = o_orderkey THEN j.p END AS matched_id FROM j LEFT JOIN f ON f.p = j.p""")
def q18_one_to_one_match(spark, sf):
    left = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy").alias("y"), "o_orderdate")
    right = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.date_format("l_shipdate", "yyyy").alias("y"), "l_partkey")
    return resolve.match_one_to_one(left, right, ["k", "y"], "o_orderkey", "l_partkey", "o_orderdate").select("o_orderkey", "status", "matched_id")


@probe("""WITH r AS (SELECT DISTINCT person_no, c, lower(p) AS piece FROM (SELECT person_no, unnest([chamber, 'legislature']) AS c, unnest([given_name, given_name]) AS p FROM person UNION ALL SELECT person_no, unnest([chamber, 'legislature']), unnest([family_name, family_name]) FROM person) WHERE p IS NOT NULL AND p <> '' AND c IS NOT NULL)
 SELECT c AS chamber, piece, min(person_no) AS person_no FROM r GROUP BY 1, 2 HAVING count(DISTINCT person_no) = 1""")
def q19_name_matcher(spark, sf):
    p = table(spark, sf, "person").filter("chamber is not null")
    pieces = F.filter(F.array("given_name", "family_name"), lambda x: x.isNotNull() & (x != ""))
    return resolve.unique_names(p, "person_no", "chamber", pieces)


@probe("SELECT DISTINCT id FROM division WHERE starts_with(id, 'ocd-division/country:us/state:wi/') AND len(string_split(id, '/')) BETWEEN 4 AND 5 AND starts_with(string_split(id, '/')[-1], 'county:')")
def q20_children_of(spark, sf):
    return relations.children_of(table(spark, sf, "division"), "id", "ocd-division/country:us/state:wi", 2, "county").select("id").distinct()


@probe("""WITH RECURSIVE t AS (SELECT p_partkey AS k, CASE WHEN p_partkey > 1 THEN p_partkey // 2 END AS p FROM part), up AS (SELECT k, p AS ancestor, 1 AS distance FROM t WHERE p IS NOT NULL UNION ALL
 SELECT up.k, t.p, distance + 1 FROM up JOIN t ON t.k = up.ancestor WHERE t.p IS NOT NULL) SELECT k AS p_partkey, ancestor, distance FROM up""")
def q21_ancestors(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") > 1, F.floor(F.col("p_partkey") / 2)).alias("parent"))
    return relations.ancestors(parts, "p_partkey", "parent")


_SHIP = "FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 5 = 0 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS st, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS en FROM lineitem)"


def _ship_windows(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") % 5 == 0, "").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("st"),
                                               F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.date_format(F.date_add("l_shipdate", 30), "yyyy-MM-dd")).alias("en"))


@probe(f"SELECT l_linenumber, count(*) FILTER ((st = '' OR st <= '1996-03-13') AND (en = '' OR en >= '1996-03-13')) AS current, count(*) FILTER ((st = '' OR st <= '1996-03-13') AND (en = '' OR en > '1996-03-13')) AS active {_SHIP} GROUP BY 1")
def q22_current_and_active(spark, sf):
    s, e = F.col("st"), F.col("en")
    return _ship_windows(spark, sf).groupBy("l_linenumber").agg(F.count_if(intervals.current(s, e, "1996-03-13")).alias("current"), F.count_if(intervals.is_active(s, e, "1996-03-13")).alias("active"))


@probe(f"SELECT l_linenumber, count(*) FILTER (((st = '' OR st <= '1996-03-13') AND en = '') OR (en <> '' AND en >= '1996-03-13')) AS loose, count(*) FILTER ((st = '' OR st <= '1996-03-13') AND (en = '' OR en >= '1996-03-13')) AS strict {_SHIP} GROUP BY 1")
def q24_member_of(spark, sf):
    s, e = F.col("st"), F.col("en")
    return _ship_windows(spark, sf).groupBy("l_linenumber").agg(F.count_if(intervals.member_now(s, e, "1996-03-13")).alias("loose"), F.count_if(intervals.member_now(s, e, "1996-03-13", strict=True)).alias("strict"))


@probe("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring')")
def q25_search_contains(spark, sf):
    return table(spark, sf, "part").filter(T.contains_word(F.col("p_name"), "RING")).select("p_partkey", "p_name")


@probe("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders), n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
 SELECT r.o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY k) FILTER (k <= 5) || CASE WHEN any_value(n) > 5 THEN ' and ' || (any_value(n) - 5) || ' more' ELSE '' END AS bills,
  count(*) FILTER (o_orderstatus = 'F') || '-' || count(*) FILTER (o_orderstatus = 'O') || '-' || count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS tally FROM r JOIN n ON n.o_custkey = r.o_custkey GROUP BY r.o_custkey""")
def q26_listing(spark, sf):
    o = table(spark, sf, "orders")
    counts = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("yes"), F.count_if(F.col("o_orderstatus") == "O").alias("no"), F.count("*").alias("n"))
    shown = reports.listed(o, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], F.col("o_orderkey").cast("string"), 5)
    return counts.join(shown, "o_custkey").select("o_custkey", F.col("listed").alias("bills"), reports.tally_text(F.col("yes"), F.col("no"), F.col("n")).alias("tally"))


@probe("SELECT raw_id, jurisdiction_id FROM event_raw WHERE jurisdiction_id NOT IN (SELECT jurisdiction_id FROM event_raw WHERE jurisdiction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 60) OR jurisdiction_id IS NULL")
def q27_throttle_large_groups(spark, sf):
    return reports.without_large_groups(table(spark, sf, "event_raw"), ["jurisdiction_id"], 60).select("raw_id", "jurisdiction_id")


@probe("SELECT raw_id, jurisdiction_id FROM (SELECT raw_id, jurisdiction_id, count(*) OVER (PARTITION BY jurisdiction_id) AS n, count(*) OVER () AS rows FROM event_raw) WHERE n * 20 <= rows")
def q27b_throttle_dominant_groups(spark, sf):
    return reports.without_dominant_groups(table(spark, sf, "event_raw"), ["jurisdiction_id"], 0.05).select("raw_id", "jurisdiction_id")


@probe("""SELECT coalesce(lang, '') AS lang, count(*) AS total, count(*) FILTER (text IS NULL OR text = '') AS missing, count(*) FILTER (n_chars IS NULL) AS errors, CAST(ceil(count(*) FILTER (text IS NULL OR text = '') * 100.0 / count(*)) AS BIGINT) AS missing_percent,
 CAST(ceil(count(*) FILTER (n_chars IS NULL) * 100.0 / count(*)) AS BIGINT) AS error_percent FROM documents GROUP BY 1""")
def q28_coverage(spark, sf):
    d = table(spark, sf, "documents").withColumn("lang", F.coalesce("lang", F.lit("")))
    return reports.coverage(d, ["lang"], F.coalesce("text", F.lit("")) == "", F.col("n_chars").isNull())


_AB = "a AS (SELECT * FROM orders WHERE o_orderdate < '1997-01-01'), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= '1995-01-01')"


def _snapshots(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter("o_orderdate < '1997-01-01'"), o.filter("o_orderdate >= '1995-01-01'").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, "P").otherwise(F.col("o_orderstatus")))


@probe(f"WITH {_AB} SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderstatus = b.o_orderstatus THEN 'noop' ELSE 'update' END AS what, count(*) AS n FROM b LEFT JOIN a USING (o_orderkey) GROUP BY 1")
def q29_outcome_counts(spark, sf):
    a, b = _snapshots(spark, sf)
    return upsert.outcomes(a, b, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"]).groupBy("what").agg(F.count("*").alias("n"))


@probe(f"WITH {_AB} SELECT o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus FROM a FULL JOIN b USING (o_orderkey)")
def q30_snapshot_merge(spark, sf):
    a, b = _snapshots(spark, sf)
    return upsert.merged(a, b, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@probe(f"WITH {_AB} SELECT o_orderkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderstatus <> a.o_orderstatus THEN 'update' ELSE 'noop' END AS what FROM a FULL JOIN b USING (o_orderkey)")
def q31_keyed_merge(spark, sf):
    a, b = _snapshots(spark, sf)
    return upsert.keyed_merge(a, b, ["o_orderkey"], ["o_orderstatus"])


@probe("SELECT listing_id, listing_id NOT IN (SELECT listing_id FROM event_listing WHERE scraped_at >= TIMESTAMPTZ '2015-01-01 00:00:00+00') AS deleted FROM event_listing")
def q32_soft_delete(spark, sf):
    e = table(spark, sf, "event_listing").select("listing_id", "deleted", "scraped_at")
    return upsert.soft_delete(e, e.filter("scraped_at >= timestamp'2015-01-01 00:00:00'"), "listing_id").select("listing_id", "deleted")


@probe("""WITH i AS (SELECT * FROM orders WHERE o_orderdate >= '1997-01-01') SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM i) OR o_orderkey IN (SELECT o_orderkey FROM i)""")
def q33_stale_delete(spark, sf):
    o = table(spark, sf, "orders")
    return upsert.stale_delete(o, o.filter("o_orderdate >= '1997-01-01'"), "o_custkey", "o_orderkey").select("o_orderkey")


@probe("""WITH a AS (SELECT o_custkey, count(*) AS n FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1)
 SELECT o_custkey, CASE WHEN a.n IS NULL THEN 'add' WHEN b.n IS NULL THEN 'remove' WHEN a.n = b.n THEN 'same' ELSE 'merge' END AS plan FROM a FULL JOIN b USING (o_custkey)""")
def q34_merge_plan(spark, sf):
    o = table(spark, sf, "orders")
    per = lambda y: o.filter(F.year("o_orderdate") == y).groupBy("o_custkey").agg(F.count("*").alias("n"))
    return diffing.merge_plan(per(1995), per(1996), ["o_custkey"], ["n"])


@probe("""WITH f AS (SELECT l_orderkey, list_sort(list(l_returnflag)) AS s FROM lineitem GROUP BY 1) SELECT o.o_orderkey, coalesce(a.s, []) = coalesce(b.s, []) AS equal FROM orders o LEFT JOIN f a ON a.l_orderkey = o.o_orderkey LEFT JOIN f b ON b.l_orderkey = o.o_orderkey + 1""")
def q35_multiset_equal(spark, sf):
    flags = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    a = flags.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", F.lit(False).alias("new"))
    b = flags.select((F.col("l_orderkey") - 1).alias("o_orderkey"), "l_returnflag", F.lit(True).alias("new"))
    differ = diffing.multiset_differences(a.unionByName(b), ["o_orderkey"], F.col("l_returnflag"), F.col("new"))
    return table(spark, sf, "orders").select("o_orderkey").join(differ, "o_orderkey", "left").select("o_orderkey", (F.coalesce(F.col("only_old") + F.col("only_new"), F.lit(0)) == 0).alias("equal"))


@probe("""WITH e AS (SELECT n_nationkey AS k, seg, n_nationkey % 5 * 3 AS seats FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer) WHERE n_nationkey % 7 <> 0), h AS (SELECT c_nationkey AS k, c_mktsegment AS seg, count(DISTINCT c_custkey) AS held FROM customer GROUP BY 1, 2)
 SELECT k AS c_nationkey, seg AS c_mktsegment, CAST(coalesce(seats, 0) AS BIGINT) AS seats, CAST(coalesce(held, 0) AS BIGINT) AS held,
  CASE WHEN seats IS NULL THEN 'extra' WHEN coalesce(held, 0) = 0 AND seats > 0 THEN 'missing' WHEN coalesce(held, 0) < seats THEN 'under' WHEN coalesce(held, 0) > seats THEN 'over' ELSE 'ok' END AS verdict FROM e FULL JOIN h USING (k, seg)""")
def q36_seat_coverage(spark, sf):
    c = table(spark, sf, "customer")
    segments = c.select("c_mktsegment").distinct()
    nations = table(spark, sf, "nation").filter("n_nationkey % 7 <> 0").select(F.col("n_nationkey").alias("c_nationkey"))
    expected = nations.withColumn("j", F.lit(1)).join(F.broadcast(segments.withColumn("j", F.lit(1))), "j").select("c_nationkey", "c_mktsegment", (F.col("c_nationkey") % 5 * 3).alias("seats"))  # 25 nations, 5 segments
    return reports.seat_coverage(expected, c, ["c_nationkey", "c_mktsegment"], "seats", "c_custkey")


@probe("""WITH g AS (SELECT identifier, count(DISTINCT bill_id) AS owners, list_sort(list(DISTINCT bill_id)) AS l FROM bill_snapshot GROUP BY 1)
 SELECT identifier, owners, array_to_string(l[1:3], ', ') || CASE WHEN owners > 3 THEN ' and ' || (owners - 3) || ' more' ELSE '' END AS held_by FROM g WHERE owners > 1 AND identifier IS NOT NULL""")
def q37_duplicate_values(spark, sf):
    b = table(spark, sf, "bill_snapshot").filter("identifier is not null")
    return reports.duplicate_values(b, ["identifier"], "bill_id")


@probe("""WITH o AS (SELECT o_custkey, o_orderpriority AS k, min(o_orderkey) AS v FROM orders WHERE year(o_orderdate) = 1995 GROUP BY 1, 2), n AS (SELECT o_custkey, o_orderpriority AS k, min(o_orderkey) AS v FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1, 2),
 u AS (SELECT o_custkey, k, coalesce(n.v, o.v) AS v, CASE WHEN o.v IS NULL THEN 1 ELSE 0 END AS side, coalesce(o.v, n.v) AS pos FROM o FULL JOIN n USING (o_custkey, k))
 SELECT o_custkey, k, v, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY side, pos) - 1 AS INTEGER) AS position FROM u""")
def q38_keyed_list_union(spark, sf):
    o = table(spark, sf, "orders")
    per = lambda y: o.filter(F.year("o_orderdate") == y).groupBy("o_custkey", F.col("o_orderpriority").alias("k")).agg(F.min("o_orderkey").alias("v"))
    return diffing.keyed_list_union(per(1995), per(1996), ["o_custkey"], "k", "v").select("o_custkey", "k", "v", "position")


@probe("""SELECT k AS key, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM events), 1) AS percent FROM (SELECT unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL) GROUP BY 1""")
def q39_map_counts(spark, sf):
    return reports.key_counts(table(spark, sf, "events"), F.from_json("props", "map<string,string>"))


@probe("""SELECT s_suppkey, '~{"nation":"' || s_nationkey || '","supplier":"' || s_name || '"}' AS pseudo, s_name AS supplier FROM supplier""")
def q40_pseudo_id(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", pseudo_id(supplier=F.col("s_name"), nation=F.col("s_nationkey")).alias("pseudo"))
    return s.withColumn("supplier", read_pseudo_id(F.col("pseudo"))["supplier"])


@probe("""SELECT time_bucket(INTERVAL '15 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q50_tumbling_15m(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy(F.window("ts", "15 minutes").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@probe("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, ts ORDER BY event_id) AS k FROM events) WHERE k = 1")
def q51_dedupe_replay(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return upsert.insert_absent(e.filter("false"), e.unionByName(e), ["user_id", "event_type", "ts"], ["event_id"]).select("event_id", "user_id")


@probe("SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN DATE '1996-03-01' - INTERVAL 30 DAY AND DATE '1996-03-01' + INTERVAL 90 DAY")
def q52_date_window(spark, sf):
    low, high = intervals.sliding_window(F.lit("1996-03-01").cast("date"))
    return table(spark, sf, "orders").filter(F.col("o_orderdate").between(low, high)).select("o_orderkey")


@probe("""SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def q55a_cascade(spark, sf):
    gone = table(spark, sf, "nation").filter("n_regionkey = 1")
    return relations.cascade(table(spark, sf, "customer"), gone, "c_nationkey", "n_nationkey").select("c_custkey")


@probe("""SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer""")
def q55b_set_null(spark, sf):
    gone = table(spark, sf, "nation").filter("n_regionkey = 1")
    return relations.set_null(table(spark, sf, "customer"), gone, "c_nationkey", "n_nationkey").select("c_custkey", "c_nationkey")


@probe("""SELECT count(*) AS blocking FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def q55c_protect(spark, sf):
    gone = table(spark, sf, "nation").filter("n_regionkey = 1")
    return relations.protected(table(spark, sf, "customer"), gone, "c_nationkey", "n_nationkey").agg(F.count("*").alias("blocking"))


@probe("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def q56_top_counts(spark, sf):
    return reports.top_counts(table(spark, sf, "events"), "event_type", 3)


@probe("""SELECT object_type, CAST(sum(insert_count) AS BIGINT) AS inserted, CAST(sum(update_count) AS BIGINT) AS updated, CAST(sum(noop_count) AS BIGINT) AS unchanged, strftime(min(start_time) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS started, strftime(max(end_time) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ended FROM import_objects_snapshot GROUP BY 1""")
def q57_run_counts(spark, sf):
    return reports.run_counts(table(spark, sf, "import_objects_snapshot"), "object_type").withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started", "ended")})


@probe("""SELECT DISTINCT legislative_session FROM bill_snapshot WHERE legislative_session NOT IN (SELECT DISTINCT legislative_session FROM person WHERE legislative_session IS NOT NULL)""")
def q58_unaccounted_sessions(spark, sf):
    return diffing.unaccounted(table(spark, sf, "bill_snapshot").filter("legislative_session is not null"), table(spark, sf, "person"), "legislative_session")


@probe("""WITH k AS (SELECT bill_id, CASE WHEN identifier IS NOT NULL THEN 'identifier' || chr(1) || legislative_session || chr(1) || identifier ELSE 'title' || chr(1) || legislative_session || chr(1) || title END AS k FROM bill_snapshot)
 SELECT k AS match_key, count(DISTINCT bill_id) AS n FROM k WHERE k IS NOT NULL GROUP BY 1 HAVING count(DISTINCT bill_id) > 1""")
def q59_match_key_conflicts(spark, sf):
    b = table(spark, sf, "bill_snapshot")
    c = F.col
    key = upsert.match_key([("identifier", [c("legislative_session"), c("identifier")]), ("title", [c("legislative_session"), c("title")])])
    rows = b.select("bill_id", key.alias("match_key")).filter("match_key is not null").distinct()
    return upsert.duplicate_targets(rows, ["match_key"])


_KEYS = "jurisdiction_id || '|' || legislative_session || '|'"


@probe(f"""WITH n AS (SELECT scrape_id, {_KEYS} || lower(name) AS nm, {_KEYS} || chamber || '|' || district AS seat FROM scrape_person), o AS (SELECT person_no, {_KEYS} || lower(name) AS nm, {_KEYS} || chamber || '|' || district AS seat FROM person),
 b AS (SELECT scrape_id, o.person_no AS o, coalesce(n.nm = o.nm, false) AS sn, n.seat IS NOT DISTINCT FROM o.seat AS sr FROM n JOIN o ON n.nm = o.nm UNION SELECT scrape_id, o.person_no, coalesce(n.nm = o.nm, false), n.seat IS NOT DISTINCT FROM o.seat FROM n JOIN o ON n.seat = o.seat),
 m AS (SELECT scrape_id, arg_min(o, (NOT (sn AND sr), NOT sn, o)) AS person_no, arg_min(sn AND sr, (NOT (sn AND sr), NOT sn, o)) AS both_same FROM b GROUP BY 1)
 SELECT n.scrape_id, person_no, CASE WHEN person_no IS NULL THEN 'new' WHEN both_same THEN 'auto' ELSE 'review' END AS decision FROM n LEFT JOIN m USING (scrape_id)""")
def q60_match_people(spark, sf):
    scope = F.concat_ws("|", "jurisdiction_id", "legislative_session")
    both = lambda t, k: table(spark, sf, t).filter("jurisdiction_id is not null and legislative_session is not null").select(
        k, F.concat(scope, F.lit("|"), F.lower("name")).alias("nm"), F.concat(scope, F.lit("|"), F.col("chamber"), F.lit("|"), F.col("district")).alias("seat"))
    new = both("scrape_person", "scrape_id").withColumn("seats", F.lit(1))
    return resolve.match_people(new, both("person", "person_no"), "scrape_id", "person_no", "nm", ["seat"], "seats")


@probe("""SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 = 0 THEN l_partkey + 1 ELSE l_partkey END AS l_partkey FROM lineitem""")
def q61_merge_redirect(spark, sf):
    moves = table(spark, sf, "part").filter("p_partkey % 10 = 0").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 1).alias("new"))
    return resolve.redirect(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", moves, "old", "new")


@probe("""WITH d AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS kept FROM documents WHERE text IS NOT NULL) SELECT e.doc_id, coalesce(kept, e.doc_id) * 10 AS stored FROM documents e LEFT JOIN d USING (doc_id)""")
def q62_map_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    copies = dedupe.duplicate_map(table(spark, sf, "documents"), F.col("text"), "doc_id")
    ids = docs.select(F.col("doc_id").alias("arrival"), (F.col("doc_id") * 10).alias("stored"))
    return resolve.map_ids(docs, "doc_id", copies, ids)


@probe("""SELECT a.bill_id, (list_sort(coalesce(a.subject, [])) = list_sort(coalesce(b.subject, []))) AS same_subjects, len(coalesce(a.subject, [])) <> len(coalesce(b.subject, [])) OR len(list_filter(coalesce(a.subject, []), lambda x: NOT list_contains(coalesce(b.subject, []), x))) > 0 AS replaced,
 array_to_string(list_sort(list_distinct(list_concat(coalesce(a.subject, []), coalesce(b.subject, [])))), '|') AS appended
 FROM (SELECT bill_id, arg_max(subject, delivered_at) AS subject FROM (SELECT bill_id, coalesce(subject, []) AS subject, delivered_at FROM bill_snapshot WHERE snapshot_no = 7) GROUP BY 1) a
 JOIN (SELECT bill_id, arg_max(subject, delivered_at) AS subject FROM (SELECT bill_id, coalesce(subject, []) AS subject, delivered_at FROM bill_snapshot WHERE snapshot_no = 8) GROUP BY 1) b USING (bill_id)""")
def q63_child_rows_differ(spark, sf):
    b = table(spark, sf, "bill_snapshot").withColumn("subject", F.coalesce("subject", F.array().cast("array<string>")))
    at = lambda n, name: b.filter(F.col("snapshot_no") == n).groupBy("bill_id").agg(F.max_by("subject", "delivered_at").alias(name))
    both = at(7, "a").join(at(8, "b"), "bill_id")
    return both.select("bill_id", diffing.multiset_equal(F.col("a"), F.col("b")).alias("same_subjects"), diffing.replaced(F.col("a"), F.col("b")).alias("replaced"),
                       F.array_join(F.array_sort(F.array_distinct(diffing.append_missing(F.col("a"), F.col("b")))), "|").alias("appended"))


@probe("""WITH c AS (SELECT o_custkey, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT o_custkey, max(o_totalprice) AS top, count(*) AS n FROM orders WHERE o_orderdate < '1998-01-01' GROUP BY 1) SELECT c.* FROM c LEFT JOIN s USING (o_custkey) WHERE c.top IS DISTINCT FROM s.top OR c.n IS DISTINCT FROM s.n""")
def q64_recompute_changed(spark, sf):
    o = table(spark, sf, "orders")
    agg = lambda d: d.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"), F.count("*").alias("n"))
    return rollup.changed_only(agg(o), agg(o.filter("o_orderdate < '1998-01-01'")), "o_custkey", ["top", "n"])


@probe("SELECT n_nationkey, r_name || ' / ' || n_name AS label FROM nation JOIN region ON n_regionkey = r_regionkey")
def q65_fk_traversal(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.concat_ws(" / ", "r_name", "n_name").alias("label"))


@probe("""SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) = (SELECT list_sort(list(DISTINCT o_orderstatus)) FROM orders x WHERE x.o_custkey = o.o_custkey AND year(o_orderdate) >= 1996) AS equal FROM orders o GROUP BY 1 HAVING count(*) FILTER (year(o_orderdate) >= 1996) > 0""")
def q66_set_equality(spark, sf):
    o = table(spark, sf, "orders")
    late = o.filter(F.year("o_orderdate") >= 1996)
    return diffing.set_equal(o.join(late.select("o_custkey"), "o_custkey", "left_semi"), late, ["o_custkey"], ["o_orderstatus"])


@probe("SELECT jurisdiction_id, strftime(max(updated_at) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS latest FROM person GROUP BY 1")
def q67_touched_stamp(spark, sf):
    p = table(spark, sf, "person")
    parents = p.select("jurisdiction_id").distinct().withColumn("latest", F.lit(None).cast("timestamp"))
    stamps = p.groupBy("jurisdiction_id").agg(F.max("updated_at").alias("stamp"))
    return upsert.touched(parents.join(stamps, "jurisdiction_id"), p, "jurisdiction_id", F.col("stamp"), "latest").select("jurisdiction_id", F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"))


@probe("SELECT (SELECT count(DISTINCT (jurisdiction_id, legislative_session, identifier, title)) FROM bill_snapshot) AS contents")
def q68_omnihash(spark, sf):
    cols = ["jurisdiction_id", "legislative_session", "identifier", "title"]
    b = table(spark, sf, "bill_snapshot").select(canonical_hash(*[F.col(c) for c in cols]).alias("h"))
    return b.agg(F.count_distinct("h").alias("contents"))

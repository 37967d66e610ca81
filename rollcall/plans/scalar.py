"""Probes of scalar functions, documents, people's records, sources and streams, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.functions import ids, text as T, validate as V, versions
from rollcall.functions.cleaning import PROFILES, clean_pair
from rollcall.operators import documents, people, rollup
from rollcall.session import scratch_root, table
from rollcall.sources import files
from rollcall.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def probe(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


@probe(r"""SELECT p_partkey, chr(65 + CAST(p_size % 3 AS INTEGER)) || 'B ' || p_size AS fixed FROM part""")
def q41_bill_id_normalise(spark, sf):
    raw = F.concat(F.chr(F.lit(97) + F.col("p_size") % 3), F.lit("b"), F.lpad(F.col("p_size").cast("string"), 5, "0"))
    return table(spark, sf, "part").select("p_partkey", T.fix_bill_id(raw).alias("fixed"))


@probe(r"""SELECT bill_id, snapshot_no, row_id, trim(regexp_replace(upper(identifier), '([A-Z]*)\s*0*([-\d]+)', '\1 \2')) AS fixed FROM bill_snapshot""")
def q41b_bill_identifiers(spark, sf):
    return table(spark, sf, "bill_snapshot").select("bill_id", "snapshot_no", "row_id", T.fix_bill_id(F.col("identifier")).alias("fixed"))


@probe(r"""SELECT c_custkey, '555-' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || CASE WHEN c_custkey % 4 = 0 THEN ' ext. ' || (c_custkey % 90 + 1) ELSE '' END AS phone,
 c_name || ';Room ' || c_nationkey AS address, regexp_replace(replace(c_name, ' ', '-'), '[^a-zA-Z-]', '', 'g') AS slug FROM customer""")
def q42_phone_address_slug(spark, sf):
    c = table(spark, sf, "customer")
    raw = F.concat(F.lit("(555) "), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit(". "), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"),
                   F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(" Ext. "), (F.col("c_custkey") % 90 + 1).cast("string"))).otherwise(""))
    address = F.concat("c_name", F.lit("  \n\n Room \t"), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", T.reformat_phone(raw).alias("phone"), T.reformat_address(address).alias("address"), T.file_slug(F.col("c_name")).alias("slug"))


NOTES = ["Introduced", "Substitute (S-2)", "Substitute (S-2) - 3", "Second Substitute", "Engrossed Second Substitute", "House Engrossed", "Senate - Floor amendment", "Enrolled", "Reenrolled", "Governor's Veto Explanation",
         "Chaptered", "Public Act 12", "c2", "e1", "Bill Text", "Amendment 1", "Conference report", "who knows", "bill", "Substitute #3"]
_EXPECTED = [(0, 0.0), (1, 2.0), (1, 2.03), (1, 2.0), (1, 2.5), (2, 0.0), (2, 0.5), (3, 0.0), (3, 2.0), (3, 3.0), (4, 0.0), (4, 12.0), (1, 2.0), (2, 1.0), (0, 0.0), (1, 1.0), (2, 0.25), (99, 0.0), (0, 0.0), (1, 3.0)]


@probe("SELECT * FROM (VALUES " + ", ".join(f"('{n.replace(chr(39), chr(39) * 2)}', {s}, CAST({o} AS DOUBLE))" for n, (s, o) in zip(NOTES, _EXPECTED, strict=True)) + ") t(note, stage, ordinal)")
def q43_note_stages(spark, sf):
    notes = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in NOTES])).alias("note"))
    return notes.select("note", versions.note_stage(F.col("note")).alias("s")).select("note", "s.stage", "s.ordinal")


@probe("""WITH k AS (SELECT *, CASE WHEN version_note IN ('Enrolled') THEN 3 WHEN version_note = 'Chaptered' THEN 4 WHEN contains(lower(version_note), 'engross') OR contains(lower(version_note), 'as passed') THEN 2 WHEN contains(lower(version_note), 'amend') OR contains(lower(version_note), 'substitute') THEN 1
   WHEN contains(lower(version_note), 'introduced') OR lower(version_note) IN ('bill text', 'bill') THEN 0 ELSE 99 END AS stage, CASE WHEN regexp_full_match(coalesce(version_date, ''), '\\d{4}(-\\d{2}(-\\d{2})?)?') THEN version_date ELSE '' END AS d,
   CASE WHEN version_note IN ('Enrolled', 'Bill Text') THEN 0 WHEN contains(lower(version_note), 'as passed') THEN 0.25 ELSE coalesce(TRY_CAST(regexp_extract(version_note, '(\\d+)\\s*$', 1) AS DOUBLE), 0) END AS o FROM bill_version_document)
 SELECT version_doc_id, stage, CASE WHEN stage <> 99 THEN CAST(row_number() OVER (PARTITION BY bill_id, stage <> 99 ORDER BY stage, d, o, version_doc_id) AS INTEGER) END AS position FROM k""".replace("\\\\", "\\"))
def q43b_version_order(spark, sf):
    d = table(spark, sf, "bill_version_document")
    return rollup.version_order(d, ["bill_id"], "version_note", "version_date", "version_doc_id").select("version_doc_id", "stage", "position")


@probe("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY bill_id, source_url ORDER BY version_doc_id) AS k FROM bill_version_document WHERE source_url IS NOT NULL)
 SELECT bill_id, coalesce(version_note, '') AS version_note, coalesce(version_date, '') AS version_date, count(*) AS links FROM r WHERE k = 1 GROUP BY 1, 2, 3""")
def q44_associated_links(spark, sf):
    d = table(spark, sf, "bill_version_document").filter("source_url is not null").select("bill_id", "source_url", "version_note", "version_date", "version_doc_id")
    first = rollup.latest_first(d, ["bill_id", "source_url"], ["version_doc_id"])
    return first.groupBy("bill_id", F.coalesce("version_note", F.lit("")).alias("version_note"), F.coalesce("version_date", F.lit("")).alias("version_date")).agg(F.count("*").alias("links"))


@probe(r"""SELECT row_id, concat_ws('-', 'ocd-bill', CASE WHEN regexp_extract(jurisdiction_id, '(?:state|territory|district):([a-z]{2})', 1) = '' THEN 'us' ELSE regexp_extract(jurisdiction_id, '(?:state|territory|district):([a-z]{2})', 1) END,
 regexp_replace(lower(legislative_session), '[^a-z0-9]', '', 'g'), regexp_replace(lower(identifier), '[^a-z0-9]', '', 'g')) AS bill_key FROM bill_snapshot WHERE jurisdiction_id IS NOT NULL AND legislative_session IS NOT NULL AND identifier IS NOT NULL""")
def q45_namespaced_id(spark, sf):
    b = table(spark, sf, "bill_snapshot").dropna(subset=["jurisdiction_id", "legislative_session", "identifier"])
    return b.select("row_id", ids.bill_key(F.col("jurisdiction_id"), F.col("legislative_session"), F.col("identifier")).alias("bill_key"))


@probe(r"""SELECT doc_id, round(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[\s\x0b]*[A-Z]'))) / CAST(len(string_split(text, chr(10))) AS DOUBLE), 6) AS share FROM documents WHERE text IS NOT NULL""")
def q46_line_share(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null")
    rows = F.split("text", "\n")
    return d.select("doc_id", F.round(F.size(F.filter(rows, lambda x: x.rlike(r"^\s*[A-Z]"))) / F.size(rows), 6).alias("share"))


@probe(r"""SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[\s\x{a0}]+', ' ', 'g')) AS words
 FROM documents WHERE starts_with(text, '<')""")
def q47_html_text(spark, sf):
    d = table(spark, sf, "documents").filter("startswith(text, '<')")
    return d.select("doc_id", F.trim(F.regexp_replace(documents.html_text(F.col("text")), r"[\s\xa0]+", " ")).alias("words"))


@probe()
def q47c_html_text_of_all(spark, sf):
    """Every text that holds a tag, wherever it is; regexes of the SQL above can't tell tags from what looks like them."""
    d = table(spark, sf, "documents").filter(F.col("text").rlike(r"<[A-Za-z/!]"))
    return d.select("doc_id", F.trim(F.regexp_replace(documents.html_text(F.col("text")), r"[\s\xa0]+", " ")).alias("words"))


@probe()
def q47b_xml_text(spark, sf):
    d = table(spark, sf, "bill_version_document").filter("raw_text is not null")
    xml = F.concat(F.lit("<bill><metadata><id>"), F.col("version_doc_id").cast("string"), F.lit("</id></metadata><text>"), F.regexp_replace("raw_text", "[<>&\\x00-\\x08]", " "), F.lit("</text></bill>"))
    return d.select("version_doc_id", documents.xml_text(xml).alias("text"))


@probe()
def q48_version_diff(spark, sf):
    d = table(spark, sf, "bill_version_document")
    with_prior = rollup.previous_version_text(d, ["bill_id"], "version_note", "version_date", "media_type", "raw_text", "version_doc_id", ["text/xml", "application/pdf"])
    out = with_prior.select("version_doc_id", documents.unified_diff(F.col("previous_text"), F.col("raw_text")).alias("diff")).filter("diff is not null")
    added, removed = documents.diff_counts(F.col("diff"))
    return out.select("version_doc_id", "diff", added.alias("added"), removed.alias("removed"))


@probe()
def q48b_cleaned_diff(spark, sf):
    d = table(spark, sf, "bill_version_document").withColumn("state", ids.abbreviation(F.col("jurisdiction_id")))
    prior = rollup.previous_version_text(d, ["bill_id"], "version_note", "version_date", "media_type", "raw_text", "version_doc_id", ["text/xml", "application/pdf"])
    out = None
    for state in PROFILES:
        rows = prior.filter((F.col("state") == state) & F.col("previous_text").isNotNull())
        a, b = clean_pair(state, F.col("previous_text"), F.col("raw_text"), F.lit("application/pdf"), F.col("media_type"), F.lit(True))
        part = rows.select("version_doc_id", "state", a.alias("a"), b.alias("b")).select("version_doc_id", "state", documents.unified_diff(F.col("a"), F.col("b")).alias("diff"))
        out = part if out is None else out.unionByName(part)
    return out


@probe(r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda w: NOT list_contains(string_split('""" + " ".join(documents.STOP_WORDS) + r"""', ' '), w))) AS token FROM documents WHERE text IS NOT NULL)
 SELECT token, doc_id, 'B' AS weight, count(*) AS tf FROM w GROUP BY 1, 2 UNION ALL
 SELECT token, doc_id, 'A', count(*) FROM (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(bill_identifier), '[\p{L}\p{N}]+'), lambda w: NOT list_contains(string_split('""" + " ".join(documents.STOP_WORDS) + r"""', ' '), w))) AS token FROM documents WHERE bill_identifier IS NOT NULL) GROUP BY 1, 2""")
def q49_search_postings(spark, sf):
    return documents.postings(table(spark, sf, "documents"), "doc_id", {"bill_identifier": "A", "text": "B"})


@probe("""WITH d AS (SELECT *, coalesce(version_date, '') AS d, coalesce(version_note, '') AS n FROM bill_version_document), m AS (SELECT bill_id, max((d, n)) AS v FROM d GROUP BY 1),
 p AS (SELECT d.bill_id, arg_min(raw_text, version_doc_id) FILTER (length(trim(raw_text, ' ')) > 0) AS t FROM d JOIN m ON m.bill_id = d.bill_id AND (d.d, d.n) = m.v GROUP BY 1) SELECT bill_id, coalesce(t, '') AS raw_text, t IS NULL AS is_error FROM p""")
def q49b_latest_text(spark, sf):
    return documents.latest_text(table(spark, sf, "bill_version_document"), "bill_id", "version_date", "version_note", "raw_text", "version_doc_id")


@probe("""SELECT c_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS f_address, max(o_totalprice) FILTER (o_orderstatus = 'O') AS o_address FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def q54_csv_pivot(spark, sf):
    offices = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lower("o_orderstatus").alias("classification"), F.col("o_totalprice").alias("address"), F.lit("").alias("voice"), F.lit("").alias("fax"))
    return people.export_rows(table(spark, sf, "customer"), offices, "c_custkey", [], ["f", "o"]).select("c_custkey", "f_address", "o_address")


@probe("""SELECT kind, value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM person), 1) AS percent FROM (SELECT 'chamber' AS kind, chamber AS value FROM person UNION ALL SELECT 'primary_party', primary_party FROM person
 UNION ALL SELECT 'email', CASE WHEN coalesce(email, '') <> '' THEN 'filled' END FROM person) WHERE coalesce(value, '') <> '' GROUP BY 1, 2""")
def q70_people_summary(spark, sf):
    return people.summarize(table(spark, sf, "person"), ["chamber", "primary_party"], ["email"])


@probe("""SELECT count(*) AS people, count(*) FILTER (len(string_split(name, ' ')) = 2 AND coalesce(given_name, '') = '') AS no_given, count(*) FILTER (len(string_split(name, ' ')) = 2 AND coalesce(family_name, '') = '') AS no_family FROM person""")
def q71_lint_people(spark, sf):
    p = table(spark, sf, "person")
    c = F.col
    found = V.person_problems(c("name"), c("given_name"), c("family_name"), c("id"), F.lit(""), F.lit(""), F.coalesce("email", F.lit("")))
    has = lambda s: F.count_if(F.exists(found, lambda x: x.startswith(s)))
    return p.agg(F.count("*").alias("people"), has("missing given_name").alias("no_given"), has("missing family_name").alias("no_family"))


@probe("""WITH o AS (SELECT person_no, name, email, district FROM person), n AS (SELECT person_no, upper(name) AS name, CASE WHEN person_no % 2 = 0 THEN coalesce(email, 'x@y.example') END AS email, district FROM person)
 SELECT o.person_no, 'name' AS field, 'replace' AS change, o.name AS old, n.name AS new FROM o JOIN n USING (person_no) WHERE coalesce(n.name, '') <> '' AND o.name IS DISTINCT FROM n.name
 UNION ALL SELECT o.person_no, 'other_names', 'append', NULL, o.name FROM o JOIN n USING (person_no) WHERE coalesce(n.name, '') <> '' AND o.name IS DISTINCT FROM n.name AND coalesce(o.name, '') <> ''
 UNION ALL SELECT o.person_no, 'email', 'replace', o.email, n.email FROM o JOIN n USING (person_no) WHERE coalesce(n.email, '') <> '' AND o.email IS DISTINCT FROM n.email""")
def q72_merge_fields(spark, sf):
    p = table(spark, sf, "person").select("person_no", "name", "email", "district")
    new = p.withColumn("name", F.upper("name")).withColumn("email", F.when(F.col("person_no") % 2 == 0, F.coalesce("email", F.lit("x@y.example"))))
    return people.merge_fields(p, new, "person_no", ["name", "email", "district"], [])


@probe("""SELECT p_partkey, 'ocd-jurisdiction/country:us/state:' || chr(97 + CAST(p_partkey % 26 AS INTEGER)) || 'x/government' AS jurisdiction, CAST(3 AS INTEGER) AS depth, 'county' AS kind FROM part""")
def q73_division_parts(spark, sf):
    p = table(spark, sf, "part")
    state = F.concat(F.lit("ocd-division/country:us/state:"), F.chr(F.lit(97) + F.col("p_partkey") % 26), F.lit("x"))
    county = F.concat(state, F.lit("/county:a:b/place:c"))
    parts = ids.division_parts(county, F.lit("us"))
    return p.select("p_partkey", ids.jurisdiction_of_division(state).alias("jurisdiction"), F.size(parts).alias("depth"), parts[1]["subtype"].alias("kind"))


@probe("""SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, length(text) >= 300 AS long FROM documents WHERE text IS NOT NULL""")
def q74_hashes_and_truncation(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null")
    return d.select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("md5"), F.sha2("text", 256).alias("sha256"), (F.length(T.truncate(F.col("text"))) == 300).alias("long"))


@probe("""SELECT scrape_id, CASE lower(trim(regexp_replace(lower(party), '\\s+party$', ''))) WHEN 'd' THEN 'Democratic' WHEN 'dem' THEN 'Democratic' WHEN 'democrat' THEN 'Democratic' WHEN 'democratic' THEN 'Democratic' WHEN 'r' THEN 'Republican' WHEN 'rep' THEN 'Republican'
 WHEN 'republican' THEN 'Republican' WHEN 'i' THEN 'Independent' WHEN 'ind' THEN 'Independent' WHEN 'independent' THEN 'Independent' ELSE party END AS party FROM scrape_person""".replace("\\\\", "\\"))
def q75_party_names(spark, sf):
    return table(spark, sf, "scrape_person").select("scrape_id", V.party_name(F.col("party")).alias("party"))


@probe("""SELECT version_doc_id, CASE lower(trim(split_part(coalesce(media_type, ''), ';', 1))) WHEN 'application/pdf' THEN 'pdf' WHEN 'text/html' THEN 'html' WHEN 'text/xml' THEN 'xml' WHEN 'application/xml' THEN 'xml' WHEN 'application/msword' THEN 'doc'
 WHEN 'application/rtf' THEN 'rtf' WHEN 'text/plain' THEN 'txt' WHEN 'application/vnd.openxmlformats-officedocument.wordprocessingml.document' THEN 'docx' ELSE 'bin' END AS ending FROM bill_version_document""")
def q76_file_endings(spark, sf):
    return table(spark, sf, "bill_version_document").select("version_doc_id", ids.file_ending(F.col("media_type")).alias("ending"))


@probe("""SELECT version_doc_id, 'bills/raw/' || lower(split_part(split_part(jurisdiction_id, ':', 3), '/', 1)) || '/2021/lower/HB-1--' || bill_id || '/Introduced-' || left(sha256(source_url), 16) || '.txt' AS path FROM bill_version_document WHERE source_url IS NOT NULL AND jurisdiction_id IS NOT NULL""")
def q77_archive_path(spark, sf):
    d = table(spark, sf, "bill_version_document").dropna(subset=["source_url", "jurisdiction_id"])
    lit = F.lit
    path = ids.archive_path(ids.abbreviation(F.col("jurisdiction_id")), lit("2021"), lit("lower"), lit("HB 1"), F.col("bill_id").cast("string"), lit(""), lit("Introduced"), F.col("source_url"), lit("text/plain"))
    return d.select("version_doc_id", path.alias("path"))


@probe("""SELECT c_mktsegment, CAST(unnest(range(1, CAST(min(c_nationkey) + 4 AS BIGINT))) AS VARCHAR) AS district FROM customer GROUP BY 1""")
def q78_numbered_districts(spark, sf):
    seats = table(spark, sf, "customer").groupBy("c_mktsegment").agg((F.min("c_nationkey") + 3).alias("seats"))
    return files.numbered_districts(seats, "c_mktsegment", "seats")


@probe("""SELECT DISTINCT jurisdiction_id, legislative_session FROM bill_snapshot WHERE (jurisdiction_id, legislative_session) NOT IN (SELECT DISTINCT (jurisdiction_id, legislative_session) FROM person WHERE jurisdiction_id IS NOT NULL AND legislative_session IS NOT NULL)""".replace("SELECT DISTINCT (jurisdiction_id, legislative_session)", "SELECT DISTINCT jurisdiction_id, legislative_session"))
def q79_insert_if_absent(spark, sf):
    key = ["jurisdiction_id", "legislative_session"]
    return files.bootstrap(table(spark, sf, "person").select(*key), table(spark, sf, "bill_snapshot").select(*key).dropna(), key)


@probe("""SELECT listing_id, CASE WHEN contains(string_split(lower(name), ' ')[1], 'house') AND NOT contains(string_split(lower(name), ' ')[1], 'senate') THEN 'lower' WHEN contains(string_split(lower(name), ' ')[1], 'senate') AND NOT contains(string_split(lower(name), ' ')[1], 'house') THEN 'upper' END AS chamber FROM event_listing""")
def q80_event_chamber(spark, sf):
    return table(spark, sf, "event_listing").select("listing_id", T.chamber_of_event(F.col("name"), F.lit("House"), F.lit("Senate")).alias("chamber"))


@probe(r"""SELECT raw_id, trim(regexp_replace(record, '[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS flat FROM event_raw""")
def q81_collapse_whitespace(spark, sf):
    return table(spark, sf, "event_raw").select("raw_id", F.trim(T.collapse_whitespace(F.col("record"))).alias("flat"))


@probe("""SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, ts FROM events) GROUP BY 1""")
def q82_replay_counts(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "ts")
    return ingest.without_replays(e.unionByName(e), ["user_id", "event_type", "ts"], "ts").groupBy("user_id").agg(F.count("*").alias("n"))


@probe("""SELECT time_bucket(INTERVAL '15 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q83_stream_windows(spark, sf):
    """The windowed counts as a stream: files read as they come, closed windows appended to a table, open ones counted from what came last."""
    import uuid

    e = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet" if _is_folder(spark, sf) else f"{sf}/event[s].parquet")
    counts = ingest.windowed_counts(e.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], late="1 day")
    out = f"{scratch_root(spark)}/windows-{uuid.uuid4().hex}"
    query = (counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    # windows the watermark hasn't closed yet are those of its last span: a day, counted from the table again
    closed = spark.read.schema("start timestamp, event_type string, n bigint").parquet(out)
    last = closed.agg(F.max("start").alias("__last"))
    rest = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).crossJoin(F.broadcast(last)).filter(F.col("__last").isNull() | (F.col("ts") >= F.col("__last") + F.expr("interval 15 minutes")))  # one row
    return closed.unionByName(ingest.windowed_counts(rest, "ts", ["event_type"])).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def _is_folder(spark: SparkSession, sf: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/events.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()

"""Queries of the operators for training text, with their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm.encode import encode_corpus, split_corpus
from rollcall.llm.formatting import formatting_duplicates, json_fields
from rollcall.llm.leakage import find_leaks, remove_leaks
from rollcall.llm.names import attribute_names
from rollcall.llm.residue import find_residue
from rollcall.session import table

EVENT_FIELDS = ["name", "description", "classification", "start_date", "status", "location.name", "location.url"]


def p1_posteriors(spark: SparkSession, sf: str) -> DataFrame:
    scope = ["jurisdiction_id", "legislative_session"]
    people = table(spark, sf, "person")
    scraped = table(spark, sf, "scrape_person").select(*scope, "name", "district")
    others = people.select(*scope, "district", F.explode("other_names").alias("o")).select(*scope, F.col("o.name").alias("name"), "district")
    reports = table(spark, sf, "session_quality_report").select(*scope, F.explode(F.map_keys("unmatched_sponsor_people")).alias("name")).select(*scope, "name", F.lit(None).cast("string").alias("district"))
    full = people.select(*scope, "person_no", F.col("name").alias("full_name"), F.col("given_name").alias("given"), F.col("middle_name").alias("middle"), F.col("family_name").alias("family"), "suffix", "district")
    return attribute_names(scraped.unionByName(others).unionByName(reports), full, scope, "name", "person_no")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_posteriors(spark, sf).select("jurisdiction_id", "legislative_session", "name", "person_no")


def _p3(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    valid, content = json_fields(F.col("record"), EVENT_FIELDS)
    return formatting_duplicates(table(spark, sf, "event_raw"), "raw_id", ["jurisdiction_id"], content, valid)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p3(spark, sf)[0]


def p3_copies(spark: SparkSession, sf: str) -> DataFrame:
    return _p3(spark, sf)[1]


def p6_residue(spark: SparkSession, sf: str) -> DataFrame:
    return find_residue(table(spark, sf, "bill_version_document"), "version_doc_id", "source_url", "media_type", "raw_text")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_residue(spark, sf).select("version_doc_id").distinct()


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(table(spark, sf, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_item"), "item_id", "text")


def p9_removed(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of the documents that hold passages of tests, the passages cut out."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    leaks = find_leaks(documents, "doc_id", "text", table(spark, sf, "eval_item"), "item_id", "text", spans=True)
    left = remove_leaks(documents.join(leaks.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id", "text", leaks, whole=False)
    return left.select("doc_id", F.length("text").alias("n_chars"), F.md5(F.encode("text", "UTF-8")).alias("md5"))


def p10_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return split_corpus(table(spark, sf, "documents"), "doc_id", "text", limit=512, overlap=64)


QUERIES = {"p1_found": p1_found, "p1_posteriors": p1_posteriors, "p3_found": p3_found, "p3_copies": p3_copies, "p6_found": p6_found, "p6_residue": p6_residue, "p8_ids": p8_ids, "p9_found": p9_found, "p9_removed": p9_removed, "p10_pieces": p10_pieces}

_P3 = "WITH v AS (SELECT raw_id, jurisdiction_id AS j, " + ", ".join(
    f"coalesce(regexp_replace(lower(json_extract_string(record, '$.{f}')), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), '') AS f{i}" for i, f in enumerate(EVENT_FIELDS)
) + " FROM event_raw WHERE record IS NOT NULL AND json_valid(record)), s AS (SELECT *, min(raw_id) OVER w AS first_id, count(*) OVER w AS copies FROM v WINDOW w AS (PARTITION BY j, " + ", ".join(
    f"f{i}" for i in range(len(EVENT_FIELDS))) + ")) "

SQL = {
    "p3_found": _P3 + "SELECT first_id, raw_id FROM s WHERE raw_id <> first_id",
    "p3_copies": _P3 + "SELECT first_id, copies FROM s WHERE raw_id = first_id",
    "p9_found": r"""WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM documents),
 e AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) AS w FROM eval_item),
 dg AS (SELECT doc_id, array_to_string(w[i:i+14], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS i FROM d WHERE len(w) >= 15)),
 eg AS (SELECT DISTINCT item_id, array_to_string(w[i:i+14], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS i FROM e WHERE len(w) >= 15))
SELECT DISTINCT doc_id, item_id FROM dg JOIN eg USING (g)""",
}

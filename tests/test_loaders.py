import datetime

import pytest
from pyspark.sql import functions as F

from rollcall.functions import times
from rollcall.operators import diffing, documents, loaders, reports


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_a_load_with_missing_records_needs_purge(spark):
    stored, docs = spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(2,), (3,)], "id int")
    with pytest.raises(ValueError, match="1 went missing"):
        loaders.missing_after_sync(stored, docs, "id", purge=False)
    assert [r.id for r in loaders.missing_after_sync(stored, docs, "id", purge=True).collect()] == [1]
    assert loaders.missing_after_sync(stored, stored, "id", purge=False).collect() == []


def test_votes_sent_again_are_noops_and_stale_ones_go(spark):
    schema = "_id long, session string, bill string, identifier string, motion string, date string, organization string, dedupe_key string, result string"
    stored = spark.createDataFrame([(1, "S", "b", None, "m", "2020", "o", None, "pass"), (2, "S", "b", "v2", "m", "2020", "o", None, "pass"), (3, "S", "c", "v3", "m", "2020", "o", None, "pass")], schema)
    again = loaders.load_votes(stored, stored, ["result"], ["_id"])
    assert {r.what for r in again.outcome.collect()} == {"noop"} and again.table.count() == 3 and again.missing.count() == 0
    part = loaders.load_votes(stored, stored.filter("_id = 1").unionByName(spark.createDataFrame([(9, "S", None, None, "m", "2020", "o", None, "pass"), (0, "S", "b", None, "m", "2020", "o", None, "fail")], schema)), ["result"], ["_id"])
    assert {(r._id, r.what) for r in part.outcome.collect()} == {(1, "noop"), (9, "invalid"), (0, "duplicate")}
    assert {r._id for r in part.table.collect()} == {1, 3}  # the other vote of bill b wasn't sent again


def test_small_parts(spark):
    s = spark.createDataFrame([([("1", "x", "y")],)], "s array<struct<identifier:string,_scraped_name:string,extras:string>>")
    assert s.select(loaders.session_input(F.col("s")).alias("x")).schema["x"].dataType.elementType.fieldNames() == ["identifier"]
    names = F.array(F.struct(F.lit("a").alias("name"), F.lit("").alias("note")))
    assert [len(value(spark, loaders.with_other_name(names, F.lit(n), F.lit("")))) for n in ("a", "b")] == [1, 2]
    assert value(spark, loaders.jurisdiction_key(F.lit("d"), F.lit("government"))).startswith("jurisdiction") and value(spark, loaders.jurisdiction_key(F.lit(None), F.lit("x"))) is None
    c = spark.createDataFrame([(1, [("Homepage", "u")]), (2, [])], "id int, links array<struct<note:string,url:string>>")
    m = spark.createDataFrame([(1, "Ann Lee"), (2, "Nobody Here")], "id int, member string")
    found = loaders.committee_warnings(c, m, spark.createDataFrame([("ANN LEE",)], "name string"))
    assert {tuple(r) for r in found.collect()} == {(2, "no homepage link"), (2, "unknown member Nobody Here")}
    assert loaders.stamped(c, F.lit("j"), F.current_timestamp()).first().jurisdiction == "j"


def test_times_at_the_edges(spark):
    at = lambda y, m, d, h: F.lit(datetime.datetime(y, m, d, h)).cast("timestamp_ntz")
    assert value(spark, times.localised(at(2021, 7, 1, 9), F.lit("America/New_York"))) == "2021-07-01T09:00:00-04:00"
    assert value(spark, times.localised(at(2021, 1, 1, 9), F.lit("America/New_York"))) == "2021-01-01T09:00:00-05:00"
    assert value(spark, times.localised(at(2021, 1, 1, 9), F.lit("Asia/Kolkata"))) == "2021-01-01T09:00:00+05:30"
    assert [value(spark, times.iso_day(F.lit(x))) for x in ("2020-02-29", "2020-02-30", "2020-02-03T04:05:06+00:00", "May 3", "", None)] == ["2020-02-29", None, "2020-02-03", None, None, None]


def test_states_with_converters_of_their_own(spark):
    rows = [("de", "HB 1", "text/html", "<body><div>a</div><div>b</div><div>c</div><div>d</div></body>"), ("de", "HCR 1", "application/pdf", " 1 one\n x\n 2 two"), ("de", "HB 1", "application/pdf", " 1 one"), ("xx", "", "application/pdf", "x"), ("xx", "", "text/plain", "t")]
    df = spark.createDataFrame([(i, *r, True, "old") for i, r in enumerate(rows)], "i int, state string, title string, media string, content string, was_error boolean, stored string")
    out = {r.i: (r.text, r.is_error, r.skipped) for r in documents.extract_text(df, "content", "media", "text", "state", "title", documents.standard_conversions()).collect()}
    assert out == {0: ("b\nc", False, None), 1: ("one\ntwo", False, None), 2: ("", True, None), 3: (None, True, "no extractor"), 4: ("t", False, None)}
    again = documents.read_again(df, "content", "media", "stored", state="state", title="title", conversions=documents.standard_conversions())
    assert {r.i: r.stored for r in again.collect()} == {0: "b\nc", 1: "one\ntwo", 2: "old", 3: "old", 4: "t"}
    assert {tuple(r) for r in reports.retried(again, "was_error", "stored", "skipped").collect()} == {("now_fixed", 4), ("skipped: no extractor", 1)}


def test_multisets_and_sets(spark):
    df = spark.createDataFrame([("g", "a", True), ("g", "a", False), ("g", "a", False), ("g", None, True), ("h", "b", True)], "k string, x string, new boolean")
    assert {tuple(r) for r in diffing.multiset_differences(df, ["k"], F.col("x"), F.col("new")).collect()} == {("g", 1, 1), ("h", 0, 1)}

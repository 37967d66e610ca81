import itertools
import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import diffing, documents, intervals, people, relations, reports, resolve, rollup, upsert
from rollcall.operators.skew import attach_by_key, salted_join
from rollcall.plans import scalar
from rollcall.sources import files
from rollcall.streaming import ingest


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_action_rollup_ties_and_blanks(spark):
    data = [("a", 1, "2020-01-02", "one", ["x"]), ("a", 2, "2020-01-02", "two", ["passage"]), ("a", 3, "2020-01-01", "late entry", ["committee-passage"]), ("b", 1, "", "blank", ["passage"]), ("b", 2, "2021", "year", [])]
    out = rollup.action_rollup(spark.createDataFrame(data, "bill string, ord int, day string, what string, cls array<string>"), "bill", "ord", "day", "what", "cls")
    assert rows(out) == [("a", "2020-01-01", "2020-01-02", "two", "2020-01-02"), ("b", "2021", "2021", "year", None)]


def test_tally_check(spark):
    declared = spark.createDataFrame([("v1", "yes", 2), ("v1", "no", 1), ("v2", "yes", 1), ("v3", "absent", 9), ("v4", "yes", 1), ("v4", "yes", 2)], "v string, option string, value int")
    observed = spark.createDataFrame([("v1", 2, 1, 0), ("v2", 1, 1, 0), ("v3", 0, 0, 0), ("v4", 2, 0, 0)], "v string, yes int, no int, other int")
    out = {r.v: (r.bad_counts, r.duplicated) for r in reports.tally_check(declared, observed, "v", ["yes", "no", "other"]).collect()}
    assert out == {"v1": (False, False), "v2": (True, False), "v3": (False, False), "v4": (False, True)}


def test_intervals(spark):
    cases = [("", "", 1, 1, 1, 1), ("2020", "2021-05-01", 1, 0, 1, 1), ("2022", "2023", 0, 0, 1, 0), ("2020", "2021", 0, 0, 0, 0), (None, None, 1, 1, 1, 1)]
    for start, end, *want in cases:
        s, e = F.lit(start), F.lit(end)
        t = "2021-05-01"
        got = spark.range(1).select(intervals.current(s, e, t), intervals.is_active(s, e, t), intervals.member_now(s, e, t), intervals.member_now(s, e, t, strict=True)).first()
        assert [int(bool(x)) for x in got] == want, (start, end)
    o = lambda *x: spark.range(1).select(intervals.overlaps(*map(F.lit, x))).first()[0]
    assert o("2020", "2021", "2020-06", "2022") and not o("2020", "2020-06", "2020-06", "2022") and o("", "", "2020", "2021") and not o("2023", "", "2020", "2023")


def test_resolve_statuses_and_tie_breaks(spark):
    scope = ["s"]
    p = spark.createDataFrame([("s", 1, "Ann Lee", [("A. Lee",)], True, "", ""), ("s", 2, "Bo Lee", [], False, "", ""), ("s", 3, "Cy Lee", [], False, "", "2019"), ("t", 4, "Dee Ray", [], True, "", "")],
                              "s string, pid long, name string, other_names array<struct<name:string>>, live boolean, start string, end string").withColumn("family", F.element_at(F.split("name", " "), -1))
    keys = resolve.names_of(p, "pid", ["name", "family"], ["other_names"], scope)
    refs = spark.createDataFrame([("s", "LEE", None), ("s", "a.  lee", None), ("s", "ray", None), ("s", "bo lee", "X9"), ("s", None, None)], "s string, n string, ident string")
    idents = spark.createDataFrame([("s", "X9", 1)], "s string, identifier string, pid long")
    plain = {r.n: (r.resolved_id, r.status) for r in resolve.resolve_by_names(refs, "n", p, "pid", keys, scope, current="live").collect()}
    assert plain == {"LEE": (1, "resolved"), "a.  lee": (1, "resolved"), "ray": (None, "unresolved"), "bo lee": (2, "resolved"), None: (None, "unresolved")}
    assert {r.n: r.status for r in resolve.resolve_by_names(refs, "n", p, "pid", keys, scope).collect()}["LEE"] == "ambiguous"
    first = resolve.resolve_by_names(refs, "n", p, "pid", keys, scope, identifier="ident", identifiers=idents)
    assert {r.n: r.resolved_id for r in first.collect()}["bo lee"] == 1
    window = (F.col("start"), F.col("end"), F.lit("2020"), F.lit("2021"))
    assert {r.n: r.status for r in resolve.resolve_by_names(refs.filter("n = 'LEE'"), "n", p.filter("pid in (2, 3)"), "pid", keys, scope, window=window).collect()} == {"LEE": "resolved"}


def test_session_of_date(spark):
    sessions = spark.createDataFrame([("a", "2019-01-01", "2019-12-31"), ("b", "2019-06-01", ""), ("c", "2021-01-01", "2021-06-01")], "id string, st string, en string")
    facts = spark.createDataFrame([(1, "2019-02-01"), (2, "2019-07-01"), (3, "2001-01-01"), (4, None), (1, "2019-02-01")], "f int, d string")
    got = rows(resolve.session_of_date(facts, "d", sessions, "st", "en", "id"), "f", "session_id", "exact")
    assert got == [(1, "a", True), (1, "a", True), (2, "c", False), (3, "c", False), (4, "c", False)]


def test_match_one_to_one(spark):
    left = spark.createDataFrame([("v2", "k", 2), ("v1", "k", 1), ("v3", "many", 1), ("v4", "none", 1)], "v string, k string, at int")
    right = spark.createDataFrame([("k", 10), ("many", 11), ("many", 12)], "k string, a int")
    assert rows(resolve.match_one_to_one(left, right, ["k"], "v", "a", "at"), "v", "status", "matched_id") == [("v1", "matched", 10), ("v2", "taken", None), ("v3", "several", None), ("v4", "none", None)]


def brute_union(old, new):
    out = {k: v for k, v in old}
    out |= dict(new)
    return list(out.items())


def test_keyed_list_union_random(spark):
    rng = random.Random(5)
    for _ in range(4):
        old = [(k, rng.randint(0, 99)) for k in rng.sample("abcdefg", 4)]
        new = [(k, rng.randint(100, 199)) for k in rng.sample("abcdefg", 4)]
        make = lambda xs: spark.createDataFrame([(1, i, k, v) for i, (k, v) in enumerate(xs)], "g int, pos int, k string, v int")
        out = diffing.keyed_list_union(make(old), make(new), ["g"], "k", "pos")
        assert [(r.k, r.v) for r in out.orderBy("position").collect()] == brute_union(old, new)


def test_comparisons(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    a = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    assert one(diffing.multiset_equal(a("x", "y", "x"), a("x", "x", "y"))) and not one(diffing.multiset_equal(a("x", "y", "y"), a("x", "x", "y"))) and not one(diffing.multiset_equal(a("x", "y"), a("y", "x"), ordered=True))
    assert not one(diffing.replaced(a("A", "A"), a("A", "B"))) and one(diffing.replaced(a("A", "A"), a("A", "B"), multiset=True))
    assert one(diffing.append_missing(a("b", "a"), a("c", "a", "c"))) == ["b", "a", "c"]
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    assert one(diffing.map_union(m({"a": 1, "b": 2}), m({"b": 3}))) == {"a": 1, "b": 3}


def test_upserts(spark):
    schema = "k string, v string, at int"
    stored = spark.createDataFrame([("a", "1", 0), ("b", "2", 0), ("c", None, 0)], schema)
    arrived = spark.createDataFrame([("b", "3", 1), ("b", "2", 2), ("c", None, 1), ("d", "4", 1), ("a", "9", 1)], schema)
    assert rows(upsert.outcomes(stored, arrived, ["k"], ["v"], ["at"])) == [("a", "update"), ("b", "noop"), ("c", "noop"), ("d", "insert")]
    assert rows(upsert.merged(stored, arrived, ["k"], ["at"]), "k", "v") == [("a", "9"), ("b", "2"), ("c", None), ("d", "4")]
    once = upsert.merged(stored, arrived, ["k"], ["at"])
    assert rows(upsert.merged(once, arrived, ["k"], ["at"])) == rows(once)
    assert rows(upsert.keyed_merge(stored, arrived.filter("k <> 'b'"), ["k"], ["v"])) == [("a", "9", "update"), ("b", "2", "noop"), ("c", None, "noop"), ("d", "4", "added")]
    assert rows(upsert.duplicate_targets(arrived, ["k"])) == [("b", 2)]
    flagged = stored.withColumn("deleted", F.lit(False))
    assert rows(upsert.soft_delete(flagged, arrived.filter("k = 'a'"), "k"), "k", "deleted") == [("a", False), ("b", True), ("c", True)]
    assert rows(upsert.soft_delete(flagged, arrived.filter("false"), "k"), "deleted") == [(False,)] * 3  # an empty batch deletes nothing
    key = spark.range(1).select(upsert.match_key([("one", [F.lit(None).cast("string")]), ("two", [F.lit("a"), F.lit(1)])])).first()[0]
    assert key == "two\u0001a\u00011"


def test_delete_rules_and_hierarchy(spark):
    parents = spark.createDataFrame([("p1",), ("p2",)], "id string")
    children = spark.createDataFrame([("c1", "p1"), ("c2", "p2"), ("c3", None)], "cid string, fk string")
    gone = parents.filter("id = 'p1'")
    assert rows(relations.cascade(children, gone, "fk", "id"), "cid") == [("c2",), ("c3",)]
    assert rows(relations.set_null(children, gone, "fk", "id"), "cid", "fk") == [("c1", None), ("c2", "p2"), ("c3", None)]
    assert rows(relations.protected(children, gone, "fk", "id"), "cid") == [("c1",)]
    assert rows(relations.missing_children(parents, children.filter("fk = 'p1'"), "id", "fk")) == [("p2",)]
    orgs = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "o string, up string")
    assert rows(relations.ancestors(orgs, "o", "up").filter("o in ('b', 'c')")) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]


def test_previous_version_text(spark):
    data = [(1, "b", "Introduced", "", "application/pdf", "one pdf"), (2, "b", "Introduced", "", "text/xml", "one xml"), (3, "b", "Substitute 1", "", "text/html", None), (4, "b", "whatever", "", "text/html", "unknown"), (5, "b", "Enrolled", "", "text/html", "last")]
    df = spark.createDataFrame(data, "id int, bill string, note string, date string, media string, t string")
    out = {r.id: r.previous_text for r in rollup.previous_version_text(df, ["bill"], "note", "date", "media", "t", "id", ["text/xml", "application/pdf"]).collect()}
    assert out == {1: None, 2: None, 3: "one xml", 4: None, 5: "one xml"}


def test_documents(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    page = "<html><head><title>t</title><script>x()</script></head><body><div class='a b' id=z>One<br>two <p>thr&amp;ee</p></div><div class=b>four</div></body></html>"
    assert one(documents.html_text(F.lit(page), cls="a")) == "One\ntwo\nthr&ee"
    assert one(documents.html_text(F.lit(page), cls="b", single=True)) is None and one(documents.html_text(F.lit(page), ident="z", single=True)).startswith("One")
    assert one(documents.xml_text(F.lit("<b><metadata>no</metadata><t>yes &amp; <i>more</i></t> end</b>"))) == "yes & more end"
    assert one(documents.xml_text(F.lit("<b><metadata>no</metadata><t>broken & text"))) == "broken & text"
    diff = one(documents.unified_diff(F.lit("a\nb\nc"), F.lit("a\nB\nc")))
    assert "-b" in diff and "+B" in diff and one(documents.unified_diff(F.lit(None).cast("string"), F.lit("x"))) is None
    assert [one(documents.recompute(F.lit(a), F.lit(b))) for a, b in (("x", "x"), ("x", None), (None, "y"))] == ["unchanged", "nulled", "corrected"]


def test_people(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    offices = "array<struct<classification:string,name:string,address:string,voice:string,fax:string>>"
    old = F.from_json(F.lit('[{"classification":"capitol","name":"","address":"1 St","voice":"5","fax":""}]'), offices)
    new = F.from_json(F.lit('[{"classification":"capitol","name":"","address":"","voice":"6","fax":"7"},{"classification":"district","name":"","address":"","voice":"6","fax":""}]'), offices)
    joined = one(people.merge_offices(old, new))
    assert [(o.classification, o.address, o.voice, o.fax) for o in joined] == [("capitol", "1 St", "6", "7")]
    parties = "array<struct<name:string,start_date:string,end_date:string>>"
    p = lambda *names: F.from_json(F.lit("[" + ",".join(f'{{"name":"{n}","start_date":"","end_date":""}}' for n in names) + "]"), parties)
    assert tuple(one(people.primary_party(p("Green", "Democratic", "Working"), "2024"))) == ("Democratic", False) and one(people.primary_party(p("Democratic", "Republican"), "2024")).error
    merged = one(people.merge_party(p("Democratic"), F.struct(F.lit("Green").alias("name"), F.lit("").alias("start_date"), F.lit("").alias("end_date")), "2024-01-01"))
    assert [(x.name, x.end_date) for x in merged] == [("Democratic", "2024-01-01"), ("Green", "")]
    schema = "pid int, name string, email string, links array<string>"
    a, b = spark.createDataFrame([(1, "Old", "", ["x"])], schema), spark.createDataFrame([(1, "New", "e", ["x", "y"])], schema)
    changes = people.merge_fields(a, b, "pid", ["name", "email"], ["links"])
    assert rows(changes, "field", "change", "new") == [("email", "replace", "e"), ("links", "append", "y"), ("name", "replace", "New"), ("other_names", "append", "Old")]
    assert rows(people.apply_fields(a, changes, "pid", ["name", "email"], ["links"]), "name", "email", "links") == [("New", "e", ["x", "y"])]
    expected = spark.createDataFrame([("upper", "1", 1), ("upper", "2", 2), ("upper", "3", 0)], "c string, d string, seats int")
    actual = spark.createDataFrame([("upper", "2", "p"), ("upper", "9", "q")], "c string, d string, who string")
    assert rows(reports.seat_coverage(expected, actual, ["c", "d"], "seats", "who"), "d", "verdict") == [("1", "missing"), ("2", "under"), ("3", "ok"), ("9", "extra")]


@pytest.mark.parametrize("hot,most", [(2, 100), (10**6, 100), (2, 0)])
def test_attach_by_key_keeps_every_row(spark, hot, most):
    left = spark.createDataFrame([("hot", i) for i in range(9)] + [("cold", 1), (None, 2), ("absent", 3)], "k string, v int")
    keyed = spark.createDataFrame([("hot", 9, "H"), ("cold", 1, "C")], "k string, n int, x string")
    want = [("cold", 1, "C")] + [("hot", i, "H") for i in range(9)]
    assert rows(attach_by_key(left, keyed, ["k"], "n", "inner", hot, most), "k", "v", "x") == want
    assert rows(attach_by_key(left, keyed.drop("x"), ["k"], "n", "left_semi", hot, most), "k", "v") == [w[:2] for w in want]
    assert salted_join(left, keyed.drop("n"), ["k"], "inner").count() == 10


def test_sources(spark, tmp_path):
    (tmp_path / "bill_1.json").write_text('{"identifier": "HB 1", "title": "x"}')
    (tmp_path / "bill_2.json").write_text("{broken")
    (tmp_path / "vote_1.json").write_text('{"identifier": "no"}')
    from pyspark.sql.types import StringType, StructField, StructType

    got = files.read_entities(spark, str(tmp_path), "bill", StructType([StructField("identifier", StringType()), StructField("title", StringType())])).collect()
    assert len(got) == 2 and {r.identifier for r in got} == {"HB 1", None} and sum(r._corrupt_record is not None for r in got) == 1
    people_dir = tmp_path / "p"
    people_dir.mkdir()
    (people_dir / "a.yml").write_text("id: ocd-person/1\nname: Ann Lee\nextra: 1\nroles:\n  - type: upper\n    district: '3'\n")
    y = files.read_yaml(spark, str(people_dir), "id string, name string, roles array<struct<type:string,district:string>>").first()
    assert (y.id, y.name, y.unknown, y.roles[0].district) == ("ocd-person/1", "Ann Lee", ["extra"], "3")
    assert files.flat_yaml("a: 1\nl:\n  - x: 2\n    y: 3\n")["l"]
    spark.dataSource.register(files.ScraperSource)
    scraped = spark.read.format("scraper").option("module", "rollcall.sources.files:numbers").option("parts", 2).schema("part string, n string").load()
    assert rows(scraped) == [("0", "0"), ("0", "1"), ("1", "0"), ("1", "1")]
    files.export_csv(spark.createDataFrame([("a,b", 1)], "x string, n int"), str(tmp_path / "csv"))
    assert files.read_csv(spark, str(tmp_path / "csv"), "x string, n int").first().x == "a,b"


def test_streams(spark, tmp_path):
    schema = "k string, v int, ts timestamp"
    source, table = tmp_path / "in", {"df": spark.createDataFrame([], schema)}
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int").withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp")).coalesce(1).write.json(str(source))
    seen = []

    def write(df):
        table["df"] = spark.createDataFrame(df.collect(), schema)

    def run(name):
        q = ingest.merge_batches(ingest.read_lines(spark, str(source), schema), ["k"], "v", lambda: table["df"], write, str(tmp_path / name), after=lambda b, _: seen.append(b.count()))
        q.awaitTermination()
    run("one")
    assert rows(table["df"], "k", "v") == [("a", 2), ("b", 1)]
    run("two")  # all of it sent again
    assert rows(table["df"], "k", "v") == [("a", 2), ("b", 1)] and seen[-1] == 0
    q = ingest.buffered(ingest.read_lines(spark, str(source), schema), str(tmp_path / "out"), str(tmp_path / "c"), by=["k"], once=True)
    q.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_longest_run_against_brute_force(spark):
    rng = random.Random(8)
    data = [(u, i, rng.random() < 0.5) for u in range(5) for i in range(40)]
    want = {u: max((len(list(g)) for f, g in itertools.groupby(x[2] for x in data if x[0] == u) if f), default=0) for u in range(5)}
    df = spark.createDataFrame(data, "u int, i int, bad boolean")
    assert {r.u: r.longest_run for r in rollup.longest_run(df, ["u"], ["i"], F.col("bad")).collect()} == want


def test_ancestors_of_deep_trees_and_rings(spark):
    links = [(i, i - 1 if i else None) for i in range(91)] + [(201, 202), (202, 203), (203, 201), (204, 203), (205, 205)]
    got = rows(relations.ancestors(spark.createDataFrame(links, "k long, up long"), "k", "up"))
    want = [(i, a, i - a) for i in range(91) for a in range(i)]
    want += [(201, 202, 1), (201, 203, 2), (202, 203, 1), (202, 201, 2), (203, 201, 1), (203, 202, 2), (204, 203, 1), (204, 201, 2), (204, 202, 3)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("times", [1, 100])
def test_dominant_groups_wait_whatever_the_size(spark, times):
    groups = ["big"] * 6 + ["a", "b", "c", None]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups * times)], "id long, g string")
    assert {r.g for r in reports.without_dominant_groups(df, ["g"], 0.2).collect()} == {"a", "b", "c", None}
    assert reports.without_dominant_groups(df.limit(0), ["g"], 0.2).count() == 0


def test_html_text_of_every_text_that_holds_a_tag(spark, tmp_path):
    cases = {"Before <b>bold</b> &amp; after": "Before bold & after", "<p>One</p><p>two</p>": "One two", "a < b and c > d": None, " \n<div>x<script>no()</script>y</div>": "xy", "plain": None, "end<br/>ing": "end ing", "": None, None: None}
    spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.words for r in scalar.QUERIES["q47c_html_text_of_all"](spark, str(tmp_path)).collect()}
    assert got == {i: w for i, w in enumerate(cases.values()) if w is not None}

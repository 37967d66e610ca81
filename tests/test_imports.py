import pytest
from pyspark.sql import functions as F

from rollcall.operators import relations
from rollcall.plans.imports import import_bills, import_votes_keys
from rollcall.sources.schemas import DOCUMENTS, document_problems, schema

J = "ocd-jurisdiction/country:us/state:zz/government"


def bill(i, identifier="hb 1", title="A  bill", session="2021", org='~{"classification":"lower"}', actions=(), sources=True, subject=()):
    return {"_id": i, "legislative_session": session, "identifier": identifier, "title": title, "from_organization": org, "classification": ["bill"], "subject": list(subject),
            "actions": [{"description": d, "date": t, "organization_id": None, "classification": c} for d, t, c in actions], "sponsorships": [], "versions": [], "documents": [], "related_bills": [],
            "sources": [{"url": "https://x.example", "note": ""}] if sources else [], "extras": None, "arrival": i}


@pytest.fixture(scope="module")
def world(spark):
    sessions = spark.createDataFrame([("s21", "2021", J), ("other", "2021", "elsewhere")], "session_id string, legislative_session string, jurisdiction_id string")
    orgs = spark.createDataFrame([("o-low", "lower", J), ("o-up", "upper", J)], "organization_id string, classification string, jurisdiction_id string")
    docs = lambda rows: spark.createDataFrame(rows, schema("bill").add("arrival", "string"))
    fields = "title string, classification array<string>, subject array<string>, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema("bill").fields if f.name in ("actions", "sponsorships", "versions", "documents", "sources", "related_bills", "extras"))
    empty = spark.createDataFrame([], f"_id string, session_id string, identifier string, organization_id string, {fields}")
    return lambda rows, stored=empty: import_bills(docs(rows), stored, sessions, orgs, J)


def outcome(x):
    return {r._id: r.what for r in x.outcome.collect()}


def test_first_import_and_again(world):
    rows = [bill("1", actions=[("filed", "2021-01-01", []), ("passed", "2021-02-01", ["passage"])]), bill("2", "HB 1", "A bill", actions=[("filed", "2021-01-01", []), ("passed", "2021-02-01", ["passage"])]), bill("3", "SB 2", org='~{"classification":"upper"}'),
            bill("4", "HB 9", session="1999"), bill("5", "HB 8", org='~{"classification":"party"}'), bill("6", "HB 7", sources=False), bill("7", "")]
    first = world(rows)
    assert outcome(first) == {"1": "insert", "2": "duplicate", "3": "insert", "4": "unresolved", "5": "unresolved", "6": "invalid", "7": "invalid"}
    stored = sorted((r.identifier, r.title, r.organization_id) for r in first.table.collect())
    assert stored == [("HB 1", "A bill", "o-low"), ("SB 2", "A bill", "o-up")]
    derived = {r.identifier: (r.first_action_date, r.latest_action_date, r.latest_action_description, r.latest_passage_date) for r in first.derived.collect()}
    assert derived == {"HB 1": ("2021-01-01", "2021-02-01", "passed", "2021-02-01"), "SB 2": (None, None, "", None)}
    kept = first.table
    again = world(rows, kept)
    assert {k: v for k, v in outcome(again).items() if k in "13"} == {"1": "noop", "3": "noop"}
    changed = world([bill("9", subject=["taxes"]), bill("8", "SB 2", org='~{"classification":"upper"}')], kept)
    assert outcome(changed) == {"9": "update", "8": "noop"}


def test_reordered_actions_are_an_update(world):
    one, two = ("a", "2021-01-01", []), ("b", "2021-01-02", [])
    stored = world([bill("1", actions=[one, two])]).table
    assert outcome(world([bill("2", actions=[two, one])], stored)) == {"2": "update"}


def test_empty_batch(world):
    assert outcome(world([])) == {}


def test_document_problems(spark):
    assert set(DOCUMENTS) == {"bill", "vote_event", "event", "person", "organization"}
    for kind in DOCUMENTS:
        df = spark.createDataFrame([{}], schema(kind))
        assert df.select(document_problems(kind).alias("p")).first().p


def test_vote_keys(spark):
    lit, none = F.lit, F.lit(None).cast("string")
    k = lambda **x: spark.range(1).select(import_votes_keys(lit("s"), lit("b"), x.get("i", none), lit("m"), lit("d"), lit("o"), x.get("d", none))).first()[0].split("\u0001")
    assert k(d=lit("dk")) == ["dedupe", "dk"] and k(i=lit("7")) == ["identifier", "s", "b", "7"] and k()[0] == "motion"


def test_links_districts_and_lookups(spark):
    df = spark.createDataFrame([("b", "u1", "Intro", 1), ("b", "u1", "Final", 2), ("b", "u2", "Final", 3)], "bill string, url string, note string, pos int")
    kept, dropped = relations.group_links(df, ["bill"], "url", ["note"], "pos")
    assert {r.note: [x.url for x in r.links] for r in kept.collect()} == {"Intro": ["u1"], "Final": ["u2"]} and [r.note for r in dropped.collect()] == ["Final"]
    d = spark.createDataFrame([("ocd-division/country:us/state:zz/sldl:1",), ("ocd-division/country:us",)], "div string")
    found = {r.div: (r.division_chamber, r.name) for r in relations.district_of(d, "div", spark.createDataFrame([("ocd-division/country:us/state:zz/sldl:1", "zz", "lower", "1")], "division_id string, state string, chamber string, name string")).collect()}
    assert found == {"ocd-division/country:us/state:zz/sldl:1": ("lower", "1"), "ocd-division/country:us": (None, None)}
    states = spark.createDataFrame([("zz", "Zed", J)], "abbr string, name string, jid string")
    refs = spark.createDataFrame([("zz",), ("Zed",), (J,), ("none",), (None,)], "v string")
    assert {r.v: r.found for r in relations.lookup(refs, "v", states, ["abbr", "name", "jid"], []).collect()} == {"zz": True, "Zed": True, J: True, "none": False, None: False}

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from rollcall.functions import ids, text as T, validate as V, versions
from rollcall.functions.cleaning import PROFILES, clean_pair, kind_of_line, laid_out, stripped


def value(spark, column, **named):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in named.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize("given,want", [("hb 1", "HB 1"), ("HB0001", "HB 1"), ("SJR AB", "SJR AB"), ("hjrb", "HJR B"), ("sb 12 x 007", "SB 12 X 007"), ("AB-1", "AB -1"), ("", ""), ("resolution", "RESOLUTION"), ("hb\xa0 02", "HB 2"), ("  x1", "X 1"), (None, None)])
def test_fix_bill_id(spark, given, want):
    assert value(spark, T.fix_bill_id(F.lit(given))) == want


@pytest.mark.parametrize("given,want", [("5551234567", "555-123-4567"), ("(555) 123-4567", "555-123-4567"), ("1-555-123-4567", "1-555-123-4567"), ("555.123.4567 Ext. 12", "555-123-4567 ext. 12"), ("call me", "call me"), ("", "")])
def test_phone(spark, given, want):
    assert value(spark, T.reformat_phone(F.lit(given))) == want


def test_small_text_functions(spark):
    f = lambda c: value(spark, c)
    assert f(T.reformat_address(F.lit("1 Main \n\n St\t x"))) == "1 Main;St x"
    assert f(T.collapse_whitespace(F.lit("a \xa0\n b"))) == "a b"
    assert f(T.clean_text(F.lit("a\xa0b\r\nc\t\td"))) == "a b\nc  d"  # blanks aren't joined
    assert f(T.org_name(F.lit("committee ON INSURANCE & the arts"))) == "Committee on insurance and the Arts"
    assert f(T.chamber_of_event(F.lit("House hearing"), F.lit("House"), F.lit("Senate"))) == "lower"
    assert f(T.chamber_of_event(F.lit("House/Senate joint"), F.lit("House"), F.lit("Senate"))) is None
    assert f(T.truncate_words(F.lit("a b  c d"), 2)) == "a b …" and f(T.truncate_words(F.lit("a b"), 2)) == "a b"
    assert f(T.keep_matching_lines(F.lit("1 first\nheader\x0c2 second\n"), r"^\d+\s(.*)$")) == "first\nsecond"
    assert f(T.numbered_share(F.lit("1 a\nb\n2 c\nd"))) == 0.5
    assert f(T.office_name(F.lit(""), F.lit("capitol"))) == "Capitol Office"
    assert f(T.is_block_page(F.lit(b"<html>Access Denied"), F.lit("application/pdf"))) and not f(T.is_block_page(F.lit(b"%PDF-1.4"), F.lit("application/pdf")))


def test_deep_map_and_tree(spark):
    kind = StructType([StructField("a", StringType()), StructField("l", ArrayType(StructType([StructField("b", StringType()), StructField("c", StringType())])))])
    df = spark.createDataFrame([((" x ", [(" y ", " z ")]),), (None,)], StructType([StructField("s", kind)]))
    out = [r[0] for r in df.select(T.deep_map(F.col("s"), kind, F.trim)).collect()]
    assert out[0].a == "x" and tuple(out[0].l[0]) == ("y", "z") and out[1] is None
    tree = {"l": {"b": [F.trim, F.upper]}}
    assert tuple(df.select(T.apply_tree(F.col("s"), kind, tree)).first()[0].l[0]) == ("Y", " z ")


def test_ids(spark):
    f = lambda c: value(spark, c)
    assert f(ids.pseudo_id(name=F.lit("A"), chamber=F.lit(None))) == '~{"name":"A"}'
    assert f(ids.read_pseudo_id(F.lit('~{"b":"1"}'))) == {"b": "1"} and f(ids.read_pseudo_id(F.lit("ocd-person/1"))) is None
    assert f(ids.pseudo_organization(F.lit("upper"), F.lit("o"))).status == "error" and f(ids.pseudo_organization(F.lit(None), F.lit(None), "legislature")).id == '~{"classification":"legislature"}'
    assert f(ids.bill_key(F.lit("ocd-jurisdiction/country:us/state:wi/government"), F.lit("2021 R"), F.lit("HB 12"))) == "ocd-bill-wi-2021r-hb12"
    space = "cf0cd5a6-2c1f-4a77-8d1c-4a0d8e3f4a11"
    for name in ("B000001", "é", ""):
        assert f(ids.name_uuid(space, F.lit(name))) == str(uuid.uuid5(uuid.UUID(space), name))
    parts = f(ids.division_parts(F.lit("ocd-division/country:us/state:wi/place:a:b"), F.lit("us")))
    assert [tuple(p) for p in parts] == [("state", "wi"), ("place", "a:b")] and f(ids.division_parts(F.lit("ocd-division/country:ca/x:y"), F.lit("us"))) is None
    assert f(ids.is_typed_id(F.lit(f"ocd-bill/{uuid.uuid4()}"), "bill")) and not f(ids.is_typed_id(F.lit("ocd-bill/1"), "bill"))
    assert f(ids.content_matches(F.lit(b"x"), F.lit('"9dd4e461268c8034f5c8564e155c67a6"'))) is True and f(ids.content_matches(F.lit(b"x"), F.lit("abc-2"))) is None
    assert f(ids.canonical_hash(F.lit(None), F.lit("a"))) != f(ids.canonical_hash(F.lit("a"), F.lit(None)))


@pytest.mark.parametrize("note,want", [("Substitute (S-1) - 2", (1, 1.02)), ("Engrossed Third Substitute House Bill", (1, 3.5)), ("c1", (1, 1.0)), ("e2", (2, 2.0)), ("Reported in House", (2, 0.25)), ("Governor Substitute", (3, 1.0)), ("Enrolled er", (3, 0.0)),
                                       ("Senate - ref Senate Engrossed", (2, 0.5)), ("Introduced", (0, 0.0)), ("Bill text", (0, 0.0)), ("mystery", (99, 0.0)), ("Session Law Chapter 9", (4, 9.0))])
def test_note_stage(spark, note, want):
    assert tuple(value(spark, versions.note_stage(F.lit(note)))) == want


def test_sort_key_takes_well_formed_dates_only(spark):
    assert value(spark, versions.sort_key(F.lit("Introduced"), F.lit("2020-01"))).date == "2020-01" and value(spark, versions.sort_key(F.lit("Introduced"), F.lit("May 2020"))).date == ""


def test_validators(spark):
    f = lambda c: value(spark, c)
    assert [f(V.is_fuzzy_date(F.lit(x))) for x in ("2020", "2020-13", "2020-02-30", "", None, "2020-1")] == [True, False, True, True, False, False]
    assert f(V.party_name(F.lit("Rep."))) == "Republican" and f(V.party_name(F.lit("Whig"))) == "Whig"
    found = f(V.person_problems(F.lit("Ann Lee"), F.lit(""), F.lit("Lee"), F.lit("x"), F.lit("20"), F.lit(""), F.lit("")))
    assert found == ["invalid person id", "invalid birth_date", "missing given_name, could be Ann"]
    assert f(V.role_problems(F.lit("upper"), F.lit(""), F.lit(""))) == ["role needs a district"] and f(V.role_problems(F.lit("mayor"), F.lit(""), F.lit("2020"))) == []
    assert f(V.is_phone(F.lit("555-123-4567 ext. 3"))) and not f(V.is_phone(F.lit("555")))
    assert f(V.is_handle(F.lit("name"))) and not f(V.is_handle(F.lit("@name"))) and not f(V.is_handle(F.lit("http://x")))


@pytest.mark.parametrize("line,want", [
    ("  12 ", "page"), ("26101118D", "page"), ("(14)", "page"), ("+", "rule"), ("——————", "rule"), ("1/9/26  10:32", "stamp"), ("01/09/2026 3:15 pm", "stamp"), ("[H 212]", "tag"), ("Patron—Smith", "sponsor"),
    ("Patrons: Smith and Jones", "sponsor"), ("Referred to Committee on Rules", "step"), ("Offered January 14, 2026", "step"), ("HOUSE BILL NO. 212", "heading"), ("2026 SESSION", "heading"), ("ENROLLED", "heading"),
    ("A BILL to amend the Code", None), ("The Senate shall meet.", None), ("Passed goods are taxed", None), ("Section 12 of the act", None), ("", None), ("THE ACT IS REPEALED.", None)])
def test_kind_of_line(line, want):
    assert kind_of_line(line) == want


def test_cleaning_profiles(spark):
    def pair(state, prior, text, media="text/html", prior_media="application/pdf", bill=True):
        a, b = clean_pair(state, F.lit(prior), F.lit(text), F.lit(prior_media), F.lit(media), F.lit(bill))
        return value(spark, F.struct(a.alias("a"), b.alias("b")))

    az = pair("az", "A. The fund is\nmade. Monies in the fund stay.\n\nB. Next; Whereas it ends.", "x")[0]
    assert az.split("\n") == ["A. The fund is made.", "Monies in the fund stay.", "", "B. Next;", "Whereas it ends."]
    body = "1  A BILL to amend the Code of Virginia.\n26101118D\nPatron—Smith\nBe it enacted by the General Assembly.   SB12\n" + "Text of it. " * 40
    va = pair("va", body, body)
    assert "Patron" not in va[0] and "26101118D" not in va[0] and "SB12" not in va[0] and va[0].startswith("A BILL") and max(map(len, va[0].split("\n"))) <= 90
    assert tuple(pair("va", "short", body)) == ("short", body) and pair("va", body, None)[1] is None
    wa = pair("wa", "HOUSE BILL 1337 State of Washington 69th Legislature 2025 Regular Session By Representatives A and B. Read first time 01/02/25. AN ACT Relating to Senate Bill 5129. Committee on Work. Z-0056.2 p. 2 HB 1337 More of it", "x")[0]
    assert wa == "AN ACT Relating to Senate Bill 5129.\nCommittee on Work.\nMore of it"
    mi = pair("mi", "Front matter. The People of\n the State of Michigan enact:\n1 Sec. 1. One  thing.\n2 Two\n  FDD H01234'23 1\x0c 12\n3 more.", "x")[0]
    assert mi == "Sec. 1. One thing.\nTwo more."
    assert pair("mi", "1 a\n2 b", "x", media="application/pdf")[0] == "a\nb"  # the same medium keeps its lines
    assert tuple(pair("tx", "a", "b")) == ("a", "b") and set(PROFILES) == {"az", "va", "wa", "mi"}
    assert stripped("", PROFILES["mi"]) == "" and laid_out("  \n ", 55, True) == ""


def test_long_text_is_fast():
    import time

    began = time.time()
    text = "RCW 64.32.250 and $1,234,567.89 on 2025-01-02 an a the people of the " * 20_000
    for p in PROFILES.values():
        assert max(map(len, laid_out(stripped(text, p), 55, p.blocks).split("\n"))) <= 55
    assert time.time() - began < 60

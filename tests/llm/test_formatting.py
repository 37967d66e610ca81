import json
import random
import re

from pyspark.sql import functions as F

from rollcall.llm.formatting import formatting_duplicates, json_fields

FIELDS = ["name", "description", "location.name"]
SCHEMA = "raw_id long, j string, record string, content string, first_id string"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    valid, content = json_fields(F.col("record"), FIELDS)
    members, representatives = formatting_duplicates(df, "raw_id", ["j"], content, valid, **kw)
    return sorted(tuple(r) for r in members.collect()), sorted(tuple(r) for r in representatives.collect())


def rec(name=None, description=None, location=None, **more):
    return json.dumps({"name": name, "description": description, "location": location, "_id": str(random.random()), **more})


def brute(rows):
    sets = {}
    for k, j, r in rows:
        try:
            o = json.loads(r)
        except (TypeError, ValueError):
            continue
        if not isinstance(o, dict) or k is None:
            continue
        bare = lambda x: re.sub(r"[\W_]", "", (x or "").lower())
        sets.setdefault((j, bare(o.get("name")), bare(o.get("description")), bare((o.get("location") or {}).get("name"))), []).append(k)
    return (sorted((min(v), k) for v in sets.values() for k in v if k != min(v)), sorted((min(v), len(v)) for v in sets.values()))


ROWS = [
    (1, "a", rec("Floor Session", "Docket 5", {"name": "Room 4"})), (2, "a", rec(" FLOOR—session!", "docket 5.", {"name": "room\n4"})), (3, "a", rec("Floor Session", "Docket 5", {"name": "Room 41"})),
    (4, "b", rec("Floor Session", "Docket 5", {"name": "Room 4"})), (5, None, rec("x")), (6, None, rec("X", "", None)), (7, "a", rec("ab", "c")), (8, "a", rec("a", "bc")),
    (9, "a", rec("É")), (10, "a", rec("é")), (11, "a", '<html>{"name": "x"}'), (12, "a", '{"name": "x"'), (13, "a", None), (14, "a", ""), (15, "a", "null"), (16, "a", rec()), (17, "a", "{}"),
    (18, "a", '{"description": "Docket 5", "location": {"url": "", "name": "Room 4"}, "name": "Floor session"}'), (None, "a", rec("Floor Session")), (19, "a", rec("y" * 20000)), (20, "a", rec("Y " * 20000)),
]


def test_cases(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_hot_sets_and_random_rows(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("ab"), rec(rng.choice(["Floor", "floor ", "FL-OOR", "Work", "w.o.r.k"]), rng.choice([None, "", "Docket", "d o c k e t"]))) for i in range(300)]
    want = brute(rows)
    assert run(spark, rows, hot_rows=5) == want and run(spark, rows) == want


def test_empty(spark):
    assert run(spark, []) == ([], [])

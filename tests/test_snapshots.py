import random

from pyspark.sql import functions as F

from rollcall.operators.snapshots import snapshot_changes

SCHEMA = "snap int, id long, at int, title string, tags array<string>, snapshot_no string"


def changes(spark, rows, schema=SCHEMA, key="id"):
    df = spark.createDataFrame(rows, schema)
    tags = F.array_sort(F.transform("tags", lambda x: F.coalesce(F.concat(F.lit("="), x), F.lit(""))))
    out = snapshot_changes(df, "snap", key, [F.col("title"), tags], latest_by=["at"], chunk_rows=3, range_rows=16)
    return sorted(tuple(r) for r in out.collect())


def test_added_removed_changed_and_nulls(spark):
    rows = [
        (1, 1, 0, "a", ["x", "y"], None), (2, 1, 0, "a", ["y", "x"], None),  # order of tags doesn't count
        (1, 2, 0, None, None, None), (2, 2, 0, None, None, None),            # nulls are equal to nulls
        (1, 3, 0, None, [], None), (2, 3, 0, "", [], None),                  # null differs from empty
        (1, 4, 0, "t", None, None), (2, 4, 0, "t", [], None),                # null array differs from empty
        (1, 5, 0, "gone", [], None), (2, 6, 0, "new", [], None),
        (1, 7, 0, "t", ["x"], None), (2, 7, 0, "t", ["x", "x"], None),       # counts of tags count
        (1, 8, 0, "ab", ["c"], None), (2, 8, 0, "a", ["bc"], None),
        (1, None, 0, "null key", [], None), (None, 9, 0, "null snapshot", [], None),
    ]
    assert changes(spark, rows) == [(2, 3, "changed"), (2, 4, "changed"), (2, 5, "removed"), (2, 6, "added"), (2, 7, "changed"), (2, 8, "changed")]


def test_repeated_deliveries_latest_counts(spark):
    rows = [(1, 1, 1, "old", [], None), (1, 1, 5, "new", [], None), (1, 1, 5, "new", [], None), (2, 1, 1, "new", [], None), (2, 1, 0, "x", [], None)]
    assert changes(spark, rows) == []


def test_empty_and_single_snapshot(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(1, 1, 0, "a", [], None)]) == []


def test_gap_in_snapshot_numbers_compares_with_the_one_before(spark):
    assert changes(spark, [(1, 1, 0, "a", [], None), (5, 1, 0, "b", [], None)]) == [(5, 1, "changed")]


def brute(rows):
    latest = {}
    for s, k, at, title, tags, _ in rows:
        if (s, k) not in latest or latest[s, k][0] < at:
            latest[s, k] = (at, title, sorted(tags))
    steps = sorted({s for s, _ in latest})
    out = []
    for a, b in zip(steps, steps[1:]):
        old, new = ({k: v[1:] for (s, k), v in latest.items() if s == x} for x in (a, b))
        out += [(b, k, "added") for k in new.keys() - old.keys()] + [(b, k, "removed") for k in old.keys() - new.keys()]
        out += [(b, k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]]
    return sorted(out)


def test_random_against_brute_force(spark):
    rng = random.Random(4)
    rows, state = [], {k: (f"t{k}", ["a"]) for k in range(150)}
    for s in range(1, 6):
        for k, (title, tags) in state.items():
            rows.append((s, k, s * 10, title, tags, None))
            if rng.random() < 0.1:
                rows.append((s, k, s * 10 - 1, "late", [], None))
        for k in rng.sample(sorted(state), 8):
            state[k] = (f"{state[k][0]}!", rng.sample(["a", "b", "c"], 2))
        for k in rng.sample(sorted(state), 4):
            del state[k]
        state |= {200 + s * 10 + i: ("new", []) for i in range(5)}
    rng.shuffle(rows)
    assert changes(spark, rows) == brute(rows)
    text = [(s, f"key-{k}", at, title, tags, x) for s, k, at, title, tags, x in rows]
    got = changes(spark, text, SCHEMA.replace("id long", "id string"))
    assert got == sorted((s, f"key-{k}", c) for s, k, c in brute(rows))

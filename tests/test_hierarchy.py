import random

import pytest

from rollcall.operators.hierarchy import descendants, resolve_hierarchy

SCHEMA = "id string, up string, node string, parent string"


def resolved(spark, rows, **kw):
    df = spark.createDataFrame([(a, b, "clash", "clash") for a, b in rows], SCHEMA)
    return resolve_hierarchy(df, "id", "up", **kw)


def brute(rows):
    parent = {}
    for n, p in rows:
        if n is not None:
            known = [x for x in (parent.get(n), p) if x is not None]
            parent[n] = min(known) if known else None
    live = {n: p if p in parent else None for n, p in parent.items()}
    out = {}
    for n in live:
        seen, at = [n], n
        while live[at] is not None and live[at] not in seen:
            at = live[at]
            seen.append(at)
        if live[at] is None:
            out[n] = (at, len(seen) - 1, "tree")
        else:
            first = seen.index(live[at])
            out[n] = (min(seen[first:]), first, "cycle" if first == 0 else "into_cycle")
    return out


def got(df):
    rows = df.select("node", "root", "depth", "kind").collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: (r.root, r.depth, r.kind) for r in rows}


EDGES = [("a", None), ("b", "a"), ("c", "b"), ("b", "a"), ("d", "missing"), ("e", "d"), ("s", "s"), ("t", "s"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "z"), ("v", "w"), (None, "a"), ("m", None), ("m", "a")]


@pytest.mark.parametrize("local", [100, 3, 0])
def test_kinds_repeats_and_dangling(spark, local):
    assert got(resolved(spark, EDGES, local_nodes=local)) == brute(EDGES)


def test_empty(spark):
    assert resolved(spark, []).collect() == []


@pytest.mark.parametrize("local", [1000, 20])
def test_random_forest_with_cycles(spark, local):
    rng = random.Random(local)
    names = [f"n{i:03d}" for i in range(120)]
    rows = [(n, rng.choice([None, *names, *names[:5], "nowhere"])) for n in names]
    assert got(resolved(spark, rows, local_nodes=local)) == brute(rows)


def test_paths_sizes_and_descendants(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("d", "b"), ("e", None)]
    for local in (100, 1):
        r = resolved(spark, rows, local_nodes=local)
        assert {x.node: (x.path, x.subtree) for x in r.collect()} == {"a": (["a"], 4), "b": (["a", "b"], 3), "c": (["a", "b", "c"], 1), "d": (["a", "b", "d"], 1), "e": (["e"], 1)}
        assert sorted(tuple(x) for x in descendants(r).collect()) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "c", 1), ("b", "d", 1)]


def test_deep_chain(spark):
    rows = [(f"{i:04d}", f"{i - 1:04d}" if i else None) for i in range(400)]
    out = got(resolved(spark, rows))
    assert out["0399"] == ("0000", 399, "tree")


def test_a_long_chain_and_a_long_ring_are_contracted(spark):
    """Both take some dozen rounds, not a thousand: a tree at the end, a tail into the ring, branches on both."""
    rows = [(f"c{i:05d}", f"c{i - 1:05d}" if i else None) for i in range(1_000)] + [(f"r{i:03d}", f"r{(i + 1) % 60:03d}") for i in range(60)]
    rows += [("t1", "r007"), ("t2", "t1"), ("b1", "c00100"), ("b2", "b1"), ("b3", "b1")]
    out = {r.node: (r.root, r.depth, r.kind, r.subtree) for r in resolved(spark, rows, local_nodes=0, with_path=False).collect()}
    assert out["c00999"] == ("c00000", 999, "tree", 1) and out["c00100"] == ("c00000", 100, "tree", 903) and out["c00000"][3] == 1_003
    assert out["b3"] == ("c00000", 102, "tree", 1) and out["b1"][3] == 3
    assert out["r050"] == ("r000", 0, "cycle", 62) and out["t2"] == ("r000", 2, "into_cycle", 1) and out["t1"][3] == 2
    assert len(out) == len(rows)


def brute_pairs(rows):
    parent = {}
    for n, p in rows:
        if n is not None:
            known = [x for x in (parent.get(n), p) if x is not None]
            parent[n] = min(known) if known else None
    pairs = set()
    for n in parent:
        seen, at = [n], parent[n]
        while at in parent and at not in seen:
            pairs.add((at, n, len(seen)))
            seen.append(at)
            at = parent[at]
    return pairs


@pytest.mark.parametrize("local", [100, 0])
def test_descendants_of_ring_nodes(spark, local):
    rows = [("x", "y"), ("y", "z"), ("z", "x"), ("w", "z"), ("v", "w"), ("s", "s"), ("t", "s"), ("a", None), ("b", "a"), ("c", "gone")]
    rng = random.Random(4)
    names = [f"n{i:02d}" for i in range(60)]
    for r in (rows, EDGES, [(n, rng.choice([None, *names, "nowhere"])) for n in names]):
        out = [tuple(x) for x in descendants(resolved(spark, r, local_nodes=local)).collect()]
        assert len(out) == len(set(out)) and set(out) == brute_pairs(r)
        assert all(x.subtree == 1 + sum(a == x.node for a, _, _ in out) for x in resolved(spark, r, local_nodes=local).collect())
    some = spark.createDataFrame([("x",), ("w",)], "node string")
    assert {tuple(x) for x in descendants(resolved(spark, rows, local_nodes=local), some).collect()} == {p for p in brute_pairs(rows) if p[0] in ("x", "w")}

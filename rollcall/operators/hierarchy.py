"""Parent-child links to full hierarchies by leaf peeling."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.session import cut

#: When at most this many nodes are left unpeeled, one task peels them to the end (a few hundred bytes a node).
LOCAL_NODES = 100_000
#: A round that takes off a smaller share of the nodes is followed by the contraction of chains.
LEAST_SHARE = 0.25

_SOLVED = "node string, root string, depth int, kind string, path array<string>, subtree long"
_NO_NAMES = "array<string>"


def resolve_hierarchy(df: DataFrame, node: str, parent: str, with_path: bool = True, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row per distinct node: ``node``, ``parent``, ``root``, ``depth``, ``kind``, ``path``, ``subtree``.

    ``kind``: ``tree``, ``cycle`` (the node lies on a cycle; root = smallest node of it, depth 0) or
    ``into_cycle`` (it leads to one; depth = links to the first node on it). ``path`` lists the nodes from the
    root (for cycles: the first node on the cycle) to the node; ``subtree`` counts the node and all its
    descendants, on a cycle all of the cycle and all that leads to it. A parent that isn't a node ends the path at the row holding it. Repeated rows
    count once; if a node is given several parents, the smallest counts; null nodes are ignored, an empty
    table gives an empty result and other columns are ignored.

    Method. Bottom-up peeling: each round takes off all nodes without unpeeled children, which send their subtree size to
    the parent. Long chains and cycles give too little to peel: after a round that took off less than ``LEAST_SHARE``, runs
    of nodes with one child each are contracted by pointer doubling into one link with its length, its sizes and its
    smallest node; runs that end nowhere are cycles. So the rounds grow with the logarithm of the nodes, whatever the
    depth. What is left is closed under parents, so as soon as at most ``local_nodes`` nodes are left (counted), one task
    ends the peeling. In reverse order each layer takes root, depth and path from its parents. A parent with very many
    children is pre-aggregated on the way up and split by adaptive execution on the way down.
    """
    named = (df.filter(F.col(node).isNotNull())
             .groupBy(F.col(node).alias("node")).agg(F.min(F.col(parent)).alias("parent")))
    linked = named.join(named.select(F.col("node").alias("parent"), F.lit(True).alias("known")), "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"))
    fan_in = linked.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("deg"))
    state = cut(linked.join(fan_in, "node", "left").select(
        "node", "parent", F.lit(1).cast("long").alias("subtree"), F.coalesce("deg", F.lit(0)).alias("deg"), F.lit(1).alias("steps"), F.lit(None).cast("string").alias("low"),
        F.lit(0).cast("long").alias("link"), (F.array() if with_path else F.lit(None)).cast(_NO_NAMES).alias("via")))

    layers: list[tuple[str, DataFrame]] = []
    solved: list[DataFrame] = []
    left = state.count()
    while left > local_nodes:
        leaves = state.filter("deg = 0")
        sent = leaves.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.sum(F.col("subtree") + F.col("link")).alias("got"), F.count("*").alias("gone"))
        state = cut(state.filter("deg > 0").join(sent, "node", "left").select(
            "node", "parent", (F.col("subtree") + F.coalesce("got", F.lit(0))).alias("subtree"), (F.col("deg") - F.coalesce("gone", F.lit(0))).alias("deg"), "steps", "low", "link", "via"))
        layers.append(("leaves", leaves))
        before, left = left, state.count()
        if left > local_nodes and left > before * (1 - LEAST_SHARE):
            chains, rings, state = _contracted(state, with_path)
            layers.append(("chains", chains))
            solved.append(rings)
            left = state.count()
    if left:
        solved.append(state.coalesce(1).mapInPandas(lambda batches: _solve_local(batches, with_path), schema=_SOLVED))
    done = df.sparkSession.createDataFrame([], _SOLVED)
    for part in solved:
        done = done.unionByName(part)
    done = cut(done)
    through = lambda path: F.concat(path, F.col("via"), F.array("node")) if with_path else F.lit(None).cast(_NO_NAMES)
    below = lambda kind: F.when(kind == "tree", "tree").otherwise("into_cycle")
    own = F.array("node") if with_path else F.lit(None).cast(_NO_NAMES)
    for kind, layer in reversed(layers):
        above = done.select(F.col("node").alias("parent"), F.col("root").alias("r"), F.col("depth").alias("d"), F.col("kind").alias("k"), F.col("path").alias("p"))
        hangs = layer.join(above, "parent")
        if kind == "leaves":
            grown = hangs.select("node", F.col("r").alias("root"), (F.col("d") + F.col("steps")).alias("depth"), below(F.col("k")).alias("kind"), through(F.col("p")).alias("path"), "subtree")
            alone = layer.filter("parent is null").select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.lit("tree").alias("kind"), own.alias("path"), "subtree")
            grown = grown.unionByName(alone)
        else:
            under = done.select(F.col("node").alias("bottom"), F.col("root").alias("b_root"), F.col("kind").alias("b_kind"), F.col("subtree").alias("b_subtree"))
            ring = F.col("b_kind") == "cycle"
            grown = hangs.join(under, "bottom").select(
                "node", F.when(ring, F.col("b_root")).otherwise(F.col("r")).alias("root"), F.when(ring, 0).otherwise(F.col("d") + F.col("steps")).alias("depth"),
                F.when(ring, "cycle").otherwise(below(F.col("k"))).alias("kind"), F.when(ring, own).otherwise(through(F.col("p"))).alias("path"),
                F.when(ring, F.col("b_subtree")).otherwise(F.col("b_subtree") + F.col("b_link") + F.col("whole") - F.col("above") + F.col("subtree")).alias("subtree"))
        done = cut(done.unionByName(grown))
    return named.join(done, "node")


def _contracted(state: DataFrame, with_path: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chains, rings, rest): nodes with one child taken out of ``state``, and the links that go over them.

    Each such node is led upwards by pointer doubling to the first node of another kind (``parent``), with the links to it
    (``steps``), the smallest node and the sizes on the way (``above``), and the uppermost node of its run (``top``).
    Runs of length n take log2(n) rounds. The node below a run (``bottom``) gets one link over all of it, and with it the run's
    sizes. What never gets anywhere is a ring.
    """
    unary = (F.col("deg") == 1) & F.col("parent").isNotNull()
    runs = state.filter(unary).select("node", F.col("parent").alias("to"), "steps", F.least("node", "low").alias("low"), (F.col("subtree") + F.col("link")).alias("above"), F.col("node").alias("top"), "via")
    before = (-1, 0)
    while True:
        up = runs.select(F.col("node").alias("to"), *[F.col(c).alias(f"__{c}") for c in ("to", "steps", "low", "above", "top", "via")])
        met = F.col("__to").isNotNull()
        via = F.when(met, F.concat("__via", F.array("to"), "via")).otherwise(F.col("via")) if with_path else F.col("via")
        runs = cut(runs.join(up, "to", "left").select(
            "node", F.coalesce("__to", "to").alias("to"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"), F.least("low", "__low").alias("low"),
            (F.col("above") + F.coalesce("__above", F.lit(0))).alias("above"), F.coalesce("__top", "top").alias("top"), via.alias("via"), met.alias("open"), F.coalesce(F.col("__low") < F.col("low"), F.lit(False)).alias("moved")))
        now = runs.agg(F.count_if("open"), F.count_if(F.col("open") & F.col("moved"))).first()
        if not now[0] or (now[0] == before[0] and not now[1]):
            break
        before = now
        runs = runs.drop("open", "moved")
    ends, open_runs = runs.filter(~F.col("open")).drop("open", "moved"), runs.filter("open")
    run_of = ends.select(F.col("node").alias("parent"), F.col("to").alias("__to"), F.col("steps").alias("__steps"), F.col("low").alias("__low"), F.col("above").alias("__above"), F.col("top").alias("__top"), F.col("via").alias("__via"))
    rest = cut(state.filter(~unary).join(run_of, "parent", "left"))
    chain_of = rest.filter("__top is not null").select(F.col("__top").alias("top"), F.col("node").alias("bottom"), F.col("__above").alias("whole"), F.col("link").alias("b_link"))
    chains = cut(ends.join(chain_of, "top").join(state.select("node", "subtree"), "node").select("node", F.col("to").alias("parent"), "steps", "via", "above", "bottom", "whole", "b_link", "subtree"))
    over = F.col("__to").isNotNull()
    via = F.when(over, F.concat("__via", F.array("parent"), "via")).otherwise(F.col("via")) if with_path else F.col("via")
    state_after = cut(rest.select(
        "node", F.coalesce("__to", "parent").alias("parent"), "subtree", "deg", (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"),
        F.least("low", "__low").alias("low"), (F.col("link") + F.coalesce("__above", F.lit(0))).alias("link"), via.alias("via")))
    members = open_runs.select("node", "low").join(state.select("node", (F.col("subtree") + F.col("link")).alias("size")), "node")
    rings = members.select("node", "low").join(members.groupBy("low").agg(F.sum("size").alias("subtree")), "low").select(
        "node", F.col("low").alias("root"), F.lit(0).alias("depth"), F.lit("cycle").alias("kind"), (F.array("node") if with_path else F.lit(None)).cast(_NO_NAMES).alias("path"), "subtree")
    return chains, rings, state_after


def descendants(resolved: DataFrame, of: DataFrame | None = None, node: str = "node") -> DataFrame:
    """(``ancestor``, ``descendant``, ``distance``): every other node from which the ancestor is reached, and in how many links.

    On a tree, and up to the first node on a cycle, made by exploding each node's own path, so no list of descendants
    is ever gathered in one row. All nodes of a cycle are reached from each other and from what leads to the cycle:
    each cycle is walked once for the places of its nodes (one row a node), and nodes on or behind it are joined to
    them. A node isn't its own descendant. ``of`` (a column ``node``) restricts the ancestors.
    """
    up = resolved.select(F.col("node").alias("descendant"), F.posexplode(F.reverse("path")).alias("distance", "ancestor")).filter("distance > 0")
    places = resolved.filter("kind = 'cycle'").select("node", "parent", "root").groupBy("root").applyInPandas(_places, "root string, node string, place int, ring int")
    first = resolved.filter("kind <> 'tree'").select(F.col("node").alias("descendant"), "root", "depth", F.col("path")[0].alias("first"))
    onto = first.join(places.select(F.col("node").alias("first"), F.col("place").alias("at")), "first")
    targets = places.select("root", F.col("node").alias("ancestor"), "place", "ring")
    if of is not None:
        wanted = of.select(F.col(node).alias("ancestor")).distinct()
        up, targets = up.join(wanted, "ancestor", "left_semi"), targets.join(wanted, "ancestor", "left_semi")
    around = onto.join(targets, "root").filter("place <> at").select(
        "ancestor", "descendant", (F.col("depth") + F.pmod(F.col("place") - F.col("at"), F.col("ring"))).alias("distance"))
    return up.select("ancestor", "descendant", "distance").unionByName(around)


def _places(pdf: pd.DataFrame) -> pd.DataFrame:
    """Places of the nodes of one cycle in the order of its links, from its smallest node."""
    parent = dict(zip(pdf["node"], pdf["parent"], strict=True))
    ring = [pdf["root"].iloc[0]]
    while (nxt := parent[ring[-1]]) != ring[0]:
        ring.append(nxt)
    return pd.DataFrame({"root": ring[0], "node": ring, "place": range(len(ring)), "ring": len(ring)})


def _solve_local(batches: Iterator[pd.DataFrame], with_path: bool) -> Iterator[pd.DataFrame]:
    """Peeling of the bounded rest: leaves first, cycles are what stays, then roots and depths in reverse order."""
    parent: dict[str, str | None] = {}
    size: dict[str, int] = {}
    over: dict[str, tuple[int, str, int, list[str]]] = {}  # the link: steps, smallest node on it, sizes on it, nodes on it
    for pdf in batches:
        for n, p, s, steps, low, link, via in zip(pdf["node"], pdf["parent"], pdf["subtree"], pdf["steps"], pdf["low"], pdf["link"], pdf["via"], strict=True):
            parent[n] = p if isinstance(p, str) else None
            size[n] = int(s)
            over[n] = (int(steps), low if isinstance(low, str) else n, int(link), list(via) if via is not None else [])
    children = dict.fromkeys(parent, 0)
    for p in parent.values():
        if p is not None:
            children[p] += 1
    peeled = [n for n, c in children.items() if c == 0]
    for n in peeled:  # grows while it is read
        p = parent[n]
        if p is not None:
            size[p] += size[n] + over[n][2]
            children[p] -= 1
            if children[p] == 0:
                peeled.append(p)
    solved: dict[str, tuple[str, int, str]] = {}
    off = set(peeled)
    for n in parent:
        if n in off or n in solved:
            continue
        ring = [n]
        while (nxt := parent[ring[-1]]) != n:
            ring.append(nxt)
        whole, low = sum(size[m] + over[m][2] for m in ring), min(min(m, over[m][1]) for m in ring)
        for m in ring:
            size[m] = whole
            solved[m] = (low, 0, "cycle")
    for n in reversed(peeled):
        p = parent[n]
        if p is None:
            solved[n] = (n, 0, "tree")
        else:
            root, depth, kind = solved[p]
            solved[n] = (root, depth + over[n][0], "tree" if kind == "tree" else "into_cycle")
    rows, held = [], 0
    for n in parent:
        root, depth, kind = solved[n]
        path = None
        if with_path:  # walked when it is given out, so that only a batch of paths is held
            path, at, to_go = [n], n, depth
            while to_go:
                path.extend(reversed(over[at][3]))
                to_go -= over[at][0]
                at = parent[at]
                path.append(at)
            path.reverse()
        rows.append((n, root, depth, kind, path, size[n]))
        held += 1 + (depth if with_path else 0)
        if held >= 200_000:
            yield pd.DataFrame(rows, columns=["node", "root", "depth", "kind", "path", "subtree"])
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["node", "root", "depth", "kind", "path", "subtree"])

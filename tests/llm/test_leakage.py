import random

from rollcall.llm.leakage import find_leaks, remove_leaks, words

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, suite string"


def brute(docs, items, n):
    grams = lambda t: {tuple(w[i:i + n]) for w in [words(t)] for i in range(len(w) - n + 1)}
    return sorted({(d, i) for d, t in docs if t for i, s in items if s and grams(t) & grams(s)})


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(*x, "clash") for x in docs], DOCS)
    i = spark.createDataFrame([(*x, "clash") for x in items], ITEMS)
    return find_leaks(d, "doc_id", "text", i, "item_id", "text", **kw)


def test_random_against_brute_force_in_any_block_size(spark):
    rng = random.Random(3)
    vocabulary = ["the", "Bill", "clause", "7", "ÉTÉ", "water"]
    text = lambda n: rng.choice([" ", ", ", "-\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(3, 25))) for i in range(12)] + [(90, None), (91, ""), (1, None)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    docs += [(100, "PREFIX " + items[2][1].upper().replace(" ", "__") + " x"), (101, None), (102, ""), (103, "the " * 20000)]
    for block in (10**6, 20):
        got = found(spark, docs, items, n=6, block_grams=block)
        assert sorted(tuple(r) for r in got.collect()) == brute(docs, items, 6)


def test_spans_and_removal(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    docs = [(1, f"Before, {passage.upper()} after."), (2, "clean text only"), (3, passage.rsplit(" ", 2)[0]), (1, f"Before, {passage.upper()} after.")]
    items = [(7, passage), (7, passage)]
    spans = found(spark, docs, items, spans=True)
    assert [(r.doc_id, r.item_id, r.begin, r.end) for r in spans.collect()] == [(1, 7, 8, 8 + len(passage))]
    d = spark.createDataFrame([(*x, "") for x in docs], DOCS)
    assert {r.doc_id for r in remove_leaks(d, "doc_id", "text", spans).collect()} == {2, 3}
    kept = {r.doc_id: r.text for r in remove_leaks(d, "doc_id", "text", spans, whole=False).collect()}
    assert kept[1] == "Before,  after." and kept[2] == "clean text only"


def test_nothing_to_find(spark):
    assert found(spark, [(1, "a " * 40)], []).collect() == []
    assert found(spark, [], [(1, "a " * 40)]).collect() == []


def test_folding_changes_no_runs(spark):
    assert words("İstanbul COUNCIL Straße") == ["i̇stanbul", "council", "strasse"]
    passage = "İstanbul " + " ".join(f"w{i}" for i in range(20))
    spans = found(spark, [(1, f"so: {passage.upper()}; end")], [(7, passage)], spans=True)
    assert [(r.begin, r.end) for r in spans.collect()] == [(4, 4 + len(passage))]

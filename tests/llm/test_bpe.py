import os
import random

import pytest

from rollcall.llm.bpe import PrefixTable
from rollcall.llm.encode import encode_corpus, encoder, split_corpus, split_text, tokenizer_path

PATH = tokenizer_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")
ALPHABET = "abcdeéñ 's\n\t \x1c\x85 ​12٣%$<|endoftext|>'lleT漢字🙂\\ŕªʼ "


@pytest.fixture(scope="module")
def e():
    return encoder(PATH)


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_equals_the_public_tokenizer(e, reference):
    rng = random.Random(1)
    texts = ["", " ", "\n\n", "it's <|endoftext|> we'll", "a" * 3000, "In2021,theCommission" * 50, "  two  blanks \r\n\r\n x", "­soft", "\x1c\x1d a"]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for x in texts:
        assert e.encode(x) == reference(x), repr(x)
        assert e.decode(e.encode(x)) == x.encode()


def test_appends_and_edits_are_exact(e, reference):
    rng = random.Random(2)
    word = lambda n: bytes(rng.choice(b"abcdefghinostrABC") for _ in range(n))
    for _ in range(60):
        data = word(rng.randint(1, 60))
        t = PrefixTable(e.v, data)
        for _ in range(4):
            more = word(rng.randint(1, 9))
            t.append(more)
            data += more
            assert t.ids() == reference(data.decode())
            at, cut, new = rng.randrange(len(data)), rng.randint(0, 6), word(rng.randint(0, 5))
            t.edit(at, cut, new)
            data = data[:at] + new + data[at + cut:]
            assert t.ids() == (reference(data.decode()) if data else [])


def test_rank_file_gives_the_same_ids(e):
    other = encoder(tokenizer_path("byte_bpe_50k.tiktoken"))
    for x in ("An act relating to $448,050 — Sección 5.", "x" * 700):
        assert other.encode(x) == e.encode(x)


def test_corpus(spark, e):
    rows = [(1, "a b", "x"), (2, "", "x"), (3, None, "x"), (None, "a b", "x"), (1, "a b", "x"), (4, "word " * 30000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = encode_corpus(df, "doc_id", "text").collect()
    assert sorted((r.doc_id or 0, len(r.ids)) for r in out) == [(0, 2), (1, 2), (1, 2), (2, 0), (3, 0), (4, 30001)]
    assert {tuple(r.ids) for r in out if r.doc_id == 1} == {tuple(e.encode("a b"))}
    assert encode_corpus(df.filter("false"), "doc_id", "text").collect() == []


def check_pieces(e, text, pieces, limit, overlap):
    assert pieces[0].start == 0 and pieces[-1].end == len(text)
    for p in pieces:
        assert 0 < p.tokens == len(e.encode(text[p.start:p.end])) <= limit
    for a, b in zip(pieces, pieces[1:]):
        assert a.start < b.start <= a.end < b.end
        assert len(e.encode(text[b.start:a.end])) <= overlap


@pytest.mark.parametrize("limit,overlap", [(512, 64), (40, 8), (20, 0)])
def test_pieces_cover_within_the_limit(e, limit, overlap):
    rng = random.Random(limit)
    words = ["Section", "council", "voted.", "The", "budget;", "passed!", "\n\nSECTION 3. ", "\r\n", "1998,", "naïve", "Aye.Nay", "🙂🙂", "…"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (30, 300, 1500)]
    texts += ["unbroken" * 400, "Inthe2021session.Thebillwaspassed." * 60, "漢字" * 400, "\n" * 900, "a" * 2000 + "\n\n" + "b c " * 400, "🙂" * 500]
    for text in texts:
        pieces = split_text(e, text, limit, overlap)
        if len(pieces) > 1:
            check_pieces(e, text, pieces, limit, overlap)
        else:
            assert pieces[0].tokens <= limit and (pieces[0].start, pieces[0].end) == (0, len(text))


def test_cuts_prefer_strong_boundaries(e):
    body = "The committee met and voted on the bill in the morning. " * 12
    text = "\n\n".join(f"SECTION {i}.  {body.strip()}" for i in range(1, 8))
    pieces = split_text(e, text, 300, 30)
    assert all(text[p.end:].startswith("\n\nSECTION") for p in pieces[:-1])
    plain = split_text(e, body * 8, 300, 30)
    assert all((body * 8)[:p.end].endswith(".") for p in plain[:-1])
    longest = split_text(e, ("word " * 100 + "end. ") + "more " * 600, 300, 30)
    assert longest[0].end == len("word " * 100 + "end.")  # the only sentence end, though below half the limit


def test_split_corpus(spark):
    rows = [(1, "short", 9), (2, None, 9), (3, "", 9), (4, "A sentence here. " * 400, 9), (4, "A sentence here. " * 400, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece long")
    out = split_corpus(df, "doc_id", "text").collect()
    assert {r.doc_id for r in out} == {4} and all(r.n_tokens <= 512 for r in out)
    text = rows[3][1]
    assert all(text[r.start:r.end] == r.piece for r in out)
    every = split_corpus(df, "doc_id", "text", only_oversized=False).collect()
    assert {r.doc_id for r in every} == {1, 4}
    assert split_corpus(df.filter("false"), "doc_id", "text").collect() == []


def test_documents_are_appended_to_and_edited(e):
    from rollcall.llm.bpe import Document

    rng = random.Random(5)
    piece = lambda: "".join(rng.choice(["word", " ", "\n\n", "it's", "é", " 12", "a" * 50, "\t ", "x"]) for _ in range(rng.randint(0, 8)))
    for _ in range(150):
        d, text = Document(e), ""
        for _ in range(6):
            if rng.random() < 0.5:
                more = piece()
                d.append(more)
                text += more
            else:
                at = rng.randint(0, len(text))
                cut, new = rng.randint(0, len(text) - at), piece()
                d.edit(at, cut, new)
                text = text[:at] + new + text[at + cut:]
            assert d.text() == text and d.ids() == e.encode(text)


def test_long_pretoken_edits_stop_where_the_tables_agree(e):
    data = b"abcdefghij" * 3000
    t = PrefixTable(e.v, data)
    seen = []
    plain = t.append
    t.append = lambda more: (seen.append(len(more)), plain(more))
    t.edit(5, 3, b"zz")
    assert t.ids() == PrefixTable(e.v, data[:5] + b"zz" + data[8:]).ids() and sum(seen) < 3000


def test_pieces_keep_the_kind_of_key(spark):
    df = spark.createDataFrame([("doc-a", "A sentence here. " * 400)], "k string, text string")
    assert {r.k for r in split_corpus(df, "k", "text").collect()} == {"doc-a"}

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from samples import docs, nothing  # noqa: F401
from tidemark.llm import alignment
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.text import Block, blocks

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def known():
    return alignment.Vocabulary(A, B)


def tokens(known, text):
    """Ids of a whole text by both, without any cut; none if bytes differ."""
    a = known.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = known.b.encode(text) if text else []
    same = b"".join(known.spell_a.bytes[k] for k in a) == b"".join(known.spell_b.bytes[k] for k in b) == (" " + text).encode()
    return (a, b) if text and same else ([], [])


def aligned(known, text):
    """Groups and links by plain loops over byte ranges."""
    a, b = tokens(known, text or "")
    spans = []
    for ids, names in ((a, known.spell_a.bytes), (b, known.spell_b.bytes)):
        at, out = 0, []
        for k in ids:
            out.append((at, at + len(names[k])))
            at += len(names[k])
        spans.append(out)
    links, j = [], 0
    for (s, e), x in zip(spans[0], a):
        while j < len(b) and spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < e:
            links.append((x, b[k]))
            k += 1
    ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, start = [], 0
    for end in ends:
        inside = [[str(k) for (s, e), k in zip(span, ids) if start <= s and e <= end] for span, ids in zip(spans, (a, b))]
        groups.append("|".join(",".join(x) for x in inside))
        start = end
    return len(a), len(b), groups, links


def brute(known, rows):
    every = [(key, *aligned(known, text)) for key, text in rows]
    counts = Counter(p for *_, links in every for p in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [(key, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for key, n_a, n_b, groups, links in every]


TEXTS = [None, "", " ", "\n", "a", " a", "a<|endoftext|>b", "<s>x</s> <unk>", "▁ is a space to one", "tabs\t\tand  runs   of    spaces\n\n\nlines\r\n",
         "Straße über 北京市 😀😀 naïve ﬁ é", "zero\0byte", "aaaaaaaaaa aaaa", "x" * 500, "1234567890 3.14159", "   　z", "def f(x):\n    return x ** 2\n",
         "thth ththth the The THE", "the the the"]


@pytest.mark.parametrize("common", [0, 5, alignment.COMMON])
def test_against_loops(spark, known, common):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, "the same id"), (None, "no id"), (18, "the the the")]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, key string, n_a long").repartition(3)
    got = alignment.align(table, A, B, common=common).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(known, rows), key=repr)


def test_whole_documents(spark, docs, known):
    want = brute(known, [(r.doc_id, r.text) for r in docs.where("length(text) < 3000 or text is null").collect()])
    got = alignment.align(docs.where("length(text) < 3000 or text is null"), A, B).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_pair_counts(spark, known):
    table = spark.createDataFrame([(1, "the thing"), (2, "the other"), (2, "the other")], "doc_id long, text string")
    want = Counter(p for t in ("the thing", "the other", "the other") for p in set(aligned(known, t)[3]))
    assert {(r.a, r.b): r.n for r in alignment.pair_counts(table, A, B).collect()} == dict(want)


LETTERS = st.text(alphabet=" \n\t\r 　▁ab'sé中<|endoftext|>9.", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(LETTERS, st.text(max_size=30)), min_size=1, max_size=4))
def test_pieces_align_as_the_text_does(known, texts):
    read = alignment.reader(A, B)
    for block in blocks(pa.array([" " + t if t else None for t in texts], pa.string())):
        (span,) = read.spans(block)
        sums, whole = span.total(span.kinds.sums), span.whole()
        for k, text in enumerate(texts):
            n_a, n_b, groups, links = aligned(known, text)
            assert whole[k] == (not text or n_a > 0)
            if whole[k]:
                mine = span.kind[span.bounds[k]:span.bounds[k + 1]]
                assert sums[k].tolist() == [n_a, n_b, len(groups), len(links)]
                assert b";".join(span.kinds.groups[i] for i in mine) == ";".join(groups).encode()


def test_long_texts_come_in_spans(spark, known, monkeypatch):
    text = "some words, naïve ones, run on\n" * 200 + "q" * 3_000 + " end"
    monkeypatch.setattr(alignment, "SPAN", 512)
    data = np.frombuffer((" " + text).encode(), np.uint8)
    spans = list(alignment.Reader(A, B).spans(Block(0, data, np.array([0, len(data)]))))
    n_a, n_b, groups, links = aligned(known, text)
    assert len(spans) > 5 and sum(s.total(s.kinds.sums)[0] for s in spans).tolist() == [n_a, n_b, len(groups), len(links)]
    assert b";".join(s.kinds.groups[i] for s in spans for i in s.kind) == ";".join(groups).encode()


def test_one_hash_for_two_pieces_is_noticed(known, monkeypatch):
    monkeypatch.setattr(Block, "hashes", lambda self, starts, ends, **_: np.ones(len(starts), np.uint64))
    block = next(blocks(pa.array([" some words here"])))
    span = alignment.Reader(A, B).span(block)
    assert span.total(span.kinds.sums)[0].tolist()[:2] == [len(x) for x in tokens(known, "some words here")]


def test_a_worker_that_forgets(spark, known, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 6)
    read = alignment.Reader(A, B)
    for text in ("one two three four", "five six one\n\n", "one two", "seven \u3000 eight", "nine ten one", "one two seven\t x"):
        span = read.span(next(blocks(pa.array([" " + text]))))
        assert span.total(span.kinds.sums)[0].tolist()[:2] == [len(x) for x in tokens(known, text)]


def test_empty(spark, nothing):
    assert alignment.align(nothing, A, B).collect() == []

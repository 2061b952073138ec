import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from samples import docs, nothing  # noqa: F401
from tidemark.llm import mixing, perfect_hash, token_files
from tidemark.llm.chunk_encoder import ChunkEncoder
from tidemark.llm.folders import folder
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.text import blocks


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


known = ChunkEncoder(tokenizer_path())
SPACES = st.text(alphabet=" \n\t\r  　\x85\x1cab'sé中<|endoftext|>9.", max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(SPACES, st.text(max_size=30)), min_size=1, max_size=5))
def test_pieces_give_the_ids_of_the_text(tokenizer, texts):
    for block in blocks(pa.array(texts, pa.string())):
        ids, number = known.encode_block(block)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert number.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


WITH_NAME = st.lists(st.one_of(st.just("<|endoftext|>"), st.sampled_from(" \n\t\u00a0a'sé9.<|>"), st.just("endoftext")), max_size=20).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(WITH_NAME, min_size=1, max_size=5))
def test_the_name_of_a_special_token_is_that_token(texts):
    plain = Tokenizer.from_file(tokenizer_path())
    for block in blocks(pa.array(["a<|endoftext|>b", *texts], pa.string())):
        ids, number = known.encode_block(block)
        want = [plain.encode(t, add_special_tokens=False).ids for t in ["a<|endoftext|>b", *texts]]
        assert number.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
        assert ids[:3].tolist() == [64, 50256, 65]


def test_one_hash_for_two_pieces_is_noticed(tokenizer, monkeypatch):
    from tidemark.llm.text import Block
    monkeypatch.setattr(Block, "hashes", lambda self, starts, ends, **_: np.ones(len(starts), np.uint64))
    block = next(blocks(pa.array(["some words here", "and there"])))
    ids, _ = ChunkEncoder(tokenizer_path()).encode_block(block)
    assert ids.tolist() == [i for t in ("some words here", "and there") for i in tokenizer.encode(t, add_special_tokens=False).ids]


def test_a_remembered_piece_takes_few_bytes(tokenizer):
    texts = [f"word{k} and{k}\nnumber {k * 7919}" for k in range(20_000)]
    fresh = ChunkEncoder(tokenizer_path())
    for block in blocks(pa.array(texts)):
        ids, _ = fresh.encode_block(block)
        assert ids[:40].tolist() == [i for k in range(20) for i in tokenizer.encode(block.text(k), add_special_tokens=False).ids][:40]
    held = sum(x.nbytes for x in (fresh.keys, fresh.checks, fresh.starts, fresh.lengths))
    assert len(fresh.keys) > 40_000 and held <= 24 * len(fresh.keys) and fresh.ids.itemsize == fresh.width == 2


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_pieces_are_encoded_together(tokenizer):
    texts = [f"word{k} and{k}, number {k * 7919}\nnext{k}  caf\u00e9{k} <|endoftext|> \u4e2d{k}\n\nlast{k}\n" for k in range(3_000)]
    fresh = ChunkEncoder(tokenizer_path())
    fresh.tokenizer = Counted(fresh.tokenizer)
    for block in blocks(pa.array(texts)):
        ids, number = fresh.encode_block(block)
        want = [tokenizer.encode(block.text(k), add_special_tokens=False).ids for k in range(len(block))]
        assert number.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert len(fresh.keys) > 15_000 and fresh.tokenizer.texts < len(fresh.keys) / 2


def test_ids_that_do_not_spell_the_text(tokenizer, tmp_path):
    """A normalizer changes the bytes, so ends of pieces can't be told from ids."""
    from tokenizers import normalizers

    changed = Tokenizer.from_file(tokenizer_path())
    changed.normalizer = normalizers.Replace("ab", "")
    changed.save(str(tmp_path / "changed.json"))
    texts = ["ab", "cabin fever ab", " ab absent\nab", "", "no change"]
    ids, number = ChunkEncoder(str(tmp_path / "changed.json")).encode_block(next(blocks(pa.array(texts))))
    want = [changed.encode(t, add_special_tokens=False).ids for t in texts]
    assert number.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_no_frame_is_made_from_a_list(spark, monkeypatch):
    """For a list Spark starts other Python workers than those of the operators, and keeps them."""
    from pyspark import SparkContext

    rows = spark.range(200).selectExpr("id AS doc_id", "concat('word ', id) AS text", "concat('s', id % 3) AS source")
    path = folder(spark, "plain")
    monkeypatch.setattr(SparkContext, "parallelize", lambda *_: pytest.fail("a frame was made from a list"))
    assert token_files.write_tokens(rows, path, tokenizer_path(), 2).count() == 200
    assert mixing.mix(rows).count() == 200


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    one, two = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64)
    sizes, bits, number = perfect_hash.build(one, two)
    assert sorted(number.tolist()) == list(range(n))
    assert (perfect_hash.find(sizes, bits, one, two) == number).all()


def test_round_trip(spark, docs, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "PART_KEYS", 20)
    home = folder(spark, "tokens")
    got = sorted((str(r.id), r.start, r.n_tokens, r.ids_crc32) for r in token_files.write_tokens(docs, home, tokenizer_path(), 2).collect())
    rows = docs.select("doc_id", "text").collect()
    coded = {(r.doc_id, r.text): tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows}
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((g[0], g[2], g[3]) for g in got) == sorted((str(r.doc_id), len(coded[r.doc_id, r.text]), crc(coded[r.doc_id, r.text])) for r in rows)
    by_place = sorted(got, key=lambda g: g[1])
    assert [g[1] for g in by_place] == np.append(0, np.cumsum([g[2] for g in by_place])[:-1]).tolist()
    ids = [int(g[0]) if g[0] != "None" else -1 for g in by_place]
    assert ids == sorted(ids)
    keys = spark.createDataFrame([(3, 0), (20, 0), (20, 1), (20, 2), (20, 3), (None, 0), (99999, 0)], "id long, occurrence long")
    fetched = {(r.id, r.occurrence): r.ids for r in token_files.fetch(keys, home).collect()}
    assert set(fetched) == {(3, 0), (20, 0), (20, 1), (20, 2), (None, 0)}
    assert fetched[3, 0] == coded[3, next(r.text for r in rows if r.doc_id == 3)]
    assert sorted(fetched[20, k] for k in range(3)) == sorted(coded[r.doc_id, r.text] for r in rows if r.doc_id == 20)


def test_unknown_keys_are_told_apart(spark, docs):
    home = folder(spark, "tokens")
    token_files.write_tokens(docs, home, tokenizer_path(), 2).count()
    asked = spark.range(1000, 60_000).selectExpr("id", "0L AS occurrence")
    assert token_files.locate(asked, token_files.index(spark, home)).count() == 0


def test_empty(spark, nothing):
    assert token_files.write_tokens(nothing, folder(spark, "tokens"), tokenizer_path(), 2).collect() == []

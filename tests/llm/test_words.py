import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from samples import plain, spaced
from tidemark.llm.text import ALPHANUMERIC, NON_SPACE, blocks, grams

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 -\né中 \x1f\x7f", max_size=40), st.text(max_size=20)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_agree_with_patterns(texts, size):
    for kind, pattern in ((NON_SPACE, spaced), (ALPHANUMERIC, plain)):
        got, seen = [[] for _ in texts], {}
        for block in blocks(pa.array(texts, pa.string()), size):
            starts, ends, rows = block.words(kind)
            for s, e, r, h in zip(starts, ends, rows, block.hashes(starts, ends)):
                word = block.data[s:e].tobytes().decode()
                got[block.first + r].append(word)
                seen.setdefault(h, set()).add(spaced(word)[0] if kind is NON_SPACE else plain(word)[0])
        assert [[w for x in row for w in pattern(x)] for row in got] == [pattern(t) for t in texts]
        assert all(len(x) == 1 for x in seen.values())


def test_hashes_do_not_depend_on_place_or_case():
    block = next(blocks(pa.array(["x Word word WORD " + "w" * 400, "word " + "W" * 400])))
    h = block.hashes(*block.words(NON_SPACE)[:2])
    assert h[1] == h[2] == h[3] == h[5] and h[4] == h[6] and len(set(h.tolist())) == 3


def test_prefix_hash_is_that_of_the_short_word():
    block = next(blocks(pa.array(["trashy trash"])))
    starts, ends, _ = block.words(NON_SPACE)
    assert block.hashes(starts, ends, limit=5)[0] == block.hashes(starts, ends)[1]


def test_grams_stay_inside_rows():
    value, at = grams(np.arange(6, dtype=np.uint64), np.array([0, 0, 0, 1, 1, 1]), 2)
    assert at.tolist() == [0, 1, 3, 4] and len(set(value.tolist())) == 4

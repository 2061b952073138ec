"""Encodes texts with a tokenizer file, each distinct piece of them once.

Byte-level tokenizers cut a text before they merge bytes. The places used here are
among those cuts, so the ids of the pieces, one after the other, are those of the text. None
is inside the name of a special token without white space, such as <|endoftext|>: the
library gives that name its own id wherever a text holds it.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from tidemark.llm.text import U64, Block, ranges

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that a worker remembers; it forgets older ones beyond that.
REMEMBERED = 1_000_000
#: Pieces that are encoded together: the library keeps up to a kilobyte or so for each.
AT_ONCE = 4_096
_CHECK_CODES = np.random.default_rng(77).integers(0, 2**63, 256, dtype=U64)


class ChunkEncoder:
    """Encoder of a tokenizer file with what it has seen so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # bytes of a text that an id stands for: byte-level names have a character for each
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        special = {k: len(x.content.encode()) for k, x in self.tokenizer.get_added_tokens_decoder().items()}
        sizes = {k: len(name) for name, k in vocabulary.items()} | special
        self.sizes = np.zeros(max(sizes, default=-1) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.empty(0, U64), np.empty(0, U64)
        self.starts, self.lengths = np.empty(0, np.uint32), np.empty(0, np.uint32)
        self.ids = np.empty(0, np.uint16 if self.width == 2 else np.uint32)

    def encode_block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and their number by row."""
        starts = cuts(block)
        ends = np.append(starts[1:], len(block.data))
        keys = block.hashes(starts, ends, fold=False)
        # the pieces follow one another without a gap
        checks = np.add.reduceat(_CHECK_CODES[block.data], starts) if len(starts) else np.empty(0, U64)
        kinds, first, kind = np.unique(keys, return_index=True, return_inverse=True)
        rows = np.searchsorted(block.offsets, starts, "right") - 1
        place = self._places(block, kinds, checks[first], starts[first], ends[first])
        if place is None or (checks != checks[first][kind]).any():
            found = [self.tokenizer.encode(block.text(k), add_special_tokens=False).ids for k in range(len(block))]
            return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)
        lengths = self.lengths[place][kind].astype(np.int64)
        return self.ids[ranges(self.starts[place][kind].astype(np.int64), lengths)], np.bincount(rows, lengths, minlength=len(block)).astype(np.int64)

    def _places(self, block: Block, kinds: np.ndarray, checks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Where the pieces are kept; None if two pieces have one hash."""
        if len(self.keys) + len(kinds) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.keys, kinds)
        known = np.zeros(len(kinds), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == kinds[inside]
        if (self.checks[at[known]] != checks[known]).any():
            return None
        new = np.flatnonzero(~known)
        if len(new):
            found = [self._encode(block, starts[mine], ends[mine]) for mine in np.split(new, range(AT_ONCE, len(new), AT_ONCE))]
            ids, lengths = (np.concatenate(x) for x in zip(*found))
            begin = (len(self.ids) + np.cumsum(lengths) - lengths).astype(np.uint32)
            self.keys, self.checks = np.insert(self.keys, at[new], kinds[new]), np.insert(self.checks, at[new], checks[new])
            self.starts, self.lengths = np.insert(self.starts, at[new], begin), np.insert(self.lengths, at[new], lengths.astype(np.uint32))
            self.ids = np.concatenate([self.ids, ids])
        return np.searchsorted(self.keys, kinds)

    def _encode(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and their number by piece. The library takes about half the
        time for a text of many pieces, so they are put together where the text would be cut again."""
        stops = np.cumsum(ends - starts)
        data = block.data[ranges(starts, ends - starts)]
        begins = np.append(0, stops[:-1])
        apart = begins[~np.isin(begins, cuts(Block(0, data, np.array([0, len(data)]))))]
        ids = np.fromiter(chain.from_iterable(self._encoded(data, np.union1d(apart, [0, len(data)]))), np.uint32)
        reached = np.cumsum(self.sizes[ids])
        last = np.searchsorted(reached, stops)
        if len(ids) and reached[-1] == len(data) and (reached[last] == stops).all():
            return ids.astype(self.ids.dtype), np.diff(last, prepend=-1)
        # not the ids of these bytes, as with a normalizer: each piece by itself
        each = self._encoded(data, np.append(0, stops))
        return np.fromiter(chain.from_iterable(each), self.ids.dtype), np.array([len(x) for x in each], np.int64)

    def _encoded(self, data: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def cuts(block: Block) -> np.ndarray:
    """First bytes of the pieces. A text may be cut before a space or line feed that
    follows a character known not to be white space, and behind such a line feed if
    another such character follows."""
    data = block.data
    if not len(data):
        return np.empty(0, np.int64)
    plain = (data > 0x20) & (data < 0x7F)
    lead = (data >= 0xC3) & (data <= 0xDF)
    solid = plain.copy()  # the last byte of a character that is not white space
    solid[1:] |= lead[:-1]
    cut = np.zeros(len(data), bool)
    after = np.flatnonzero(solid[:-1] & ((data[1:] == 0x20) | (data[1:] == 0x0A))) + 1
    cut[after] = True
    feed = after[(data[after] == 0x0A) & (after + 1 < len(data))]
    cut[feed[plain[feed + 1] | lead[feed + 1]] + 1] = True
    cut[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
    return np.flatnonzero(cut)


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]

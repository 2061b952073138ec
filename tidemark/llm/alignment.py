"""Alignment of two tokenizers' tokens over all documents.

Tokenizer A is a byte-level BPE file of ``tokenizers``, B a BPE model of
``sentencepiece`` with byte fallback. Both cut a text at the same bytes before a space
or around a line feed, so distinct pieces of text are encoded and aligned once and a
document's figures are sums over its pieces.

Pairs of ids are counted by the documents that hold them linked. An A id and the B id of
the same bytes (``Vocabulary.same``) are counted in a vector as long as A's vocabulary;
only other pairs are shuffled. For the figures of documents the vectors and the
``COMMON`` most frequent other pairs are broadcast, both of bounded size; the rarer pairs
of a document, none of which is hot, are joined with their counts.

Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no
tokens: zeros and an empty digest. Repeated rows are documents of their own, an empty
table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.chunk_encoder import cuts
from tidemark.llm.folders import written
from tidemark.llm.text import U64, Block, blocks, bounded_batches, ranges

#: Kinds of pieces that a worker remembers; beyond that it keeps those that came most often.
REMEMBERED = 1_000_000
#: Bytes of text that are cut into pieces together.
SPAN = 4 << 20
#: Pieces that are encoded together.
AT_ONCE = 16_384
#: Pairs of different bytes whose counts are broadcast.
COMMON = 1 << 19
#: Distinct pairs that a task holds before it passes their counts on.
HELD = 1 << 20
#: Bits of a pair's code; the rest of 63 numbers a row of a block.
_PAIR_BITS = 40
_CHECKS = np.random.default_rng(4711).integers(0, 2**63, 256, dtype=U64)
#: Pieces of one word, which can be encoded together with a line feed between them.
_WORD = re.compile(r" ?\S+")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones
    for themselves, the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Ids:
    """Ids of a tokenizer, one after the other, with their number by piece."""

    def __init__(self, ids: np.ndarray, number: np.ndarray):
        self.ids, self.number = ids, number

    @classmethod
    def cut(cls, ids: np.ndarray, at: int) -> Ids:
        """Ids of pieces that an id parts; it is left out."""
        ends = np.append(np.flatnonzero(ids == at), len(ids))
        return cls(ids[ids != at], np.diff(np.append(-1, ends)) - 1)


class Spelling:
    """The bytes of a vocabulary's ids."""

    def __init__(self, spelled: list[bytes]):
        self.bytes = spelled
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.first[ids], self.sizes[ids])]


class Vocabulary:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, a: str, b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        alphabet = byte_alphabet()
        spelled = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            spelled[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.spell_a = Spelling(spelled)
        self.spell_b = Spelling([self._spelled_b(k) for k in range(self.b.get_piece_size())])
        # B's tokens must end at the cuts: before spaces that follow something else, around line feeds
        if any(re.search("[^ ] |\n.|.\n", x.decode("utf-8", "replace")) for x in self.spell_b.bytes):
            raise ValueError(f"{b}: tokens go across the cuts of texts")
        if len(self.spell_a.bytes) * len(self.spell_b.bytes) > 1 << _PAIR_BITS:
            raise ValueError("the vocabularies are too large for the codes of pairs")
        by_bytes = {x: k for k, x in enumerate(self.spell_b.bytes) if x and self.b.is_byte(k)}
        by_bytes |= {x: k for k, x in enumerate(self.spell_b.bytes) if x and not self.b.is_byte(k)}
        self.same = np.array([by_bytes.get(x, -1) for x in self.spell_a.bytes], np.int64)
        (self.feed_a,) = self.a.encode("\n", add_special_tokens=False).ids
        *self.lead, self.feed_b = self.b.encode("\n")  # the space that B puts before a text, and the line feed

    def _spelled_b(self, k: int) -> bytes:
        if self.b.is_byte(k):
            return bytes([int(self.b.id_to_piece(k)[3:5], 16)])
        if self.b.is_control(k) or self.b.is_unknown(k):
            return b""
        return self.b.id_to_piece(k).replace("▁", " ").encode()

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Codes of pairs of ids."""
        return a * np.int64(len(self.spell_b.bytes)) + b

    def unpaired(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.divmod(pairs, np.int64(len(self.spell_b.bytes)))

    def encode(self, pieces: list[str], words: bool) -> tuple[Ids, Ids]:
        """Ids of pieces of text by A and by B. ``words``: all pieces are words, with a space before them or not.

        A line feed before a piece keeps B from putting a space there."""
        if words:
            text = "\n".join(pieces)
            by_a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            by_b = np.array(self.b.encode("\n" + text)[len(self.lead) + 1:], np.int64)
            return Ids.cut(by_a, self.feed_a), Ids.cut(by_b, self.feed_b)
        by_a = [x.ids for x in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        by_b = [x[len(self.lead) + 1:] for x in self.b.encode(["\n" + x for x in pieces], num_threads=1)]
        return tuple(Ids(np.array([k for x in ids for k in x], np.int64), np.array([len(x) for x in ids], np.int64)) for ids in (by_a, by_b))


class Kinds:
    """Figures of distinct pieces, in the order in which they came."""

    def __init__(self, vocabulary: Vocabulary, texts: bool = True):
        self.known, self.texts = vocabulary, texts
        self.n = 0
        self.sums = np.empty((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.whole = np.empty(0, bool)  # both give the piece back
        self.groups: list[bytes] = []
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)  # of its pairs
        self.pairs, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, pieces: list[bytes]) -> np.ndarray:
        """Add pieces; their numbers. Words come first, so they need not be in the order given."""
        texts = [x.decode() for x in pieces]
        words = np.array([_WORD.fullmatch(x) is not None for x in texts], bool)
        number = np.empty(len(pieces), np.int64)
        for mine in (np.flatnonzero(words), np.flatnonzero(~words)):
            for at in range(0, len(mine), AT_ONCE):
                some = mine[at:at + AT_ONCE].tolist()
                number[some] = self.n + np.arange(len(some))
                self._add([pieces[k] for k in some], *self.known.encode([texts[k] for k in some], bool(words[some[0]])))
        return number

    def _add(self, pieces: list[bytes], a: Ids, b: Ids) -> None:
        whole = self._whole(pieces, a, b)
        if not whole.all():
            for x in (a, b):
                kept = np.repeat(whole, x.number)
                x.ids, x.number = x.ids[kept], np.where(whole, x.number, 0)
        end_a, end_b = np.cumsum(self.known.spell_a.sizes[a.ids]), np.cumsum(self.known.spell_b.sizes[b.ids])
        # each stretch between neighbouring ends lies in one token of A and one of B: a link
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        piece = np.repeat(np.arange(len(pieces)), a.number)
        of_link = piece[at_a]
        count = lambda x: np.bincount(x, minlength=len(pieces)).astype(np.int64)
        sums = np.stack([a.number, b.number, count(piece[np.searchsorted(end_a, common)]), count(of_link)], 1)
        links = np.sort((of_link << _PAIR_BITS) | self.known.pair(a.ids[at_a], b.ids[at_b]))
        begin = np.flatnonzero(np.append(True, links[1:] != links[:-1])) if len(links) else np.empty(0, np.int64)
        size = count(links[begin] >> _PAIR_BITS)
        if self.texts:
            self.groups += self._texts(a, b, np.searchsorted(common, end_a), np.searchsorted(common, end_b))
        self.first = np.append(self.first, len(self.pairs) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.pairs = np.append(self.pairs, links[begin] & ((1 << _PAIR_BITS) - 1))
        self.times = np.append(self.times, np.diff(np.append(begin, len(links))))
        self.sums, self.whole = np.concatenate([self.sums, sums]), np.append(self.whole, whole)
        self.n += len(pieces)

    def _whole(self, pieces: list[bytes], a: Ids, b: Ids) -> np.ndarray:
        """Whether the tokens of both have the bytes of each piece."""
        data, sizes = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(x) for x in pieces], np.int64)
        out = np.ones(len(pieces), bool)
        for x, spell in ((a, self.known.spell_a), (b, self.known.spell_b)):
            size = spell.sizes[x.ids]
            mine = np.bincount(np.repeat(np.arange(len(pieces)), x.number), size, minlength=len(pieces)).astype(np.int64)
            if (mine == sizes).all() and (spell.of(x.ids) == data).all():
                continue
            ends = np.cumsum(x.number)
            out &= [b"".join(spell.bytes[k] for k in x.ids[e - n:e].tolist()) == piece for piece, e, n in zip(pieces, ends, x.number)]
        return out

    def _texts(self, a: Ids, b: Ids, group_a: np.ndarray, group_b: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each piece. group_a, group_b: the group of each token."""
        group = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(group, kind="stable")
        group, side = group[order], (group & 1)[order]
        last = np.append(group[1:] != group[:-1], True)[:len(group)]
        # the spelling of an id, with what follows it
        code = np.concatenate([a.ids, b.ids])[order] * 4 + side * 2 + last
        spelled, place = np.unique(code, return_inverse=True)
        spelled = [b"%d%c" % (x >> 2, b",|,;"[x & 3]) for x in spelled.tolist()]
        words = [spelled[k] for k in place.tolist()]
        ends = np.cumsum(a.number + b.number).tolist()
        return [b"".join(words[s:e])[:-1] for s, e in zip([0, *ends], ends)]

    def some(self, kept: np.ndarray) -> Kinds:
        """Only these kinds, in this order."""
        out = Kinds(self.known, self.texts)
        out.n, out.sums, out.whole, out.size = len(kept), self.sums[kept], self.whole[kept], self.size[kept]
        out.first = np.cumsum(out.size) - out.size
        place = ranges(self.first[kept], out.size)
        out.pairs, out.times = self.pairs[place], self.times[place]
        out.groups = [self.groups[k] for k in kept.tolist()] if self.texts else []
        return out


class Span:
    """Pieces of some rows: their kinds, in order, and the row of each."""

    def __init__(self, kinds: Kinds, kind: np.ndarray, row: np.ndarray, rows: int):
        self.kinds, self.kind, self.row, self.rows = kinds, kind, row, rows
        self.bounds = np.searchsorted(row, np.arange(rows + 1))

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sum by row of a figure of kinds; integers stay exact."""
        running = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values[self.kind], 0)])
        return running[self.bounds[1:]] - running[self.bounds[:-1]]

    def whole(self) -> np.ndarray:
        if self.kinds.whole.all():
            return np.ones(self.rows, bool)
        return self.total((~self.kinds.whole).astype(np.int64)) == 0

    def _kinds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, kind and how often for each kind that a row has."""
        mark = np.sort((self.row.astype(np.int64) << 32) | self.kind)
        begin = np.flatnonzero(np.append(True, mark[1:] != mark[:-1])) if len(mark) else np.empty(0, np.int64)
        return mark[begin] >> 32, mark[begin] & 0xFFFFFFFF, np.diff(np.append(begin, len(mark)))

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and pair for each pair that a row has."""
        row, kind, _ = self._kinds()
        size = self.kinds.size[kind]
        both = np.sort((np.repeat(row, size) << _PAIR_BITS) | self.kinds.pairs[ranges(self.kinds.first[kind], size)])
        if len(both):
            both = both[np.append(True, both[1:] != both[:-1])]
        return both >> _PAIR_BITS, both & ((1 << _PAIR_BITS) - 1)

    def links(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, pair and number of links, of the places of pairs that ``of`` marks."""
        row, kind, often = self._kinds()
        size = self.kinds.size[kind]
        place = ranges(self.kinds.first[kind], size)
        row, often = np.repeat(row, size)[of[place]], np.repeat(often, size)[of[place]]
        place = place[of[place]]
        both, back = np.unique((row << _PAIR_BITS) | self.kinds.pairs[place], return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, back, self.kinds.times[place] * often)
        return both >> _PAIR_BITS, both & ((1 << _PAIR_BITS) - 1), total


class Reader:
    """Cuts rows of text into pieces and remembers their kinds."""

    def __init__(self, a: str, b: str, texts: bool = True):
        self.known, self.texts = _vocabulary(a, b), texts
        self.forget()

    def forget(self) -> None:
        self.kinds = Kinds(self.known, self.texts)
        self.keys, self.checks, self.kind = np.empty(0, U64), np.empty(0, U64), np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def _thin(self) -> None:
        """Keep the half of the kinds that came most often."""
        kept = np.sort(np.argpartition(-self.uses, REMEMBERED // 2)[:REMEMBERED // 2])
        self.kinds, self.uses = self.kinds.some(self.kind[kept]), self.uses[kept] // 2
        self.keys, self.checks, self.kind = self.keys[kept], self.checks[kept], np.arange(len(kept))

    def spans(self, block: Block) -> Iterator[Span]:
        """Spans of a block; one of a single long text has several."""
        data, at = block.data, 0
        if len(block) > 1 or len(data) <= 2 * SPAN:
            yield self.span(block)
            return
        while at < len(data):
            size = SPAN
            while at + size < len(data):
                places = cuts(Block(0, data[at:at + size], np.array([0, size])))
                if len(places) > 1:
                    break
                size *= 2
            to = at + int(places[-1]) if at + size < len(data) else len(data)
            yield self.span(Block(block.first, data[at:to], np.array([0, to - at])))
            at = to

    def span(self, block: Block) -> Span:
        starts = cuts(block)
        ends = np.append(starts[1:], len(block.data))
        row = np.searchsorted(block.offsets, starts, "right") - 1
        keys = block.hashes(starts, ends, fold=False)
        total = np.zeros(len(block.data) + 1, U64)
        np.cumsum(_CHECKS[block.data], out=total[1:])
        checks = total[ends] - total[starts]
        del total
        distinct, first, back, uses = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        if (checks != checks[first][back]).any():  # two pieces of one hash: go by their bytes
            pieces = [block.data[s:e].tobytes() for s, e in zip(starts, ends)]
            number = {x: k for k, x in enumerate(dict.fromkeys(pieces))}
            kinds = Kinds(self.known, self.texts)
            place = kinds.add(list(number))
            return Span(kinds, place[[number[x] for x in pieces]], row, len(block))
        if self.kinds.n > REMEMBERED // 2 and self.kinds.n + len(distinct) > REMEMBERED:
            self._thin()
        at = np.searchsorted(self.keys, distinct)
        old = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        old[inside] = self.keys[at[inside]] == distinct[inside]
        if (self.checks[at[old]] != checks[first][old]).any():
            self.forget()
            return self.span(block)
        self.uses[at[old]] += uses[old]
        new = np.flatnonzero(~old)
        if len(new):
            data, begin, end = block.data.tobytes(), starts[first[new]].tolist(), ends[first[new]].tolist()
            number = self.kinds.add([data[s:e] for s, e in zip(begin, end)])
            self.keys, self.checks, self.kind, self.uses = (np.insert(x, at[new], y) for x, y in (
                (self.keys, distinct[new]), (self.checks, checks[first[new]]), (self.kind, number), (self.uses, uses[new])))
        return Span(self.kinds, self.kind[np.searchsorted(self.keys, distinct)][back], row, len(block))


@lru_cache(maxsize=1)
def _vocabulary(a: str, b: str) -> Vocabulary:
    return Vocabulary(a, b)


@lru_cache(maxsize=1)
def reader(a: str, b: str, texts: bool = True) -> Reader:
    """The reader of this worker for two tokenizers."""
    return Reader(a, b, texts)


class PairCounts:
    """Counts of pairs in a task: pairs of the same bytes in a vector, others by pair."""

    def __init__(self, vocabulary: Vocabulary):
        self.known = vocabulary
        self.vector = np.zeros(len(vocabulary.same), np.int64)
        self.pairs, self.counts = [], []

    def add(self, pairs: np.ndarray) -> None:
        """One for each pair, which may come several times."""
        distinct, counts = np.unique(pairs, return_counts=True)
        a, b = self.known.unpaired(distinct)
        same = self.known.same[a] == b
        self.vector[a[same]] += counts[same]
        self.pairs.append(distinct[~same])
        self.counts.append(counts[~same])

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Counts that are to be passed on; all, at the end."""
        if not last and sum(map(len, self.pairs)) < HELD:
            return
        pairs, counts = np.concatenate(self.pairs), np.concatenate(self.counts)
        distinct, back = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, back, counts)
        self.pairs, self.counts = [distinct], [total]
        if last or len(distinct) >= HELD // 2:
            self.pairs, self.counts = [], []
            yield self._batch(*self.known.unpaired(distinct), total)
        if last:
            a = np.flatnonzero(self.vector)
            yield self._batch(a, self.known.same[a], self.vector[a])

    @staticmethod
    def _batch(a, b, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], ["a", "b", "n"])


def _spaced(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    return documents.select(F.col(id_column).alias("id"), F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).alias("text"))


def pair_counts(documents: DataFrame, a: str, b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(a, b, n)``: how many documents hold an A id and a B id linked."""
    bounded_batches(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader(a, b, False)
        counts = PairCounts(read.known)
        for batch in batches:
            for block in blocks(batch.column(0), SPAN):
                found, whole = [], np.ones(len(block), bool)
                for span in read.spans(block):
                    whole &= span.whole()
                    row, pairs = span.distinct_pairs()
                    found.append((row, pairs))
                row, pairs = found[0]
                if len(found) > 1:  # of one long text
                    pairs = np.unique(np.concatenate([p for _, p in found]))
                    row = np.zeros(len(pairs), np.int64)
                counts.add(pairs[whole[row]])
                yield from counts.rows(False)
        if counts.pairs:
            yield from counts.rows(True)

    texts = _spaced(documents, id_column, text_column).select("text")
    return texts.mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Known:
    """Counts that every task has: vectors over A's ids, and the commonest pairs of other bytes."""

    def __init__(self, best: np.ndarray, same: np.ndarray, pairs: np.ndarray, counts: np.ndarray):
        self.best, self.same, self.pairs, self.counts = best, same, pairs, counts

    def of(self, pairs: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """The count of each pair; -1 where a task does not know it."""
        a, b = vocabulary.unpaired(pairs)
        out = np.where(vocabulary.same[a] == b, self.same[a], -1)
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            out = np.where((out < 0) & (self.pairs[at] == pairs), self.counts[at], out)
        return out


def known_counts(counts: DataFrame, vocabulary: Vocabulary, common: int) -> Known:
    """Two rows for each A id and ``common`` pairs at most come to the driver."""
    same = counts.sparkSession.createDataFrame(
        pa.table({"a": pa.array(np.arange(len(vocabulary.same)), pa.int32()), "same": pa.array(vocabulary.same, pa.int32())}))
    marked = counts.join(F.broadcast(same), "a")
    vectors = marked.groupBy("a").agg(F.max("n").alias("best"), F.max(F.when(F.col("b") == F.col("same"), F.col("n"))).alias("same")).toArrow()
    others = marked.where("b <> same").orderBy(F.desc("n"), "a", "b").limit(common).select("a", "b", "n").toArrow()
    number = lambda table, name: table.column(name).to_numpy().astype(np.int64)
    best, own = np.zeros((2, len(vocabulary.same)), np.int64)
    best[number(vectors, "a")] = number(vectors, "best")
    own[number(vectors, "a")] = vectors.column("same").fill_null(0).to_numpy()
    pairs = vocabulary.pair(number(others, "a"), number(others, "b"))
    order = np.argsort(pairs)
    return Known(best, own, pairs[order], number(others, "n")[order])


def align(documents: DataFrame, a: str, b: str, id_column: str = "doc_id", text_column: str = "text", common: int = COMMON) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of each document.

    Links are the pairs of tokens whose bytes overlap. ``n_best`` are those whose pair of
    ids is, by documents, the most frequent one of its A id, ties included; ``count_sum``
    adds the counts of all.
    """
    spark = documents.sparkSession
    counts = written(pair_counts(documents, a, b, id_column, text_column), "pairs")
    shared = spark.sparkContext.broadcast(known_counts(counts, _vocabulary(a, b), common))
    source = _spaced(documents, id_column, text_column)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, known = reader(a, b), shared.value
        key, scored, figures = TaskContext.get().partitionId() << 40, None, None

        def figures_of(kinds: Kinds) -> tuple:
            """Best links and sums of counts by kind, and which places of pairs are unknown; only new kinds are worked out."""
            nonlocal scored, figures
            if scored is not kinds:
                scored, figures = kinds, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
            best, total, unknown = figures
            if len(best) < kinds.n:
                done = len(best)
                at, size = len(unknown), kinds.size[done:]
                pairs, times = kinds.pairs[at:], kinds.times[at:]
                n = known.of(pairs, read.known)
                parts = np.repeat(np.arange(len(size)), size)
                more = np.zeros((2, len(size)), np.int64)
                np.add.at(more[0], parts, np.where((n >= 0) & (n == known.best[read.known.unpaired(pairs)[0]]), times, 0))
                np.add.at(more[1], parts, np.where(n >= 0, n * times, 0))
                figures = np.append(best, more[0]), np.append(total, more[1]), np.append(unknown, n < 0)
            return figures

        for batch in batches:
            for block in blocks(batch.column(1), SPAN):
                sums, whole = np.zeros((len(block), 6), np.int64), np.ones(len(block), bool)
                texts = [None] * len(block)
                rest = []
                for span in read.spans(block):
                    best, total, unknown = figures_of(span.kinds)
                    sums += span.total(np.concatenate([span.kinds.sums, best[:, None], total[:, None]], 1))
                    whole &= span.whole()
                    groups = span.kinds.groups
                    names = [groups[k] for k in span.kind.tolist()]
                    for k, (s, e) in enumerate(zip(span.bounds[:-1].tolist(), span.bounds[1:].tolist())):
                        if s < e:
                            if texts[k] is None:
                                texts[k] = hashlib.sha256()
                            else:
                                texts[k].update(b";")
                            texts[k].update(b";".join(names[s:e]))
                    if unknown.any():
                        rest.append(span.links(unknown))
                row, pairs, times = (np.concatenate(x) for x in zip(*rest)) if rest else [np.empty(0, np.int64)] * 3
                row, pairs, times = (x[whole[row]] for x in (row, pairs, times))
                sums[~whole] = 0
                size = np.bincount(row, minlength=len(block))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(x, pa.int64()))
                rare_a, rare_b = read.known.unpaired(pairs)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, len(block)), pa.array(key + np.arange(len(block))), *[pa.array(sums[:, k]) for k in range(6)],
                    pa.array([t.hexdigest() if t and ok else "" for t, ok in zip(texts, whole)], pa.string()), lists(rare_a), lists(rare_b), lists(times)],
                    ["id", "key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "a", "b", "times"])
                key += len(block)

    kind = source.schema["id"].dataType.simpleString()
    found = written(source.mapInArrow(
        measure, f"id {kind}, key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
                 "a array<long>, b array<long>, times array<long>"), "aligned")
    return _with_rare(found, counts).select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _with_rare(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the links of the pairs that tasks did not know. ``found`` is a written table, so its keys stay."""
    rare = found.where(F.size("a") > 0).select("key", F.explode(F.arrays_zip("a", "b", "times")).alias("x")).select(
        "key", F.col("x.a").cast("int").alias("a"), F.col("x.b").cast("int").alias("b"), F.col("x.times").alias("times"))
    best = counts.groupBy("a").agg(F.max("n").alias("best"))  # one row for each A id
    more = rare.join(counts, ["a", "b"]).join(F.broadcast(best), "a").groupBy("key").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    added = lambda name, more: (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)
    return found.join(more, "key", "left").withColumns({
        "n_best": added("n_best", "more_best"), "count_sum": added("count_sum", "more_sum")})

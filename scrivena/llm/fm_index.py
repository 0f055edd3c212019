"""Substring dedup over words: a compressed FM-index per shard, searched backwards with matching statistics.

A document's word is removed when it lies in a window of `span` words whose sequence also starts in a document with a
smaller doc_id; windows are judged on the input. `windows` finds the stretches of text that could repeat, and gathers
those with one anchor. A shard orders each anchor's stretches by the least doc_id that holds them, and halves this order
again and again: of every two halves, the earlier one is built into an FM-index (suffix array by prefix doubling, wavelet
matrix of packed bit vectors with block counts, LCP array), and the stretches of the later one are streamed through it
from right to left, all in lock-step. Every place gets its matching statistic, the longest match with an earlier
document; where it reaches `span` words, a repeated window starts. A stretch is never searched in an index that holds it.

Defined results: null text has no words; empty tables give no rows; rows without a doc_id are left out; rows that share
doc_id and text are one document, so copies of a row don't remove each other; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm import windows
from scrivena.llm._common import chunks, covered, documents, hash_words, raw, spans_of

SPAN, GRAM = 50, 16
#: Windows in a stretch, each time that large anchors are cut.
BLOCKS = (6, 2, 1)


class BitVector:
    """Bits in 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1].astype(np.int32)

    def rank1(self, at: np.ndarray) -> np.ndarray:
        w = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & below)


class FMIndex:
    """Of several integer sequences (values from 0). Each ends in a terminator of its own, less than all values."""

    def __init__(self, seqs: list[np.ndarray]):
        k = len(seqs)
        self.k, sizes = k, np.array([len(s) + 1 for s in seqs])
        ends = np.cumsum(sizes)
        text = np.empty(int(ends[-1]) if k else 0, np.int64)
        self.seq = np.repeat(np.arange(k), sizes)
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = np.concatenate(seqs) + k if k else []
        text[~inside] = np.arange(k)
        values, text = np.unique(text, return_inverse=True)
        self.code = values[k:] - k  # the value of symbol k + i
        self.n, self.sigma = len(text), len(values)
        self._sort(text, int(sizes.max(initial=1)))
        bwt = text[self.sa - 1]
        self.start = np.searchsorted(np.sort(text), np.arange(self.sigma + 1))
        self.levels, self.zeros = [], []
        for bit in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            b = (bwt >> bit) & 1
            self.levels.append(BitVector(b.astype(bool)))
            self.zeros.append(int((b == 0).sum()))
            bwt = np.concatenate((bwt[b == 0], bwt[b == 1]))
        self.first = self._down(np.arange(self.sigma), np.zeros(self.sigma, np.int64))
        self._table: list[np.ndarray] = []

    def _sort(self, text: np.ndarray, longest: int) -> None:
        n, rank, ranks, size = self.n, text.copy(), [text], 1
        while size < longest:
            after = np.concatenate((rank[size:], np.full(min(size, n), -1)))
            key = rank * (n + 1) + after + 1
            order = np.argsort(key, kind="stable")
            key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
            ranks.append(rank)
            size *= 2
        self.sa = np.argsort(rank, kind="stable")
        a, b = self.sa[:-1].copy(), self.sa[1:].copy()
        lcp = np.zeros(max(n - 1, 0), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            ok = (a < n) & (b < n)
            same = ok & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
            lcp[same] += 1 << level
            a, b = np.where(same, a + (1 << level), a), np.where(same, b + (1 << level), b)
        self.lcp = np.concatenate(([-1], lcp, [-1]))  # of neighbours i - 1 and i

    def _down(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, (v, z) in enumerate(zip(self.levels, self.zeros)):
            one = (c >> (len(self.levels) - 1 - i)) & 1
            r = v.rank1(at)
            at = np.where(one == 1, z + r, at - r)
        return at

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of c in the first `at` symbols of the transform."""
        return self._down(c, at) - self.first[c]

    def symbols(self, values: np.ndarray) -> np.ndarray:
        """Symbols of the index; -1 for values that it doesn't hold."""
        if not len(self.code):
            return np.full(len(values), -1)
        i = np.minimum(np.searchsorted(self.code, values), len(self.code) - 1)
        return np.where(self.code[i] == values, i + self.k, -1)

    def _widen(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix-array intervals of depth around [lo, hi), by doubling over least LCPs."""
        if not self._table:
            t = [self.lcp]
            while (1 << len(t)) <= len(self.lcp):
                h = 1 << (len(t) - 1)
                t.append(np.minimum(t[-1][:-h], t[-1][h:]))
            self._table = t
        for j in range(len(self._table) - 1, -1, -1):
            t, w = self._table[j], 1 << j
            ok = (lo - w + 1 >= 0) & (t[np.maximum(lo - w + 1, 0)] >= depth)
            lo = np.where(ok, lo - w, lo)
            ok = (hi + w <= len(self.lcp)) & (t[np.minimum(hi, len(t) - 1)] >= depth)
            hi = np.where(ok, hi + w, hi)
        return lo, hi

    def matching_statistics(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of each stream (end to end): the longest match from there, and its suffix-array interval."""
        sizes = np.array([len(s) for s in streams])
        ends = np.cumsum(sizes)
        sym = self.symbols(np.concatenate(streams)) if len(streams) else np.zeros(0, int)
        length, low, high = (np.zeros(len(sym), np.int64) for _ in range(3))
        order = np.argsort(-sizes, kind="stable")
        lo, hi, ln = np.zeros(len(order), np.int64), np.full(len(order), self.n), np.zeros(len(order), np.int64)
        for step in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-sizes[order], -step, side="left"))
            at = ends[order[:active]] - 1 - step
            c, l, h, m = sym[at], lo[:active].copy(), hi[:active].copy(), ln[:active].copy()
            todo = np.arange(active)
            dead = c < 0
            l[dead], h[dead], m[dead] = 0, self.n, 0
            todo = todo[~dead]
            while len(todo):
                ct = c[todo]
                a, b = (self.start[ct] + self.rank(ct, x[todo]) for x in (l, h))
                ok = a < b
                hit, miss = todo[ok], todo[~ok]
                l[hit], h[hit], m[hit] = a[ok], b[ok], m[hit] + 1
                miss = miss[m[miss] > 0]
                if len(miss):
                    depth = np.maximum(np.maximum(self.lcp[l[miss]], self.lcp[h[miss]]), 0)
                    l[miss], h[miss] = self._widen(l[miss], h[miss], depth)
                    m[miss] = depth
                    root = miss[depth == 0]
                    l[root], h[root] = 0, self.n
                todo = miss
            lo[:active], hi[:active], ln[:active] = l, h, m
            length[at], low[at], high[at] = m, l, h
        return length, low, high


def seen_earlier(seqs: list[np.ndarray], anchor: np.ndarray, low_doc: np.ndarray, span: int) -> list[np.ndarray]:
    """For each sequence, at which places `span` symbols start that also start in a sequence of the same anchor with a
    smaller low_doc. Sequences of one anchor lie together."""
    sizes = np.array([len(s) for s in seqs])
    out = [np.zeros(max(0, n - span + 1), bool) for n in sizes.tolist()]
    order = np.lexsort((low_doc, anchor))
    a, d = anchor[order], low_doc[order]
    first = np.concatenate(([True], a[1:] != a[:-1]))
    step = np.cumsum(np.concatenate(([False], d[1:] != d[:-1])) & ~first)
    rank = np.empty(len(seqs), np.int64)
    rank[order] = step - np.maximum.accumulate(np.where(first, step, 0))
    number = np.unique(anchor, return_inverse=True)[1]
    for bit in range(int(rank.max(initial=0)).bit_length()):
        # Halves share all higher bits of the rank; the earlier one has a zero here.
        half = number * (int(rank.max()) + 1) + (rank >> (bit + 1))
        late = (rank >> bit) & 1 == 1
        index_at = np.flatnonzero(~late & np.isin(half, half[late]))
        stream_at = np.flatnonzero(late)
        # Symbols of other halves are other symbols.
        both = np.concatenate((index_at, stream_at))
        own = np.unique(half[both], return_inverse=True)[1]
        symbols = np.concatenate([seqs[i] for i in both]) * (int(own.max()) + 1) + np.repeat(own, sizes[both])
        parts = np.split(np.unique(symbols, return_inverse=True)[1], np.cumsum(sizes[both])[:-1])
        index = FMIndex(parts[: len(index_at)])
        length, _, _ = index.matching_statistics(parts[len(index_at) :])
        at = 0
        for i in stream_at.tolist():
            out[i] |= length[at : at + len(out[i])] >= span
            at += int(sizes[i])
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return hash_words(texts)


def _solve(span: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in windows.shards(batches, shard_bytes):
            anchor, _, _, low_doc, _, data = zip(*shard)
            hashes = [np.frombuffer(d, np.uint64) for d in data]
            ids = np.unique(np.concatenate(hashes), return_inverse=True)[1]
            seqs = np.split(ids, np.cumsum([len(h) for h in hashes])[:-1])
            yield windows.solved(shard, seen_earlier(seqs, np.array(anchor), np.array(low_doc), span))

    return run


def repeated_words(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, tk and cuts: word intervals [a, b) that also start in a document with a smaller doc_id.

    docs has doc_id, tk and text (see _common.documents).
    """
    return windows.repeated(docs, word_hashes, span, gram, 8, BLOCKS, _solve(span, 1 << 21), earlier=True)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, max_bytes=4 << 20):
        out = []
        for doc, text, cuts in zip(part.column("doc_id").to_pylist(), raw(part), part.column("cuts").to_pylist()):
            words = text.split()
            gone = covered(len(words), [c["a"] for c in cuts or ()], [c["b"] for c in cuts or ()])
            a, b = spans_of(gone)
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if len(a) else words)
            out.append((doc, len(words), int(gone.sum()), [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())], kept))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types)), pa.array(cols[4], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept"])


def drop_repeated_passages(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Removes words in windows of `span` words that also start in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, spans (removed word intervals) and kept (the kept words, joined by one space).
    """
    docs = documents(docs)
    cuts = repeated_words(docs, span, gram)
    out = docs.join(cuts, ["doc_id", "tk"], "left").select("doc_id", "text", "cuts")
    return out.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string")

"""Substring dedup over bytes or words: suffixes sorted by merging, compared by polynomial hashes of prefixes.

A symbol (byte or word) is removed when it lies in a string of `span` symbols that also starts anywhere else, in the same
document too; or, if the first copy is to stay, that also starts in a document with a smaller doc_id. `windows` finds the
stretches that could repeat. In each shard the suffixes from the stretches' anchors, and the reversed prefixes before
them, are sorted by a merge sort that works on all anchors at once. Two suffixes compare in logarithmic time: binary
search over prefix hashes finds their common extension, and the symbol after it decides. Neighbours' extensions are then
checked symbol by symbol; a hash collision shows there, and the shard is sorted again under another hash. A window is
repeated when some other stretch agrees with it both after the anchor (forward order) and before it (backward order).

Defined results: null text is empty; empty tables give no rows; rows without a doc_id are left out; each row is a place
of its own, so a repeated row repeats all of its strings of `span` symbols (if the first copy stays, rows of one doc_id
don't remove each other); other columns are ignored. Texts are processed whole, about 80 bytes of memory for each byte of
a text, so that a task of the default size takes texts of some ten megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scrivena.llm import windows
from scrivena.llm._common import chunks, covered, documents, hash_words, raw, spans_of, words_at

SPAN, GRAM = 400, 128
#: Windows in a stretch, each time that large anchors are cut.
BYTE_BLOCKS, WORD_BLOCKS = (48, 12, 3, 1), (6, 2, 1)


class HashedText:
    """Prefix sums of a polynomial hash modulo 2**64 over random symbol values; seed chooses values and base."""

    def __init__(self, text: np.ndarray, seed: int = 0):
        rng = np.random.default_rng(seed)
        values = rng.integers(1, 1 << 63, int(text.max(initial=0)) + 1, dtype=np.uint64)
        base = int(rng.integers(1, 1 << 62)) * 4 + 3
        self.text, n = text, len(text)
        self.power = np.ones(n + 1, np.uint64)
        size = 1
        while size <= n:  # powers by doubling
            step = np.uint64(pow(base, size, 1 << 64))
            self.power[size : 2 * size] = self.power[: min(size, n + 1 - size)] * step
            size *= 2
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[text] * self.power[:n], out=self.sums[1:])
        self.n = n

    def extension(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes from a and b, up to limit."""
        lo, hi = np.zeros(len(a), np.int64), limit.copy()
        pa_, pb = self.power[self.n - a], self.power[self.n - b]
        sa, sb = self.sums[a], self.sums[b]
        for _ in range(int(limit.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = (self.sums[a + mid] - sa) * pa_ == (self.sums[b + mid] - sb) * pb
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def merge_sort(text: HashedText, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the strings text[at : at + size] inside each group; groups lie together.

    Returns the order and, for each place of it, the common prefix with the one before (-1 between groups). All groups
    merge at once; a string's place in the other half is found by binary search, each step of which compares by hashes.
    """
    n = len(at)
    new = np.concatenate(([True], group[1:] != group[:-1])) if n else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    start = begin[np.cumsum(new) - 1] if n else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((begin, [n])))
    end = start + count[np.cumsum(new) - 1] if n else start
    order, place, width = np.arange(n), np.arange(n), 1
    most = int(count.max(initial=0))
    while width < most:
        k = place - start
        left = (k // width) % 2 == 0
        block = start + k // (2 * width) * (2 * width)
        lo = np.minimum(np.where(left, block + width, block), end)
        hi = np.minimum(np.where(left, block + 2 * width, block + width), end)
        own, base = k % width, lo.copy()
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            x, y = order[place[todo]], order[mid]
            limit = np.minimum(size[x], size[y])
            e = text.extension(at[x], at[y], limit)
            more = e < limit
            bx, by = text.text[np.where(more, at[x] + e, 0)], text.text[np.where(more, at[y] + e, 0)]
            # The other one comes first if it is less, or equal and in the left half.
            less = np.where(more, by < bx, size[y] < size[x])
            same = ~more & (size[y] == size[x])
            first = less | (same & ~left[todo])
            lo[todo], hi[todo] = np.where(first, mid + 1, lo[todo]), np.where(first, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        place_new = np.where(left | (lo >= base), block + own + lo - base, place)
        merged = np.empty(n, np.int64)
        merged[place_new] = order[place]
        order, place = merged, np.arange(n)
        width *= 2
    x, y = order[:-1], order[1:]
    common = text.extension(at[x], at[y], np.minimum(size[x], size[y])) if n else np.zeros(0, np.int64)
    lcp = np.concatenate(([-1], common))[:n]
    lcp[new] = -1
    return order, lcp


def sorted_suffixes(text: np.ndarray, at: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """merge_sort, with each pair of neighbours checked on the symbols; a collision sorts again under another hash."""
    for seed in range(16):
        order, lcp = merge_sort(HashedText(text, seed), at, size, group)
        mine = np.flatnonzero(lcp >= 0)
        x, y, n = order[mine - 1], order[mine], lcp[mine]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        same = (text[np.repeat(at[x], n) + step] == text[np.repeat(at[y], n) + step]).all()
        more = (n < size[x]) & (n < size[y])
        rises = text[np.where(more, at[x] + n, 0)] < text[np.where(more, at[y] + n, 0)]
        if same and np.where(more, rises, size[x] <= size[y]).all():
            return order, lcp
    raise RuntimeError("hash collisions under 16 hashes")


def repeated_starts(data: list[np.ndarray], off: np.ndarray, low_doc: np.ndarray, group: np.ndarray, span: int, earlier: bool) -> list[np.ndarray]:
    """For different stretches around anchors (at off): which window starts of each are in another one of its group too
    (earlier: in one with a smaller low_doc)."""
    sizes = np.array([len(d) for d in data])
    text = np.concatenate(data)
    base = np.cumsum(sizes) - sizes
    at = base + off
    fo, fl = sorted_suffixes(text, at, np.minimum(base + sizes - at, span), group)
    back = text[::-1].copy()
    bo, bl = sorted_suffixes(back, len(text) - at, np.minimum(off, span), group)
    m = len(data)
    width = int(off.max()) + 1
    o = np.arange(width)

    def classes(order: np.ndarray, lcp: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Stretches that agree in `need` bytes with their neighbour in the order get one number, for each offset."""
        out = np.empty((m, width), np.int64)
        out[order] = np.cumsum(lcp[:, None] < need[None, :], axis=0)
        return out

    key = classes(fo, fl, span - o) * (m + 1) + classes(bo, bl, o)
    start = off[:, None] - o[None, :]
    valid = (start >= 0) & (start <= (sizes - span)[:, None])
    key = np.where(valid, key, -1 - np.arange(m)[:, None])
    found = np.zeros((m, width), bool)
    if earlier:
        order = np.lexsort((np.broadcast_to(low_doc[:, None], key.shape), key), axis=0)
        sorted_, low = np.take_along_axis(key, order, 0), low_doc[order]
        new = np.ones((m, width), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(m)[:, None], 0), axis=0)
        twice = np.take_along_axis(low, first, 0) < low
    else:
        order = np.argsort(key, axis=0)
        sorted_ = np.take_along_axis(key, order, 0)
        twice = np.zeros((m, width), bool)
        twice[1:] = sorted_[1:] == sorted_[:-1]
        twice[:-1] |= twice[1:].copy()
    np.put_along_axis(found, order, twice, 0)
    found &= valid
    out = []
    for i in range(m):
        w = np.zeros(sizes[i] - span + 1, bool)
        w[start[i][found[i]]] = True
        out.append(w)
    return out


def _solve(span: int, shard_bytes: int, unit: str, earlier: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in windows.shards(batches, shard_bytes):
            anchor, _, _, low_doc, off, data = zip(*shard)
            codes = [np.frombuffer(d, np.uint8 if unit == "bytes" else np.uint64) for d in data]
            if unit == "words":
                numbers = np.unique(np.concatenate(codes), return_inverse=True)[1]
                codes = np.split(numbers, np.cumsum([len(c) for c in codes])[:-1])
            yield windows.solved(shard, repeated_starts(codes, np.array(off), np.array(low_doc), np.array(anchor), span, earlier))

    return run


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and how many each has."""
    return np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))


def repeated_strings(docs: DataFrame, span: int = SPAN, gram: int = GRAM, unit: str = "bytes", earlier: bool = False) -> DataFrame:
    """doc_id, tk and cuts: intervals [a, b) of symbols in strings of `span` that also start elsewhere."""
    if unit == "words":
        return windows.repeated(docs, hash_words, span, gram, 8, WORD_BLOCKS, _solve(span, 1 << 20, unit, earlier), earlier)
    return windows.repeated(docs, symbols, span, gram, 1, BYTE_BLOCKS, _solve(span, 1 << 19, unit, earlier), earlier)


def _keep(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=4 << 20):
            out = []
            for doc, tk, text, cuts in zip(part.column("doc_id").to_pylist(), part.column("tk").to_pylist(), raw(part), part.column("cuts").to_pylist()):
                a, b = ([c[k] for c in cuts or ()] for k in ("a", "b"))
                if unit == "words" and a:  # from the first removed word to the next kept one, or to the end
                    start, _ = words_at(np.frombuffer(text, np.uint8))
                    start = np.append(start, len(text))
                    a, b = start[a].tolist(), start[b].tolist()
                a, b = (x.tolist() for x in spans_of(covered(len(text), a, b)))
                kept = b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)])) if a else text
                out.append((doc, tk, len(text), len(text) - len(kept), len(a), [{"start": x, "end": y} for x, y in zip(a, b)], kept))
            types = [*[pa.int64()] * 5, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "tk", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return run


def drop_repeated_strings(docs: DataFrame, span: int = SPAN, gram: int = GRAM, unit: str = "bytes", keep_first: bool = False) -> DataFrame:
    """Removes every byte (unit="words": every word, with the space after it) covered by a string of `span` of them that
    also starts anywhere else; keep_first: that also starts in a document with a smaller doc_id.

    Returns doc_id, tk (the text's hash), n_bytes, n_removed, n_spans, spans (removed byte intervals) and kept (the
    remaining bytes; of bytes, a cut may fall inside a character).
    """
    if unit not in ("bytes", "words"):
        raise ValueError("unit must be bytes or words")
    docs = documents(docs)
    cuts = repeated_strings(docs, span, gram, unit, keep_first)
    out = docs.join(cuts, ["doc_id", "tk"], "left").select("doc_id", "tk", "text", "cuts")
    return out.mapInArrow(_keep(unit), "doc_id long, tk long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary")

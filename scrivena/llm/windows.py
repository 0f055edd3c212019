"""Repeated fixed-length windows: which windows of some documents could occur more than once, and where.

A window is `span` symbols in a row (words or bytes). Of the k-grams in a window the leftmost one with the least hash is
its anchor; equal windows have equal anchors at equal places, so only windows with the same anchor need comparing.
Neighbouring windows with the same anchor form a run. All runs are shuffled as a few numbers each:

1. `anchors` counts each anchor's runs, with partial sums before the shuffle, and keeps those seen more than once;
2. `candidates` keeps the runs that have such an anchor. If all runs of an anchor have the same content, they are
   decided by that; the others ("mixed") go on;
3. `contents` fetches the symbols of one run for each distinct content of a mixed anchor.

Contents of an anchor are compared by the index that the operator is named after, a task taking whole anchors. A task
takes anchors of up to GROUP contents. The contents of a larger one are first dealt out under finer anchors: they are cut
into stretches of fewer windows, and what all windows of a stretch have in common is its new anchor. `decide` repeats
this down to single windows, where a stretch is its own anchor. The same index decides at every step, and what it says
of a stretch is handed back to the contents that hold it, as one array of intervals each.

Runs are identified by 64 bits of their anchor's hash and 64 of their content's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import chunks, discard, mix, raw, scratch

#: Distinct contents that are compared under one anchor.
GROUP = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_SHIFT = np.uint64(32)

RUNS = "anchor long, ctx long, doc_id long, tk long, at int, first int, last int"


def gram_hashes(sym: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each place, by doubling; the last k - 1 places hold those of shorter strings."""
    out, have, power = None, 0, sym.astype(np.uint64)
    size, base, rest = 1, _BASE, k
    shifted = lambda a, by: np.concatenate((a[by:], np.zeros(min(by, len(a)), np.uint64)))
    while rest:
        if rest & 1:
            out = power if out is None else out + shifted(power, have) * np.uint64(pow(int(_BASE), have, 1 << 64))
            have += size
        rest >>= 1
        if rest:
            power = power + shifted(power, size) * base
            base, size = np.uint64(pow(int(base), 2, 1 << 64)), size * 2
    return mix(out + _MIX)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of the w values from each place (fewer at the end)."""
    size = 1
    while size * 2 <= w:
        x = np.concatenate((np.minimum(x[:-size], x[size:]), x[-size:])) if len(x) > size else x
        size *= 2
    if size < w and len(x) > w - size:
        x = np.concatenate((np.minimum(x[: size - w], x[w - size :]), x[size - w :]))
    return x


def window_runs(sym: np.ndarray, ends: np.ndarray, span: int, k: int):
    """Runs of windows with one anchor, over documents that lie end to end in sym (uint64).

    Returns, in places of sym: first and last window start, anchor's place, and its k-gram's hash, and the document.
    """
    starts = np.concatenate(([0], ends[:-1]))
    sizes = np.maximum(ends - starts - span + 1, 0)
    if not sizes.sum():
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    h = gram_hashes(sym, k)
    low = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), span - k + 1)
    doc = np.repeat(np.arange(len(ends)), sizes)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[doc]
    m = (low[at] & _LOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (doc[1:] != doc[:-1]))))
    stop = np.concatenate((new[1:], [len(m)])) - 1
    return at[new], at[stop], m[new], h[m[new]], doc[new]


def _runs(symbols: Callable, span: int, k: int, max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=max_bytes):
            sym, sizes = symbols(raw(part))
            ends = np.cumsum(sizes)
            first, last, at, anchor, doc = window_runs(sym.astype(np.uint64), ends, span, k)
            if not len(first):
                continue
            base = np.concatenate(([0], ends[:-1]))[doc]
            size, buf = sym.itemsize, memoryview(np.ascontiguousarray(sym)).cast("B")
            digest = xxhash.xxh3_64_intdigest
            ctx = np.fromiter((digest(buf[a * size : b * size]) for a, b in zip(first.tolist(), (last + span).tolist())), np.uint64, len(first))
            ids, tk = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tk"))
            cols = [anchor.view(np.int64), ctx.view(np.int64), ids[doc], tk[doc], *((x - base).astype(np.int32) for x in (at, first, last))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[c.split()[0] for c in RUNS.split(", ")])

    return run


def all_runs(docs: DataFrame, symbols: Callable, span: int, k: int, max_bytes: int) -> DataFrame:
    """RUNS of every document; symbols(texts) gives their symbols, end to end, and how many each text has. at is the anchor's
    place, first and last are the run's first and last window start."""
    return docs.mapInArrow(_runs(symbols, span, k, max_bytes), RUNS)


def anchors(runs: DataFrame) -> DataFrame:
    """Anchors of two runs or more: anchor, mixed (contents differ), low_doc (least doc_id)."""
    g = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"), F.min("doc_id").alias("low_doc"))
    return g.where("n > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed"), "low_doc")


def candidates(runs: DataFrame, found: DataFrame) -> DataFrame:
    return runs.join(found, "anchor")


def distinct(mixed: DataFrame) -> DataFrame:
    """One row for each anchor and content: anchor, ctx, n (runs), low_doc (least doc_id), r (the least run)."""
    per = mixed.groupBy("anchor", "ctx").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("low_doc"),
        F.min(F.struct("doc_id", "tk", "first", "last", "at")).alias("r"),
    )
    return scratch(per, "contents")


def contents(docs: DataFrame, per: DataFrame, symbols: Callable, span: int) -> DataFrame:
    """CONTENTS of distinct()'s rows: off (from the run's first window to the anchor), data (the symbols' bytes)."""
    wanted = per.select("anchor", "ctx", "n", "low_doc", "r.*").groupBy("doc_id", "tk").agg(F.collect_list(F.struct("anchor", "ctx", "n", "low_doc", "first", "last", "at")).alias("runs"))
    # Where rows are repeated, one row for each content is enough.
    return scratch(docs.join(wanted, ["doc_id", "tk"]).mapInArrow(_cut(symbols, span), CONTENTS).dropDuplicates(["anchor", "ctx"]), "stretches")


CONTENTS = "anchor long, ctx long, n long, low_doc long, off int, data binary"
NAMES = [c.split()[0] for c in CONTENTS.split(", ")]
SOLVED = "anchor long, ctx long, cuts array<struct<a: int, b: int>>"
CUTS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _cut(symbols: Callable, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            out, start = [], 0
            sym, sizes = symbols(raw(part))
            for size, runs in zip(sizes.tolist(), part.column("runs").to_pylist()):
                out += [(r["anchor"], r["ctx"], r["n"], r["low_doc"], r["at"] - r["first"], sym[start + r["first"] : start + r["last"] + span].tobytes()) for r in runs]
                start += size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 4, pa.int32(), pa.binary()))], names=NAMES)

    return run


def shards(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[list[tuple]]:
    """Whole anchors, up to about max_bytes of symbols."""
    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            if size > max_bytes and row[0] != last:
                yield held
                held, size = [], 0
            held.append(row)
            size, last = size + len(row[-1]), row[0]
    if held:
        yield held


def solved(shard: list[tuple], masks: list[np.ndarray]) -> pa.RecordBatch:
    """SOLVED rows for a shard, from a mask of window starts for each of its contents."""
    rows = []
    for row, mask in zip(shard, masks):
        if mask.any():
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            rows.append((row[0], row[1], [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), CUTS))], names=["anchor", "ctx", "cuts"])


STRETCHES = "anchor1 long, ctx1 long, low1 long, a int, b int, " + CONTENTS


def _split(span: int, itemsize: int, block: int):
    """Contents cut into stretches of at most `block` windows, at fixed distances from the anchor. The symbols that all
    windows of a block have in common become the stretch's anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in chunks(batches, "data"):
            out = []
            for anchor, ctx, n, low, off, data in zip(*(batch.column(c).to_pylist() for c in NAMES)):
                view, last = memoryview(data), len(data) // itemsize - span
                for b in range((off - last) // block, off // block + 1):
                    j0, j1 = max(0, off - b * block - block + 1), min(last, off - b * block)
                    if j0 > j1:
                        continue
                    core = view[(off - b * block) * itemsize : (off - b * block - block + 1 + span) * itemsize]
                    part = data[j0 * itemsize : (j1 + span) * itemsize]
                    out.append((anchor, ctx, low, j0, j1 + 1, signed(digest(core, seed=b & 0xFFFFFFFF)) ^ anchor, signed(digest(part)), n, low, off - j0, part if block > 1 else b""))
            if out:
                types = (*[pa.int64()] * 3, pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in STRETCHES.split(", ")])

    return run


def decide(data: DataFrame, span: int, itemsize: int, blocks: tuple[int, ...], solve: Callable, whole: str) -> DataFrame:
    """SOLVED rows: the windows [a, b) of a content that also start in another one, as solve sees it. solve maps batches of
    CONTENTS, sorted by anchor, to SOLVED rows; whole is its rule for contents that are equal, over n and low_doc of all
    of them and low1, the least doc_id of one.

    blocks: windows in a stretch, for each time that the contents of large anchors are cut; the last is 1. More windows than
    symbols in a span would have nothing in common, so such steps are left out.
    """
    blocks = tuple(b for b in blocks if b <= span)
    sizes = scratch(data.groupBy("anchor").agg(F.count("*").alias("group")).where("group > 1"), "sizes")  # written, so that the join can split an anchor
    data = data.join(sizes, "anchor")
    out = scratch(data.where(F.col("group") <= GROUP).select(*NAMES).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(solve, SOLVED), "solved")
    hot = data.where(F.col("group") > GROUP).select(*NAMES)
    if not blocks or sizes.where(F.col("group") > GROUP).isEmpty():
        return out
    cut = scratch(hot.mapInArrow(_split(span, itemsize, blocks[0]), STRETCHES), "stretches")
    per = cut.groupBy("anchor", "ctx").agg(F.sum("n").alias("n"), F.min("low_doc").alias("low_doc"), F.first("off").alias("off"), F.first("data").alias("data"))
    per = scratch(per, "contents")
    inner = decide(per, span, itemsize, blocks[1:], solve, whole)
    found = cut.select("anchor1", "ctx1", "low1", "a", "b", "anchor", "ctx").join(per.select("anchor", "ctx", "n", "low_doc"), ["anchor", "ctx"]).join(inner, ["anchor", "ctx"], "left")
    cuts = F.when(F.expr(whole), F.array(F.struct("a", "b"))).otherwise(F.transform("cuts", lambda c: F.struct((c["a"] + F.col("a")).alias("a"), (c["b"] + F.col("a")).alias("b"))))
    found = found.select(F.col("anchor1").alias("anchor"), F.col("ctx1").alias("ctx"), cuts.alias("cuts")).where("cuts is not null")
    found = scratch(found.groupBy("anchor", "ctx").agg(F.flatten(F.collect_list("cuts")).alias("cuts")), "solved")  # a content's windows bound the list
    both = scratch(out.unionByName(found), "solved")
    discard(cut, per, inner, sizes, out, found)
    return both


def repeated(docs: DataFrame, symbols: Callable, span: int, gram: int, itemsize: int, blocks: tuple[int, ...], solve: Callable, earlier: bool, max_bytes: int = 1 << 19) -> DataFrame:
    """doc_id, tk and cuts: the intervals [a, b) of symbols in windows that start elsewhere too, one row a document.

    earlier: only those that start in a document with a smaller doc_id. docs has doc_id, tk and text.
    """
    if not 0 < gram <= span:
        raise ValueError("gram must not exceed span")
    runs = all_runs(docs, symbols, span, gram, max_bytes)
    found = scratch(anchors(runs), "anchors")
    runs = scratch(candidates(runs, found), "runs")
    all_of_it = F.array(F.struct(F.col("first").alias("a"), (F.col("last") + span).alias("b")))
    plain = runs.where("not mixed and low_doc < doc_id" if earlier else "not mixed").select("doc_id", "tk", all_of_it.alias("cuts"))
    mixed = runs.where("mixed").drop("low_doc", "mixed")
    per = distinct(mixed)
    data = contents(docs, per, symbols, span)
    inner = decide(data, span, itemsize, blocks, solve, "low_doc < low1" if earlier else "n > 1")
    discard(data)
    # One row for each content that is decided, and one join row for each run of it.
    known = scratch(per.select("anchor", "ctx", "n", "low_doc").join(inner, ["anchor", "ctx"], "left").where("n > 1 or cuts is not null"), "decided")
    part = F.transform("cuts", lambda c: F.struct((c["a"] + F.col("first")).alias("a"), (c["b"] + F.col("first") + (span - 1)).alias("b")))
    cuts = F.when(F.expr("low_doc < doc_id" if earlier else "n > 1"), all_of_it).otherwise(part)
    split = mixed.join(known, ["anchor", "ctx"]).select("doc_id", "tk", cuts.alias("cuts")).where("cuts is not null")
    return plain.unionByName(split).groupBy("doc_id", "tk").agg(F.flatten(F.collect_list("cuts")).alias("cuts"))  # a document's length bounds the list

"""Divergence of each source from the other sources of its language, and the terms that set it apart.

Terms are counted by chunk, then by (language, group, term) in one shuffle by (language, term), which also makes the
postings: for each kept term the groups that hold it, with counts. A group is a (language, source).

Terms of a group, by an upper-bound search: its terms fall into buckets of nearly equal count. The greatest probability of
a bucket and the least one that its terms have in the language bound f for all of them. Buckets are evaluated best bound
first, until `most` terms are in; of the rest only those whose bound isn't strictly below the value at rank `most` so far.

Pairs of sources, by postings: a term that a source lacks has one probability there, whatever the term. f summed over all
terms therefore comes from histograms of counts, with a correction for each term that both sources hold, found in its
postings. Tasks add corrections up in a matrix of sources before anything is shuffled; sources are taken GROUPS at a time,
so that the matrix stays small, however many there are. A posting is as long as a language has sources, and the result
itself has a row for each two of them.

Probabilities and f are whole numbers, and exact for counts below 9e15.

Defined results: null text, language and source are empty; every row is a document, repeated ones and those without a
doc_id too; a language without kept terms has pairs of value 0; ties go by the item's UTF-8 bytes; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrivena.llm._common import chunks, numbered, scratch

#: Documents that a kept term has at least, and terms in a group's list.
LEAST, MOST = 3, 200
#: Groups whose matrix is held at once, its entries that are worked on at once, and bytes of text counted at once.
GROUPS, WORK, CHUNK = 1024, 1 << 19, 8 << 20
SCALE = 1000
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _split(texts: pa.Array) -> pa.ListArray:
    """The terms of each text (no nulls), and empty strings between them; all texts' bytes are mapped at once."""
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
    data = bytes((texts.buffers()[2] or b"")[at[0] : at[-1]]).translate(_TERM)
    return pc.ascii_split_whitespace(pa.StringArray.from_buffers(n, pa.py_buffer(at - at[0]), pa.py_buffer(data)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n (occurrences), docs; of each chunk of texts."""
    for batch in chunks(batches, max_bytes=CHUNK):
        found = _split(batch.column("text").cast(pa.string()))
        flat = found.flatten()
        doc = np.repeat(np.arange(len(found)), np.diff(found.offsets.to_numpy()))
        full = pc.greater(pc.binary_length(flat), 0)
        terms, doc = flat.filter(full).dictionary_encode(), doc[full.to_numpy(zero_copy_only=False)]
        if not len(doc):
            continue
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        # First by document and term, then by group and term.
        m = len(terms.dictionary)
        pair, times = np.unique(doc * m + terms.indices.to_numpy(), return_counts=True)
        key = group[pair // m] * m + pair % m
        order = np.argsort(key, kind="stable")
        start = np.flatnonzero(np.diff(key[order], prepend=-1))
        g, term = np.divmod(key[order][start], m)
        at = np.divmod(g, len(source.dictionary))
        sizes = np.diff(np.append(start, len(order)))
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(at[0])), source.dictionary.take(pa.array(at[1])), terms.dictionary.take(pa.array(term)), pa.array(np.add.reduceat(times[order], start)), pa.array(sizes)],
            names=["lang", "source", "term", "n", "docs"],
        )


def postings(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(terms, groups), written. terms: lid (language), term, total, held: array<struct<gid, n>>, of terms in `least`
    documents of their language. groups: gid (dense, by lang and source), lid, lang, source, v (kept terms of the
    language), own (its own kept terms), tot and ltot (occurrences of kept terms, in the group and the language, plus v)."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = rows.select("lang", "source").distinct().repartitionByRange("lang", "source").sortWithinPartitions("lang", "source")
    groups = numbered(groups, "gid", "groups")
    groups = groups.join(groups.groupBy("lang").agg(F.min("gid").alias("lid")), "lang")
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").join(groups, ["lang", "source"])
    # One exchange by language and term serves both groupings.
    found = found.select("lid", "gid", "term", "n", "docs").repartition("lid", "term").groupBy("lid", "term", "gid").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = found.groupBy("lid", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("gid", "n")).alias("held"))
    terms = scratch(terms.where(F.col("docs") >= least).drop("docs"), "postings")
    by_lang = terms.groupBy("lid").agg(F.count("*").alias("v"), F.sum("total").alias("ln"))
    by_group = _occurrences(terms).groupBy("gid").agg(F.sum("n").alias("gn"), F.count("*").alias("own"))
    groups = groups.join(by_lang, "lid", "left").join(by_group, "gid", "left").na.fill(0, ["v", "ln", "gn", "own"])
    groups = groups.select("gid", "lid", "lang", "source", "v", "own", (F.col("gn") + F.col("v")).alias("tot"), (F.col("ln") + F.col("v")).alias("ltot"))
    return terms, scratch(groups, "group-sums")


def _occurrences(terms: DataFrame) -> DataFrame:
    """lid, term, total, gid, n."""
    return terms.select("lid", "term", "total", F.explode("held").alias("h")).select("lid", "term", "total", "h.gid", "h.n")


def _p(count: str, total: str) -> str:
    """SQL of 1 + floor(1000000000 * (count + 1) / total): three digits of the quotient at a time, so that no product is
    larger than total * 1000."""
    first = f"(({count} + 1) * {SCALE})"
    second = f"({first} % {total} * {SCALE})"
    return f"(1 + {first} div {total} * {SCALE * SCALE} + {second} div {total} * {SCALE} + {second} % {total} * {SCALE} div {total})"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _probability(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As _p."""
    out, rest = np.zeros_like(total + count), count + 1
    for _ in range(3):
        high, rest = np.divmod(rest * SCALE, total)
        out = out * SCALE + high
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f, as _f."""
    return (p - q) ** 2 // q


def scored(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """gid, term, p, q, bucket: the terms that a group holds with a higher probability than its language. Counts share a
    bucket that agree in their highest four bits."""
    rows = _occurrences(terms).join(groups.select("gid", "tot", "ltot"), "gid").select("gid", "term", "n", F.expr(_p("n", "tot")).alias("p"), F.expr(_p("total", "ltot")).alias("q"))
    low = F.greatest(F.char_length(F.bin("n")) - 4, F.lit(0))
    return rows.select("gid", "term", "p", "q", (low * 16 + F.call_function("shiftright", "n", low)).cast("int").alias("bucket")).where("p > q")


def buckets(rows: DataFrame, most: int = MOST) -> DataFrame:
    """gid, bucket, bound, first: whether it is among the best that hold `most` terms. Some 500 rows a group at most."""
    found = rows.groupBy("gid", "bucket").agg(F.max("p").alias("p"), F.min("q").alias("q"), F.count("*").alias("m"))
    found = found.select("gid", "bucket", "m", F.expr(_f("p", "q")).alias("bound"))
    before = Window.partitionBy("gid").orderBy(F.desc("bound"), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    return found.select("gid", "bucket", "bound", (F.coalesce(F.sum("m").over(before), F.lit(0)) < most).alias("first"))


def _best(rows: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def top_terms(terms: DataFrame, groups: DataFrame, most: int = MOST) -> DataFrame:
    """gid, item, value, rank: each group's `most` terms by f."""
    rows = scored(terms, groups)
    cells = scratch(buckets(rows, most), "buckets")
    value = lambda opened: rows.join(opened.select("gid", "bucket"), ["gid", "bucket"], "left_semi").select("gid", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    top = scratch(_best(value(cells.where("first")), most), "best-first")
    last = top.where(F.col("rank") == most).select("gid", F.col("value").alias("kth"))
    # What is left counts only where it could still reach that value; a group without one has no buckets left.
    more = value(cells.where("not first").join(last, "gid").where("bound >= kth"))
    return _best(top.drop("rank").unionByName(more), most)


class _Sums:
    """Adds f up for pairs of the groups in two blocks. As it goes to tasks, it holds two blocks' numbers only."""

    def __init__(self, a: list, b: list):
        # gid, lid, tot of both blocks, in order of gid; those of one language lie together.
        self.n = len(a)
        both = np.array(a + (b if b is not a else []), np.int64).reshape(-1, 3)
        self.gid, self.lid, self.tot = both[:, 0], both[:, 1], both[:, 2]

    def place(self, gid: np.ndarray) -> np.ndarray:
        """Places of groups; -1 for those in neither block."""
        at = np.minimum(np.searchsorted(self.gid, gid), len(self.gid) - 1)
        return np.where(self.gid[at] == gid, at, -1)

    def pairs(self, batches: Iterator[pa.RecordBatch], add) -> Iterator[pa.RecordBatch]:
        n = len(self.gid)
        sums = np.zeros(n * n, np.int64)
        zero = _probability(np.zeros(n, np.int64), np.maximum(self.tot, 1))
        for batch in batches:
            for s, t, v in add(batch, zero):
                np.add.at(sums, s * n + t, v)
        s, t = np.divmod(np.flatnonzero(sums), n)
        # Of two blocks only the pairs across them; each block's own come from a run of their own.
        keep = (s != t) & ((s < self.n) != (t < self.n) if n > self.n else True)
        s, t = s[keep], t[keep]
        yield pa.RecordBatch.from_arrays([pa.array(self.gid[s]), pa.array(self.gid[t]), pa.array(sums[s * n + t])], names=["gid", "other", "v"])

    def by_postings(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Corrections for terms that both groups hold."""

        def add(batch: pa.RecordBatch, zero: np.ndarray):
            held = batch.column("held")
            row = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
            flat = held.flatten()
            at, count = self.place(flat.field("gid").to_numpy()), flat.field("n").to_numpy()
            row, count, at = row[at >= 0], count[at >= 0], at[at >= 0]
            p = _probability(count, self.tot[at])
            start, size = np.searchsorted(row, row, "left"), np.searchsorted(row, row, "right") - np.searchsorted(row, row, "left")
            ends = np.cumsum(size)
            i = 0
            while i < len(row):  # one side's entries, as many as have WORK partners
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + WORK, "right")))
                k = size[i:j]
                x = np.repeat(np.arange(i, j), k)
                y = np.repeat(start[i:j], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                x, y = x[x != y], y[x != y]
                s, t = at[x], at[y]
                yield s, t, _apart(p[x], p[y]) - _apart(p[x], zero[t]) - _apart(zero[s], p[y]) + _apart(zero[s], zero[t])
                i = j

        return self.pairs(batches, add)

    def by_counts(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each group's terms against groups that lack them, and the other way round."""

        def add(batch: pa.RecordBatch, zero: np.ndarray):
            at = self.place(batch.column("gid").to_numpy())
            n, m = (batch.column(c).to_numpy()[at >= 0] for c in ("n", "m"))
            at = at[at >= 0]
            p = _probability(n, self.tot[at])
            low, size = np.searchsorted(self.lid, self.lid[at], "left"), np.searchsorted(self.lid, self.lid[at], "right") - np.searchsorted(self.lid, self.lid[at], "left")
            step = max(1, WORK // max(1, len(self.gid)))
            for i in range(0, len(at), step):
                k = size[i : i + step]
                x = np.repeat(np.arange(i, i + len(k)), k)
                t = np.repeat(low[i : i + step], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                yield at[x], t, m[x] * _apart(p[x], zero[t])
                yield t, at[x], m[x] * _apart(zero[t], p[x])

        return self.pairs(batches, add)


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """gid, other, value: f summed over the language's kept terms, for each two sources of it."""
    histogram = scratch(_occurrences(terms).groupBy("gid", "n").agg(F.count("*").alias("m")), "histogram")
    last = groups.agg(F.max("gid")).first()[0]
    kinds, sums = "gid long, other long, v long", None
    # GROUPS rows of three numbers at a time; blocks that share no language have no pairs.
    block = lambda i: [tuple(r) for r in groups.where(F.col("gid").between(i, i + GROUPS - 1)).select("gid", "lid", "tot").orderBy("gid").collect()]
    for i in range(0, -1 if last is None else last + 1, GROUPS):
        a = block(i)
        for j in range(i, last + 1, GROUPS):
            b = a if j == i else block(j)
            if a[-1][1] != b[0][1] and j > i:
                break
            s = _Sums(a, b)
            found = terms.select("held").mapInArrow(s.by_postings, kinds).unionByName(histogram.mapInArrow(s.by_counts, kinds))
            sums = found if sums is None else sums.unionByName(found)
    g = groups.select("gid", "lid", "v", "own", "tot")
    pairs = g.join(g.select("lid", *(F.col(c).alias(f"o_{c}") for c in ("gid", "own", "tot"))), "lid").where("gid != o_gid").withColumnRenamed("o_gid", "other")
    if sums is None:
        return pairs.select("gid", "other", F.col("v").alias("value"))
    sums = scratch(sums.groupBy("gid", "other").agg(F.sum("v").alias("sum")), "pair-sums")
    neither = F.expr(f"(v - own - o_own) * {_f(_p('0L', 'tot'), _p('0L', 'o_tot'))}")
    value = F.when(F.col("v") == 0, F.lit(0)).otherwise(F.coalesce("sum", F.lit(0)) + neither)
    return pairs.join(sums, ["gid", "other"], "left").select("gid", "other", value.cast("long").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank. docs: lang, source, text."""
    terms, groups = postings(docs, least)
    names = groups.select("gid", "lang", "source")
    pairs = source_pairs(terms, groups).join(groups.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    pairs = pairs.select("gid", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    found = pairs.unionByName(top_terms(terms, groups, most).select("gid", F.lit("term").alias("part"), "item", "value", "rank"))
    return found.join(names, "gid").select("lang", "source", "part", "item", "value", "rank")

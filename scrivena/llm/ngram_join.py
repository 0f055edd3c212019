"""Exact n-gram Jaccard join with token-combination prefixes.

A document's tokens are its distinct word n-grams. Counts of all documents' tokens in BUCKETS hash buckets (a fixed size)
give one global order, rare first. With s tokens and `e` of them allowed to miss, a document's prefix is extended until
e losses cannot destroy all of its signatures: each rare token is a signature by itself; frequent tokens are dealt into
subclasses by hash, and in each subclass every combination of k of them is one (k = 2, or 3 for very frequent ones), of
which a subclass of n tokens only dies with n - k + 1 losses. Documents that link share a signature. Subclasses are one
for 16 tokens of the size band (32 for triples), which keeps combinations in proportion to the document; a document near the
edge of its band signs in both. What is rare, frequent or very frequent goes by how many documents would share a signature
by chance, so that chance groups stay in proportion to the table.

Documents with equal sets are one class. Candidates are compared in three steps, each over fewer documents:

1. In each group of equal signatures every member is compared with one pivot, the member that has most signatures in
   common with others (one pair a row). A family of near copies thereby falls together around its centre. The pivot is
   then done with its group.
2. Documents in a group whose other members lie in several components sign again with the longest combinations: all tokens of a
   class, dealt into more classes than a link can spoil, so that only close sets meet; these groups have pivots too.
3. In the groups that then still have several components, members of different components are compared with each other,
   a pair in the first group that it shares and not in each one.

A pair is verified on the whole sets of tokens (64-bit hashes of the n-grams), unless its bitmaps (parities of hashed
tokens) already differ in too many bits.

Defined results: null or empty texts have no tokens and link with nothing; rows without a doc_id are left out; rows that
share a doc_id are one document, whose links are pooled; repeated rows give a row each; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import chunks, discard, documents, hash_words, mix, raw, scratch
from scrivena.llm.components import components
from scrivena.llm.windows import gram_hashes

BUCKETS = 1 << 21
#: A token whose bucket counts RARE at most signs by itself; others sign in pairs, and in triples where pairs would still
#: meet by chance: where the square of the count exceeds CHANCE times the number of documents.
RARE, CHANCE = 4, 0.25
#: Bits of a filter that thins out rows before they are shuffled; as it fills up it only lets more rows pass.
FILTER = 1 << 27
#: Least signatures that a member carries to the last comparison.
LISTED = 16
#: 64-bit words of a set's bitmap.
WORDS = 8
BITS = [f"b{i}" for i in range(WORDS)]


def token_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each text's words, A-Z lower-cased; fewer words are one n-gram."""
    flat, sizes = hash_words(texts, lower=True)
    grams = gram_hashes(flat, n) if len(flat) else flat
    out, at = [], 0
    for k in sizes.tolist():
        if k >= n:
            x = np.sort(grams[at : at + k - n + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        else:
            out.append(mix(gram_hashes(flat[at : at + k], k)[:1] + np.uint64(k)) if k else np.zeros(0, np.uint64))
        at += k
    return out


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parities of a set's tokens over 64 * WORDS places. Two sets differ in as many tokens at least as their bitmaps do
    in bits, so that a bitmap tells sets apart that are too different to link."""
    at = (tokens >> np.uint64(40)).astype(np.int64) % (64 * WORDS)
    return np.packbits(np.bincount(at, minlength=64 * WORDS).astype(np.uint8) & 1).view(np.int64)


def least_linked(num: int, den: int) -> int:
    """Tokens of the smallest set that can link with a different one."""
    return -(-num // (den - num)) if num < den else 1 << 60


def _holds_back(band: int, num: int, den: int) -> bool:
    """Whether subclasses could hold back so many tokens of the band's smallest set that its prefix is too short. All sets
    of the band then sign with single tokens; this needs thresholds far below 0.8."""
    s = max(-(-(1 << band - 1) * num // den), least_linked(num, den))
    return -(-num * s // den) <= max(1, (1 << band) >> 4) + 2 * max(1, (1 << band) >> 5)


def signatures(tokens: np.ndarray, counts: np.ndarray, total: int, num: int, den: int) -> np.ndarray:
    """Signatures of a set; counts are those of the tokens' buckets, total is the number of documents."""
    s = len(tokens)
    if s < least_linked(num, den):
        return np.zeros(0, np.uint64)
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    need = s - -(-num * s // den) + 1
    single = int(np.searchsorted(counts, RARE, side="right"))
    out = []
    for band in {s.bit_length(), (s * den // num).bit_length()}:
        salt = np.uint64(band * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
        if single >= need or _holds_back(band, num, den):
            out.append(mix(tokens[:need] ^ salt))
            continue
        out.append(mix(tokens[:single] ^ salt))
        t, k = tokens[single:], np.where(counts[single:].astype(np.float64) ** 2 <= CHANCE * total, 2, 3)
        many = np.where(k == 2, max(1, (1 << band) >> 4), max(1, (1 << band) >> 5)).astype(np.uint64)
        part = ((t >> np.uint64(20)) % many).astype(np.int64) * 4 + k
        by = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(part[by]) != 0)))
        nth = np.empty(len(t), np.int64)  # of its subclass, in the order of the prefix
        nth[by] = np.arange(len(t)) - np.repeat(starts, np.diff(np.append(starts, len(t))))
        gain = np.cumsum(nth + 1 >= k)
        stop = int(np.searchsorted(gain, need - single)) + 1
        out += _combinations(mix(t[:stop] ^ salt), part[:stop], k[:stop])
    return np.unique(np.concatenate(out))


def _combinations(h: np.ndarray, part: np.ndarray, k: np.ndarray) -> list[np.ndarray]:
    """Hashes of all pairs and triples inside the parts; a sum doesn't depend on the order."""
    by = np.argsort(part, kind="stable")
    h, part, k = h[by], part[by], k[by]
    out, far = [], 1
    while far < len(h) and (same := part[far:] == part[:-far]).any():
        i = np.flatnonzero(same)
        two = i[k[i] == 2]
        out.append(mix(h[two] + h[two + far]))
        three, last = i[k[i] == 3], far + 1
        while len(three := three[three + last < len(h)]) and len(three := three[part[three + last] == part[three]]):
            out.append(mix(h[three] + h[three + far] + h[three + last] + np.uint64(3)))
            last += 1
        far += 1
    return out


@lru_cache(maxsize=4)
def bands(num: int, den: int) -> list[int]:
    """First sizes of bands; sets that link lie in one band or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * den // num)))
    return out


def lengthened(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of whole classes: all tokens are dealt into more classes than a link can spoil, and each class is one.

    Classes without tokens are left out where so few are empty that another one is left in common.
    """
    s, first = len(tokens), bands(num, den)
    own, out = int(np.searchsorted(first, s, side="right")) - 1, []
    for j in (own - 1, own):
        if j < 0:
            continue
        spoilt = (den - num) * 2 * (first[j + 2] - 1) // (den + num)
        many = spoilt + 1 + spoilt // 4
        salt = np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        h = mix(tokens ^ salt)
        part = ((h >> np.uint64(33)) % np.uint64(many)).astype(np.int64)
        sums = np.zeros(many, np.uint64)
        np.add.at(sums, part, mix(h))
        full = np.bincount(part, minlength=many) > 0
        if many - int(full.sum()) >= many - spoilt:
            full[:] = True
        out.append(mix(sums + mix(np.arange(many, dtype=np.uint64) ^ salt))[full])
    return np.concatenate(out)


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)  # of this task
        for part in chunks(batches):
            found = token_sets(raw(part), n)
            np.add.at(total, (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        for i in range(0, len(some), 1 << 16):
            at = some[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    return run


def _keys(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            found = token_sets(raw(part), n)
            ck = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in found], np.uint64).view(np.int64)
            bits = np.array([bitmap(x) for x in found]).reshape(len(found), WORDS)
            cols = [part.column("doc_id"), part.column("tk"), pa.array(ck), pa.array([len(x) for x in found], pa.int32()), *(pa.array(bits[:, i]) for i in range(WORDS))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "tk", "ck", "n", *BITS])

    return run


def _filter(df: DataFrame, column: str):
    """A filter that holds the hashes in a column, broadcast: 256 bits or more for each of them, up to FILTER bits (16 MB)."""
    at = f"(shiftrightunsigned({column}, 20) & {FILTER - 1}L)"
    words = df.selectExpr(f"cast(shiftright({at}, 6) as int) as word", f"shiftleft(1L, cast({at} & 63L as int)) as mask")
    rows = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # FILTER / 64 rows at most
    bits = np.zeros(min(FILTER >> 6, 1 << max(10, len(rows).bit_length() + 2)), np.int64)
    np.bitwise_or.at(bits, rows.column("word").to_numpy() & (len(bits) - 1), rows.column("mask").to_numpy())
    return df.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a filter may hold."""
    at = (hashes >> np.uint64(20)) & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _wanted(bits):
    """The rows whose tk a filter may hold; of rows that share doc_id and text, one a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = np.flatnonzero(_passes(bits.value, batch.column("tk").to_numpy().view(np.uint64))).tolist()
            ids, tks = batch.column("doc_id"), batch.column("tk")
            keep = []
            for i in rows:
                key = ids[i].as_py(), tks[i].as_py()
                if key not in seen:
                    seen.add(key)
                    keep.append(i)
            if keep:
                yield batch.take(pa.array(keep))

    return run


def _texts(docs: DataFrame, known: DataFrame, wanted: DataFrame) -> DataFrame:
    """ck, text: one text for each class in wanted. Only rows that a filter lets pass are shuffled."""
    own = scratch(known.join(wanted, "ck", "left_semi").select("ck", "doc_id", "tk"), "wanted")
    bits = _filter(own, "tk")
    rows = docs.mapInArrow(_wanted(bits), "doc_id long, text string, tk long")
    out = scratch(rows.dropDuplicates(["doc_id", "tk"]).join(own, ["doc_id", "tk"]).select("ck", "text"), "texts")
    bits.destroy()
    discard(own)
    return out


def _sign(n: int, counts, total: int, num: int, den: int, bits=None):
    """Signatures of the documents, of equal sets once a task; with bits, only those that this filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = counts.value, set()
        for part in chunks(batches):
            sigs, cks = [], []
            for x in token_sets(raw(part), n):
                ck = xxhash.xxh3_64_intdigest(x.tobytes())
                if ck in seen:
                    continue
                seen.add(ck)
                s = signatures(x, table[(x & np.uint64(BUCKETS - 1)).astype(np.int64)], total, num, den)
                if bits is not None:
                    s = s[_passes(bits.value, s)]
                if len(s):
                    sigs.append(s)
                    cks.append(ck)
            if sigs:
                per = [len(s) for s in sigs]
                cks = np.repeat(np.array(cks, np.uint64).view(np.int64), per)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(cks)], names=["sig", "ck"])

    return run


def _lengthen(n: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            sigs = [lengthened(x, num, den) for x in token_sets(raw(part), n)]
            per = [len(x) for x in sigs]
            ck = np.repeat(part.column("ck").to_numpy(), per)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(ck)], names=["sig", "ck"])

    return run


def _verify(n: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def tokens(ck: int, text: bytes) -> np.ndarray:
            if ck not in held:
                held[ck] = token_sets([text], n)[0]
                while len(held) > 256:
                    held.popitem(last=False)
            else:
                held.move_to_end(ck)
            return held[ck]

        for batch in batches:
            out = []
            for a, b, s, t in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), raw(batch, "s"), raw(batch, "t")):
                x, y = tokens(a, s), tokens(b, t)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if den * both >= num * (len(x) + len(y) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return run


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row a document: doc_id, tk (the text's hash), n_shingles, component_id (least doc_id reachable by links).

    Two documents link when den * (common n-grams) >= num * (n-grams of either).
    """
    if not 0 < num <= den or 2 * num < den:
        raise ValueError("the threshold must be from 1/2 to 1")
    docs = documents(docs)
    spark = docs.sparkSession
    keys = scratch(docs.mapInArrow(_keys(n), "doc_id long, tk long, ck long, n int, " + ", ".join(f"{b} long" for b in BITS)), "keys")
    sketch = np.zeros(BUCKETS, np.int32)
    rows = docs.mapInArrow(_count(n), "bucket int, n long").groupBy("bucket").agg(F.least(F.sum("n"), F.lit(1 << 30)).cast("int").alias("n")).toArrow()  # BUCKETS rows at most
    sketch[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    counts = spark.sparkContext.broadcast(sketch)
    del rows, sketch
    total = keys.count()
    sigs = docs.mapInArrow(_sign(n, counts, total, num, den), "sig long, ck long")
    groups = scratch(sigs.groupBy("sig").agg(F.min("ck").alias("p"), F.max("ck").alias("q")).where("p != q").select("sig"), "groups")
    bits = _filter(groups, "sig")
    sigs = docs.mapInArrow(_sign(n, counts, total, num, den, bits), "sig long, ck long")
    members = scratch(sigs.join(groups, "sig").dropDuplicates(["sig", "ck"]), "members")
    counts.destroy()
    bits.destroy()
    discard(groups)
    known = keys.join(members.select("ck").dropDuplicates(), "ck", "left_semi")
    known = scratch(known.groupBy("ck").agg(F.min(F.struct("doc_id", "tk")).alias("r"), *(F.min(c).alias(c) for c in ("n", *BITS))).select("ck", "r.*", "n", *BITS), "classes")

    others = _pivoted(members)
    discard(members)
    first = _close(others, known, num, den)
    texts = _texts(docs, known, first.select(F.col("a").alias("ck")).union(first.select("b")).dropDuplicates())
    links = _links(texts, first, n, num, den)
    discard(texts)

    part = components(links)
    apart = _apart(others, part)
    still = scratch(apart.select("ck").dropDuplicates(), "open")
    discard(others)
    texts = _texts(docs, known, still)  # of all that later pairs can hold
    longer = texts.mapInArrow(_lengthen(n, num, den), "sig long, ck long")
    groups = longer.groupBy("sig").agg(F.min("ck").alias("p"), F.max("ck").alias("q")).where("p != q").select("sig")
    members = scratch(longer.join(scratch(groups, "groups"), "sig"), "members")
    others = _pivoted(members)
    discard(members)
    more = scratch(_close(others, known, num, den).join(first, ["a", "b"], "left_anti"), "pairs")
    part = _merged(part, _links(_compared(texts, more), more, n, num, den))

    apart = scratch(_apart(others, part).join(known.select("ck", "n", *BITS), "ck"), "apart")
    discard(others)
    rest = _meetings(apart, num, den).dropDuplicates()
    rest = scratch(rest.join(first.union(more), ["a", "b"], "left_anti"), "pairs")
    part = _merged(part, _links(_compared(texts, rest), rest, n, num, den))
    discard(apart, texts)
    return _result(keys, part)


def _merged(part: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the links behind part and of some more: each member's link to its component stands for the former."""
    return components(part.toDF("u", "v").union(links))


def _pivoted(members: DataFrame) -> DataFrame:
    """sig, ck, pivot: the members of each group without its pivot, the member that is in most groups."""
    rank = scratch(members.groupBy("ck").agg(F.count("*").alias("groups")), "ranks")
    pivot = scratch(members.join(rank, "ck").groupBy("sig").agg(F.max(F.struct("groups", "ck")).alias("p")).select("sig", F.col("p.ck").alias("pivot")), "pivots")
    out = scratch(members.join(pivot, "sig").where("ck != pivot").select("sig", "ck", "pivot"), "others")
    discard(rank, pivot)
    return out


def _meetings(apart: DataFrame, num: int, den: int) -> DataFrame:
    """a < b: members of different components that may link, from rows of sig, ck, c, n and the bitmap.

    Members that share one group mostly share dozens. A pair is left to the least signature that both have among their
    LISTED least ones; only a pair without such a signature comes once a group.
    """
    listed = apart.groupBy("ck").agg(F.slice(F.array_sort(F.collect_list("sig")), 1, LISTED).alias("l"))
    rows = apart.join(scratch(listed, "listed"), "ck")
    x, y = (rows.select("sig", F.col("ck").alias(k), *(F.col(v).alias(f"{v}{k}") for v in ("n", "c", "l", *BITS))) for k in ("a", "b"))
    once = "coalesce(array_min(array_intersect(la, lb)), sig) >= sig"
    return x.join(y, "sig").where("a < b and ca != cb").where(_may_link(num, den)).where(once).select("a", "b")


def _may_link(num: int, den: int) -> str:
    """What sizes (na, nb) and bitmaps don't rule out."""
    differ = " + ".join(f"bit_count({v}a ^ {v}b)" for v in BITS)
    return f"{den} * least(na, nb) >= {num} * greatest(na, nb) and {den + num} * ({differ}) <= {den - num} * (na + nb)"


def _close(others: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """a < b: pairs of a member and its pivot that may link."""
    pairs = others.select(F.least("ck", "pivot").alias("a"), F.greatest("ck", "pivot").alias("b")).dropDuplicates()
    for k in ("a", "b"):
        pairs = pairs.join(known.select(F.col("ck").alias(k), F.col("n").alias(f"n{k}"), *(F.col(v).alias(f"{v}{k}") for v in BITS)), k)
    return scratch(pairs.where(_may_link(num, den)).select("a", "b"), "pairs")


def _compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of texts, those that the pairs name."""
    return scratch(texts.join(pairs.select(F.col("a").alias("ck")).union(pairs.select("b")).dropDuplicates(), "ck"), "compared")


def _links(texts: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """u, v: the pairs that link, by their whole texts."""
    both = pairs.join(texts.select(F.col("ck").alias("b"), F.col("text").alias("t")), "b").join(texts.select(F.col("ck").alias("a"), F.col("text").alias("s")), "a")
    return scratch(both.select("a", "b", "s", "t").mapInArrow(_verify(n, num, den), "u long, v long"), "links")


def _apart(others: DataFrame, part: DataFrame) -> DataFrame:
    """sig, ck, c (component) of the groups whose members besides the pivot lie in several components."""
    rows = others.join(part, others.ck == part.node, "left").select("sig", "ck", F.coalesce("component", "ck").alias("c"))
    rows = scratch(rows, "apart")
    mixed = rows.groupBy("sig").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x != y").select("sig")
    return rows.join(scratch(mixed, "mixed"), "sig")


def _result(keys: DataFrame, part: DataFrame) -> DataFrame:
    own = keys.where("n > 0").groupBy("ck").agg(F.min("doc_id").alias("low"))
    own = own.join(part, own.ck == part.node, "left").select("ck", "low", F.coalesce("component", "ck").alias("c"))
    own = scratch(own, "classes")
    low = scratch(own.groupBy("c").agg(F.min("low").alias("component_id")), "least")
    own = scratch(own.join(low, "c").select("ck", "component_id"), "classes")
    out = keys.join(own, "ck", "left")
    return out.select("doc_id", "tk", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

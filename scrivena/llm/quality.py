"""Quality classifier: supervised subword embeddings.

A document is the average of its words' vectors; a word's vector is the average of learned vectors of the word and of its
character n-grams, all hashed into one table. A softmax layer gives the score. Table and layer are trained by stochastic
gradient descent in numpy, on the driver, on `sample` labelled documents at most (SAMPLE), the ones whose ids have the
least hashes; scoring covers every whole text and reads the model from a broadcast of fixed size.

Defined results: null and empty texts score as a document without words (the layer's bias); without labelled rows every
score is 0.5; labels that are null don't train; of several labels of a doc_id the least counts; rows without a doc_id are
left out; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import chunks, documents, raw

#: Most labelled documents that the model is fitted on.
SAMPLE = 3000
BUCKETS, DIM, GRAMS = 1 << 16, 8, (3, 4, 5)
#: Stands once for each word that equals the one before it: what word pairs tell of repetition, as one learned vector.
AGAIN = b"\x00again"
_BASE = np.uint64(0x100000001B3)


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, sample: int) -> list[tuple[bytes, int]]:
    """Texts and labels of at most `sample` documents outside the held-out fold."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    y = y.where(fold("doc_id", folds) != held_out).groupBy("doc_id").agg(F.min("y").alias("y"))
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most `sample` rows are broadcast and collected; rows that share id and text are one.
    rows = docs.join(F.broadcast(y), "doc_id").groupBy("doc_id", "tk").agg(F.first("text").alias("text"), F.first("y").alias("y"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "tk").limit(sample).select(F.col("text").cast("binary").alias("text"), "y", "doc_id").toArrow()
    found = sorted(zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), rows.column("y").to_pylist()), key=lambda r: (r[0], r[1] or b""))
    return [(t or b"", y) for _, t, y in found]


def features(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the words' features, word after word, and how many each has."""
    data = b"<" + b"><".join(words) + b">"
    # Code points: a word has as many as bytes that don't go on with another one.
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    lengths_ = np.array([len(w) + 2 for w in words], np.int64)
    sizes = np.add.reduceat(begins.astype(np.int64), np.cumsum(lengths_) - lengths_)
    text = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    stop = np.cumsum(sizes)
    start = stop - sizes
    left = np.repeat(stop, sizes) - np.arange(len(text))  # places to the word's end
    grams, owner = [], []
    word = np.repeat(np.arange(len(words)), sizes)
    h = text.copy()
    for k in range(2, max(GRAMS) + 1):
        h = h[:-1] * _BASE + text[k - 1 :]
        if k in GRAMS:
            at = np.flatnonzero(left[: len(h)] >= k)
            grams.append(h[at] ^ np.uint64(k << 56))
            owner.append(word[at])
    power = np.cumprod(np.concatenate(([1], np.full(int(sizes.max()) - 1, _BASE))).astype(np.uint64))
    whole = np.add.reduceat(text * power[np.arange(len(text)) - np.repeat(start, sizes)], start)
    grams.append(whole)
    owner.append(np.arange(len(words)))
    g, o = np.concatenate(grams), np.concatenate(owner)
    g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(o, kind="stable")
    return ((g >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)[order], np.bincount(o, minlength=len(words))


def _word_rows(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each document's words as numbers of them (end to end), and how many it has."""
    split = []
    for t in texts:
        w = t.split()
        again = sum(map(eq, w, w[1:]))
        split.append(w + [AGAIN] * again if again else w)
    number: dict[bytes, int] = {}
    for w in split:
        for x in w:
            if x not in number:
                number[x] = len(number)
    sizes = np.array([len(w) for w in split], np.int64)
    return list(number), np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum())), sizes


def _means(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Means of consecutive rows; zero where there are none."""
    out = np.zeros((len(sizes), rows.shape[1]), np.float32)
    some = sizes > 0
    if some.any():
        start = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(rows, start, axis=0) / sizes[some, None]
    return out


class Embeddings:
    """The model: table (buckets x dim), layer (dim x 2) and bias."""

    def __init__(self, table: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.table, self.layer, self.bias = table, layer, bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        words, at, sizes = _word_rows(texts)
        docs = np.zeros((len(texts), self.table.shape[1]), np.float32)
        if words:
            rows, per = features(words, len(self.table))
            docs = _means(_means(self.table[rows], per)[at], sizes)
        z = docs @ self.layer + self.bias
        return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -50, 50).astype(np.float64)))


def train(rows: list[tuple[bytes, int]], epochs: int = 6, rate: float = 0.4, dim: int = DIM, buckets: int = BUCKETS, seed: int = 7) -> Embeddings:
    """Stochastic gradient descent over the rows, the step falling to nothing."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    if not rows:
        return Embeddings(table, layer, bias)
    held = []
    for text, y in rows:  # a document's features, each with its share in the average
        words, at, sizes = _word_rows([text])
        if not words:
            held.append((np.zeros(0, np.int64), np.zeros(0, np.float32), y))
            continue
        f, per = features(words, buckets)
        share = np.repeat(np.bincount(at, minlength=len(words)) / per, per) / sizes[0]
        w = np.bincount(f, share, minlength=0)
        k = np.flatnonzero(w)
        held.append((k.astype(np.int32), w[k].astype(np.float32), y))
    steps, step = epochs * len(held), 0
    for _ in range(epochs):
        for i in rng.permutation(len(held)):
            k, w, y = held[i]
            now = rate * (1 - step / steps)
            step += 1
            v = w @ table[k] if len(k) else np.zeros(dim, np.float32)
            z = v @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y)] -= 1
            grad = layer @ p
            layer -= now * np.outer(v, p).astype(np.float32)
            bias -= now * 0.1 * p.astype(np.float32)
            if len(k):
                # Shares are small for long texts; the step is per word, as for one occurrence of each feature.
                table[k] -= (now * min(len(k), 500) * w)[:, None] * grad[None, :]
    return Embeddings(table, layer, bias)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, tk (the text's hash), held_out, score and predicted for every row of docs."""
    docs = documents(docs)
    model = train(labelled(docs, labels, label, folds, held_out, sample))
    return score(docs, model, folds, held_out, threshold)


def score(docs: DataFrame, model, folds: int, held_out: int, threshold: float) -> DataFrame:
    """docs has doc_id, tk and text; the model has scores(texts)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tk"), pa.array(m.scores(raw(part)), pa.float64())], names=["doc_id", "tk", "score"])

    out = docs.select("doc_id", "tk", "text").mapInArrow(run, "doc_id long, tk long, score double")
    return out.select("doc_id", "tk", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

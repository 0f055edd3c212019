"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the presence of words and word beginnings in a document. In training, each labelled sentence
that names a group (identity term) gets counterfactuals: the same sentence with the term swapped for others of its kind.
Their scores should not differ, so the squared change of the logit is a penalty beside the log loss; neutral mentions of
a group then don't raise a score. Few corpora name groups often enough for that, so identity terms are also put into a
sentence of labelled documents of either class, as many of one as of the other (PLANTED of each at most); those copies train
with their documents' labels, and their sentences are swapped like others. Any labelled table with words thus has pairs;
Presence.pairs is their number, and at 0 the model is a plain logistic regression. Features are those that tell the classes
apart best in the sample, plus the identity terms, so that their weights can be held down. Fitting uses `sample` labelled documents at most (SAMPLE), the ones whose
ids have the least hashes; scoring covers every whole text.

Defined results: null and empty texts score as a document without features; without labelled rows every score is 0.5;
labels that are null don't train; of several labels of a doc_id the least counts; rows without a doc_id are left out;
repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from scrivena.llm._common import documents
from scrivena.llm.quality import labelled, score

#: Most labelled documents that the model is fitted on.
SAMPLE = 8000
#: Most documents of each class that get an identity term put in.
PLANTED = 1000
#: Most features of the model, and the lengths of word beginnings.
FEATURES, STEMS = 4096, (4, 5, 6)
STRIP = ".,;:!?\"'()[]{}<>*|-"

#: Identity terms; those of one set are swapped for each other. Fixed values.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("old", "young", "elderly"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas"),
)


def terms(words: set[str]) -> set[str]:
    """Features of a set of words: each without its punctuation, and its beginnings (marked by a star)."""
    out = set()
    for w in words:
        w = w.strip(STRIP)
        if w:
            out.add(w)
            for k in STEMS:
                if len(w) > k:
                    out.add(w[:k] + "*")
    return out


def counterfactuals(text: str, groups=IDENTITIES, most: int = 4) -> list[tuple[str, str]]:
    """Sentences that name a group, each with up to `most` versions that name another one of its kind."""
    kind = {t: g for g in groups for t in g}
    out = []
    for sentence in re.split(r"(?<=[.!?\n])\s*", text.lower()):
        words = sentence.split()
        at = [i for i, w in enumerate(words) if w.strip(STRIP) in kind]
        if not at:
            continue
        for shift in range(1, most + 1):
            other = list(words)
            for i in at:
                term = words[i].strip(STRIP)
                g = kind[term]
                other[i] = words[i].replace(term, g[(g.index(term) + shift) % len(g)])
            if other != words:
                out.append((sentence, " ".join(other)))
    return out


def planted(rows: list[tuple[bytes, int]], groups=IDENTITIES, most: int = PLANTED) -> list[tuple[bytes, int]]:
    """Copies of labelled documents with an identity term put into one sentence; as many of each class, `most` at most.
    Which documents, sentence, place and term is a matter of the text's hash."""
    flat = [t for g in groups for t in g]
    kinds = [sorted((xxhash.xxh64_intdigest(text), text) for text, y in rows if y == label and text.strip()) for label in (0, 1)]
    out = []
    for label, kind in enumerate(kinds):
        for h, text in kind[: min(most, *map(len, kinds))]:
            parts = re.split(r"(?<=[.!?\n])(\s*)", text.decode("utf-8", "replace"))
            at = 2 * (h % ((len(parts) + 1) // 2))
            words = parts[at].split(" ")
            words.insert((h >> 16) % (len(words) + 1), flat[(h >> 32) % len(flat)])
            parts[at] = " ".join(words)
            out.append(("".join(parts).encode(), label))
    return out


class Presence:
    """The model: weights of features, the bias, and how many counterfactual pairs it was fitted with."""

    def __init__(self, weights: dict[str, float], bias: float, pairs: int = 0):
        self.weights, self.bias, self.pairs = weights, bias, pairs
        # A word scores only through these, so that most words are done with one look at their beginning.
        self.begins = {f.removesuffix("*")[: min(STEMS)] for f in weights}

    def logit(self, text: str) -> float:
        k, begins = min(STEMS), self.begins
        found = {w for w in set(text.lower().split()) if w[:k] in begins or w.strip(STRIP)[:k] in begins}
        weights = self.weights
        return self.bias + sum(sorted(weights[f] for f in terms(found) if f in weights))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = np.array([self.logit(t.decode("utf-8", "replace")) for t in texts], np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(rows: list[tuple[bytes, int]], groups=IDENTITIES, penalty: float = 10.0, ridge: float = 1e-6, rounds: int = 1500, rate: float = 0.1) -> Presence:
    """Full-batch Adam on log loss + penalty * mean squared logit change under identity swaps + ridge."""
    if not rows:
        return Presence({}, 0.0)
    given = len(rows)
    rows = rows + planted(rows, groups)
    y = np.array([r[1] for r in rows], np.float64)
    # A document's features are kept as 32-bit hashes; only those that are chosen are needed as texts.
    hashes, pairs = [], []
    for text, _ in rows:
        t = text.decode("utf-8", "replace")
        hashes.append(np.unique(np.fromiter(map(xxhash.xxh32_intdigest, terms(set(t.lower().split()))), np.uint32)))
        pairs += counterfactuals(t, groups)
    # Features are chosen by the documents as they are; the copies are there to be fitted.
    n1, n0 = max(y[:given].sum(), 1), max(given - y[:given].sum(), 1)
    toxic = [h for h, label in zip(hashes[:given], y) if label]
    keys, a = np.unique(np.concatenate(toxic), return_counts=True) if toxic else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    keys, a = keys[a >= 3], a[a >= 3]
    b = np.zeros(len(keys), np.int64)
    for h, label in zip(hashes[:given], y):
        if not label and len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            b[at[keys[at] == h]] += 1
    p = (a + b) / given
    gain = (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-9)
    best = np.lexsort((keys, -gain))[:FEATURES]
    chosen = set(keys[best[gain[best] >= 3]].tolist())
    # Identity terms too, where they occur: their weights are what the penalty holds down.
    named = {f: xxhash.xxh32_intdigest(f) for g in groups for t in g for f in terms({t})}
    seen = set(np.intersect1d(np.array(list(named.values()), np.uint32), np.concatenate(hashes)).tolist())
    number = {f: i for i, f in enumerate(sorted(f for f, h in named.items() if h in chosen or h in seen))}
    wanted = np.array(sorted(chosen), np.uint32)
    docs: list[list[str]] = []
    for (text, _), h in zip(rows, hashes):
        found = []
        if np.isin(h, wanted).any() or number:
            for f in sorted(terms(set(text.decode("utf-8", "replace").lower().split()))):
                if f in number or xxhash.xxh32_intdigest(f) in chosen:
                    number.setdefault(f, len(number))
                    found.append(f)
        docs.append(found)
    del hashes
    m = len(number)

    def sparse(sets: list) -> tuple[np.ndarray, np.ndarray]:
        hit = [[number[f] for f in s if f in number] for s in sets]
        return np.repeat(np.arange(len(hit)), [len(h) for h in hit]), np.array([i for h in hit for i in h], np.int64)

    row, col = sparse(docs)
    (ra, ca), (rb, cb) = (sparse([terms(set(p[k].split())) for p in pairs]) for k in (0, 1))
    w, bias = np.zeros(m), float(np.log(n1 / n0))
    m1, m2 = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, w[col], len(y)) + bias
        d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        grad = np.append(np.bincount(col, d[row], m) + ridge * w, d.sum())
        if pairs:
            change = (np.bincount(ra, w[ca], len(pairs)) - np.bincount(rb, w[cb], len(pairs))) * (2 * penalty / len(pairs))
            grad[:m] += np.bincount(ca, change[ra], m) - np.bincount(cb, change[rb], m)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:m], bias - move[m]
    names = list(number)
    return Presence({names[i]: float(w[i]) for i in np.flatnonzero(np.abs(w) > 1e-3)}, float(bias), len(pairs))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1, threshold: float = 0.7, sample: int = SAMPLE, groups=IDENTITIES, penalty: float = 10.0) -> DataFrame:
    """doc_id, tk (the text's hash), held_out, score and predicted for every row of docs."""
    docs = documents(docs)
    model = train(labelled(docs, labels, label, folds, held_out, sample), groups, penalty)
    return score(docs, model, folds, held_out, threshold)

"""Word and byte substring dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from scrivena.llm import fm_index, suffix_sort, windows
from scrivena.llm._common import prepare


def rows_of(kind: int) -> list[tuple]:
    rng = random.Random(kind)
    words = ["a", "bb", "cé", "d"] + [f"w{i}" for i in range(40 if kind else 3)]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rng.choice(base) if rng.random() < 0.6 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(0, 3))]
        w = " \n".join(parts).split(" ")
        if w and rng.random() < 0.5:
            w[rng.randrange(len(w))] = f"EDIT{i}"
        rows.append((i * 7 - 20, " ".join(w)))
    return rows + [(900, None), (901, ""), (902, "a" * 100), (903, rows[3][1]), (904, "x " * 80), (None, rows[3][1])]


def words_brute(rows, span):
    split = [(d, (t or "").encode().split()) for d, t in rows if d is not None]
    first: dict = {}
    for d, w in split:
        for i in range(len(w) - span + 1):
            k = tuple(w[i : i + span])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - span + 1):
            if first[tuple(w[i : i + span])] < d:
                gone[i : i + span] = [True] * span
        out.append((d, len(w), sum(gone), b" ".join(x for x, y in zip(w, gone) if not y).decode()))
    return sorted(out)


def bytes_brute(rows, span):
    texts = [(d, (t or "").encode()) for d, t in rows if d is not None]
    seen = Counter(b[i : i + span] for _, b in texts for i in range(len(b) - span + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(b), int(gone.sum()), runs, bytes(x for x, y in zip(b, gone) if not y)))
    return sorted(out)


@pytest.mark.parametrize(("kind", "group"), [(0, 256), (1, 2)])
def test_against_brute_force(spark, monkeypatch, kind, group):
    prepare(spark)
    monkeypatch.setattr(windows, "GROUP", group)
    monkeypatch.setattr(fm_index, "BLOCKS", (3, 1))
    monkeypatch.setattr(suffix_sort, "BYTE_BLOCKS", (7, 2, 1))
    monkeypatch.setattr(suffix_sort, "WORD_BLOCKS", (3, 1))
    rows = rows_of(kind)
    # Further columns may have any name, those used inside too.
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, tk int, anchor string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in fm_index.drop_repeated_passages(df, 10, 4).collect())
    assert got == words_brute(rows, 10) and sum(r[2] for r in got) > 100
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_sort.drop_repeated_strings(df, 40, 12).collect())
    assert got == bytes_brute(rows, 40) and sum(r[2] for r in got) > 100
    got = sorted((r.doc_id, b" ".join(bytes(r.kept).split()).decode()) for r in suffix_sort.drop_repeated_strings(df, 10, 4, "words", keep_first=True).collect())
    assert got == [(r[0], r[3]) for r in words_brute(rows, 10)]


def test_common_passage_with_different_surroundings(spark, monkeypatch):
    """One passage in 400 documents: its anchors are cut down to single windows, and nothing is lost."""
    prepare(spark)
    monkeypatch.setattr(windows, "GROUP", 16)
    rng = random.Random(4)
    word = lambda: f"x{rng.randint(0, 3)}" if rng.random() < 0.3 else f"y{rng.randint(0, 999)}"
    passage = [f"p{i}" for i in range(14)]
    rows = [(i, " ".join([*(word() for _ in range(rng.randint(5, 25))), *passage, *(word() for _ in range(rng.randint(5, 25)))])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in fm_index.drop_repeated_passages(df, 10, 4).collect())
    assert got == words_brute(rows, 10) and sum(r[2] for r in got) > 399 * 14
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_sort.drop_repeated_strings(df, 40, 12).collect())
    assert got == bytes_brute(rows, 40)


def test_matching_statistics_decide(monkeypatch):
    """Without them, or with shorter ones, nothing is found."""
    a, b, c = np.arange(20), np.concatenate((np.arange(5, 18), [40, 41])), np.arange(30, 45)
    args = ([a, b, c], np.zeros(3, int), np.array([3, 9, 9]), 10)
    assert [np.flatnonzero(x).tolist() for x in fm_index.seen_earlier(*args)] == [[], [0, 1, 2, 3], []]
    true = fm_index.FMIndex.matching_statistics
    monkeypatch.setattr(fm_index.FMIndex, "matching_statistics", lambda self, s: (true(self, s)[0] // 2, *true(self, s)[1:]))
    assert not any(x.any() for x in fm_index.seen_earlier(*args))


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fm_index.drop_repeated_passages(empty).count() == 0 and suffix_sort.drop_repeated_strings(empty).count() == 0
    twice = spark.createDataFrame([(1, "abc " * 30)] * 2, "doc_id long, text string")
    assert [r.n_removed for r in fm_index.drop_repeated_passages(twice, 10, 4).collect()] == [0, 0]
    assert [r.n_removed for r in suffix_sort.drop_repeated_strings(twice, 40, 12).collect()] == [120, 120]


def test_fm_index_matching_statistics():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 4, n) for n in (50, 1, 0, 80)]
    index = fm_index.FMIndex(seqs)
    streams = [rng.integers(0, 5, 60), seqs[0]]
    length, low, high = index.matching_statistics(streams)
    text = ["".join(map(str, s)) for s in seqs]
    at = 0
    for s in streams:
        q = "".join(map(str, s))
        for i in range(len(q)):
            most = max(k for k in range(len(q) - i + 1) if k == 0 or any(q[i : i + k] in t for t in text))
            assert length[at] == most
            if most:
                found = sum(t[j : j + most] == q[i : i + most] for t in text for j in range(len(t) - most + 1))
                assert high[at] - low[at] == found
            at += 1


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    at = np.sort(rng.choice(400, 60, replace=False))
    size, group = np.minimum(400 - at, 50), np.repeat([1, 2, 3], 20)
    order, lcp = suffix_sort.sorted_suffixes(text, at, size, group)
    raw = text.tobytes()
    for g in (1, 2, 3):
        mine = [i for i in order.tolist() if group[i] == g]
        assert [raw[at[i] : at[i] + size[i]] for i in mine] == sorted(raw[at[i] : at[i] + size[i]] for i in np.flatnonzero(group == g))


def test_collision_is_noticed(monkeypatch):
    class Weak(suffix_sort.HashedText):
        def __init__(self, text, seed=0):
            super().__init__(text, seed)
            if seed == 0:
                self.sums[:] = 0  # every two strings look equal

    monkeypatch.setattr(suffix_sort, "HashedText", Weak)
    text = np.frombuffer(b"banana bandana", np.uint8)
    order, _ = suffix_sort.sorted_suffixes(text, np.array([0, 7, 9]), np.array([6, 7, 5]), np.zeros(3, int))
    assert order.tolist() == [0, 1, 2]

"""Similarity joins, fingerprints and revisits against brute force."""

import gc
import hashlib
import os
import random

import numpy as np
import pytest

from scrivena.llm import _common, embedding_dedup, imatch, ngram_join, revisit
from scrivena.llm import components as components_module
from scrivena.llm._common import prepare
from scrivena.llm.components import components


def groups(n, links):
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[root(a)] = root(b)
    return [root(i) for i in range(n)]


def test_components(spark):
    prepare(spark)
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 700)] + [(rng.randrange(800, 900), rng.randrange(800, 900)) for _ in range(40)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    root = groups(1000, links)
    low = {}
    for i, r in enumerate(root):
        low.setdefault(r, i)
    assert got == {i: low[root[i]] for i in range(1000) if low[root[i]] != i}


def join_brute(rows, n, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    root = groups(len(rows), links)
    low: dict = {}
    for i, (d, _) in enumerate(rows):
        low[root[i]] = min(low.get(root[i], d), d)
    return sorted((d, len(sets[i]), low[root[i]]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (2, 60)])
def test_ngram_join(spark, monkeypatch, n, num):
    """Components against all pairs; repeated rows, equal ids, nulls and clashing names are among them."""
    prepare(spark)
    monkeypatch.setattr(ngram_join, "RARE", 2)  # so that single tokens, pairs and triples all occur in a small table
    monkeypatch.setattr(ngram_join, "CHANCE", 0.3)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([5, 12, 30, 100, 400]))] for _ in range(20)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6, 12]) * len(w) // 200 + rng.choice([0, 0, 1])):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 5)}"
        rows.append((i * 3 + 7, " ".join(w[:-1] if rng.random() < 0.2 else w)))
    rows += [(9000, None), (9001, ""), (9002, "a"), (9003, "A"), (9004, "a b"), (9005, "a b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ck int").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df, n, num, 100).collect())
    assert got == join_brute(rows, n, num, 100)


def test_signatures_are_shared():
    """Sets that link share a signature, whatever the counts are."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        s = int(rng.integers(10, 400))
        x = np.unique(rng.integers(0, 1 << 62, s).astype(np.uint64))
        k = int(rng.integers(0, max(1, len(x) // 9)))
        y = np.unique(np.concatenate((x[k // 2 :], rng.integers(0, 1 << 62, k - k // 2).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both < 90 * (len(x) + len(y) - both) or len(x) == both == len(y):
            continue
        count = lambda z: (z % np.uint64(97)).astype(np.int64)
        a, b = (ngram_join.signatures(z, count(z), 10_000, 90, 100) for z in (x, y))
        assert len(np.intersect1d(a, b))


def test_filter_passes_what_it_holds(spark):
    rng = np.random.default_rng(5)
    held, other = (rng.integers(-(1 << 63), 1 << 63, n, dtype=np.int64) for n in (500, 20_000))
    bits = ngram_join._filter(spark.createDataFrame([(int(x),) for x in held], "sig long"), "sig").value
    assert ngram_join._passes(bits, held.view(np.uint64)).all()
    assert ngram_join._passes(bits, other.view(np.uint64)).mean() < 0.01
    none = ngram_join._filter(spark.createDataFrame([], "sig long"), "sig").value
    assert not ngram_join._passes(none, other.view(np.uint64)).any()


def test_lengthened_signatures_are_shared():
    rng = np.random.default_rng(2)
    for num in (60, 80, 90):
        for _ in range(200):
            s = int(rng.integers(4, 300))
            x = np.unique(rng.integers(0, 1 << 62, s).astype(np.uint64))
            k = int(rng.integers(0, max(1, len(x) * (100 - num) // 90) + 1))
            y = np.unique(np.concatenate((x[k // 2 :], rng.integers(0, 1 << 62, k - k // 2).astype(np.uint64))))
            both = len(np.intersect1d(x, y))
            if 100 * both >= num * (len(x) + len(y) - both):
                assert len(np.intersect1d(ngram_join.lengthened(x, num, 100), ngram_join.lengthened(y, num, 100)))


def test_ngram_join_large_group(spark):
    """Three thousand variants of one text, most of them too far apart to link, lose no link; few pairs are made."""
    prepare(spark)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(3000):
        w = list(base)
        for k in rng.sample(range(60), rng.choice([1, 4, 5, 6, 7])):
            w[k] = f"e{rng.randint(0, 9)}"
        rows.append((i + 1, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in ngram_join.join(df, 1, 90, 100).collect()}
    sets = [set(t.split()) for _, t in rows]
    number = {w: i for i, w in enumerate(sorted(set().union(*sets)))}
    x = np.zeros((len(rows), len(number)), np.float32)
    for i, z in enumerate(sets):
        x[i, [number[w] for w in z]] = 1
    both, size = x @ x.T, x.sum(1)
    links = [(int(i), int(j)) for i, j in zip(*np.nonzero(100 * both >= 90 * (size[:, None] + size[None, :] - both))) if i < j]
    root = groups(len(rows), links)
    low: dict = {}
    for i, r in enumerate(rows):
        low[root[i]] = min(low.get(root[i], r[0]), r[0])
    assert got == {r[0]: low[root[i]] for i, r in enumerate(rows)}
    assert 1000 < len(set(got.values())) < 2999


def test_ngram_join_empty(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def vectors_brute(rows, least):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0 and lab is not None for _, v, lab in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links.append((i, j))
    root = groups(len(rows), links)
    low: dict = {}
    for i, r in enumerate(rows):
        low[root[i]] = min(low.get(root[i], r[0]), r[0])
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((r[0], count[i], low[root[i]], r[0] == low[root[i]]) for i, r in enumerate(rows))


def test_embeddings(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 120)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        if i and rng.random() < 0.5:
            v = np.array(rows[rng.integers(0, min(i, 12))][1]) * rng.uniform(0.5, 2) + rng.normal(0, rng.choice([0, 0.03, 0.1]), 8)
        else:
            v = rng.normal(0, 1, 8)
        rows.append((i * 2 + 1, [float(x) for x in v], int(i % 3)))
    rows += [(900, None, 1), (901, [0.0] * 8, 1), (902, [1.0, None] + [0.0] * 6, 1), (903, [float("nan")] * 8, 1), (904, rows[0][1], None), (905, [], 1), (906, [1.0, 0.0], 1), (907, [2.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, w int").repartition(3)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == vectors_brute(rows, 0.98)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_imatch(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i * 5, " ".join(["The"] + [rng.choice(words) for _ in range(rng.choice([3, 40, 400]))])) for i in range(120)]
    rows += [(2000, None), (2001, ""), (2002, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, f string")
    got = {r.doc_id: r for r in imatch.edited(df).collect()}
    ordered = sorted(((d, t or "") for d, t in rows), reverse=True)
    for i, (d, t) in enumerate(ordered):
        nxt = ordered[(i + 1) % len(ordered)][1]
        half = len(t) // 2
        assert got[d].edited_text == t[: len(t) - half] + nxt[:half] and got[d].n_chars == len(t)
        if (got[d].fingerprint, got[d].n_chars) != ("", 0) and len(t) > 100:
            assert got[d].near_edited > got[d].near_next
    assert got[0].fingerprint == got[2002].fingerprint != got[5].fingerprint
    assert got[2001].near_edited == 1.0 and got[2001].near_next == 1.0
    one = imatch.edited(df.where("doc_id = 5")).first()
    assert one.near_next == 1.0
    assert imatch.edited(df.where("false")).count() == 0


def test_revisits(spark):
    rows = [
        (1, "response", "http://a.org/x?b=2&a=1#f", 10, {"etag": "v1", "content-length": "9", "date": "d10"}, "one"),
        (2, "response", "https://www.A.org/x/?a=1&b=2&utm_source=q", 20, {"etag": "v2", "content-length": "8"}, "two"),
        (3, "revisit", "a.org/x?a=1&b=2", 15, {"etag": 'W/v1', "content-length": "0", "date": "d15"}, None),
        (4, "revisit", "a.org/x?a=1&b=2", 20, {"etag": "v1"}, None),
        (5, "revisit", "a.org/x?a=1&b=2", 99, {"etag": "v1"}, None),
        (6, "revisit", "a.org/x?a=1&b=2", 99, None, None),
        (7, "revisit", "b.org/", 5, {"etag": "v1"}, None),
        (8, "revisit", None, 5, {"etag": "v1"}, None),
        (9, "revisit", "a.org/x?a=1&b=2", 5, {"etag": "v1"}, None),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "record_id long, kind string, url string, ts long, headers map<string,string>, payload string, block int")
    got = {r.record_id: r for r in revisit.resolve(df).collect()}
    assert {k: (v.status, v.response_id, v.payload) for k, v in got.items()} == {
        3: ("resolved", 1, "one"), 4: ("resolved", 1, "one"), 5: ("mismatch", 2, None), 6: ("unvalidated", 2, None), 7: ("no_response", None, None), 8: ("no_response", None, None), 9: ("no_response", None, None),
    }
    assert got[3].headers == {"etag": "W/v1", "content-length": "9", "date": "d15"}
    assert revisit.resolve(df.where("false")).count() == 0


def test_edited_digest(spark, sf_dir):
    from scrivena.llm.queries import op7_imatch

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    for r in op7_imatch(spark, sf_dir).collect():
        t, nxt = docs[r.doc_id], docs[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(t) // 2
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()


def test_imatch_hot_groups(spark):
    """Copies count once in document frequencies, and texts that the band leaves nothing of keep apart."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(200_000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [some(40) for _ in range(1000)]
    copied, template, other = some(40), some(40), some(40)
    texts += [copied] * 500 + [f"{template} x{i}" for i in range(100)] + [f"{other} y{i}" for i in range(100)] + [template, other, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    stop = imatch.stop_terms(df)
    assert set(stop) == {r.t for t in (template, other) for r in spark.createDataFrame([(t,)], "text string").select(imatch.F.explode(imatch.term_hashes(imatch.F.col("text"))).alias("t")).collect()}
    pairs = [(copied, copied), (template, other), (copied, template), (template, f"{template} x1"), (template, " ".join(template.split()[:20]) + " " + some(20)), ("", None), (template, "")]
    a, b = (imatch.fingerprint(imatch.F.col(c), stop) for c in "ab")
    got = spark.createDataFrame(pairs, "a string, b string").select(a.alias("a"), b.alias("b")).select(imatch.likeness(imatch.F.col("a"), imatch.F.col("b")).alias("n"), imatch.as_text(imatch.F.col("a")).alias("f")).collect()
    n = [r.n for r in got]
    assert n[0] == 1.0 and n[1] < 0.1 and n[2] < 0.1 and n[3] > 0.9 and n[4] > 0.15 and n[5] == 1.0 and n[6] == 0.0
    assert len({r.f for r in got}) == 3 and [r.f == "" for r in got] == [False] * 5 + [True, False]


def test_imatch_lexicons_cover_the_band(spark):
    """A text that differs by any one term of the band has another fingerprint, alike but not equal."""
    words = [f"u{i}" for i in range(400)]
    rows = [(" ".join(words), " ".join(words[:i] + ["other"] + words[i + 1 :])) for i in range(0, 400, 10)]
    a, b = (imatch.fingerprint(imatch.F.col(c), []) for c in "ab")
    got = spark.createDataFrame(rows, "a string, b string").select(a.alias("a"), b.alias("b")).select(imatch.as_text(imatch.F.col("a")).alias("f"), imatch.as_text(imatch.F.col("b")).alias("g"), imatch.likeness(imatch.F.col("a"), imatch.F.col("b")).alias("n")).collect()
    assert all(r.f != r.g and 0.8 < r.n < 1.0 for r in got) and len({r.g for r in got}) == len(rows)


def test_imatch_band_is_a_share_at_every_size(spark):
    for n in (100, 200):
        # Terms a and b are in 2 % of texts and in one text more.
        rows = [(i, f"t{i}" + " a" * (i < n // 50) + " b" * (i <= n // 50)) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert imatch.stop_terms(df) == [spark.range(1).select(imatch.F.xxhash64(imatch.F.lit("b"))).first()[0]]


def test_embedding_dedup_deals_in_bounded_batches(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    monkeypatch.setattr(embedding_dedup, "TILE", 1 << 14)
    x = np.random.default_rng(3).normal(0, 1, (3000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = len(x)
    batch = pa.RecordBatch.from_arrays([pa.array([1] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], names=["label", "cls", "w", "data"])
    # No centroids: one cell, of 50 blocks of homes and 5 wide ones.
    deal = embedding_dedup._deal(SimpleNamespace(value={}), SimpleNamespace(value={(1, -9): (50, 5)}), 0.98)
    sizes = [b.num_rows for b in deal(iter([batch]))]
    assert max(sizes) <= embedding_dedup.SLICE + 54
    assert sum(sizes) == n * 54  # 50 tiles as a member, 5 as a home, one of them as both
    tile = embedding_dedup._tile(0.98)
    same = pa.table({"cls": list(range(200)), "w": [1] * 200, "home": [True] * 200, "member": [True] * 200, "data": [x[0].tobytes()] * 200})
    out = tile(same).to_pydict()
    assert out["n"] == [199] * 200 and set(out["v"]) == {0}


def test_members_meet_once_however_many_groups_they_share(spark):
    from scrivena.llm.ngram_join import BITS, _meetings

    rows = [(sig, ck) for sig in range(40) for ck in range(6)] + [(sig, ck) for sig in (50, 51) for ck in (5, 9)]
    apart = spark.createDataFrame(rows, "sig long, ck long").selectExpr("sig", "ck", "ck as c", "100 as n", *(f"0L as {b}" for b in BITS))
    found = sorted(tuple(r) for r in _meetings(apart, 80, 100).collect())
    # The last two groups are beyond what 5 has listed, so that its pair with 9 comes once for each of them.
    assert found == [(a, b) for a in range(6) for b in range(a + 1, 6)] + [(5, 9)] * 2


def test_ngram_join_leaves_no_broadcasts(spark, monkeypatch):
    made, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append(broadcast(self, value)) or made[-1])
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:i] + ["x"] + words[i + 1 :])) for i in range(30)]
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 90, 100)
    assert len(made) >= 3 and not [b for b in made if os.path.exists(b._path)]
    assert {r["component_id"] for r in found.collect()} == {0}


def test_garbage_is_collected_between_tables(spark, monkeypatch):
    calls, collect = [], gc.collect
    monkeypatch.setattr(_common.gc, "collect", lambda *a: calls.append(1) or collect(*a))
    tables = [_common.scratch(spark.range(3), "tidy") for _ in range(2 * _common.TIDY)]
    assert len(calls) == 2 and [t.count() for t in tables] == [3] * len(tables)
    _common.discard(*tables)


def written(monkeypatch, *modules):
    """The names of the tables that the modules write from now on."""
    names: list = []
    for m in modules:
        monkeypatch.setattr(m, "scratch", lambda df, name: names.append(name) or _common.scratch(df, name))
    return names


def test_components_of_stars_take_one_look(spark, monkeypatch):
    prepare(spark)
    names = written(monkeypatch, components_module)
    links = [(i, i % 7) for i in range(7, 400)]
    part = components(spark.createDataFrame(links, "u long, v long"))
    assert names == ["edges", "least", "edges"]
    # Components go on from those found before, whose members' links to them stand for all others.
    more = components(part.toDF("u", "v").union(spark.createDataFrame([(9, 3), (1000, 999)], "u long, v long")))
    want = {i: 2 if i % 7 == 3 else i % 7 for i in range(7, 400)} | {3: 2, 1000: 999}
    assert {r.node: r.component for r in more.collect()} == want


def test_ngram_join_writes_few_tables(spark, monkeypatch):
    """The driver keeps the plan and the status of each query it has run, so that tables are what its memory grows with."""
    names = written(monkeypatch, ngram_join, components_module)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(200)]
    texts = [[rng.choice(words) for _ in range(60)] for _ in range(20)]
    rows = [(i, " ".join(texts[i % 20][:59] + [f"e{i // 20}"])) for i in range(80)]
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90, 100)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i % 20 for i in range(80)}
    assert len(names) <= 47, (len(names), names)


def test_filter_is_as_large_as_its_rows(spark):
    bits = ngram_join._filter(spark.range(500).selectExpr("xxhash64(id) as sig"), "sig").value
    assert bits.nbytes <= 1 << 14

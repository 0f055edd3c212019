"""Divergence audit, prefix trie and weakly supervised rules against brute force, and their defined results."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scrivena.llm import divergence, prefix_trie, weak_rules
from scrivena.llm._common import prepare


def audit_brute(rows, least=3, most=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(a or "", b or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(lower))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        n = {None: Counter()} | {s: Counter() for s in {d[1] for d in mine}}
        for _, s, ts in mine:
            for t in ts:
                if df[t] >= least:
                    n[s][t] += 1
                    n[None][t] += 1
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in n.items()}
        f = lambda p, q: (p - q) ** 2 // q
        for s in set(n) - {None}:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in set(n) - {None, s}]
            terms = [(t, f(p[s][t], p[None][t])) for t in kept if n[s][t] and p[s][t] > p[None][t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:limit])]
    return sorted(out)


def audit_rows(n=400, sources=7):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ab", "ké", "Zz", "漢", "x") for b in ("", "o", "ü", "ing", "ER", "qq", "mno")]
    rows = []
    for i in range(n):
        s = min(rng.randrange(sources), rng.randrange(sources))
        w = [words[min(int(rng.expovariate(0.15)) + s, len(words) - 1)] for _ in range(rng.choice([0, 3, 30, 200]))]
        rows.append((rng.choice(["en", "de"]), f"s{s}", rng.choice([" ", "1", "-", "\x00"]).join(w)))
    rows += rows[:20]
    return [*rows, (None, None, "abo abo x"), (None, "s1", None), ("en", None, "xo"), ("fr", "a", "unique words"), ("fr", "b", ""), ("en", "s1", "ab1 " * 20000)]


@pytest.mark.parametrize(("block", "most"), [(1024, 200), (3, 2)])
def test_audit(spark, monkeypatch, block, most):
    """All groups in one block, and a few to a block; long lists, and such as stop early."""
    prepare(spark)
    monkeypatch.setattr(divergence, "GROUPS", block)
    rows = audit_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, term int, value int").repartition(5)
    got = sorted(map(tuple, divergence.audit(df, most=most).select("lang", "source", "part", "item", "value", "rank").collect()))
    assert got == audit_brute(rows, most=most)


def test_audit_stops_early(spark):
    """Buckets whose bound is below what is reached are never evaluated; what is left is enough."""
    prepare(spark)
    rows = [("en", f"s{i % 3}", " ".join(f"t{'abcdefghij'[k]}{'abcdefghij'[i % 3]}" for k in range(10) for _ in range(4 ** min(k, 6)))) for i in range(9)]
    terms, groups = divergence.postings(spark.createDataFrame(rows, "lang string, source string, text string"))
    found = divergence.buckets(divergence.scored(terms, groups), 2)
    assert found.where("first").count() < found.count()
    top = sorted(map(tuple, divergence.top_terms(terms, groups, 2).join(groups, "gid").select("lang", "source", F.lit("term"), "item", "value", "rank").collect()))
    assert top == [r for r in audit_brute(rows, most=2) if r[2] == "term"]


def test_audit_empty(spark):
    prepare(spark)
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(none).count() == 0
    wordless = spark.createDataFrame([("en", "a", None), ("en", "b", "12")], "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(wordless).select("source", "part", "item", "value", "rank").collect())) == [("a", "pair", "b", 0, 1), ("b", "pair", "a", 0, 1)]


def trie_brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), (r, x)))
    own = {c: [e[2] for e in sorted(v, key=lambda e: e[:2])] for c, v in convs.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, v in full.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
            if d:
                kids[v[: d - 1]].add(v[:d])
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in kids[p]]
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        sums[p] = (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if full[c] == p)))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *sums[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()), key=repr)


def trie_rows():
    rng = random.Random(6)
    rows = []
    for c in [*range(-7, 90), 100000, 70003, 70004]:
        if c % 11 == 3:
            continue
        for t in range(rng.choice([1, 2, 5, 9, 14, 40 if c % 5 == 0 else 3])):
            rows.append((c, t, rng.choice(["user", "user", None]), rng.choice(["a", "ü", "", None, "long " * 50])))
    rows += [(200, t, "user", "same") for t in range(70)] + [(205, t, "user", "same") for t in range(70)] + [(210, 5, "user", "same")] * 33
    rows += [(215, None, "user", "x"), (215, None, "a", "y"), (215, 1, "a", "z"), (215, 1, "b", "z"), (None, 1, "a", "b"), (220, 1, "us", "erx"), (225, 1, "user", "x" * 300000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("stretch", [4, 1024])
def test_trie(spark, monkeypatch, stretch):
    """Short stretches and blocks, so that conversations and member lists span many of them, and the ones in use."""
    prepare(spark)
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    if stretch == 4:
        monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    rows = trie_rows()
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, d int, name string").repartition(5)
    got = prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.positions(df)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == trie_brute(rows)


def test_trie_empty(spark):
    prepare(spark)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.positions(none))).count() == 0
    one = spark.createDataFrame([(3, 0, "user", "x")], "conv_id long, turn long, role string, text string")  # its base is absent and h is 4: no turns
    assert [tuple(r)[:7] for r in prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.positions(one))).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens").collect()] == [(3, 0, None, 1, 0, 1, 0)]


def rules_brute(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def rules_rows(n=300):
    rng = random.Random(7)
    letters = "abcdefghijklmno"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        w = [rng.choice(["the", "of", "and", "to", "is"]) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.choice([3, 60, 90, 400]))]
        if i % 5 == 1:
            w = [x + "###" for x in w]
        elif i % 5 == 2:
            w = [x.upper() + "!!" for x in w]
        elif i % 5 == 3 and i % 10 < 5:
            w = w[:10] * 8
        rows.append((i, "".join(x + rng.choice([" ", " ", " ", ".\n", "  "]) for x in w)))
    return rows


def test_rules(spark):
    rows = [*rules_rows(), (900, None), (901, ""), (902, " \n\t"), (903, "a b c a b c a b c d"), (904, "a a a a a"), (905, "x y z\nx y z\n\n\nx y z\n"), (906, "ü|漢 😀\x1f<b>"), (907, "word and the " * 60000), (5, "twice"), (5, "twice"), (None, "x")]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, votes int, w int").repartition(4)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = weak_rules.judge(df).collect()
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter((d, *rules_brute(t)) for d, t in rows if d is not None)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
        if not r.base_failed and r.doc_id < 900:
            assert r.kept == (r.doc_id % 5 in (0, 3, 4)), r


def test_rules_model(spark):
    """The accuracies against a plain loop; a single bad vote of a weak rule doesn't decide."""
    rng = random.Random(1)
    k = len(weak_rules.RULES)
    sure = [0.95 - 0.04 * j for j in range(k)]
    patterns = Counter()
    for _ in range(3000):
        good = rng.random() < 0.8
        patterns[tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < sure[j]) == good else -1) for j in range(k))] += 1
    got = weak_rules.estimate(spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long").repartition(3)).first().model
    prior, good, bad = 0.7, [0.8] * k, [0.8] * k
    inside = lambda x, a, b: min(max(x, a), b)

    def q(v):
        s = math.log(prior / (1 - prior)) + sum(math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0 for x, g, b in zip(v, good, bad))
        return 1 / (1 + math.exp(-s))

    for _ in range(weak_rules.ROUNDS):
        p = {v: q(v) for v in patterns}
        share = lambda j, want, side: sum(n * (p[v] if side else 1 - p[v]) for v, n in patterns.items() if want(v[j]))
        good, bad, prior = (
            [inside((share(j, lambda x: x == 1, True) + 1) / (share(j, lambda x: x != 0, True) + 2), weak_rules.LOW, weak_rules.HIGH) for j in range(k)],
            [inside((share(j, lambda x: x == -1, False) + 1) / (share(j, lambda x: x != 0, False) + 2), weak_rules.LOW, weak_rules.HIGH) for j in range(k)],
            inside((sum(n * p[v] for v, n in patterns.items()) + 1) / (sum(patterns.values()) + 2), 0.01, 0.99),
        )
    assert got.prior == pytest.approx(prior) and got.good == pytest.approx(good) and got.bad == pytest.approx(bad)
    assert abs(got.prior - 0.8) < 0.05 and max(abs(a - b) for a, b in zip(got.good, sure)) < 0.06
    assert q([1] * (k - 1) + [-1]) > 0.5 > q([-1] * k)


def test_rules_without_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert weak_rules.judge(none).count() == 0
    short = spark.createDataFrame([(1, "too short")], "doc_id long, text string")
    assert [(r.base_failed, r.kept) for r in weak_rules.judge(short).collect()] == [(True, False)]


def test_rules_against_labels(spark, sf_dir):
    """No label is read; they agree with the verdicts where the base rules say nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = weak_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("not base_failed").join(labels.where("label is not null"), "doc_id").collect()
    assert sum(r.kept == bool(r.label) for r in found) >= 0.95 * len(found) > 0


def test_rules_are_native(spark, sf_dir):
    plan = weak_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

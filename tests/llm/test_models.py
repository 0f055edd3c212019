"""Classifiers: held-out accuracy, fixed edge cases, and what the counterfactual penalty does."""

import random
import zlib

import numpy as np

from scrivena.llm import quality, toxicity


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            w = [x.upper() + "!!" for x in w]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["grumblex", "snarlop", "vilethor"])
        rows.append((i, " ".join(w), int(not bad), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(d, t, "clash") for d, t, _, _ in rows] + [(9001, None, ""), (9002, "", ""), (None, "x", "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(d, q, x) for d, _, q, x in rows] + [(9001, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def accuracy(got, rows, col, folds, held):
    truth = {d: (q, x)[col] for d, _, q, x in rows}
    out = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    return np.mean([a == b for a, b in out])


def test_quality(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) + 2
    assert accuracy(got, rows, 0, 4, 2) > 0.97


def test_toxicity(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows) + 2
    assert accuracy(got, rows, 1, 3, 1) > 0.97


def test_without_labels(spark):
    docs, labels = frames(spark, corpus(5))
    none = labels.where("false")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.5}
    assert quality.classify(docs.where("false"), labels).count() == 0


def test_labels_outside_the_fold_only(spark):
    """Labels of the held-out fold change no score; labels of the others do."""
    rows = corpus(200)
    docs, labels = frames(spark, rows)
    held = {d for d, *_ in rows if zlib.crc32(str(d).encode()) % 3 == 1}
    turned = lambda which: spark.createDataFrame([(d, q, 1 - x if (d in held) == which else x) for d, _, q, x in rows], "doc_id long, quality int, toxic int")
    scores = lambda y: {r.doc_id: r.score for r in toxicity.classify(docs, y).collect()}
    base = scores(labels)
    assert scores(turned(True)) == base != scores(turned(False))
    found = quality.labelled(quality.documents(docs), labels, "toxic", 3, 1, 1000)
    assert len(found) == len([d for d, *_ in rows if d not in held])


def test_pairs_on_any_table():
    """Texts without identity terms get them, as many in either class; the penalty then changes the model and brings
    mentions of groups closer to each other."""
    rows = [(t.encode(), x) for _, t, _, x in corpus(400)]
    assert not any(toxicity.counterfactuals(t.decode()) for t, _ in rows)
    put = toxicity.planted(rows)
    assert len(put) == 2 * min(sum(y == k for _, y in rows) for k in (0, 1)) and {y for _, y in put} == {0, 1}
    assert all(toxicity.counterfactuals(t.decode()) for t, _ in put)
    plain, fair = toxicity.train(rows, penalty=0.0), toxicity.train(rows, penalty=10.0)
    assert plain.pairs == fair.pairs >= len(put) and plain.weights != fair.weights

    def spread(m):
        return np.mean([np.ptp([m.logit(f"we met the {t} there.") for t in g]) for g in toxicity.IDENTITIES])

    assert spread(fair) < 0.7 * spread(plain)
    neutral = [f"we met the {t} there.".encode() for g in toxicity.IDENTITIES for t in g]
    assert (fair.scores(neutral) < 0.7).all()
    assert toxicity.train([(b"", 0), (b" ", 1)]).pairs == 0 and toxicity.planted([]) == []


def test_counterfactual_penalty():
    """A group that is mostly named in toxic rows: the penalty takes the weight off the group's name."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        toxic = i % 2
        w = [f"w{rng.randint(0, 40)}" for _ in range(8)]
        if toxic and rng.random() < 0.9:
            w.append("muslims")
        elif not toxic:
            w.append(rng.choice(["christians", "jews"]))
        if toxic and rng.random() < 0.8:
            w.append("grumblex")
        rows.append((" ".join(w).encode(), toxic))
    neutral = "muslims w1 w2 w3"
    plain, fair = toxicity.train(rows, penalty=0.0), toxicity.train(rows, penalty=5.0)
    gap = lambda m: abs(m.logit(neutral) - m.logit(neutral.replace("muslims", "christians")))
    assert gap(fair) < 0.25 * gap(plain)
    assert fair.scores([neutral.encode()])[0] < plain.scores([neutral.encode()])[0]
    assert toxicity.counterfactuals("We saw women. Fine.")[0][0].startswith("we saw women")


def test_features_are_those_of_single_words():
    words = [b"a", "é".encode(), b"longer-word"]
    rows, per = quality.features(words, 1 << 16)
    at = np.cumsum(per) - per
    for w, s, n in zip(words, at, per):
        one, m = quality.features([w], 1 << 16)
        assert m[0] == n and sorted(rows[s : s + n]) == sorted(one)


def test_scoring_strips_words_as_training_does():
    weights = {"non-white": 2.0, "f****": 3.0, "gay": 1.0, "a-b": 4.0}
    model = toxicity.Presence(weights, 0.0)
    for w in ("non-white", "(non-white", "(non-white)", "f***ed", "(f***ed!", "gay", "'gay',", "[a-b]", "a-b-", "nongay", "f*"):
        assert model.logit(w) == sum(weights[f] for f in toxicity.terms({w}) if f in weights), w


def test_characters_are_symbols():
    """A letter of two bytes makes as many n-grams as one of one."""
    for a, b in (("a", "é"), ("abc", "äöü"), ("word", "слов"), ("ab", "😀漢")):
        (_, m), (_, n) = quality.features([a.encode()], 1 << 16), quality.features([b.encode()], 1 << 16)
        assert m[0] == n[0]


def test_repeated_rows_train_once(spark):
    rows = corpus(60)
    docs, labels = frames(spark, rows)
    once = quality.labelled(quality.documents(docs), labels, "quality", 4, 2, 1000)
    many = quality.documents(docs.union(docs).union(docs))
    assert quality.labelled(many, labels.union(labels), "quality", 4, 2, 1000) == once
    assert len(quality.labelled(many, labels, "quality", 4, 2, 7)) == 7
    got = toxicity.classify(docs.union(docs), labels).collect()
    assert len(got) == 2 * (len(rows) + 2) and len({(r.doc_id, r.score) for r in got}) == len(rows) + 2

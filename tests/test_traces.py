"""Batched edit traces against the table of one pair, and the confusions that they add up to."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scrivena.functions import traces
from scrivena.operators import recognition
from scrivena.plans.fixtures import table
from scrivena.plans.queries import QUERIES


def one(pred, gt):
    n, m = len(pred), len(gt)
    c = [list(range(m + 1))] + [[i] + [0] * m for i in range(1, n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            c[i][j] = c[i - 1][j - 1] if pred[i - 1] == gt[j - 1] else 1 + min(c[i - 1][j], c[i][j - 1], c[i - 1][j - 1])
    out, i, j = [], n, m
    while i or j:
        if i and j and pred[i - 1] == gt[j - 1]:
            i, j = i - 1, j - 1
        elif i and c[i - 1][j] == c[i][j] - 1:
            out.append(("delete", "", pred[i - 1]))
            i -= 1
        elif j and c[i][j - 1] == c[i][j] - 1:
            out.append(("insert", gt[j - 1], ""))
            j -= 1
        else:
            out.append(("substitute", gt[j - 1], pred[i - 1]))
            i, j = i - 1, j - 1
    return out[::-1]


@pytest.mark.parametrize("cells", [50, 1 << 24])
def test_traces(monkeypatch, cells):
    monkeypatch.setattr(traces, "CELLS", cells)
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abé낮😀") for _ in range(rng.choice([0, 1, 2, 5, 9, 30])))
    a, b = [word() for _ in range(600)] + [None, "x", None, "a" * 700], [word() for _ in range(600)] + ["x", None, None, "b" + "a" * 600]
    got = traces.edit_traces(pa.array(a), pa.array(b)).to_pylist()
    for x, y, ops in zip(a, b, got):
        assert (None if ops is None else [(o["op"], o["gt"], o["pred"]) for o in ops]) == (None if x is None or y is None else one(x, y))
    assert traces.edit_traces(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []


def test_confusions_query(spark, sf_dir):
    rows = recognition.samples(table(spark, sf_dir, "rec_samples")).select("pred_text", "gt_text").collect()
    count = Counter((g, p) for r in rows for op, g, p in one(r.pred_text, r.gt_text) if op == "substitute")
    want = sorted(((-n, g, p) for (g, p), n in count.items()))[:20]
    assert [(-r["count"], r.gt_char, r.pred_char) for r in QUERIES["rec_confusions"](spark, sf_dir).collect()] == want


def test_equal_pairs_count(spark):
    rows = recognition.samples(spark.createDataFrame([("c/1.png", "OFF", "OEF")] * 5 + [("c/1.png", "AL", "AL")], "image_path string, gt_text string, pred_text string"))
    assert [tuple(r) for r in recognition.confusions(rows).select("gt_char", "pred_char", F.col("count")).collect()] == [("F", "E", 5)]

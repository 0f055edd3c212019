import math
import random

import pytest
from pyspark.sql import functions as F

from scrivena.operators import dataset, order_stats, registry


def values(n, seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: rng.choice([-1e300, 1e-300, 0.0, -0.0, 5e-324, 1e308, -1.7e308]), lambda: float(rng.randrange(5)), lambda: rng.lognormvariate(0, 20), lambda: 1.0 + rng.randrange(100) * 2**-52]
    return [kinds[rng.randrange(len(kinds))]() for _ in range(n)]


@pytest.mark.parametrize("bins", [4, 2048])
def test_ranks(spark, monkeypatch, bins):
    """All ranks of a group, against a sort; few bins make many rounds."""
    monkeypatch.setattr(order_stats, "BINS", bins)
    groups = {"a": values(300, 1), "b": [3.0], None: values(20, 2), "c": [7.0] * 50, "d": [math.inf, -math.inf, math.nan, 1.0]}
    rows = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("e", None)], "g string, v double").repartition(5)
    step = 37 if bins == 4 else 7
    wanted = spark.createDataFrame([(k, r, r * 2) for k, vs in groups.items() for r in [*range(0, len(vs), step), len(vs) - 1, len(vs), -1]], "g string, rank long, tag long")
    got = {(r.g, r.rank): (r.tag, r.value, r.below) for r in order_stats.at_ranks(rows, ["g"], "v", wanted).collect()}
    big = lambda v: math.inf if v != v else v
    want = {}
    for k, vs in groups.items():
        s = sorted(map(big, vs))
        want |= {(k, r): (r * 2, s[r], sum(x < s[r] for x in s)) for r in {*range(0, len(vs), step), len(vs) - 1}}
    assert got == want


def test_one_group_of_all_rows(spark):
    rows = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    r = registry.latency(rows, "v").first()
    s = sorted((i * 7919) % 200_003 for i in range(200_000))
    assert (r.p50, r.p95, r.p99, r.n, r.max) == (s[99999], s[int(199_999 * 0.95)], s[int(199_999 * 0.99)], 200_000, s[-1])
    plan = registry.latency(rows, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert registry.latency(rows.where("false"), "v").first().n == 0


def test_first_k(spark):
    rows = spark.createDataFrame([(g, float(v), i) for i, (g, v) in enumerate([("a", 1), ("a", 2), ("a", 2), ("a", 2), ("a", 3), ("b", 5), (None, 1), (None, 0)])], "g string, v double, i int")
    sizes = spark.createDataFrame([("a", 3), ("b", 9), (None, 1), ("none", 2)], "g string, k long")
    got = order_stats.first_k(rows, ["g"], "v", sizes, ["i"])
    assert sorted(r.i for r in got.where("first").collect()) == [0, 1, 2, 5, 7]
    assert got.count() == 8
    assert order_stats.first_k(rows, ["g"], "v", sizes.withColumn("k", F.lit(0)), ["i"]).where("first").count() == 0


def test_split_of_one_stratum(spark):
    images = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("paper").alias("format"), F.when(F.col("id") % 10 == 0, "synthetic").otherwise("masked").alias("source"), (F.col("id") % 7 == 0).alias("difficult"))
    out = dataset.stratified_split(images)
    n = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert n == {"test": 135, "val": 135, "train": 730}
    assert out.where("split = 'test' and (difficult or source = 'synthetic')").count() == 0
    assert {r.doc_id for r in out.where("split = 'val'").collect()} == {r.doc_id for r in dataset.stratified_split(images.repartition(7)).where("split = 'val'").collect()}

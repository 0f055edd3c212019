import pytest
from pyspark.sql import functions as F

from scrivena.operators import samples


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000, 4097])
def test_permutation(spark, n):
    """Each number once, the inverse undoes it, and a slice alone is that part of the whole."""
    o = samples.order_of(n, 7, 1)
    whole = {r.position: r.idx for r in samples.slice_of(spark, o, 0, n + 5).collect()}
    assert sorted(whole) == sorted(whole.values()) == list(range(n))
    back = spark.range(n).select("id", samples.position_of(F.col("id"), o).alias("p")).collect()
    assert all(whole[r.p] == r.id for r in back)
    assert {r.position: r.idx for r in samples.slice_of(spark, o, n // 3, n // 2).collect()} == {p: whole[p] for p in range(n // 3, n // 2)}


def test_orders_differ(spark):
    take = lambda **k: [r.idx for r in samples.slice_of(spark, samples.order_of(1000, **k), 0, 1000).orderBy("position").collect()]
    a, b, c = take(seed=1), take(seed=1, epoch=1), take(seed=2)
    assert a == take(seed=1) and sum(x == y for x, y in zip(a, b)) < 20 and sum(x == y for x, y in zip(a, c)) < 20
    # No trend: neighbours lie as far apart as in a random order, about a third of the range.
    assert 280 < sum(abs(x - y) for x, y in zip(a, a[1:])) / 999 < 390


def test_epoch_shuffles_nothing(spark):
    rows = spark.range(500).withColumnRenamed("id", "idx")
    e = samples.epoch(rows, samples.order_of(500), shards=3, batch=10)
    assert "Exchange" not in e._jdf.queryExecution().executedPlan().toString()
    sizes = e.groupBy("shard", "batch").count().collect()
    assert {r["count"] for r in sizes if r.batch < 16} == {10} and sum(r["count"] for r in sizes) == 500
    far = samples.order_of(10**12, 3)
    got = samples.slice_of(spark, far, 10**11, 10**11 + 50).collect()
    assert len({r.idx for r in got}) == 50 and all(0 <= r.idx < 10**12 for r in got)
    assert samples.slice_of(spark, samples.order_of(0), 0, 5).count() == 0


def test_index_and_take(spark):
    rows = samples.indexed(spark.createDataFrame([(k * 7 % 101, str(k)) for k in range(101)], "k long, v string"), "k")
    assert sorted((r.k, r.idx) for r in rows.collect()) == [(k, k) for k in range(101)]
    o = samples.order_of(101)
    got = samples.taken(rows, samples.slice_of(spark, o, 10, 20))
    assert got.count() == 10 and got.where("position < 10 or position >= 20").count() == 0

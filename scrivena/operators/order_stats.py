"""Exact order statistics inside groups, by histograms that are refined, not by a sort of the group.

For each group and rank a bracket of values is held that must contain the value at that rank, with the number of values
below it. A round bins what lies in the brackets, by partial sums, and narrows each bracket to one bin's least and greatest
value. A bracket of one value is done. Rounds bin evenly and by magnitude in turn, so that a few rounds do for values of any
scale. A group that holds all rows is spread over all tasks in every round; what is shuffled is BINS rows a bracket and task
at most.

NaN counts as infinite, and nulls are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.sources.shared import folder

BINS = 2048
_MOST = 1.7976931348623157e308


def _finite(v: Column) -> Column:
    return F.when(F.isnan(v), _MOST).otherwise(F.least(F.greatest(v, F.lit(-_MOST)), F.lit(_MOST)))


def _same(left: str, right: str, by: list[str]) -> Column:
    """Equal groups; nulls are a group too."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in by), F.lit(True))


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _bin(v: Column, low: Column, high: Column, even: bool) -> Column:
    """From 0 to BINS - 1, never falling as v grows; evenly, or by magnitude."""
    size = (lambda x: x / 2) if even else (lambda x: F.signum(x) * F.log1p(F.abs(x)))
    share = F.coalesce(F.try_divide(size(v) - size(low), size(high) - size(low)), F.lit(0.0))
    return F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")


def at_ranks(rows: DataFrame, by: list[str], value: str, wanted: DataFrame) -> DataFrame:
    """wanted (by, rank from 0, other columns) with value, the one at that rank of its group, and below, how many of the
    group's values are smaller. Ranks outside a group have no row."""
    rows = rows.where(F.col(value).isNotNull()).select(*by, _finite(F.col(value).cast("double")).alias("_v"))
    whole = rows.groupBy(*by).agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("n"))
    asked = wanted.select(*by, F.col("rank").cast("long").alias("rank")).distinct()
    open_ = asked.alias("a").join(whole.alias("w"), _same("a", "w", by)).where("rank >= 0 and rank < n").select(*(F.col(f"a.{c}") for c in by), "rank", "low", "high", F.lit(0).cast("long").alias("below"))
    done, even = None, True
    open_ = _written(open_, "brackets")
    while True:
        found = open_.where("low = high")
        done = found if done is None else done.unionByName(found)
        rest = open_.where("low < high")
        if rest.isEmpty():
            break
        inside = rows.alias("r").join(rest.alias("b"), _same("r", "b", by) & F.col("_v").between(F.col("low"), F.col("high")))
        bins = inside.groupBy(*(F.col(f"b.{c}").alias(c) for c in by), "rank", "below", _bin(F.col("_v"), F.col("low"), F.col("high"), even).alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        before = Window.partitionBy(*by, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS rows at most
        bins = bins.withColumn("below", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        open_ = _written(bins.where("below <= rank and rank < below + n").select(*by, "rank", "low", "high", "below"), "brackets")
        even = not even
    done = done.select(*by, "rank", F.when(F.col("low") >= _MOST, float("inf")).when(F.col("low") <= -_MOST, float("-inf")).otherwise(F.col("low")).alias("value"), "below")
    more = [c for c in wanted.columns if c not in (*by, "rank")]
    return wanted.alias("w").join(done.alias("d"), _same("w", "d", by) & (F.col("w.rank") == F.col("d.rank"))).select(*(F.col(f"w.{c}") for c in (*by, "rank", *more)), "d.value", "d.below")


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """by, and for each name the value at int((n - 1) * share) of the sorted group."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"))
    marks = F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.floor((F.col("n") - 1) * p).alias("rank")) for k, p in shares.items())))
    found = at_ranks(rows, by, value, n.where("n > 0").select(*by, marks.alias("m")).select(*by, "m.rank", "m.name"))
    return found.groupBy(*by).agg(*(F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for k in shares))


def first_k(rows: DataFrame, by: list[str], value: str, sizes: DataFrame, order: list[str]) -> DataFrame:
    """rows with `first`: whether a row is among the first k of its group by value, ties by `order`. sizes: by, k. Only rows
    whose value is just the one at rank k are sorted."""
    n = rows.groupBy(*by).agg(F.count(value).alias("_n"))
    asked = sizes.alias("s").join(n.alias("n"), _same("s", "n", by)).select(*(F.col(f"s.{c}") for c in by), "k", (F.least(F.col("k"), F.col("_n")) - 1).alias("rank"))
    found = at_ranks(rows, by, value, asked.where("rank >= 0"))
    last = found.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(by)), F.col("value").alias("_last"), (F.col("k") - F.col("below")).alias("_room"))
    met = rows.join(last, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(by)), F.lit(True)), "left")
    tie = F.coalesce(F.col(value) == F.col("_last"), F.lit(False))
    clear = met.where(~tie).withColumn("first", F.coalesce(F.col(value) < F.col("_last"), F.lit(False)))
    ties = met.where(tie).withColumn("first", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) <= F.col("_room"))
    return clear.unionByName(ties).drop("_last", "_room", *(f"_{i}" for i in range(len(by))))

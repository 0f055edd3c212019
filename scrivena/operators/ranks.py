"""Global ranks without a global sort in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256


def range_of(column: Column, cuts: list) -> Column:
    """How many of the sorted cuts lie below the value: a look at every k-th cut, then at those between two of them.

    Literal arrays keep the generated code small, however many cuts there are.
    """
    if not cuts:
        return F.lit(0)
    k = math.isqrt(len(cuts))
    groups = [cuts[i : i + k] for i in range(0, len(cuts), k)]
    below = lambda values: F.size(F.filter(values, lambda c: c < column))
    full = below(F.lit([x[-1] for x in groups]))
    rest = F.when(full < len(groups), below(F.get(F.lit([x + [x[-1]] * (k - len(x)) for x in groups]), full))).otherwise(0)
    return full * k + rest


def cuts_of(rows: DataFrame, order: str, ranges: int = RANGES) -> list:
    found = rows.select(F.percentile_approx(F.col(order).cast("double"), [i / ranges for i in range(1, ranges)], 10000)).first()[0] or []
    return sorted(set(found))


def ranked(rows: DataFrame, order: str, ranges: int = RANGES) -> DataFrame:
    """rows with rank (from 1) by a numeric column: ranges of about equal size are ranked by themselves, after the counts
    of those before."""
    cut = rows.withColumn("_r", range_of(F.col(order).cast("double"), cuts_of(rows, order, ranges)))
    counts = cut.groupBy("_r").agg(F.count("*").alias("_c"))  # `ranges` rows at most
    before = Window.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_r", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_b"))
    own = F.row_number().over(Window.partitionBy("_r").orderBy(order))
    return cut.join(F.broadcast(counts), "_r").withColumn("rank", F.col("_b") + own).drop("_r", "_b")

"""Boxes as rasters: where a training target is on, in runs of cells, by difference counts and running sums.

Each row of cells that a box covers gets a rise where the box begins and a fall where it ends. The running sum of rises and
falls along a row is how many boxes lie over a cell; where it leaves and reaches zero, runs begin and end. Rows of cells are
summed apart from each other, so that a large plan is no heavier than its rows, and only rises and falls are shuffled.

How much is covered needs no runs: an image's boxes meet as one row, and between neighbouring edges in height all rows of
cells are alike, so that one pass over the boxes from left to right measures them. Only boxes are shuffled, and the work is
boxes times distinct edges, of which there are no more than rows of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cells(boxes: DataFrame, key: str, scale: int) -> DataFrame:
    """key, a, b, c, d: the cells [a, b) x [c, d) of each box that has some."""
    cell = lambda v: F.greatest(F.lit(0), F.floor(F.col(v) / scale)).cast("long")
    last = lambda side: F.greatest(F.lit(1), F.floor(F.col(side) / scale)) - 1
    return boxes.select(key, cell("x1").alias("a"), F.least(last("w"), cell("x2")).alias("b"), cell("y1").alias("c"), F.least(last("h"), cell("y2")).alias("d")).where("b > a and d > c")


def runs(boxes: DataFrame, key: str = "image_id", scale: int = 4) -> DataFrame:
    """key, row, start, end (exclusive): the cells that boxes cover at 1/scale of the size. boxes: key, w, h (of the image,
    long), x1, y1, x2, y2 (long). Boxes end at the last cell but one, as far as it is theirs; those without a cell count
    for nothing."""
    b = _cells(boxes, key, scale)
    rows = b.select(key, "a", "b", F.explode(F.sequence(F.col("c"), F.col("d") - 1)).alias("row"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("by")), F.struct(F.col("b").alias("x"), F.lit(-1).alias("by")))).alias("e")
    steps = rows.select(key, "row", ends).groupBy(key, "row", F.col("e.x").alias("x")).agg(F.sum("e.by").alias("by"))
    w = Window.partitionBy(key, "row").orderBy("x")
    depth = F.sum("by").over(w.rowsBetween(Window.unboundedPreceding, 0))
    at = steps.withColumn("over", depth).withColumn("under", F.coalesce(F.lag("over").over(w), F.lit(0)))
    # Between two edges that count, the row is on from the first to the second.
    edges = at.where("(over = 0) <> (under = 0)").withColumn("end", F.lead("x").over(w))
    return edges.where("under = 0").select(key, "row", F.col("x").alias("start"), "end")


def _area(boxes: Column) -> Column:
    """Cells that boxes (structs a, b, c, d, in order) cover together."""
    edges = F.array_sort(F.array_distinct(F.concat(F.transform(boxes, lambda x: x["c"]), F.transform(boxes, lambda x: x["d"]))))
    none = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(s: Column, x: Column) -> Column:
        end = F.greatest(s["end"], x["b"])
        return F.struct(end.alias("end"), (s["n"] + end - F.greatest(s["end"], F.least(x["a"], end))).alias("n"))

    def high(top: Column, end: Column) -> Column:
        at = F.filter(boxes, lambda x: (x["c"] <= top) & (x["d"] > top))
        return F.aggregate(at, none, step, lambda s: s["n"] * (end - top))

    both = lambda e: F.zip_with(F.slice(e, 1, F.size(e) - 1), F.slice(e, 2, F.size(e) - 1), high)
    # The edges are computed once an image.
    return F.aggregate(F.transform(F.array(edges), both)[0], F.lit(0).cast("long"), lambda n, k: n + k)


def covered(boxes: DataFrame, key: str = "image_id", scale: int = 4) -> DataFrame:
    """key, cells: how many cells of each image boxes cover; images without a covered cell have no row. boxes as for runs;
    an image's boxes have to fit into a row."""
    per = _cells(boxes, key, scale).repartition(key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("a", "b", "c", "d"))).alias("boxes"))
    return per.select(key, _area(F.col("boxes")).alias("cells"))

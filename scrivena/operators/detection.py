"""Detection evaluation: one-to-one matching of boxes, and the figures that follow from it.

Predictions and ground truth become one row an image, with an array of boxes on either side. Candidates, the greedy
matching, counts and errors are expressions over those arrays, so that whatever is asked, images meet in one join. An
image's boxes have to fit into a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivena.functions import geometry as g
from scrivena.functions.scalars import safe_div

_BOX = ("x1", "y1", "x2", "y2")
_MATCH = "struct<iou: double, pi: int, gi: int, hard: boolean>"
DONE = f"struct<p: array<int>, g: array<int>, m: array<{_MATCH}>>"


def _side(boxes: DataFrame, key: str, name: str, *more: Column) -> DataFrame:
    """key and an array of boxes: idx, x1..y2 (corners in order), area, and more; as given in `raw`."""
    low, high = (lambda a, b: F.least(a, b).cast("double")), (lambda a, b: F.greatest(a, b).cast("double"))
    rows = boxes.select(key, F.col("idx").cast("int").alias("idx"), F.struct(*_BOX).alias("raw"), low("x1", "x2").alias("x1"), low("y1", "y2").alias("y1"), high("x1", "x2").alias("x2"), high("y1", "y2").alias("y2"), *more)
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    names = [c for c in rows.columns if c != key]
    return rows.withColumn("area", area).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*names, "area"))).alias(name))


def _shared(a: Column, b: Column) -> Column:
    """The area that two boxes share."""
    side = lambda u, v: F.greatest(F.lit(0.0), F.least(a[v], b[v]) - F.greatest(a[u], b[u]))
    return side("x1", "x2") * side("y1", "y2")


def _iou(shared: Column, a: Column, b: Column) -> Column:
    return F.when(shared <= 0, 0.0).otherwise(safe_div(shared, a["area"] + b["area"] - shared))


def greedy(cand: Column) -> Column:
    """Matches out of an array of (iou, pi, gi, hard): by falling IoU, then prediction, then truth; each box once."""
    order = F.sort_array(F.transform(cand, lambda c: F.struct((-c["iou"]).alias("n"), c["pi"].alias("pi"), c["gi"].alias("gi"), c["hard"].alias("hard"))))
    none = F.array().cast("array<int>")
    start = F.struct(none.alias("p"), none.alias("g"), F.array().cast(f"array<{_MATCH}>").alias("m"))

    def step(a: Column, c: Column) -> Column:
        free = ~F.array_contains(a["p"], c["pi"]) & ~F.array_contains(a["g"], c["gi"])
        found = F.struct((-c["n"]).alias("iou"), c["pi"].alias("pi"), c["gi"].alias("gi"), c["hard"].alias("hard"))
        return F.when(free, F.struct(F.array_append(a["p"], c["pi"]).alias("p"), F.array_append(a["g"], c["gi"]).alias("g"), F.array_append(a["m"], found).alias("m"))).otherwise(a)

    return F.aggregate(order, start.cast(DONE), lambda a, c: step(a, c).cast(DONE), lambda a: a["m"])


def paired(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """One row an image: key, ps and ts (its boxes), m (its matches). Images of one side only have an empty other side."""
    hard = F.coalesce(F.col("difficult"), F.lit(False)).alias("hard") if "difficult" in gt.columns else F.lit(False).alias("hard")
    both = _side(gt, key, "ts", hard).join(_side(pred, key, "ps"), key, "full")
    kinds = dict(both.dtypes)
    both = both.select(key, *(F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in ("ps", "ts")))
    near = lambda p: F.filter(F.transform("ts", lambda t: F.struct(_iou(_shared(p, t), p, t).alias("iou"), p["idx"].alias("pi"), t["idx"].alias("gi"), t["hard"].alias("hard"))), lambda c: c["iou"] >= threshold)
    return both.withColumn("m", greedy(F.flatten(F.transform("ps", near))))


def matches(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """One row a match: key, pi, gi, iou."""
    return paired(pred, gt, threshold, key).select(key, F.explode_outer("m").alias("m")).where("m is not null").select(key, "m.pi", "m.gi", "m.iou")


def image_counts(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, ignore_difficult: bool = True, key: str = "image_id") -> DataFrame:
    """tp, fp, fn and the boxes of each image. A match with a difficult box counts; a difficult box without one doesn't."""
    rows = paired(pred, gt, threshold, key)
    n = lambda c: F.size(c).cast("long")
    hard = lambda c: n(F.filter(c, lambda x: x["hard"])) if ignore_difficult else F.lit(0).cast("long")
    out = rows.select(key, n("m").alias("tp"), hard("m").alias("hard_tp"), n("ps").alias("n_pred"), n("ts").alias("n_gt"), hard("ts").alias("n_hard"))
    return out.select(key, "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp") - F.col("n_hard") + F.col("hard_tp")).alias("fn"), (F.col("n_gt") - F.col("n_hard")).alias("num_gt"), "n_pred")


def figures(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1."""
    p, r = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), safe_div(2 * p * r, p + r).alias("f1")]


def summed(counts: DataFrame, *keys: str) -> DataFrame:
    """Figures over all images of each group, or over all."""
    out = counts.groupBy(*keys).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")), F.count("*").alias("sample_count"))
    return out.select(*keys, "tp", "fp", "fn", (F.col("tp") + F.col("fp")).alias("num_pred"), (F.col("tp") + F.col("fn")).alias("num_gt"), *figures(F.col("tp"), F.col("fp"), F.col("fn")), "sample_count")


def evaluate(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """One row of figures over all images."""
    return summed(image_counts(pred, gt, threshold, key=key))


def per_image(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """Figures of each image; num_gt counts the boxes that are not difficult."""
    c = image_counts(pred, gt, threshold, key=key)
    return c.select(key, "tp", "fp", "fn", "num_gt", F.col("n_pred").alias("num_pred"), *figures(F.col("tp"), F.col("fp"), F.col("fn")))


def breakdown(pred: DataFrame, gt: DataFrame, meta: DataFrame, by: str, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """Figures by an attribute of the images."""
    return summed(image_counts(pred, gt, threshold, key=key).join(meta.select(key, by), key, "left"), by)


def breakdowns(pred: DataFrame, gt: DataFrame, meta: DataFrame, by: list[str], threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """Figures by each attribute of the images, and over all: attribute ('all' for the latter), value and the figures. The
    boxes are matched once; the attributes are grouping sets over the images' counts."""
    counts = image_counts(pred, gt, threshold, key=key).join(meta.select(key, *by), key, "left")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]
    rows = counts.groupingSets([[F.col(c)] for c in by] + [[]], *(F.col(c) for c in by)).agg(*sums, F.count("*").alias("sample_count"), F.grouping_id().alias("set"))
    # The bits of the set are off for the attribute that it groups by.
    bit = lambda i: F.col("set").bitwiseAND(1 << (len(by) - 1 - i)) == 0
    pick = lambda f, rest: reduce(lambda other, i: F.when(bit(i), f(by[i])).otherwise(other), range(len(by)), rest)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return rows.select(pick(F.lit, F.lit("all")).alias("attribute"), pick(lambda c: F.col(c).cast("string"), F.lit(None)).alias("value"), "tp", "fp", "fn", (tp + fp).alias("num_pred"), (tp + fn).alias("num_gt"), *figures(tp, fp, fn), "sample_count")


def errors(pred: DataFrame, gt: DataFrame, threshold: float = 0.5, least_side: int = 3, key: str = "image_id") -> DataFrame:
    """What false positives and misses (of boxes that are not difficult) look like: kind ('fp' or 'fn'), label, count."""
    rows = paired(pred, gt, threshold, key)
    out_of = lambda of, which: F.filter(of, lambda b: ~F.exists("m", lambda m: m[which] == b["idx"]))
    hit = F.filter("ts", lambda t: F.exists("m", lambda m: m["gi"] == t["idx"]))
    rows = rows.select("ts", out_of("ps", "pi").alias("fp"), F.filter(out_of("ts", "gi"), lambda t: ~t["hard"]).alias("fn"), hit.alias("hit"))

    def false(p: Column) -> Column:
        twice = F.exists("hit", lambda h: _iou(_shared(p, h), p, h) > 0.3)
        return F.when(g.extreme_ratio(p), "grid_line_false_positive").when(twice, "duplicate_detection").when(p["area"] < least_side * least_side * 2, "small_noise").otherwise("other_false_positive")

    def missed(t: Column) -> Column:
        near = lambda o, u, v: F.abs((o["raw"][u] + o["raw"][v]) / 2.0 - (t["raw"][u] + t["raw"][v]) / 2.0) < 5
        return F.exists("ts", lambda o: (o["raw"] != t["raw"]) & (near(o, "x1", "x2") | near(o, "y1", "y2")))

    one = lambda kind, label, area: F.struct(F.lit(kind).alias("kind"), label.alias("label"), area.alias("area"))
    dense = lambda t: F.when(missed(t), "dense_region_miss").otherwise("blur_or_hard_text_miss")
    found = F.concat(F.transform("fp", lambda p: one("fp", false(p), F.lit(None).cast("double"))), F.transform("fn", lambda t: one("fn", dense(t), t["area"])))
    found = rows.select(F.explode_outer(found).alias("e")).where("e is not null").select("e.*")
    low, high = (lambda a, b: F.least(a, b)), (lambda a, b: F.greatest(a, b))
    mean = gt.agg(F.avg(((high("x1", "x2") - low("x1", "x2")) * (high("y1", "y2") - low("y1", "y2"))).cast("double")).alias("mean"))  # one row
    label = F.when(F.col("area") < 0.3 * F.col("mean"), "small_cell_miss").otherwise(F.col("label"))
    return found.join(F.broadcast(mean)).groupBy("kind", label.alias("label")).agg(F.count("*").alias("count"))


def lowest(pred: DataFrame, gt: DataFrame, k: int = 5, threshold: float = 0.5, key: str = "image_id") -> DataFrame:
    """The k images with the lowest F1; ties by key."""
    return per_image(pred, gt, threshold, key).select(key, "f1").orderBy("f1", key).limit(k)


def filter_boxes(boxes: DataFrame, least_score: float = 0.6, least_side: int = 3, most: int = 1000, key: str = "image_id") -> DataFrame:
    """The first `most` boxes of an image, in input order, that score and measure enough."""
    from pyspark.sql import Window

    ok = boxes.where((F.col("score") >= least_score) & (F.least(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) >= least_side))
    return ok.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy("idx"))).where(F.col("rn") <= most).drop("rn")


def mean_iou(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Mean IoU of box pairs (0 without any), and whether annotators agree well enough."""
    m = F.coalesce(F.avg(g.iou_raw(F.col(a), F.col(b))), F.lit(0.0))
    return pairs.agg(m.alias("mean_iou")).withColumn("passed", F.col("mean_iou") >= 0.85)

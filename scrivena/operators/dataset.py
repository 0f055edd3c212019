"""Data sets: image quality, duplicates, statistics, stratified splits, leakage and quotas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.functions import text as t
from scrivena.functions.scalars import safe_div
from scrivena.operators.ranks import cuts_of, range_of

#: Samples per format and industry that a collection asks for.
FORMAT_TARGETS = {"paper": 200, "scan": 100, "screen": 150, "excel": 100, "handwrite": 50}
INDUSTRY_MINIMUMS = {"hospital": 50, "convenience": 50, "factory": 50, "office": 50, "food": 50}
#: Images and crops that each split must have.
SPLIT_MINIMUMS = {"train": (700, 5000), "val": (100, 700), "test": (100, 700)}


def file_size_kb(size: Column) -> Column:
    return F.bround(size / 1024.0, 2)


def quality_reasons(width: Column, height: Column, text_area: Column, tilt: Column, legibility: Column, size: Column, blur: Column | None = None, masked: Column | None = None, other: Column | None = None, duplicate: Column | None = None) -> Column:
    """Why an image fails, in a fixed order; an empty array for one that passes."""
    no = F.lit(False)
    rules = (
        (F.least(width, height) < 720, "resolution_below_720px"),
        (text_area < 0.2, "text_area_below_20_percent"),
        (blur if blur is not None else no, "motion_blur_or_focus_failure"),
        ((masked > 0.5) if masked is not None else no, "masking_covers_over_50_percent_of_text"),
        (other if other is not None else no, "non_schedule_image"),
        (duplicate if duplicate is not None else no, "duplicate_image_hash"),
        (F.abs(tilt) > 30, "tilt_exceeds_30_degrees"),
        (legibility < 0.8, "legibility_below_80_percent"),
        (file_size_kb(size) < 100, "file_size_below_100kb"),
        (size > 20 * 1024 * 1024, "file_size_above_20mb"),
    )
    return F.array_compact(F.array(*(F.when(rule, F.lit(name)) for rule, name in rules)))


def resolution(width: Column, height: Column) -> Column:
    return F.concat(width.cast("string"), F.lit("x"), height.cast("string"))


def duplicates(files: DataFrame, digest: str = "file_md5", order: str = "doc_id") -> DataFrame:
    """Files whose content came before: order, digest, first (the one that came first). Firsts come from partial minima,
    so a content that very many files share doesn't meet in one task before the join, which Spark can split."""
    first = files.groupBy(digest).agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    return files.select(order, digest).join(first, digest).where(F.col(order) != F.col("first")).select(order, digest, "first")


def automatic_checks(images: DataFrame, digest: str = "file_md5", order: str = "doc_id") -> DataFrame:
    """filename, issue_code, details: duplicates, small images, images without boxes; and one row if too many are
    synthetic."""
    first = images.groupBy(digest).agg(F.min(F.struct(order, "filename")).alias("f"))
    rows = images.join(first, digest)
    issue = lambda c, d: F.struct(F.lit(c).alias("issue_code"), d.alias("details"))
    short = F.least("width", "height")
    found = F.array_compact(F.array(
        F.when(F.col(f"f.{order}") != F.col(order), issue("duplicate_image", F.concat(F.lit("same_as="), F.col("f.filename")))),
        F.when(short < 720, issue("resolution_below_720px", short.cast("string"))),
        F.when(F.col("detection_boxes") == 0, issue("empty_detection_label", F.lit("no detection boxes"))),
    ))
    per = rows.select("filename", F.explode(found).alias("i")).select("filename", "i.*")
    ratio = images.agg(safe_div(F.count_if(F.col("source") == "synthetic"), F.count("*")).alias("r")).where("r > 0.5")
    return per.unionByName(ratio.select(F.lit("dataset").alias("filename"), F.lit("synthetic_ratio_exceeds_50_percent").alias("issue_code"), F.format_string("%.3f", "r").alias("details")))


def statistics(images: DataFrame) -> DataFrame:
    """One row of counts and ratios."""
    n = F.count("*")
    synthetic = F.count_if(F.col("source") == "synthetic")
    boxes = F.coalesce(F.sum("detection_boxes"), F.lit(0))
    return images.agg(n.alias("total"), synthetic.alias("synthetic"), (n - synthetic).alias("real"), safe_div(synthetic, n).alias("synthetic_ratio"), F.count_if(F.col("difficult")).alias("difficult"), boxes.alias("detection_boxes"), safe_div(boxes, n).alias("mean_boxes"))


def distribution(rows: DataFrame, column: str, keys: tuple[str, ...]) -> DataFrame:
    """key, count, ratio for each of the fixed keys, zero-filled; other values count in the denominator only."""
    counts = rows.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total"))  # one row
    fixed = rows.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    out = fixed.join(counts, "key", "left").join(F.broadcast(total))
    return out.select("key", F.coalesce("count", F.lit(0)).alias("count"), safe_div(F.coalesce("count", F.lit(0)), F.coalesce("total", F.lit(0))).alias("ratio"))


def stratified_split(images: DataFrame, strata: tuple[str, ...] = ("format",), seed: int = 42, key: str = "doc_id", test: float = 0.15, val: float = 0.15) -> DataFrame:
    """images with split: of each stratum's real images, int(test * n) that aren't difficult are tested, int(val * n) of
    the others validate; all others and all synthetic ones train. Ranks by a hash of seed and key replace a shuffle, so
    that any run gives the same split."""
    # Hashes are uniform, so that a histogram of their first digits tells for each stratum in which bin its tests and its
    # validation end. Only the rows of those two bins are sorted, by the whole hash and the key.
    rows = images.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).withColumn("_bin", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    rows = rows.withColumn("_real", F.coalesce(F.col("source") != "synthetic", F.lit(False)))
    rows = rows.withColumn("_easy", F.col("_real") & ~F.coalesce("difficult", F.lit(True)))
    bins = rows.where("_real").groupBy(*strata, "_bin").agg(F.count("*").alias("n"), F.count_if("_easy").alias("easy"))
    all_, upto = Window.partitionBy(*strata), Window.partitionBy(*strata).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)

    def end(counts: DataFrame, of: str, size: str, name: str) -> DataFrame:
        """counts with the bin where `size` of the column's rows are reached, and how many of that bin belong to them."""
        met = counts.withColumn("_sum", F.sum(of).over(upto))
        at = (F.col("_sum") >= F.col(size)) & (F.col("_sum") - F.col(of) < F.col(size))
        first = F.min(F.when(at, F.struct("_bin", (F.col(size) - F.col("_sum") + F.col(of)).alias("room")))).over(all_)
        beyond = F.when(F.col(size) <= 0, -1).otherwise(1 << 16)
        return met.withColumns({name: F.coalesce(first["_bin"], beyond), f"{name}_room": F.coalesce(first["room"], F.lit(0))}).drop("_sum")

    total = F.sum("n").over(all_)
    bins = end(bins.withColumns({"_test": F.floor(total * test), "_val": F.floor(total * val)}), "easy", "_test", "_bt")
    left = F.col("n") - F.when(F.col("_bin") < F.col("_bt"), F.col("easy")).when(F.col("_bin") == F.col("_bt"), F.col("_bt_room")).otherwise(0)
    ends = end(bins.withColumn("_left", left), "_left", "_val", "_bv").groupBy(*strata).agg(*(F.first(c).alias(c) for c in ("_bt", "_bt_room", "_bv", "_bv_room")))
    ends = ends.withColumnsRenamed({c: f"_s{i}" for i, c in enumerate(strata)})
    rows = rows.join(ends, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(strata)), F.lit(True)), "left")
    decided = (F.col("_bin") == F.col("_bt")) | (F.col("_bin") == F.col("_bv"))
    rank = lambda flag: F.row_number().over(Window.partitionBy(*strata, "_bin", flag).orderBy("_h", key))

    def ended(part: DataFrame, sort: bool) -> DataFrame:
        inside = lambda name, flag: (F.col("_bin") < F.col(name)) | ((F.col("_bin") == F.col(name)) & (rank(flag) <= F.col(f"{name}_room"))) if sort else F.col("_bin") < F.col(name)
        part = part.withColumn("_t", F.coalesce(F.col("_easy") & inside("_bt", "_easy"), F.lit(False)))
        part = part.withColumn("_pool", F.col("_real") & ~F.col("_t"))
        return part.withColumn("split", F.when(F.col("_t"), "test").when(F.col("_pool") & inside("_bv", "_pool"), "val").otherwise("train"))

    edge = F.coalesce(decided & F.col("_real"), F.lit(False))
    out = ended(rows.where(~edge), False).unionByName(ended(rows.where(edge), True))
    return out.select(*images.columns, "split")


def positional_split(items: DataFrame, order: str, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """items with split, by position: int(n * train) first ones train, the next int(n * val) validate, the rest tests.

    Positions come from counts of ranges of the order column, not from one sort of all rows in a task.
    """
    rows = items.withColumn("_r", range_of(F.col(order).cast("double"), cuts_of(items, order)))
    counts = rows.groupBy("_r").agg(F.count("*").alias("_c"))  # as many rows as there are ranges, at most
    before = Window.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_r", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_b"), F.sum("_c").over(Window.partitionBy(F.lit(0))).alias("_n"))
    rows = rows.join(F.broadcast(counts), "_r")
    at = F.col("_b") + F.row_number().over(Window.partitionBy("_r").orderBy(order)) - 1
    a, b = F.floor(F.col("_n") * train), F.floor(F.col("_n") * val)
    return rows.withColumn("_at", at).withColumn("split", F.when(F.col("_at") < a, "train").when(F.col("_at") < a + b, "val").otherwise("test")).drop("_r", "_b", "_n", "_at")


def split_issues(images: DataFrame) -> DataFrame:
    """issue, count: names that two splits share, synthetic or difficult images outside training, splits that are too
    small. Only issues with a count."""
    names = images.groupBy("filename").agg(F.collect_set("split").alias("s"))  # three splits at most
    pairs = [("test", "train"), ("test", "val"), ("train", "val")]
    both = names.select(F.explode(F.array_compact(F.array(*(F.when(F.array_contains("s", a) & F.array_contains("s", b), F.lit(f"filename_overlap_{a}_{b}")) for a, b in pairs)))).alias("issue"))
    held = images.where("split != 'train'")
    leaks = held.select(F.explode(F.array_compact(F.array(
        F.when(F.col("source") == "synthetic", F.concat(F.lit("synthetic_found_in_"), F.col("split"))),
        F.when(F.col("difficult") & (F.col("split") == "test"), F.lit("difficult_found_in_test")),
    ))).alias("issue"))
    issues = both.unionByName(leaks).groupBy("issue").agg(F.count("*").alias("count"))
    least = images.sparkSession.createDataFrame([(k, *v) for k, v in SPLIT_MINIMUMS.items()], "split string, images long, boxes long")
    got = images.groupBy("split").agg(F.count("*").alias("n"), F.sum("detection_boxes").alias("b"))
    sizes = least.join(got, "split", "left").select("split", "images", "boxes", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("b", F.lit(0)).alias("b"))
    few = F.array_compact(F.array(
        F.when(F.col("n") < F.col("images"), F.struct(F.concat("split", F.lit("_image_count_below_minimum")).alias("issue"), F.col("n").alias("count"))),
        F.when(F.col("b") < F.col("boxes"), F.struct(F.concat("split", F.lit("_det_boxes_below_minimum")).alias("issue"), F.col("b").alias("count"))),
    ))
    return issues.unionByName(sizes.select(F.explode(few).alias("x")).select("x.*"))


def quota_gaps(rows: DataFrame, column: str, quotas: dict[str, int]) -> DataFrame:
    """key, required, actual, missing: quotas that aren't met."""
    q = rows.sparkSession.createDataFrame(list(quotas.items()), "key string, required long")
    out = q.join(rows.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("actual")), "key", "left")
    out = out.select("key", "required", F.coalesce("actual", F.lit(0)).alias("actual"))
    return out.where("actual < required").withColumn("missing", F.col("required") - F.col("actual"))


def empty_items(items: DataFrame) -> DataFrame:
    """Items with neither text nor boxes."""
    return items.where((F.coalesce("text", F.lit("")) == "") & (F.coalesce(F.size("boxes"), F.lit(0)) <= 0))


def label_prefix_join(images: DataFrame, crops: DataFrame) -> DataFrame:
    """filename, crop_names, crop_texts: crops whose name starts with an image's stem and '_', sorted by name and text.

    Every beginning of a crop's name that ends before a '_' is a key, as many as the name has underscores; that makes the
    prefix match a hash join.
    """
    c = crops.withColumn("p", F.split("crop_name", "_"))
    keys = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.array_join(F.slice("p", 1, i), "_"))
    c = c.where(F.size("p") > 1).select("crop_name", "crop_text", F.explode(F.array_distinct(keys)).alias("stem"))
    i = images.select("filename", t.stem(F.col("filename")).alias("stem"))
    got = i.join(c, "stem").groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("crop_name", "crop_text"))).alias("c"))
    return got.select("filename", F.transform("c", lambda x: x["crop_name"]).alias("crop_names"), F.transform("c", lambda x: x["crop_text"]).alias("crop_texts"))


def angle_pairs(files: DataFrame, order: str = "doc_id", train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Each file as two training images, upright (0) and turned (180), split by position."""
    return positional_split(files, order, train, val).withColumn("angle", F.explode(F.array(F.lit(0), F.lit(180))))


def supplements(counts: DataFrame) -> DataFrame:
    """industry, real_count -> what synthesis should add: 80 renders where there is nothing, 25 and 25 below 50, else up
    to three of each image, 200 at most."""
    n = F.col("real_count")
    why = F.when(n == 0, "no_real_samples_use_render_only").when(n < 50, "low_real_samples_use_mixed_top_up").otherwise("sufficient_real_samples_aug_only")
    counts = counts.withColumn("reason", why)
    render = F.when(n == 0, 80).when(n < 50, 25).otherwise(0)
    return counts.withColumn("recommended_render", render.cast("long")).withColumn("recommended_aug", F.when(n == 0, 0).when(n < 50, 25).otherwise(F.least(n * 3, F.lit(200))).cast("long"))


def visual_sample(total: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(total * 0.05))


def _unmet(rules: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for bad, name in rules)))


def dataset_done(issues: Column, manual_error_rate: Column, split_issues: Column, config: Column, stats: Column, report: Column, frozen: Column) -> Column:
    """What a data set still lacks."""
    return _unmet([(issues > 0, "automatic_quality_issues_remaining"), (manual_error_rate > 0.03, "manual_review_error_rate_exceeds_3_percent"), (F.size(split_issues) > 0, "split_issues_remain"), (~config, "split_config_missing"), (~stats, "dataset_stats_missing"), (~report, "quality_report_missing"), (~frozen, "dataset_not_marked_read_only")])


def annotation_done(images: Column, det_exists: Column, rec_exists: Column, crops: Column, unreadable: Column, boxes: Column, mean_iou: Column, reviewed: Column, log_exists: Column) -> Column:
    return _unmet([(~det_exists, "det_gt_missing"), (~rec_exists, "rec_gt_missing"), (crops == 0, "crop_images_missing"), (safe_div(unreadable, boxes) > 0.05, "unreadable_ratio_exceeds_5_percent"), (mean_iou < 0.85, "calibration_iou_below_0.85"), (reviewed < F.floor(images * 0.1), "cross_review_below_10_percent"), (~log_exists, "annotation_log_missing")])


def synthetic_done(render: Column, aug: Column, handwriting: Column, labels: Column, log: Column, params: Column, qc: Column, masked: Column) -> Column:
    total = render + aug
    return _unmet([(total < 400, "synthetic_total_below_minimum"), (render < 150, "render_count_below_minimum"), (aug < 200, "aug_count_below_minimum"), (handwriting < 100, "handwriting_count_below_minimum"), (labels < total, "missing_label_jsons"), (~log, "synth_log_csv_missing"), (~params, "synth_params_json_missing"), (~qc, "visual_qc_not_passed"), (safe_div(total, total + masked) > 0.5, "synthetic_ratio_exceeds_50_percent"), (total + masked < 600, "combined_dataset_below_600")])

"""Recognition evaluation: edit distances, error rates, breakdowns and confusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.functions import text as t
from scrivena.functions.scalars import safe_div

BUCKETS = ("1", "2", "3-5", "6-10", "11+")


def samples(pairs: DataFrame, ignore_case: bool = False) -> DataFrame:
    """image_path, gt_text, pred_text (and text_type, where the table has it) -> those and distance, cer,
    normalized_cer, is_correct. Unreadable and empty truths are skipped; null predictions are empty."""
    fold = (lambda c: F.lower(c)) if ignore_case else (lambda c: c)
    pred = F.coalesce("pred_text", F.lit(""))
    kind = t.text_type(F.col("gt_text"), F.coalesce("image_path", F.lit("")))
    if "text_type" in pairs.columns:
        kind = F.when(F.col("text_type").isin(*t.TEXT_TYPES), F.col("text_type")).otherwise(kind)
    rows = pairs.where(F.col("gt_text").isNotNull() & ~F.col("gt_text").isin("", t.UNREADABLE)).withColumn("pred_text", pred).withColumn("text_type", kind)
    d, n = F.levenshtein(fold(F.col("pred_text")), fold(F.col("gt_text"))), F.char_length("gt_text")
    rows = rows.withColumn("distance", d.cast("long")).withColumn("gt_length", n.cast("long"))
    return rows.withColumn("cer", safe_div(F.col("distance"), n)).withColumn("normalized_cer", safe_div(F.col("distance"), F.greatest(n, F.char_length("pred_text")))).withColumn("is_correct", F.col("distance") == 0)


def _rates() -> list[Column]:
    count = F.count("is_correct")
    right = F.coalesce(F.sum(F.col("is_correct").cast("int")), F.lit(0))
    accuracy = safe_div(right, count)
    return [count.alias("sample_count"), right.alias("correct"), safe_div(F.sum("distance"), F.sum("gt_length")).alias("cer"), F.when(count > 0, 1.0 - accuracy).otherwise(0.0).alias("wer"), accuracy.alias("accuracy")]


def summary(rows: DataFrame) -> DataFrame:
    """One row: rates over all samples, and whether they meet the targets of a report."""
    out = rows.agg(*_rates(), F.coalesce(F.avg("normalized_cer"), F.lit(0.0)).alias("normalized_cer"), *_domain())
    meets = (F.col("cer") <= 0.03) & (F.col("wer") <= 0.05) & (F.col("accuracy") >= 0.90) & (F.col("work_code_accuracy") >= 0.95)
    return out.withColumn("targets_met", meets)


def _domain() -> list[Column]:
    right = F.col("is_correct").cast("int")
    code, date = F.col("gt_text").isin(*t.WORK_CODES), F.col("text_type") == "date"
    rate = lambda c: safe_div(F.coalesce(F.sum(F.when(c, right)), F.lit(0)), F.count_if(c))
    return [rate(code).alias("work_code_accuracy"), rate(date).alias("date_exact_match")]


def domain(rows: DataFrame) -> DataFrame:
    """Accuracy over work codes (as they are written) and over dates."""
    return rows.agg(*_domain())


def by_type(rows: DataFrame) -> DataFrame:
    """Rates of each of the four text types, zero where there are none."""
    kinds = rows.sparkSession.createDataFrame([(k,) for k in t.TEXT_TYPES], "text_type string")
    return _filled(kinds, rows.groupBy("text_type").agg(*_rates()), "text_type")


def by_length(rows: DataFrame) -> DataFrame:
    """Mean CER by length of the truth, zero where there are none."""
    buckets = rows.sparkSession.createDataFrame([(k,) for k in BUCKETS], "bucket string")
    got = rows.groupBy(t.length_bucket(F.col("gt_length")).alias("bucket")).agg(F.count("*").alias("sample_count"), F.avg("cer").alias("mean_cer"))
    return _filled(buckets, got, "bucket")


def _filled(keys: DataFrame, got: DataFrame, key: str) -> DataFrame:
    kinds = dict(got.dtypes)
    out = keys.join(got, key, "left")
    return out.select(key, *(F.coalesce(c, F.lit(0).cast(kinds[c])).alias(c) for c in got.columns if c != key))


def confusions(rows: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent substitutions: gt_char, pred_char, count; ties by characters."""
    # Equal pairs are traced once.
    pairs = rows.where("distance > 0").groupBy("pred_text", "gt_text").agg(F.count("*").alias("n"))
    ops = pairs.select("n", F.explode(t.edit_ops(F.col("pred_text"), F.col("gt_text"))).alias("o")).where(F.col("o.op") == "substitute")
    found = ops.groupBy(F.col("o.gt").alias("gt_char"), F.col("o.pred").alias("pred_char")).agg(F.sum("n").alias("count"))
    return found.orderBy(F.desc("count"), "gt_char", "pred_char").limit(k)


def worst(rows: DataFrame, k: int = 50, order: str = "sample_id") -> DataFrame:
    """The k samples with the highest CER; ties by the order column."""
    return rows.orderBy(F.desc("cer"), order).limit(k)


def error_table(rows: DataFrame) -> DataFrame:
    return rows.select("image_path", "gt_text", "pred_text", F.when(F.col("gt_text") == F.col("pred_text"), "True").otherwise("False").alias("match"))


def passes(cer: Column, most: float = 0.03) -> Column:
    return cer <= most


def top_per_type(rows: DataFrame, k: int = 10, order: str = "sample_id") -> DataFrame:
    """The k worst samples of each text type."""
    w = Window.partitionBy("text_type").orderBy(F.desc("cer"), order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

"""Confidence of recognised cells, corrections sent back, and what they are worth for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.functions import text as t

HIGH, LOW = 0.90, 0.70


def level(score: Column, high: float = HIGH, low: float = LOW) -> Column:
    return F.when(score >= high, "high").when(score < low, "low").otherwise("mid")


def enrich(results: DataFrame, import_id: str = "import_id", high: float = HIGH, low: float = LOW) -> DataFrame:
    """import_id, pos (from 0), text, confidence or score, bbox, cell_id -> rounded confidence, level of the unrounded
    one, and a cell_id where there is none."""
    cols = results.columns
    got = [F.col(c).cast("double") for c in ("confidence", "score") if c in cols]
    score = F.coalesce(*got, F.lit(0.0))
    own = F.when(F.col("cell_id") != "", F.col("cell_id")) if "cell_id" in cols else F.lit(None).cast("string")
    return results.select(*[c for c in cols if c not in ("confidence", "score", "cell_id")], F.bround(score, 4).alias("confidence"), level(score, high, low).alias("confidence_level"), F.coalesce(own, t.cell_id(F.col(import_id), F.col("pos") + 1)).alias("cell_id"))


def normalize_response(responses: DataFrame) -> DataFrame:
    """A response's fields with their defaults: import_id, enabled, angle, processing_time and its results."""
    defaults = {"import_id": F.lit("imp_pending"), "enabled": F.lit(True), "angle": F.lit(0), "processing_time": F.lit(0.0)}
    return responses.select(*(F.coalesce(F.col(c), d).alias(c) if c in responses.columns else d.alias(c) for c, d in defaults.items()), *[c for c in responses.columns if c not in defaults])


def usable_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens with text and box; a score that is missing is 1."""
    return tokens.where(F.col("text").isNotNull() & F.col("bbox").isNotNull()).withColumn("score", F.coalesce("score", F.lit(1.0)))


def levels(results: DataFrame, *by: str) -> DataFrame:
    """Counts by level, and how many need a review."""
    lv = F.coalesce("confidence_level", F.lit("low"))
    return results.groupBy(*by).agg(F.count("*").alias("total"), *(F.count_if(lv == k).alias(k) for k in ("high", "mid", "low")), F.count_if(lv.isin("mid", "low")).alias("review_required"))


def is_usable(original: Column, corrected: Column, crop_saved: Column, dictionary: list[str] | None = None) -> Column:
    """A real correction of 1 to 20 characters with a crop, all of them in the dictionary (an empty one checks nothing)."""
    n = F.char_length(corrected)
    ok = (original != corrected) & n.between(1, 20) & crop_saved
    if dictionary:
        known = F.lit(sorted(set(dictionary)))
        ok = ok & F.forall(F.split(corrected, ""), lambda c: (c == "") | F.array_contains(known, c))
    return F.coalesce(ok, F.lit(False))


def statistics(feedback: DataFrame, threshold: int = 100, dictionary: list[str] | None = None) -> DataFrame:
    """One row: total, usable, by level, last date, and whether there is enough for training."""
    ok = is_usable(F.col("original_text"), F.col("corrected_text"), F.col("crop_saved"), dictionary)
    lv = level(F.col("confidence"))
    out = feedback.agg(F.count("*").alias("total"), F.count_if(ok).alias("usable"), *(F.count_if(lv == k).alias(k) for k in ("high", "mid", "low")), F.substr(F.max(F.col("ts").cast("string")), F.lit(1), F.lit(10)).alias("last_date"))
    return out.withColumn("ready", F.col("usable") >= threshold)


def top_corrections(feedback: DataFrame, k: int = 10) -> DataFrame:
    """Of the k most frequent (original, corrected) pairs those that change something; ties by text."""
    top = feedback.groupBy("original_text", "corrected_text").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "original_text", "corrected_text").limit(k)
    return top.where("original_text != corrected_text")


def with_ids(feedback: DataFrame, order: str = "event_id", start: int = 0) -> DataFrame:
    """feedback_id fb_000001 and on, in the order of arrival; ranks come from ranges of the order column."""
    from scrivena.operators.ranks import ranked

    return ranked(feedback, order).withColumn("feedback_id", F.format_string("fb_%06d", F.col("rank") + start)).drop("rank")


def training_set(feedback: DataFrame, crops: DataFrame, least: int = 50, dictionary: list[str] | None = None) -> DataFrame:
    """crop_path, text of usable corrections whose crop exists (its own path, else the one by feedback id); no rows if
    there are fewer than `least` usable ones. crops has path."""
    ok = feedback.where(is_usable(F.col("original_text"), F.col("corrected_text"), F.col("crop_saved"), dictionary))
    enough = ok.agg((F.count("*") >= least).alias("enough"))  # one row
    own = crops.select(F.col("path").alias("crop_path"), F.lit(1).alias("own"))
    by_id = crops.select(t.stem(F.col("path")).alias("feedback_id"), F.col("path").alias("fallback")).dropDuplicates(["feedback_id"])
    out = ok.join(own.dropDuplicates(["crop_path"]), "crop_path", "left").join(by_id, "feedback_id", "left").join(F.broadcast(enough.where("enough")))
    path = F.when(F.col("own") == 1, F.col("crop_path")).otherwise(F.col("fallback"))
    return out.select(path.alias("crop_path"), F.col("corrected_text").alias("text")).where("crop_path is not null")


def rollback_triggers(error_rate: Column, previous: Column, exceptions: Column, memory_gb: Column, healthy: Column) -> Column:
    """Reasons to roll back, in a fixed order."""
    rules = (((error_rate > 0.05) & (error_rate >= previous * 3), "error_rate_exceeded"), (exceptions >= 10, "consecutive_exceptions"), (memory_gb > 4.0, "memory_limit_exceeded"), (~healthy, "health_check_failed"))
    return F.array_compact(F.array(*(F.when(r, F.lit(n)) for r, n in rules)))


def latest(feedback: DataFrame, k: int = 20, order: str = "event_id") -> DataFrame:
    w = Window.partitionBy("import_id").orderBy(F.desc(order))
    return feedback.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).drop("rn")

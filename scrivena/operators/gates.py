"""Release gates: criteria as rows, sections and gates as aggregates over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrivena.functions.scalars import metric

#: Gate, section, criterion, path in the summary, threshold, operator, required, default.
CRITERIA = (
    (1, "detection", "test_f1", "metrics.f1", 0.82, ">=", True, 0.0),
    (1, "detection", "test_recall", "metrics.recall", 0.80, ">=", True, 0.0),
    (1, "detection", "test_precision", "metrics.precision", 0.80, ">=", True, 0.0),
    (1, "detection", "grid_false_positive_rate", "error_analysis.grid_false_positive_rate", 0.05, "<=", False, 0.0),
    (1, "detection", "small_cell_miss_rate", "error_analysis.small_cell_miss_rate", 0.20, "<=", False, 0.0),
    (1, "recognition", "test_cer", "metrics.cer", 0.05, "<=", True, 0.0),
    (1, "recognition", "test_wer", "metrics.wer", 0.08, "<=", True, 0.0),
    (1, "recognition", "test_accuracy", "metrics.accuracy", 0.85, ">=", True, 0.0),
    (1, "recognition", "work_code_accuracy", "domain_metrics.work_code_accuracy", 0.93, ">=", True, 0.0),
    (1, "recognition", "date_exact_match", "domain_metrics.date_exact_match", 0.90, ">=", True, 0.0),
    (1, "recognition", "single_char_cer", "by_type.single_char.cer", 0.03, "<=", True, 0.0),
    (1, "recognition", "handwrite_cer", "by_type.handwrite.cer", 0.12, "<=", False, 0.0),
    (1, "classifier", "test_accuracy", "metrics.accuracy", 0.98, ">=", True, 0.0),
    (1, "classifier", "false_positive_rate", "metrics.false_positive_rate", 0.01, "<=", True, 0.0),
    (2, "e2e", "cell_accuracy", "metrics.cell_accuracy", 0.88, ">=", True, 0.0),
    (2, "e2e", "worker_schedule_accuracy", "metrics.worker_schedule_accuracy", 0.65, ">=", True, 0.0),
    (2, "e2e", "name_accuracy", "metrics.name_accuracy", 0.82, ">=", True, 0.0),
    (2, "e2e", "code_distribution_error", "metrics.code_distribution_error", 0.08, "<=", True, 0.0),
    (2, "e2e", "parse_success_rate", "parse_success_rate", 0.90, ">=", True, 0.0),
    (3, "deployment", "cpu_p50_seconds", "speed.cpu_p50_seconds", 3.0, "<=", True, 999.0),
    (3, "deployment", "cpu_p95_seconds", "speed.cpu_p95_seconds", 10.0, "<=", False, 999.0),
    (3, "deployment", "model_loaded_gb", "memory.model_loaded_gb", 2.0, "<=", True, 999.0),
    (3, "deployment", "peak_inference_gb", "memory.peak_inference_gb", 4.0, "<=", True, 999.0),
    (3, "deployment", "exceptions_per_100", "stability.exceptions_per_100", 0.0, "<=", True, 999.0),
    (3, "deployment", "high_conf_error_rate", "confidence.high_conf_error_rate", 0.02, "<=", False, 1.0),
    (3, "deployment", "low_conf_error_rate", "confidence.low_conf_error_rate", 0.20, ">=", False, 0.0),
)
#: Fixed values.
FORMAT_THRESHOLDS = {"paper": 0.88, "scan": 0.88, "screen": 0.88, "excel": 0.90, "handwrite": 0.70}
ACTIONS = {
    "detection": "Re-tune Detection postprocess thresholds before retraining.",
    "recognition": "Check work-code coverage and single-char oversampling before retraining Recognition.",
    "classifier": "Increase Angle Classifier threshold conservatism and review false positives.",
    "e2e": "Inspect parse_error ratio and roster parser failures before model retraining.",
    "deployment": "Optimize input size, backbone, or runtime conversion before service release.",
}


def passed():
    """'>=' compares upwards, any other operator downwards."""
    return F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))


def criteria(summaries: DataFrame) -> DataFrame:
    """summaries: run, section, summary (JSON text) -> a row for each criterion of each run, with its value or default."""
    spark = summaries.sparkSession
    rules = spark.createDataFrame([(i, *c) for i, c in enumerate(CRITERIA)], "pos int, gate int, section string, name string, path string, threshold double, op string, required boolean, `default` double")
    runs = summaries.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("section", "summary"))).alias("s"))
    value = F.coalesce(*(F.when(F.col("path") == p, metric(F.coalesce(F.col("s")[F.col("section")], F.lit("{}")), *p.split("."), default=float("nan"))) for p in dict.fromkeys(c[3] for c in CRITERIA)))
    # A classifier's summary may be flat.
    flat = F.when(F.col("section") == "classifier", F.coalesce(*(F.when(F.col("path") == f"metrics.{n}", metric(F.col("s")["classifier"], n, default=float("nan"))) for n in ("accuracy", "false_positive_rate"))))
    flat = F.when(~F.isnan(flat), flat)
    out = runs.join(F.broadcast(rules))  # as many rows for each run as there are rules
    out = out.withColumn("value", F.when(F.isnan(value), F.coalesce(flat, F.col("default"))).otherwise(value))
    return out.select("run", "pos", "gate", "section", "name", "value", "threshold", "op", "required")


def format_criteria(by_format: DataFrame) -> DataFrame:
    """run, format, cell_accuracy -> criteria rows for the formats that have a threshold."""
    spark = by_format.sparkSession
    rules = spark.createDataFrame(list(FORMAT_THRESHOLDS.items()), "format string, threshold double")
    out = by_format.join(F.broadcast(rules), "format")
    return out.select("run", F.lit(100).alias("pos"), F.lit(2).alias("gate"), F.lit("e2e").alias("section"), F.format_string("format_%s_cell_accuracy", "format").alias("name"), F.coalesce("cell_accuracy", F.lit(0.0)).alias("value"), "threshold", F.lit(">=").alias("op"), F.lit(True).alias("required"))


def sections(rows: DataFrame) -> DataFrame:
    """run, gate, section, passed, conditional, failed_items (required ones, in order)."""
    p, need = passed(), F.col("required")
    out = rows.groupBy("run", "gate", "section").agg(F.min(F.when(need, p.cast("int"))).alias("ok"), F.max((~need & ~p).cast("int")).alias("soft"), F.array_sort(F.collect_list(F.when(need & ~p, F.struct("pos", "name")))).alias("f"))
    out = out.withColumn("passed", F.coalesce(F.col("ok"), F.lit(1)) == 1)
    return out.select("run", "gate", "section", "passed", (F.col("passed") & (F.col("soft") == 1)).alias("conditional"), F.transform("f", lambda x: x["name"]).alias("failed_items"))


def gates(rows: DataFrame) -> DataFrame:
    """run, gate, passed, skipped, failed_items: a gate is skipped, and has not passed, once one before it failed."""
    s = sections(rows).groupBy("run", "gate").agg(F.min(F.col("passed").cast("int")).alias("p"), F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("section")))).alias("failed_items"))
    before = F.min("p").over(Window.partitionBy("run").orderBy("gate").rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("skipped", F.coalesce(before, F.lit(1)) == 0)
    return s.select("run", "gate", ((F.col("p") == 1) & ~F.col("skipped")).alias("passed"), "skipped", F.when(F.col("skipped"), F.array(F.format_string("gate%d", "gate"))).otherwise(F.col("failed_items")).alias("failed_items"))


def status(found: DataFrame) -> DataFrame:
    """run, status, actions: PASS, CONDITIONAL_PASS (only the third gate failed) or FAIL, and what to do."""
    ok = lambda k: F.coalesce(F.max(F.when(F.col("gate") == k, F.col("passed").cast("int"))), F.lit(0)) == 1
    out = found.groupBy("run").agg(F.when(ok(1) & ok(2) & ok(3), "PASS").when(ok(1) & ok(2), "CONDITIONAL_PASS").otherwise("FAIL").alias("status"), F.array_sort(F.collect_list(F.struct("gate", "failed_items"))).alias("f"))
    table = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    items = F.flatten(F.transform("f", lambda g: g["failed_items"]))
    return out.select("run", "status", F.array_compact(F.transform(items, lambda i: F.try_element_at(table, i))).alias("actions"))


def check(summaries: DataFrame, by_format: DataFrame | None = None) -> DataFrame:
    rows = criteria(summaries)
    if by_format is not None:
        rows = rows.unionByName(format_criteria(by_format))
    return status(gates(rows))


def catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([c[:7] for c in CRITERIA], "gate int, section string, name string, path string, threshold double, op string, required boolean")

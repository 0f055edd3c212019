"""Fixed lists as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed values.
LISTS = {
    "detection_metrics": ("precision", "recall", "f1", "iou", "tp", "fp", "fn"),
    "recognition_metrics": ("cer", "wer", "accuracy", "normalized_cer", "work_code_accuracy", "date_exact_match"),
    "end_to_end_metrics": ("cell_accuracy", "worker_schedule_accuracy", "name_accuracy", "code_distribution_error", "parse_success_rate"),
    "confidence_fields": ("confidence", "confidence_level", "cell_id", "summary", "feedback"),
    "release_controls": ("model_registry", "active_version", "deployment_log", "rollback_policy", "version_api"),
    "monitoring_targets": ("wandb", "local_csv_logs", "checkpoint_manager", "health_checks", "prediction_visualizations", "completion_notifications"),
    "formats": ("paper", "scan", "screen", "excel", "handwrite"),
    "industries": ("hospital", "convenience", "factory", "office", "food", "etc"),
    "version_statuses": ("active", "superseded", "deprecated", "rollback_candidate"),
}

#: Training defaults.
TRAINING = {"gpus": 7, "gpu_memory_gb": 11, "batch_cls": 128, "batch_det": 12, "batch_rec": 64, "seed": 42}


def items(spark: SparkSession, name: str | None = None) -> DataFrame:
    """list, pos, item."""
    rows = [(k, i, v) for k, vs in LISTS.items() if name in (None, k) for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "list string, pos int, item string")


def settings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in TRAINING.items()], "name string, value double")


def grid(spark: SparkSession, **values: list) -> DataFrame:
    """Every combination of the values: a product of short lists of settings."""
    import itertools

    names = list(values)
    return spark.createDataFrame([tuple(map(str, c)) for c in itertools.product(*values.values())], ", ".join(f"{n} string" for n in names))

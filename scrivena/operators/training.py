"""Training logs: health and checkpoints, by windows over a run's steps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def health(log: DataFrame, rising: int = 10, most_norm: float = 1000.0, run: str = "run_id", order: str = "step") -> DataFrame:
    """log with issues: a loss that is no number, losses that rose for `rising` steps on end, a gradient that is too
    large."""
    w = Window.partitionBy(run).orderBy(order)
    up = (F.col("loss_total") > F.lag("loss_total").over(w)).cast("int")
    rows = log.withColumn("_up", F.coalesce(up, F.lit(0)))
    ups = F.sum("_up").over(w.rowsBetween(-(rising - 2), 0))
    found = F.array(
        F.when(F.isnan("loss_total"), F.lit("loss_nan")),
        F.when((ups == rising - 1) & ~F.isnan("loss_total"), F.lit("loss_diverging")),
        F.when(~F.isnan("grad_norm") & (F.col("grad_norm") > most_norm), F.lit("grad_norm_spike")),
    )
    return rows.withColumn("issues", F.array_compact(found)).drop("_up")


def epoch_issues(epoch, train_loss, val_loss):
    return F.when((epoch >= 5) & (val_loss > train_loss * 10), F.array(F.lit("validation_loss_10x"))).otherwise(F.array().cast("array<string>"))


def best(points: DataFrame, metric: str, mode: str = "max", run: str = "run_id", order: str = "step") -> DataFrame:
    """points with is_best: strictly better than all before, or the first."""
    if mode not in ("max", "min"):
        raise ValueError(f"unknown mode {mode}")
    before = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    prior = (F.max if mode == "max" else F.min)(metric).over(before)
    better = F.col(metric) > prior if mode == "max" else F.col(metric) < prior
    return points.withColumn("is_best", prior.isNull() | better)


def keep_last(points: DataFrame, n: int = 3, run: str = "run_id", order: str = "step") -> DataFrame:
    w = Window.partitionBy(run).orderBy(F.desc(order))
    return points.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


@dataclass(frozen=True)
class Retention:
    """What decides which checkpoints of a run stay: the best by a metric, and the last few."""

    monitor: str
    mode: str = "max"
    keep: int = 3

    def kept(self, points: DataFrame, run: str = "run_id", order: str = "step") -> DataFrame:
        """points that stay, with is_best (better than all before) and is_last (the latest); the best is the last of the
        former."""
        marked = best(points, self.monitor, self.mode, run, order)
        w = Window.partitionBy(run).orderBy(F.desc(order))
        marked = marked.withColumns({"_k": F.row_number().over(w), "_b": F.max(F.when(F.col("is_best"), F.col(order))).over(Window.partitionBy(run))})
        return marked.where((F.col("_k") <= self.keep) | (F.col(order) == F.col("_b"))).withColumns({"is_last": F.col("_k") == 1, "is_best": F.col(order) == F.col("_b")}).drop("_k", "_b")


def conform(rows: DataFrame, header: list[str]) -> DataFrame:
    """The header's columns as text, missing ones empty, others dropped."""
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in header))


def completion_message(name, metric, epoch, path):
    return F.concat_ws("\n", F.concat(F.lit("experiment: "), name), F.concat(F.lit("best: "), metric, F.lit(" at epoch "), epoch.cast("string")), F.concat(F.lit("checkpoint: "), path))

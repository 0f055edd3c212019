"""Model versions and deployments as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.operators.order_stats import quantiles

STATUSES = ("active", "superseded", "deprecated", "rollback_candidate")


def upsert(versions: DataFrame, new: DataFrame) -> DataFrame:
    """versions with the rows of new put in or in the place of those with the same version."""
    return versions.join(new.select("version"), "version", "left_anti").unionByName(new)


def active(versions: DataFrame) -> DataFrame:
    """The first active version, by version as text; no row without one."""
    return versions.where("status = 'active'").agg(F.min("version").alias("active_version")).where("active_version is not null")


def set_status(versions: DataFrame, version: str, status: str) -> DataFrame:
    if status not in STATUSES:
        raise ValueError(f"unknown status {status}")
    return versions if not version else versions.withColumn("status", F.when(F.col("version") == version, status).otherwise(F.col("status")))


def deploy(versions: DataFrame, version: str) -> DataFrame:
    """The version becomes active, the one that was so is superseded."""
    return versions.withColumn("status", F.when(F.col("version") == version, "active").when(F.col("status") == "active", "superseded").otherwise(F.col("status")))


def rollback(versions: DataFrame, target: str, force: bool = False) -> DataFrame:
    """The target becomes active, the one that was so is deprecated. A deprecated target raises unless forced."""
    bad = (F.col("version") == target) & (F.col("status") == "deprecated")
    status = F.when(F.col("version") == target, "active").when(F.col("status") == "active", "deprecated").otherwise(F.col("status"))
    return versions.withColumn("status", status if force else F.when(bad, F.raise_error("the target is deprecated")).otherwise(status))


def history(log: DataFrame, limit: int = 20, order: str = "seq") -> DataFrame:
    """The last events in their order; a limit of 0 gives all."""
    return log.orderBy(order) if limit == 0 else log.orderBy(F.desc(order)).limit(limit).orderBy(order)


def active_from_log(log: DataFrame, order: str = "seq") -> DataFrame:
    """The version that the last completed deployment or rollback left running."""
    done = log.where(F.col("event").isin("deploy_complete", "rollback_complete"))
    return done.agg(F.max(F.struct(order, "to")).alias("x")).select(F.col("x.to").alias("active_version"))


def issues(versions: DataFrame, required: tuple[str, ...] = ("version", "status")) -> DataFrame:
    """version, issue: missing values and unknown statuses."""
    found = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in required), F.when(~F.col("status").isin(*STATUSES), F.lit("unknown_status"))))
    return versions.select("version", F.explode(found).alias("issue"))


def missing_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected paths that a listing lacks."""
    return expected.join(listing, "path", "left_anti")


def metric_delta(before, after, tolerance: float):
    return F.abs(after - before) <= tolerance


def latency(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """p50, p95, p99 (the sorted value at int((n - 1) * p)), mean and max; by selection, so that no group is sorted."""
    sums = rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    found = quantiles(rows, list(by), value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    same = reduce(lambda a, b: a & b, (sums[c].eqNullSafe(found[c]) for c in by), F.lit(True))
    return sums.join(found, same).select(*(sums[c] for c in by), "n", "p50", "p95", "p99", "mean", "max")

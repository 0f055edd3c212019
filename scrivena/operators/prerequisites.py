"""What a data set lacks before it can be split, from a listing of its files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.sources.shared import folder

#: Files that a collection has at least.
LEAST_MASKED, LEAST_SYNTHETIC = 600, 400


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, length and whether it is a folder, of what lies in each folder."""
    from pyarrow import fs

    for b in batches:
        for path in b.column("path").to_pylist():
            store, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
            found = store.get_file_info(fs.FileSelector(name, allow_not_found=True))
            head = path[: len(path) - len(name)]
            yield pa.RecordBatch.from_arrays([pa.array([head + i.path for i in found], pa.string()), pa.array([i.size for i in found], pa.int64()), pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_())], names=["path", "length", "folder"])


def listing(spark: SparkSession, root: str) -> DataFrame:
    """file (below root) and length of the files below a folder, empty ones too. Folders are listed by tasks, a level of the
    tree a round; no content is read."""
    root = root.rstrip("/")
    found, level = None, spark.createDataFrame([(root,)], "path string")
    while level is not None:
        path = folder(spark, "listing")
        level.repartition("path").mapInArrow(_children, "path string, length long, folder boolean").write.parquet(path)
        rows = spark.read.parquet(path)
        found = rows if found is None else found.unionByName(rows)
        level = None if rows.where("folder").isEmpty() else rows.where("folder").select("path")
    return found.where("not folder").select(F.substring("path", len(root) + 2, 1 << 30).alias("file"), "length")


def counts(files: DataFrame, log: DataFrame) -> DataFrame:
    """One row: files of each kind, and rejected images of the annotation log (file, status)."""
    inside = lambda folder, deep, end: F.col("file").rlike(f"^data/{folder}/{'.*' if deep else '[^/]*'}{end}$")
    kinds = {
        "masked": inside("masked", False, "[.][^/]*"), "synthetic": inside("synthetic", True, "[.]png"), "synthetic_labels": inside("synthetic/labels", False, "[.]json"),
        "crops": inside("labels/crop", False, "[.][^/]*"), "det_gt": F.col("file") == "data/labels/det_gt.txt", "rec_gt": F.col("file") == "data/labels/rec_gt.txt", "log": F.col("file") == "data/meta/annotation_log.csv",
    }
    return files.agg(*(F.count_if(k).alias(n) for n, k in kinds.items())).join(log.agg(F.count_if(F.col("status") == "rejected").alias("rejected")))  # both of one row


def unmet(c: DataFrame) -> DataFrame:
    """issue, found: the prerequisites that the counts don't meet, with the count that tells."""
    issue = lambda bad, name, found: F.when(bad, F.struct(F.lit(name).alias("issue"), found.cast("long").alias("found")))
    none = F.lit(None).cast("long")
    absent = lambda n: F.col(n) == 0
    rules: list[Column] = [
        issue(F.col("masked") < LEAST_MASKED, "masked_count_below_600", F.col("masked")),
        issue(F.col("synthetic") < LEAST_SYNTHETIC, "synthetic_count_below_400", F.col("synthetic")),
        issue(absent("det_gt"), "det_gt_missing", none),
        issue(absent("rec_gt"), "rec_gt_missing", none),
        issue(absent("crops"), "crop_images_missing", none),
        issue(F.col("synthetic_labels") < F.col("synthetic"), "synthetic_label_json_missing", F.col("synthetic_labels")),
        issue(absent("log"), "annotation_log_missing", none),
        issue((F.col("log") > 0) & (F.col("rejected") > 0), "annotation_log_contains_rejected", F.col("rejected")),
    ]
    return c.select(F.explode(F.array_compact(F.array(*rules))).alias("i")).select("i.*")

"""Label files and logs as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrivena.functions import geometry as g
from scrivena.functions import text as t
from scrivena.sources import json_pieces
from scrivena.sources.shared import prepare

POLYGONS = "array<struct<transcription: string, points: array<array<double>>, difficult: boolean>>"
TOKENS = "array<struct<text: string, bbox: array<double>, score: double>>"
FEEDBACK = "feedback_id string, import_id string, cell_id string, worker_id string, original_text string, corrected_text string, confidence double, confidence_level string, timestamp string, crop_saved boolean, crop_path string"
DEPLOYMENTS = "event string, `from` string, `to` string, timestamp string, by string, reason string"
SCHEDULE = "image_path string, format string, industry string, year_month string, workers array<string>, schedule map<string, map<string, string>>, metadata map<string, string>"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 0) and value of the lines of a text file that aren't blank. A file is numbered as a whole: it is read as
    one value, as label files of one shard are."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return rows.where(F.trim("value") != "")


def detection_labels(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """image_path, name, line, polygons. A line without a tab is skipped, or raises if strict."""
    rows = lines(spark, path)
    has = F.instr("value", "\t") > 0
    rows = rows.where(F.when(has, True).otherwise(F.raise_error("a label line without a tab"))) if strict else rows.where(has)
    p = F.split("value", "\t", 2)
    return rows.select(p[0].alias("image_path"), t.base_name(p[0]).alias("name"), "file", "line", F.from_json(p[1], POLYGONS).alias("polygons"))


def last_by_name(labels: DataFrame) -> DataFrame:
    """The last line of each name."""
    w = Window.partitionBy("name").orderBy(F.desc("file"), F.desc("line"))
    return labels.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def boxes(labels: DataFrame, whole: bool = False) -> DataFrame:
    """image_path, idx, x1..y2, difficult, transcription: bounding boxes of the polygons that have points."""
    rows = labels.select("image_path", F.posexplode("polygons").alias("idx", "p")).where(F.size("p.points") > 0)
    b = g.box_of_points(F.col("p.points"))
    kind = "int" if whole else "double"
    return rows.select("image_path", "idx", *(b[c].cast(kind).alias(c) for c in ("x1", "y1", "x2", "y2")), F.coalesce("p.difficult", F.lit(False)).alias("difficult"), F.col("p.transcription").alias("transcription"))


def recognition_labels(spark: SparkSession, path: str, strip: bool = False, strict: bool = False) -> DataFrame:
    """crop_path, name, line, text: split at the first space. A line without one is skipped, or raises if strict."""
    rows = lines(spark, path)
    v = F.trim("value") if strip else F.col("value")
    has = F.instr(v, " ") > 0
    rows = rows.where(F.when(has, True).otherwise(F.raise_error("a label line without a space"))) if strict else rows.where(has)
    p = F.split(v, " ", 2)
    return rows.select(p[0].alias("crop_path"), t.base_name(p[0]).alias("name"), "file", "line", p[1].alias("text"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """idx, token."""
    rows = spark.read.text(path, wholetext=True)
    out = rows.select(F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("idx", "token"))
    return out


def schedules(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file an image, as long rows: image, worker, worker_pos, day, gt_code. A file is read in pieces, however many
    workers it has, from any store that Arrow opens."""
    files = prepare(spark).read.format("binaryFile").load(path).select(F.monotonically_increasing_id().alias("file"), "path")
    pieces = json_pieces.cut(files, ("image_path", "format", "industry"), {"workers": "[", "schedule": "{"})
    rows = pieces.select("file", "place", F.posexplode(F.from_json("text", f"array<struct<{SCHEDULE}>>")).alias("record", "r")).select("file", "record", "place", t.stem(F.col("r.image_path")).alias("image"), "r.format", "r.industry", "r.workers", "r.schedule")
    # A worker's place and days meet by a shuffle: looked up in the array, a file would cost the square of its workers. The
    # first days count if a worker has several.
    place = F.transform("workers", lambda w, i: F.struct(w.alias("worker"), (F.col("place") + i).alias("pos"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("map<string, string>").alias("days")))
    own = F.transform(F.map_entries("schedule"), lambda e, i: F.struct(e["key"].alias("worker"), F.lit(None).cast("long").alias("pos"), F.when(e["value"].isNotNull(), F.col("place") + i).alias("at"), e["value"].alias("days")))
    none = F.array().cast("array<struct<worker: string, pos: long, at: long, days: map<string, string>>>")
    each = rows.select("file", "record", "image", "format", "industry", F.col("workers").isNull().alias("unknown"), F.explode(F.concat(F.coalesce(place, none), F.coalesce(own, none))).alias("e"))
    met = each.groupBy("file", "record", "image", "format", "industry", "unknown", "e.worker").agg(F.min("e.pos").alias("pos"), F.min_by("e.days", "e.at").alias("days"))
    pos = F.when(~F.col("unknown"), F.coalesce("pos", F.lit(-1))).cast("int")
    return met.select("image", "format", "industry", "worker", pos.alias("worker_pos"), F.explode("days").alias("day", "gt_code"))


def tokens(spark: SparkSession, path: str) -> DataFrame:
    """Recognised tokens from a JSON file that is a map of images, or a list of them: image, seq, text, bbox, score."""
    raw = spark.read.text(path, wholetext=True)
    as_map = F.map_entries(F.from_json("value", f"map<string, {TOKENS}>"))
    as_list = F.transform(F.from_json("value", f"array<struct<image: string, tokens: {TOKENS}>>"), lambda e: F.struct(e["image"].alias("key"), e["tokens"].alias("value")))
    rows = raw.select(F.explode(F.when(F.ltrim("value").startswith("["), as_list).otherwise(as_map)).alias("e"))
    rows = rows.select(F.col("e.key").alias("image"), F.posexplode("e.value").alias("seq", "t"))
    return rows.where("t.text is not null and t.bbox is not null").select("image", "seq", "t.text", "t.bbox", F.coalesce("t.score", F.lit(1.0)).alias("score"))


def feedback(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEEDBACK).json(path)


def deployments(spark: SparkSession, path: str) -> DataFrame:
    """Events with seq, their line."""
    return lines(spark, path).select(F.col("line").alias("seq"), F.from_json("value", DEPLOYMENTS).alias("e")).select("seq", "e.*")


def csv_log(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).csv(path)


def json_value(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file as one variant value."""
    return spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("value"))


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """path, label (the folder's name), file_md5, content of the files below a folder, unread until content is used."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select("path", F.element_at(F.split("path", "/"), -2).alias("label"), F.md5("content").alias("file_md5"), "length", "content")


def dataset_records(images: DataFrame, detection: DataFrame, recognition: DataFrame, synthetic: DataFrame) -> DataFrame:
    """images (filename, width, height) with their boxes and crops, and synthetic ones with theirs (filename, method,
    bboxes, width, height): one row an image."""
    from scrivena.operators.dataset import label_prefix_join

    det = detection.select(F.col("name").alias("filename"), F.size("polygons").alias("detection_boxes"), F.exists("polygons", lambda p: F.coalesce(p["difficult"], F.lit(False))).alias("difficult"), F.size(F.filter("polygons", lambda p: p["transcription"] == t.UNREADABLE)).alias("unreadable_count"))
    rec = label_prefix_join(images, recognition.select(F.col("name").alias("crop_name"), F.col("text").alias("crop_text")))
    parts = t.dataset_filename_parts(F.col("filename"))
    shape = lambda df, source, method: df.select("filename", F.lit(source).alias("source"), parts["format"].alias("format"), parts["industry"].alias("industry"), "width", "height", F.coalesce("difficult", F.lit(False)).alias("difficult"), F.coalesce("unreadable_count", F.lit(0)).alias("unreadable_count"), F.coalesce("detection_boxes", F.lit(0)).alias("detection_boxes"), F.coalesce("crop_texts", F.array().cast("array<string>")).alias("crop_texts"), method.alias("synthetic_method"))
    real = images.join(det, "filename", "left").join(rec, "filename", "left")
    made = synthetic.withColumn("difficult", F.lit(False)).withColumn("unreadable_count", F.lit(0)).withColumn("detection_boxes", F.size("bboxes")).withColumn("crop_texts", F.transform("bboxes", lambda b: b["text"]))
    return shape(real, "masked", F.lit(None).cast("string")).unionByName(shape(made, "synthetic", F.col("method")))

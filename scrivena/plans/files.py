"""Queries over files: what the given tables hold is written as label files, logs and folders, and read by the sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.functions import geometry as g
from scrivena.operators import prerequisites
from scrivena.plans.fixtures import table
from scrivena.sources import label_source, labels, sinks
from scrivena.sources.shared import folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _detection_file(s: SparkSession, d: str) -> str:
    """A label line for each image: its boxes as polygons."""
    b = F.struct("x1", "y1", "x2", "y2")
    shape = F.struct("idx", F.format_string("t%d", "idx").alias("transcription"), g.polygon(b).alias("points"), "difficult")
    rows = table(s, d, "gt_boxes").groupBy("image_id").agg(F.array_sort(F.collect_list(shape)).alias("p"))
    path = folder(s, "det")
    kept = F.transform("p", lambda p: F.struct(p["transcription"].alias("transcription"), p["points"].alias("points"), p["difficult"].alias("difficult")))
    sinks.write_lines(rows.select(sinks.detection_line(F.format_string("img/doc_%d.jpg", "image_id"), kept).alias("line")), "line", path)
    return path


@query("select 'img/doc_' || image_id || '.jpg' as image_path, idx, cast(x1 as bigint) as x1, cast(y1 as bigint) as y1, cast(x2 as bigint) as x2, cast(y2 as bigint) as y2, difficult, 't' || idx as transcription from gt_boxes")
def src_detection_labels(s, d):
    rows = label_source.register(s).read.format("detection_labels").option("rangeBytes", 1 << 20).load(_detection_file(s, d))
    found = labels.boxes(rows)
    return found.select("image_path", "idx", *(F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")), "difficult", "transcription")


@query("select image_path as crop_path, cast(sample_id as varchar) || '.png' as name, gt_text as text from rec_samples where sample_id % 2 = 1 and gt_text <> ''")
def src_recognition_labels(s, d):
    """One in two crops has a label; the others' lines lack the space."""
    path = folder(s, "rec")
    line = F.when(F.col("sample_id") % 2 == 1, sinks.recognition_line(F.col("image_path"), F.col("gt_text"))).otherwise(F.col("image_path"))
    sinks.write_lines(table(s, d, "rec_samples").select(line.alias("line")), "line", path)
    return label_source.register(s).read.format("recognition_labels").load(path).where("text <> ''").select("crop_path", "name", "text")


@query("select 'fb_' || event_id as feedback_id, import_id, original_text, nullif(corrected_text, original_text) as corrected_text, confidence, crop_saved from feedback")
def src_feedback_log(s, d):
    f = table(s, d, "feedback")
    path = folder(s, "feedback")
    sinks.append_events(f.select(F.concat(F.lit("fb_"), F.col("event_id").cast("string")).alias("feedback_id"), "import_id", "original_text", F.nullif("corrected_text", "original_text").alias("corrected_text"), "confidence", "crop_saved"), path)
    kinds = "feedback_id string, import_id string, original_text string, corrected_text string, confidence double, crop_saved boolean"
    return label_source.register(s).read.format("json_events").schema(kinds).load(path)


@query("select s_nationkey as registry, version as active_version from (select s_nationkey, 'v' || s_suppkey as version, row_number() over (partition by s_nationkey order by s_suppkey desc) as k from supplier where s_suppkey % 3 <> 0) where k = 1")
def src_deployment_log(s, d):
    """The version that each registry runs, from its log of deployments, rollbacks and failures; events are in the order of
    their lines, whichever byte ranges they are read in."""
    kind = F.when(F.col("s_suppkey") % 3 == 0, "deploy_failed").when(F.col("s_suppkey") % 3 == 1, "deploy_complete").otherwise("rollback_complete")
    path = folder(s, "deployments")
    log = table(s, d, "supplier").select(F.col("s_nationkey").alias("registry"), F.concat(F.lit("v"), F.col("s_suppkey").cast("string")).alias("to"), kind.alias("event"), "s_suppkey")
    # One registry's events lie in one file, in order.
    sinks.append_events(log.repartition("registry").sortWithinPartitions("s_suppkey").drop("s_suppkey"), path)
    kinds = "file string, offset long, registry long, event string, to string"
    rows = label_source.register(s).read.format("json_events").schema(kinds).option("rangeBytes", 4096).load(path)
    done = rows.where(F.col("event").isin("deploy_complete", "rollback_complete"))
    return done.groupBy("registry").agg(F.max_by("to", F.struct("file", "offset")).alias("active_version"))


@query("select cast(row_number() over (order by ch) - 1 as int) as idx, ch as token from (select distinct unnest(string_split(text, '')) as ch from documents) where ord(ch) > 32 and ord(ch) not in (133, 160, 8232, 8233, 65279)")
def src_dictionary(s, d):
    """The characters of all documents, as the lines of a dictionary file."""
    chars = table(s, d, "documents").select(F.explode(F.split("text", "")).alias("ch")).distinct()
    code = F.unicode("ch") if hasattr(F, "unicode") else F.ascii("ch")
    path = folder(s, "dictionary")
    chars = chars.where((code > 32) & ~code.isin(133, 160, 8232, 8233, 65279))  # as many as there are characters
    sinks.write_lines(chars.coalesce(1).sortWithinPartitions("ch"), "ch", path)
    return labels.dictionary(s, path)


@query("select 'm' || image_id as image, 'w' || worker as worker, cast(dense_rank() over (partition by image_id order by worker) - 1 as int) as worker_pos, cast(day as varchar) as day, gt_code from schedule_gt")
def src_schedules(s, d):
    """A JSON file for each image's schedule. It is written as its workers come: an image has as many as the tables make it."""
    days = F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("day").cast("string"), "gt_code"))))
    one = table(s, d, "schedule_gt").groupBy("image_id", "worker").agg(days.alias("days"))
    name, worker = F.col("image_id").cast("string"), F.concat(F.lit('"w'), F.col("worker").cast("string"), F.lit('"'))
    part = lambda k, piece: F.struct(F.lit(k).alias("part"), piece.alias("piece"))
    parts = one.select("image_id", "worker", F.inline(F.array(part(0, worker), part(1, F.concat(worker, F.lit(":"), "days")))))
    lie = parts.repartition("image_id").sortWithinPartitions("image_id", "part", "worker")
    opening = F.when(F.col("part") == 0, F.concat(F.lit('{"image_path":"x/m'), name, F.lit('.png","workers":['))).otherwise('],"schedule":{')
    root = folder(s, "schedules")
    sinks.write_parts(lie.select(F.concat(F.lit("m"), name, F.lit(".json")).alias("name"), opening.alias("opening"), "piece"), root, "}}")
    return labels.schedules(s, root).select("image", "worker", "worker_pos", "day", "gt_code")


@query("select 'i' || image_id as image, seq, text, [cast(x1 as double), y1, x2, y2] as bbox, 1.0::double as score from tokens")
def src_tokens(s, d):
    """JSON files that are lists of images with tokens, one for every thousand images."""
    t = F.struct("seq", "text", F.array(*(F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2"))).alias("bbox"))
    one = table(s, d, "tokens").groupBy("image_id").agg(F.array_sort(F.collect_list(t)).alias("tokens"))
    item = F.struct(F.concat(F.lit("i"), F.col("image_id").cast("string")).alias("image"), F.transform("tokens", lambda x: F.struct(x["text"].alias("text"), x["bbox"].alias("bbox"))).alias("tokens"))
    body = one.groupBy(F.expr("image_id div 1000").alias("part")).agg(F.to_json(F.collect_list(item)).alias("value"))
    root = folder(s, "tokens")
    sinks.write_files(body.select(F.format_string("t%d.json", "part").alias("name"), F.col("value").cast("binary").alias("content")), root)
    return labels.tokens(s, root)


@query("""with c as (select count(*) as masked, count(*) filter (where s_suppkey % 2 = 0) as synthetic, count(*) filter (where s_suppkey % 4 = 0) as labels, count(*) filter (where s_suppkey % 10 = 3) as rejected from supplier)
    select 'masked_count_below_600' as issue, masked as found from c where masked < 600 union all select 'synthetic_count_below_400', synthetic from c where synthetic < 400 union all select 'rec_gt_missing', null
    union all select 'crop_images_missing', null union all select 'synthetic_label_json_missing', labels from c where labels < synthetic union all select 'annotation_log_contains_rejected', rejected from c where rejected > 0""")
def ds_prerequisites(s, d):
    """A data set's folder with an image for each supplier, some synthetic ones and labels; recognition labels are missing."""
    k = F.col("s_suppkey").cast("string")
    rows = table(s, d, "supplier").select("s_suppkey", F.array_compact(F.array(
        F.concat(F.lit("data/masked/img_"), k, F.lit(".jpg")), F.concat(F.lit("data/masked/deeper/"), k, F.lit(".jpg")),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("data/synthetic/render/"), k, F.lit(".png"))),
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("data/synthetic/labels/"), k, F.lit(".json"))),
    )).alias("names"))
    log = table(s, d, "supplier").select(F.concat(F.lit("img_"), k, F.lit(".jpg")).alias("filename"), F.when(F.col("s_suppkey") % 10 == 3, "rejected").otherwise("done").alias("status"))
    root = folder(s, "dataset")
    sinks.write_files(rows.select(F.explode("names").alias("name"), F.lit("x").cast("binary").alias("content")), root)
    # The label file and the log are files of one part; the log has as many rows as there are images.
    single = lambda name, body: s.createDataFrame([(name, bytearray(body.encode()))], "name string, content binary")
    sinks.write_files(single("data/labels/det_gt.txt", "a.jpg\t[]\n").unionByName(single("data/meta/annotation_log.csv", "filename,status\n")), root)
    log_path = folder(s, "annotation-log")
    sinks.append_log(log, ["filename", "status"], log_path)
    return prerequisites.unmet(prerequisites.counts(prerequisites.listing(s, root), labels.csv_log(s, log_path, ["filename", "status"])))

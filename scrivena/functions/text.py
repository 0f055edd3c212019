"""Texts, file names and labels."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivena.functions.traces import edit_traces

#: Fixed values.
FORMATS = ("paper", "scan", "screen", "excel", "handwrite")
INDUSTRIES = ("hospital", "convenience", "factory", "office", "food", "etc")
EXTENSIONS = ("jpg", "jpeg", "png", "pdf")
TEXT_TYPES = ("single_char", "date", "handwrite", "normal")
WORK_CODES = ("D", "E", "N", "A", "B", "C", "OFF", "OT", "AL", "SL", "CL", "PH", "AM", "PM", "OP", "MD", "FT", "PT", "Open", "Close", "Mid", "Full", "Part")
UNREADABLE = "###"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), "[.][^.]*$", "")


def edit_distance(a: Column, b: Column) -> Column:
    """On code points."""
    return F.levenshtein(a, b)


def text_type(gt: Column, path: Column) -> Column:
    """As evaluation sorts texts."""
    return F.when(F.lower(path).contains("handwrite"), "handwrite").when(F.char_length(gt) == 1, "single_char").when(gt.rlike(r"^[0-9./:\-~ ]+$"), "date").otherwise("normal")


def training_text_type(text: Column, path: Column) -> Column:
    """As the training sets sort texts; not the same rules."""
    name = F.lower(base_name(path))
    dated = text.rlike("[0-9]") & text.rlike("[/.:-]")
    return F.when(F.char_length(text) == 1, "single_char").when(dated, "date").when(name.contains("hand") | name.contains("write"), "handwrite").otherwise("normal")


def length_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n == 2, "2").when(n <= 5, "3-5").when(n <= 10, "6-10").otherwise("11+")


def dataset_length_bucket(text: Column) -> Column:
    """Of dataset statistics; not the same buckets, and an empty text is in the first."""
    n = F.char_length(text)
    return F.when(n <= 1, "1").when(n <= 4, "2-4").when(n <= 10, "5-10").otherwise("11+")


def filename_parts(path: Column) -> Column:
    """format and industry of an evaluated image's name, 'unknown' where it doesn't say."""
    p = F.split(stem(path), "_")
    synth = (p[0] == "synth") & (F.size(p) >= 4)
    known = F.size(p) >= 3
    pick = lambda i, j: F.when(synth, F.get(p, F.lit(i))).when(known, F.get(p, F.lit(j))).otherwise("unknown")
    return F.struct(pick(1, 0).alias("format"), pick(2, 1).alias("industry"))


def synthetic_format(method: Column) -> Column:
    return F.when(method == "render", "handwrite").otherwise("screen")


def dataset_filename_parts(path: Column) -> Column:
    """format and industry of a dataset image's name; paper and etc where it doesn't say."""
    p = F.split(stem(path), "_")
    synth = p[0] == "synth"
    form = F.when(synth, synthetic_format(F.get(p, F.lit(1)))).otherwise(p[0])
    industry = F.when(synth, F.get(p, F.lit(2))).otherwise(F.get(p, F.lit(1)))
    return F.struct(F.when(form.isin(*FORMATS), form).otherwise("paper").alias("format"), F.when(industry.isin(*INDUSTRIES), industry).otherwise("etc").alias("industry"))


def valid_filename(name: Column) -> Column:
    return name.rlike(f"(?i)^({'|'.join(FORMATS)})_({'|'.join(INDUSTRIES)})_[0-9]{{4}}[.]({'|'.join(EXTENSIONS)})$")


def image_filename(form: Column, industry: Column, sequence: Column, extension: Column) -> Column:
    """Raises for a format, industry or extension that is not one of the known ones."""
    ok = form.isin(*FORMATS) & industry.isin(*INDUSTRIES) & extension.isin(*EXTENSIONS)
    return F.when(ok, F.format_string("%s_%s_%04d.%s", form, industry, sequence, extension)).otherwise(F.raise_error("unknown format, industry or extension"))


def synthetic_filename(method: Column, industry: Column, sequence: Column) -> Column:
    ok = method.isin("render", "aug") & industry.isin(*INDUSTRIES[:-1])
    return F.when(ok, F.format_string("synth_%s_%s_%05d.png", method, industry, sequence)).otherwise(F.raise_error("unknown method or industry"))


def cell_id(import_id: Column, index: Column, row: Column | None = None, col: Column | None = None) -> Column:
    plain = F.format_string("%s_cell%03d", import_id, index)
    if row is None or col is None:
        return plain
    return F.when(row.isNotNull() & col.isNotNull(), F.format_string("%s_row%02d_col%02d", import_id, row, col)).otherwise(plain)


def now_iso() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def resolved(root: Column, path: Column) -> Column:
    """path below root unless it is absolute."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), path))


OPS = "array<struct<op: string, gt: string, pred: string>>"


def edit_ops(pred: Column, gt: Column) -> Column:
    """The edit operations from pred to gt (an extra character of pred is a delete, a missing one of gt an insert), by an
    Arrow function over whole batches; for texts that differ, others have none to trace."""

    @F.arrow_udf(OPS)
    def trace(a: pa.Array, b: pa.Array) -> pa.Array:
        return edit_traces(a, b)

    return trace(pred, gt)

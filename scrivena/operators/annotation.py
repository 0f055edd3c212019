"""Rules of annotation and of answers to a client, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivena.functions import text as t
from scrivena.operators.feedback import enrich, normalize_response

#: Fixed value: the tilt in degrees from which boxes are drawn as polygons.
POLYGON_TILT = 15.0


def needs_polygons(tilt: Column, most: float = POLYGON_TILT) -> Column:
    return F.abs(tilt) > most


def legibility(text: Column, difficult: Column) -> Column:
    """'unreadable' by its mark, else 'difficult' by its flag, else 'normal'."""
    return F.when(text == t.UNREADABLE, "unreadable").when(difficult, "difficult").otherwise("normal")


def equivalent(largest_difference: Column, tolerance: float = 1e-5) -> Column:
    """Whether an exported model's outputs agree with those of the one it was made from."""
    return largest_difference <= tolerance


def roster_payload(results: DataFrame, responses: DataFrame, key: str = "import_id") -> DataFrame:
    """One row a response: key, entries (its cells in order, with their levels and ids, which survive if they are there)
    and the response's fields with their defaults. results: key, pos, text, confidence, bbox, cell_id."""
    cells = enrich(results, key)
    one = F.struct("pos", "text", "confidence", "confidence_level", "cell_id", "bbox")
    entries = cells.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("entries"))
    kind = dict(entries.dtypes)["entries"]
    return normalize_response(responses).join(entries, key, "left").withColumn("entries", F.coalesce("entries", F.array().cast(kind)))

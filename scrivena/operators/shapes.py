"""Shapes of inputs and of the layers that they go through, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivena.functions.scalars import half_even


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("long")


def detection_resize(w: Column, h: Column, longest: int = 960) -> Column:
    """Size after scaling down to the longest side, and after padding to multiples of 32."""
    scale = F.least(F.lit(1.0), F.lit(float(longest)) / F.greatest(w, h))
    rw, rh = (F.greatest(F.lit(32).cast("long"), half_even(x * scale)) for x in (w, h))
    pw, ph = ((F.ceil(x / 32.0) * 32).cast("long") for x in (rw, rh))
    return F.struct(rw.alias("resized_w"), rh.alias("resized_h"), pw.alias("padded_w"), ph.alias("padded_h"), (pw - rw).alias("pad_right"), (ph - rh).alias("pad_bottom"))


def recognition_resize(w: Column, h: Column, height: int = 32, widest: int = 320) -> Column:
    """Width at the fixed height, cut or padded to the widest."""
    rw = F.greatest(F.lit(1).cast("long"), half_even(w * (F.lit(float(height)) / F.greatest(h, F.lit(1)))))
    return F.struct(rw.alias("resized_w"), F.lit(height).cast("long").alias("resized_h"), F.lit(widest).cast("long").alias("final_w"), F.greatest(F.lit(0).cast("long"), widest - rw).alias("pad_right"))


def detection_maps(inputs: DataFrame) -> DataFrame:
    """b, c, h, w -> a row for each feature map: level, stride, and its shape in backbone, neck and head."""
    strides = (4, 8, 16, 32)
    rows = F.array(*(F.struct(F.lit(i + 2).alias("level"), F.lit(s).alias("stride"), _div(F.col("h"), s).alias("map_h"), _div(F.col("w"), s).alias("map_w"), F.lit(256).alias("neck_channels")) for i, s in enumerate(strides)))
    return inputs.select("*", _div(F.col("h"), 4).alias("head_h"), _div(F.col("w"), 4).alias("head_w"), F.explode(rows).alias("m")).select("*", "m.*").drop("m")


def recognition_maps(inputs: DataFrame, vocabulary: int = 11287) -> DataFrame:
    """b, c, h, w -> patch grid, sequence, combining and output shapes of the transformer, and of the recurrent one."""
    q = _div(F.col("w"), 4)
    return inputs.select("*", F.array(F.col("b"), F.lit(128), _div(F.col("h"), 4), q).alias("patch"), F.array(F.col("b"), q * 8, F.lit(128)).alias("sequence"), F.array(F.col("b"), q, F.lit(96)).alias("combined"), F.array(F.col("b"), q, F.lit(vocabulary)).alias("output"), F.array(F.col("b"), F.lit(512), F.lit(1), q).alias("recurrent_features"), F.array(F.col("b"), q, F.lit(512)).alias("recurrent_sequence"))


def classifier_maps(inputs: DataFrame) -> DataFrame:
    return inputs.select("*", F.array(F.col("b"), F.lit(576), _div(F.col("h"), 32), _div(F.col("w"), 32)).alias("features"), F.array(F.col("b"), F.lit(576)).alias("pooled"), F.array(F.col("b"), F.lit(128)).alias("hidden"), F.array(F.col("b"), F.lit(2)).alias("output"))


def detection_issues(c: Column, h: Column, w: Column, longest: int = 960) -> Column:
    rules = ((c != 3, "channels_not_3"), (F.greatest(h, w) > longest, "side_too_long"), ((h % 32 != 0) | (w % 32 != 0), "side_not_multiple_of_32"))
    return F.array_compact(F.array(*(F.when(r, F.lit(n)) for r, n in rules)))


def recognition_issues(c: Column, h: Column, w: Column) -> Column:
    rules = ((c != 3, "channels_not_3"), (h != 32, "height_not_32"), ((w < 8) | (w > 320), "width_out_of_range"))
    return F.array_compact(F.array(*(F.when(r, F.lit(n)) for r, n in rules)))


def classifier_issues(c: Column, h: Column, w: Column) -> Column:
    rules = ((c != 3, "channels_not_3"), ((h != 48) | (w != 192), "size_not_48x192"))
    return F.array_compact(F.array(*(F.when(r, F.lit(n)) for r, n in rules)))


def orientation(upright: Column, turned: Column, threshold: float = 0.5) -> Column:
    return F.when((upright < threshold) & (turned >= upright), "180").otherwise("0")

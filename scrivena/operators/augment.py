"""Augmentation chains: what is done to an image, and where its boxes go, as column expressions.

Every draw is a number in [0, 1) from the seed, the row's key and the name of the draw. No generator has a state, so that a
row's draws don't depend on its neighbours, its partition or on earlier steps, and a rerun of one row gives the same.
Detection boxes go through rotation, crop, flip, perspective and resizing one after the other, as their image would; the
maps are arithmetic on the draws, with no matrix that a task would have to solve. An image's draws are made once, and its
boxes are moved by numpy in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrivena.functions.scalars import half_even
from scrivena.sources.shared import prepare

DEGREE = 0.017453292519943295


@dataclass(frozen=True)
class Step:
    """A step's name, its chance, and the range of its strength; whole: an integer, both ends included."""

    name: str
    chance: float
    low: float = 0.0
    high: float = 0.0
    whole: bool = False


#: The steps in their order.
DETECTION_GEOMETRY = (Step("rotate", 0.5, -10, 10), Step("random_crop", 0.6, 0.75, 1.0), Step("horizontal_flip", 0.3), Step("perspective", 0.3, -0.05, 0.05), Step("resize_jitter", 0.5, 0.5, 2.0))
DETECTION_LIGHT = (
    Step("brightness", 0.7, 0.6, 1.4), Step("contrast", 0.6, 0.7, 1.5), Step("hsv_shift", 0.4), Step("gaussian_noise", 0.4, 1, 8), Step("motion_blur", 0.2, 3, 5, True),
    Step("jpeg_quality", 0.5, 50, 95, True), Step("shadow", 0.25),
)
RECOGNITION_GEOMETRY = (Step("rotate", 0.3, -3, 3), Step("stretch_x", 0.3, 0.9, 1.1), Step("stretch_y", 0.2, 0.9, 1.05))
RECOGNITION_LIGHT = (
    Step("brightness", 0.7, 0.5, 1.5), Step("contrast", 0.6, 0.6, 1.6), Step("gaussian_noise", 0.5, 1, 5), Step("gaussian_blur", 0.3, 0.3, 1.2), Step("jpeg_quality", 0.6, 40, 90, True),
    Step("dilate", 0.25, 1, 2, True), Step("erode", 0.25, 1, 2, True), Step("grayscale", 0.2),
)
CROP_OVERLAP = 0.5


def draw(seed: int, key: Column, name: str) -> Column:
    """In [0, 1), from 32 bits of a hash of seed, key and name."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"), F.lit(f"|{name}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / 4294967296.0


def strength(text_type: Column) -> Column:
    """How far the ranges of recognition steps go, for a type of text."""
    return F.when(text_type == "single_char", 0.5).when(text_type == "handwrite", 0.7).otherwise(1.0)


def _value(u: Column, step: Step, by: Column | None = None) -> Column:
    """A strength; `by` shrinks the range about its centre."""
    if step.whole:
        return (F.floor(u * (step.high - step.low + 1)) + step.low).cast("double")
    if by is None:
        return step.low + u * (step.high - step.low)
    mid, half = (step.low + step.high) / 2, (step.high - step.low) / 2
    return (mid - half * by) + u * (2 * half * by)


def detection_plan(key: Column, seed: int = 42, steps: tuple[Step, ...] = DETECTION_GEOMETRY + DETECTION_LIGHT) -> Column:
    """array<struct<step, value>>: the steps that an image gets, with their strengths."""
    chosen = [F.when(draw(seed, key, s.name) < s.chance, F.struct(F.lit(s.name).alias("step"), _value(draw(seed, key, f"{s.name}.value"), s).alias("value"))) for s in steps]
    return F.array_compact(F.array(*chosen))


def recognition_plan(key: Column, text_type: Column, seed: int = 42) -> Column:
    """The steps of a crop. Ranges shrink for single characters and handwriting; handwriting is lit half as often, dates
    aren't stretched in width and get fewer artefacts of compression; of dilating and eroding one at most."""
    by, written = strength(text_type), text_type == "handwrite"

    def chosen(s: Step) -> Column:
        p = F.lit(s.chance)
        if s in RECOGNITION_LIGHT and s.name not in ("jpeg_quality", "grayscale"):
            p = F.when(written, s.chance * 0.5).otherwise(p)
        if s.name == "jpeg_quality":
            p = F.when(text_type == "date", s.chance * 0.9).otherwise(p)
        on = draw(seed, key, s.name) < p
        return on & (text_type != "date") if s.name == "stretch_x" else on

    steps = RECOGNITION_GEOMETRY + RECOGNITION_LIGHT
    on = {s.name: chosen(s) for s in steps}
    on["erode"] = on["erode"] & ~on["dilate"]
    ranged = ("rotate", "stretch_x", "stretch_y", "brightness", "contrast", "gaussian_noise", "gaussian_blur")
    value = lambda s: _value(draw(seed, key, f"{s.name}.value"), s, by if s.name in ranged else None)
    return F.array_compact(F.array(*(F.when(on[s.name], F.struct(F.lit(s.name).alias("step"), value(s).alias("value"))) for s in steps)))


def homography(corners: list[tuple[Column, Column]]) -> Column:
    """array<double>: the homography from the unit square to four points (upper left, upper right, lower right, lower left),
    in closed form."""
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = corners
    ax, bx, sx = x1 - x2, x3 - x2, x0 - x1 + x2 - x3
    ay, by, sy = y1 - y2, y3 - y2, y0 - y1 + y2 - y3
    det = ax * by - ay * bx
    p, q = (sx * by - sy * bx) / det, (ax * sy - ay * sx) / det
    return F.array(p, q, x1 - x0 + p * x1, x3 - x0 + q * x3, x0, y1 - y0 + p * y1, y3 - y0 + q * y3, y0)


def detection_maps(images: DataFrame, key: str = "image_id", seed: int = 42) -> DataFrame:
    """images: key, w, h (long), other columns. The same rows with what mapped_boxes() needs: which steps an image gets, their
    numbers, and its sizes after them, in columns whose names begin with an underscore. They don't depend on boxes, so that
    they can be drawn before an image's boxes go one a row."""
    u = lambda name: draw(seed, F.col(key), name)
    spec = {s.name: s for s in DETECTION_GEOMETRY}
    value = lambda name: _value(u(f"{name}.value"), spec[name])
    when = lambda name, v: F.when(F.col(f"_{name}"), v)
    w, h, w1, h1 = F.col("w"), F.col("h"), F.col("_w1"), F.col("_h1")
    rows = images.withColumns({f"_{n}": u(n) < spec[n].chance for n in spec})
    rows = rows.withColumns({"_angle": when("rotate", value("rotate")), "_ratio": when("random_crop", value("random_crop")), "_scale": when("resize_jitter", value("resize_jitter"))})
    rows = rows.withColumns({"_cos": F.cos(F.col("_angle") * DEGREE), "_sin": F.sin(F.col("_angle") * DEGREE)})
    rows = rows.withColumns({"_cw": F.greatest(F.lit(1), F.floor(w * F.col("_ratio"))), "_ch": F.greatest(F.lit(1), F.floor(h * F.col("_ratio")))})
    rows = rows.withColumn("_random_crop", F.col("_random_crop") & ((F.col("_cw") < w) | (F.col("_ch") < h)))
    rows = rows.withColumns({"_top": when("random_crop", F.floor(u("random_crop.top") * (h - F.col("_ch") + 1))), "_left": when("random_crop", F.floor(u("random_crop.left") * (w - F.col("_cw") + 1)))})
    rows = rows.withColumns({"_w1": when("random_crop", F.col("_cw")).otherwise(w), "_h1": when("random_crop", F.col("_ch")).otherwise(h)})
    far = lambda name, side: side * _value(u(f"perspective.{name}"), spec["perspective"])
    corners = {f"_x{i}": when("perspective", (w1 - 1) * int(i in (1, 2)) + far(f"x{i}", w1)) for i in range(4)} | {f"_y{i}": when("perspective", (h1 - 1) * int(i in (2, 3)) + far(f"y{i}", h1)) for i in range(4)}
    rows = rows.withColumns(corners)
    rows = rows.withColumn("_map", when("perspective", homography([(F.col(f"_x{i}"), F.col(f"_y{i}")) for i in range(4)]))).drop(*corners)
    rows = rows.withColumns({"_tw": when("resize_jitter", F.greatest(F.lit(1), half_even(w1 * F.col("_scale")))), "_th": when("resize_jitter", F.greatest(F.lit(1), half_even(h1 * F.col("_scale"))))})
    return rows.withColumns({"_sx": F.col("_tw") / w1, "_sy": F.col("_th") / h1}).drop("_angle", "_ratio", "_scale")


def _mapped(v: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Clamped to the image, in whole pixels; like SQL's greatest and least, without regard to what is missing (nan)."""
    return np.trunc(np.fmax(0, np.fmin(v, most - 1)))


def _bounds(xs: list[np.ndarray], ys: list[np.ndarray], w: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    low, high = np.fmin.reduce, np.fmax.reduce
    return [_mapped(low(xs), w), _mapped(low(ys), h), _mapped(high(xs), w), _mapped(high(ys), h)]


def _moved(b: list[np.ndarray], of: np.ndarray, v: dict[str, np.ndarray]) -> np.ndarray:
    """Moves boxes (x1, y1, x2, y2) of the images `of`, in place; which are left. v: an image's columns of detection_maps()."""
    left = np.ones(len(of), bool)

    def some(name: str) -> tuple[np.ndarray, list[np.ndarray], Callable]:
        rows = np.flatnonzero(v[f"_{name}"][of])
        image = of[rows]
        return rows, [c[rows] for c in b], lambda c: v[c][image]

    def put(rows: np.ndarray, values) -> None:
        for c, new in zip(b, values):
            c[rows] = new

    corners = lambda x1, y1, x2, y2: [(x, y) for x in (x1, x2) for y in (y1, y2)]
    rows, old, of_image = some("rotate")
    c, s, w, h = (of_image(k) for k in ("_cos", "_sin", "w", "h"))
    cx, cy = w / 2.0, h / 2.0
    p, q = (1 - c) * cx - s * cy, s * cx + (1 - c) * cy
    put(rows, _bounds([x * c + y * s + p for x, y in corners(*old)], [x * -s + y * c + q for x, y in corners(*old)], w, h))
    rows, (x1, y1, x2, y2), of_image = some("random_crop")
    px, py, w, h = (of_image(k) for k in ("_left", "_top", "_cw", "_ch"))
    area = np.fmax(0, x2 - x1) * np.fmax(0, y2 - y1)
    x1, y1, x2, y2 = np.fmax(x1, px), np.fmax(y1, py), np.fmin(x2, px + w), np.fmin(y2, py + h)
    left[rows] = (area > 0) & (np.fmax(0, x2 - x1) * np.fmax(0, y2 - y1) / area >= CROP_OVERLAP)
    put(rows, (x1 - px, y1 - py, x2 - px, y2 - py))
    rows, (x1, y1, x2, y2), of_image = some("horizontal_flip")
    put(rows, (of_image("_w1") - x2, y1, of_image("_w1") - x1, y2))
    rows, old, of_image = some("perspective")
    w, h, m = of_image("_w1"), of_image("_h1"), of_image("_map").T
    at = [(x / (w - 1), y / (h - 1)) for x, y in corners(*old)]
    far = [m[0] * x + m[1] * y + 1 for x, y in at]
    put(rows, _bounds([(m[2] * x + m[3] * y + m[4]) / d for (x, y), d in zip(at, far)], [(m[5] * x + m[6] * y + m[7]) / d for (x, y), d in zip(at, far)], w, h))
    rows, old, of_image = some("resize_jitter")
    put(rows, [np.rint(k * of_image(n)) for k, n in zip(old, ("_sx", "_sy", "_sx", "_sy"))])
    for k, n in zip(b, ("_w2", "_h2", "_w2", "_h2")):
        k[:] = np.fmax(0, np.fmin(k, v[n][of] - 1))
    return left & (b[2] > b[0]) & (b[3] > b[1])


def _move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v = {}
        for name in MAPS:
            col = batch.column(name)
            if name == "_map":
                v[name] = np.full((len(col), 8), np.nan)
                v[name][col.is_valid().to_numpy(zero_copy_only=False)] = col.flatten().to_numpy().reshape(-1, 8)
            else:
                flag = pa.types.is_boolean(col.type)
                v[name] = (pc.fill_null(col, False) if flag else col.cast(pa.float64())).to_numpy(zero_copy_only=False)
        v |= {n: batch.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in ("w", "h")}
        boxes, known = batch.column("boxes"), batch.column("boxes").is_valid()
        sizes = pc.fill_null(pc.list_value_length(boxes), 0).to_numpy(zero_copy_only=False)
        of, flat = np.repeat(np.arange(len(sizes)), sizes), boxes.flatten()
        fields = dict(zip([f.name for f in flat.type], flat.flatten()))
        b = [np.array(fields[c].cast(pa.float64()).to_numpy(zero_copy_only=False)) for c in SIDES]
        with np.errstate(all="ignore"):
            left = np.flatnonzero(_moved(b, of, v))
        out = {n: pa.array(b[SIDES.index(n)][left].astype(np.int64)) if n in SIDES else x.take(pa.array(left)) for n, x in fields.items()}
        ends = np.concatenate(([0], np.cumsum(np.bincount(of[left], minlength=len(sizes))))).astype(np.int32)
        items = pa.StructArray.from_arrays(list(out.values()), names=list(out))
        lists = pa.ListArray.from_arrays(pa.array(ends), items, mask=pc.invert(known))
        names = [n for n in batch.schema.names if n not in (*MAPS, "w", "h", "boxes")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pc.cast(batch.column(n), pa.int64()) for n in ("_w2", "_h2")), lists], names=[*names, "w", "h", "boxes"])


def mapped_boxes(rows: DataFrame) -> DataFrame:
    """rows: those of detection_maps(), with boxes array<struct<x1, y1, x2, y2>> (long; other fields go along). The same rows
    with the size and the boxes after the steps, those that are left, and `applied`, the names of the steps. Boxes are moved
    in Arrow batches, all of a batch at once; missing coordinates count as SQL's greatest and least take them."""
    step = lambda name, a, b: F.when(F.col(f"_{name}"), a).otherwise(b).cast("long")
    applied = F.array_compact(F.array(*(F.when(F.col(f"_{s.name}"), F.lit(s.name)) for s in DETECTION_GEOMETRY)))
    rows = rows.withColumns({"_w2": step("resize_jitter", F.col("_tw"), F.col("_w1")), "_h2": step("resize_jitter", F.col("_th"), F.col("_h1")), "applied": applied})
    rows = rows.drop("_tw", "_th")
    own = [f for f in rows.schema if f.name not in (*MAPS, "w", "h", "boxes")]
    schema = T.StructType([*own, T.StructField("w", T.LongType()), T.StructField("h", T.LongType()), rows.schema["boxes"]])
    prepare(rows.sparkSession)
    out = rows.mapInArrow(_move, schema)
    return out.select(*(F.col(f"`{f.name}`") for f in own if f.name != "applied"), "w", "h", "boxes", "applied")


SIDES = ("x1", "y1", "x2", "y2")
#: Columns that boxes need besides an image's first size.
MAPS = (*(f"_{s.name}" for s in DETECTION_GEOMETRY), "_cos", "_sin", "_cw", "_ch", "_top", "_left", "_w1", "_h1", "_map", "_sx", "_sy", "_w2", "_h2")


def detection_boxes(images: DataFrame, key: str = "image_id", seed: int = 42) -> DataFrame:
    """images: key, w, h (long), boxes array<struct<x1, y1, x2, y2>> (long), other columns. The same rows with the size and
    the boxes after an image's steps, those that are left, and `applied`, the names of the steps."""
    return mapped_boxes(detection_maps(images, key, seed))

"""Boxes: structs of x1, y1, x2, y2 (doubles or longs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrivena.functions.scalars import half_even, safe_div


def box(x1, y1, x2, y2) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(lit(x1).alias("x1"), lit(y1).alias("y1"), lit(x2).alias("x2"), lit(y2).alias("y2"))


def box_of(array: Column) -> Column:
    """From an array [x1, y1, x2, y2]."""
    return box(array[0], array[1], array[2], array[3])


def normalized(b: Column) -> Column:
    """Corners in order."""
    return box(F.least(b["x1"], b["x2"]), F.least(b["y1"], b["y2"]), F.greatest(b["x1"], b["x2"]), F.greatest(b["y1"], b["y2"]))


def area(b: Column) -> Column:
    """Zero for a box that is turned inside out."""
    return (F.greatest(F.lit(0), b["x2"] - b["x1"]) * F.greatest(F.lit(0), b["y2"] - b["y1"])).cast("double")


def overlap(a: Column, b: Column) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return (F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)).cast("double")


def iou_raw(a: Column, b: Column) -> Column:
    """Intersection over union of boxes as they are: no overlap gives 0."""
    both = overlap(a, b)
    return F.when(both <= 0, 0.0).otherwise(safe_div(both, area(a) + area(b) - both))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes with their corners put in order."""
    return iou_raw(normalized(a), normalized(b))


def centre_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2.0


def centre_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2.0


def width(b: Column) -> Column:
    return F.greatest(F.lit(1), b["x2"] - b["x1"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(1), b["y2"] - b["y1"])


def unclip(b: Column, ratio: float = 1.5) -> Column:
    """Grown about the centre."""
    cx, cy = centre_x(b), centre_y(b)
    hw, hh = (b["x2"] - b["x1"]) * (ratio / 2), (b["y2"] - b["y1"]) * (ratio / 2)
    return box(half_even(cx - hw), half_even(cy - hh), half_even(cx + hw), half_even(cy + hh))


def reverse_padding(b: Column, top, left, scale_x=1.0, scale_y=1.0) -> Column:
    """From padded and scaled coordinates to those before."""
    return box(half_even((b["x1"] - left) / scale_x), half_even((b["y1"] - top) / scale_y), half_even((b["x2"] - left) / scale_x), half_even((b["y2"] - top) / scale_y))


def clip(b: Column, w, h) -> Column:
    """Clamped to [0, w] x [0, h], corners in order."""
    at = lambda v, most: F.greatest(F.lit(0), F.least(v, most if isinstance(most, Column) else F.lit(most)))
    return normalized(box(at(b["x1"], w), at(b["y1"], h), at(b["x2"], w), at(b["y2"], h)))


def restore(b: Column, padded_w, padded_h, top, left, width, height) -> Column:
    """From a padded detection input to the original image; the scale is padded size over original size."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    sx, sy = lit(padded_w) / lit(width), lit(padded_h) / lit(height)
    return clip(reverse_padding(b, top, left, sx, sy), width, height)


def clip_all(boxes: Column, w, h) -> Column:
    """An array of boxes clamped to the last pixels; those without area go."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    at = lambda v, most: F.greatest(F.lit(0), F.least(v, most - 1))
    moved = F.transform(boxes, lambda b: box(at(b["x1"], lit(w)), at(b["y1"], lit(h)), at(b["x2"], lit(w)), at(b["y2"], lit(h))))
    return F.filter(moved, lambda b: (b["x2"] > b["x1"]) & (b["y2"] > b["y1"]))


def intersection(a: Column, b: Column) -> Column:
    """Null where boxes don't meet."""
    both = box(F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]), F.least(a["x2"], b["x2"]), F.least(a["y2"], b["y2"]))
    return F.when((both["x2"] > both["x1"]) & (both["y2"] > both["y1"]), both)


def polygon(b: Column) -> Column:
    """Four corners, clockwise from the upper left."""
    return F.array(F.array(b["x1"], b["y1"]), F.array(b["x2"], b["y1"]), F.array(b["x2"], b["y2"]), F.array(b["x1"], b["y2"]))


def box_of_points(points: Column) -> Column:
    """The bounding box of an array of [x, y]."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def mapped(b: Column, to, w, h) -> Column:
    """Bounding box of the corners under a map of points, clamped to the image, in whole pixels. The map is written into
    the expression once, whatever it takes."""
    whole = lambda v, most: F.greatest(F.lit(0), F.least(v, F.lit(most).cast("double") - 1)).cast("long")
    corners = F.array(*(F.struct(b[x].alias("x"), b[y].alias("y")) for x in ("x1", "x2") for y in ("y1", "y2")))

    def moved(p: Column) -> Column:
        x, y = to(p["x"], p["y"])
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def bounds(at: Column) -> Column:
        xs, ys = F.transform(at, lambda p: p["x"]), F.transform(at, lambda p: p["y"])
        return box(whole(F.array_min(xs), w), whole(F.array_min(ys), h), whole(F.array_max(xs), w), whole(F.array_max(ys), h))

    return F.transform(F.array(F.transform(corners, moved)), bounds)[0]


def affine(b: Column, m: list[list[float]], w: int, h: int) -> Column:
    """Bounding box of the corners under a 2 x 3 matrix, clamped to the image."""
    return mapped(b, lambda x, y: (x * m[0][0] + y * m[0][1] + m[0][2], x * m[1][0] + y * m[1][1] + m[1][2]), w, h)


def perspective(b: Column, m: list[list[float]], w: int, h: int) -> Column:
    """Bounding box of the corners under a 3 x 3 homography, clamped to the image."""

    def to(x: Column, y: Column) -> tuple[Column, Column]:
        d = x * m[2][0] + y * m[2][1] + m[2][2]
        return safe_div(x * m[0][0] + y * m[0][1] + m[0][2], d), safe_div(x * m[1][0] + y * m[1][1] + m[1][2], d)

    return mapped(b, to, w, h)


def flip(b: Column, w) -> Column:
    """Mirrored left to right in an image of width w."""
    return box(w - b["x2"], b["y1"], w - b["x1"], b["y2"])


def scaled(b: Column, s) -> Column:
    return box(*(half_even(b[k] * s) for k in ("x1", "y1", "x2", "y2")))


def cropped(boxes: Column, crop: Column, least: float = 0.5) -> Column:
    """Boxes that a crop holds at least this share of, moved to its corner."""
    kept = F.filter(boxes, lambda b: (area(b) > 0) & (safe_div(overlap(b, crop), area(b)) >= least))
    cut = F.transform(kept, lambda b: intersection(b, crop))
    return F.transform(cut, lambda b: box(b["x1"] - crop["x1"], b["y1"] - crop["y1"], b["x2"] - crop["x1"], b["y2"] - crop["y1"]))


def extreme_ratio(b: Column) -> Column:
    """More than ten times as long as wide, either way."""
    w, h = (F.greatest(F.lit(1e-6), b[p] - b[q]) for p, q in (("x2", "x1"), ("y2", "y1")))
    return (w / h > 10) | (w / h < 0.1)

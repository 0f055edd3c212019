"""Images as tables of pixels: thresholds, sharpness, orientation and skew, as aggregates over pixels.

A pixel table has a key, x, y and v (grey, 0 to 255, not null); `size` columns w and h go along. A pixel is a small row, and
what is shuffled are sums: histograms of 256 bins, profiles of one value a row and angle, which Arrow batches of pixels add
up before. Where pixels need their neighbours, they are gathered into lines: key, w, h, y and v, the greys of a line. No
image is held whole by a task, so that a scanned plan of any size is measured like a thumbnail.

Rotations work in whole numbers, with sines and cosines in units of 2**-16, so that every engine and every run puts a pixel
into the same row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.operators.shapes import detection_resize, recognition_resize
from scrivena.sources.shared import folder

UNIT = 16
#: Pixels that a task works on at once.
STRIP = 1 << 20


def angles(low: float, high: float, step: float) -> list[tuple[float, int, int]]:
    """(degrees, cosine, sine), both in units of 2**-16, from low to high."""
    found = [low + i * step for i in range(int(math.floor((high - low) / step + 1e-9)) + 1)]
    return [(a, round(math.cos(math.radians(a)) * (1 << UNIT)), round(math.sin(math.radians(a)) * (1 << UNIT))) for a in found]


def exploded(images: DataFrame, key: str, image: str = "image") -> DataFrame:
    """key, w, h, x, y, v from image structs of one or three channels (blue, green, red)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, height, width, channels, data in zip(*(b.column(c).to_pylist() for c in ("key", "height", "width", "channels", "data"))):
                a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
                grey = (a[:, :, 0] if channels == 1 else np.rint(a[:, :, :3] @ np.array([0.114, 0.587, 0.299]))).astype(np.int64).ravel()
                y, x = np.divmod(np.arange(height * width), width)
                for i in range(0, len(grey), 1 << 16):
                    s = slice(i, i + (1 << 16))
                    n = len(grey[s])
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(k, b.schema.field("key").type), n), *(pa.array(np.full(n, v, np.int64)) for v in (width, height)), pa.array(x[s]), pa.array(y[s]), pa.array(grey[s])], names=[key, "w", "h", "x", "y", "v"])

    kind = dict(images.dtypes)[key]
    rows = images.where(F.col(f"{image}.data").isNotNull()).select(F.col(key).alias("key"), *(F.col(f"{image}.{c}").alias(c) for c in ("height", "width", "channels", "data")))
    return rows.mapInArrow(run, f"`{key}` {kind}, w long, h long, x long, y long, v long")


def threshold(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """key, cut: Otsu's threshold, the first value that parts the histogram best; pixels up to it are dark."""
    return _threshold(pixels.groupBy(key, "v").agg(F.count("*").alias("n")), key)


def _threshold(bins: DataFrame, key: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)  # 256 rows at most
    whole = Window.partitionBy(key)
    at = bins.select(key, "v", F.sum("n").over(w).alias("n0"), F.sum(F.col("n") * F.col("v")).over(w).alias("m0"), F.sum("n").over(whole).alias("n"), F.sum(F.col("n") * F.col("v")).over(whole).alias("m"))
    apart = F.col("m") * F.col("n0") - F.col("m0") * F.col("n")
    score = F.when(F.col("n0") < F.col("n"), apart.cast("double") * apart / (F.col("n0").cast("double") * (F.col("n") - F.col("n0")))).otherwise(0.0)
    return at.groupBy(key).agg(F.max_by("v", F.struct(score, -F.col("v"))).alias("cut"))


def laplacian(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """The pixels with l, the sum of the four neighbours less four times the value; borders are mirrored.

    Each pixel hands its value to its neighbours, so that neighbours meet in sums and not in joins."""
    x, y, w, h, v = (F.col(c) for c in ("x", "y", "w", "h", "v"))

    def to(dx: int, dy: int) -> Column:
        # The one next to the border stands for the one beyond it too.
        tx, ty = x + dx, y + dy
        edge = (tx == (0 if dx < 0 else w - 1)) if dx else (ty == (0 if dy < 0 else h - 1))
        inside = (tx >= 0) & (tx < w) & (ty >= 0) & (ty < h)
        none = F.lit(None).cast("long")
        return F.when(inside, F.struct(tx.alias("x"), ty.alias("y"), (v * F.when(edge, 2).otherwise(1)).cast("long").alias("l"), none.alias("v")))

    # A line of one pixel has no neighbours in its other direction but itself.
    alone = v * (F.when(w == 1, 2).otherwise(0) + F.when(h == 1, 2).otherwise(0))
    own = F.struct(x.alias("x"), y.alias("y"), (alone - 4 * v).cast("long").alias("l"), v.cast("long").alias("v"))
    given = F.array_compact(F.array(own, to(1, 0), to(-1, 0), to(0, 1), to(0, -1)))
    rows = pixels.select(key, "w", "h", F.explode(given).alias("g"))
    return rows.groupBy(key, "w", "h", F.col("g.x").alias("x"), F.col("g.y").alias("y")).agg(F.max("g.v").alias("v"), F.sum("g.l").alias("l"))


def sharpness(edges: DataFrame, key: str = "image_id") -> DataFrame:
    """key, sharpness: the variance of l."""
    n, s, q = F.count("*"), F.sum("l"), F.sum(F.col("l") * F.col("l"))
    return edges.groupBy(key).agg(((q * n - s * s).cast("double") / (n * n).cast("double")).alias("sharpness"))


def orientation(pixels: DataFrame, key: str = "image_id", least: float = 5.0) -> DataFrame:
    """key, turned: whether the mean of the lowest quarter is below that of the highest by more than `least`. The darker end
    is the upper one of an upright image."""
    q = F.greatest(F.lit(1), F.expr("h div 4"))
    mean = lambda c: F.avg(F.when(c, F.col("v")))
    return pixels.groupBy(key).agg((mean(F.col("y") >= F.col("h") - q) < mean(F.col("y") < q) - least).alias("turned"))


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in slices of about STRIP pixels (one line at least)."""
    for b in batches:
        ends = np.cumsum(b.column("v").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + STRIP, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def _longs(b: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _flat(b: pa.RecordBatch, name: str = "v") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all lines, the line of each, and its place there."""
    n = b.column(name).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(len(n)), n)
    return b.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64), line, np.arange(len(line)) - (np.cumsum(n) - n)[line]


def _keys(b: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """The number of each row's key among the batch's keys, and those."""
    d = b.column("key").dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _written(rows: DataFrame, name: str) -> DataFrame:
    """rows, once written: several sums read them."""
    path = folder(rows.sparkSession, name)
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def gathered(pixels: DataFrame, key: str = "image_id") -> DataFrame:
    """key, w, h, y, v: the lines of a pixel table. Neighbours that come one after the other are joined before the shuffle,
    which is by key alone, so that all of an image's lines lie in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code, _ = _keys(b)
            x, y = _longs(b, "x", "y")
            new = np.flatnonzero(np.concatenate(([True], (np.diff(code) != 0) | (np.diff(y) != 0) | (np.diff(x) != 1))))
            head = b.take(pa.array(new))
            parts = pa.ListArray.from_arrays(pa.array(np.append(new, b.num_rows), pa.int32()), b.column("v").cast(pa.int64()))
            yield pa.RecordBatch.from_arrays([head.column(c) for c in ("key", "w", "h", "y", "x")] + [parts], names=["key", "w", "h", "y", "x", "v"])

    kind = dict(pixels.dtypes)[key]
    rows = pixels.select(F.col(key).alias("key"), *(F.col(c).cast("long").alias(c) for c in ("w", "h", "x", "y", "v")))
    rows = rows.mapInArrow(run, f"key {kind}, w long, h long, y long, x long, v array<long>").repartition("key")
    lines = rows.groupBy("key", "w", "h", "y").agg(F.array_sort(F.collect_list(F.struct("x", "v"))).alias("p"))
    return lines.select(F.col("key").alias(key), "w", "h", "y", F.flatten(F.transform("p", lambda p: p["v"])).alias("v"))


def _profiles(code: np.ndarray, h: np.ndarray, w: np.ndarray, x: np.ndarray, y: np.ndarray, sides: np.ndarray, table: list) -> list[tuple[list, list]]:
    """For each key, the bins (angle times height, plus row) that dark pixels fall into, and how many in each."""
    first = np.cumsum(sides) - sides
    px, py, base, total = 2 * x + 1 - w, 2 * y + 1 - h, first[code], int(sides.sum())
    bins, count = [], []
    for i, (_, c, s) in enumerate(table):
        row, col = (c * py - s * px + (h << UNIT)) >> (UNIT + 1), (c * px + s * py + (w << UNIT)) >> (UNIT + 1)
        n = np.bincount((base + row)[(row >= 0) & (row < h) & (col >= 0) & (col < w)], minlength=total)
        at = np.flatnonzero(n)
        bins.append(at + i * total)
        count.append(n[at])
    at, n = np.concatenate(bins), np.concatenate(count)
    own = np.searchsorted(first, at % total, side="right") - 1
    order = np.argsort(own, kind="stable")
    at, n, own = at[order], n[order], own[order]
    cut = np.searchsorted(own, np.arange(len(sides) + 1))
    return [((at[a:b] // total * sides[k] + at[a:b] % total - first[k]), n[a:b]) for k, (a, b) in enumerate(zip(cut, cut[1:]))]


def _skew(parts: DataFrame, key: str, table: list, low: float, step: float) -> DataFrame:
    """key, angle from partial profiles: key, h, p struct<bins, n>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for h, ps in zip(b.column("h").to_pylist(), b.column("ps")):
                part = ps.values
                bins, n = (part.field(f).flatten().to_numpy(zero_copy_only=False) for f in ("bins", "n"))
                rows = np.zeros(len(table) * h, np.int64)
                np.add.at(rows, bins, n)
                rows = rows.reshape(len(table), h)
                # The variance over all rows, times the square of their number: whole numbers, which compare exactly.
                score = (rows * rows).sum(axis=1) * h - rows.sum(axis=1) ** 2
                score[rows.sum(axis=1) == 0] = -1
                found.append(low + int(np.argmax(score)) * step)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(found, pa.float64())], names=["key", "angle"])

    kind = dict(parts.dtypes)["key"]
    return parts.groupBy("key", "h").agg(F.collect_list("p").alias("ps")).mapInArrow(run, f"key {kind}, angle double").withColumnRenamed("key", key)


_PART = "h long, p struct<bins: array<long>, n: array<long>>"


def _part(keys: pa.Array, sides: np.ndarray, found: list) -> pa.RecordBatch:
    some = [k for k, (bins, _) in enumerate(found) if len(bins)]
    ends = np.cumsum([0] + [len(found[k][0]) for k in some])
    both = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([found[k][j] for k in some]) if some else [], pa.int64())) for j in (0, 1)]
    return pa.RecordBatch.from_arrays([keys.take(pa.array(some, pa.int64())), pa.array(sides[some], pa.int64()), pa.StructArray.from_arrays(both, ["bins", "n"])], names=["key", "h", "p"])


def skew(dark: DataFrame, key: str = "image_id", low: float = -15.0, high: float = 15.0, step: float = 0.5) -> DataFrame:
    """key, angle: the rotation (degrees, counter-clockwise) that makes the rows of dark pixels most unlike each other. dark:
    key, w, h, x, y. Of equal angles the least; images without dark pixels have no row. Each batch of pixels is turned by
    all angles and leaves only how many fall into each row."""
    table = angles(low, high, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code, keys = _keys(b)
                w, h, x, y = _longs(b, "w", "h", "x", "y")
                sides = np.zeros(len(keys), np.int64)
                sides[code] = h
                yield _part(keys, sides, _profiles(code, h, w, x, y, sides, table))

    rows = dark.select(F.col(key).alias("key"), *(F.col(c).cast("long").alias(c) for c in ("w", "h", "x", "y")))
    return _skew(rows.mapInArrow(run, f"key {dict(dark.dtypes)[key]}, {_PART}"), key, table, low, step)


def _line_skew(lines: DataFrame, key: str, low: float, high: float, step: float) -> DataFrame:
    """skew() of lines, whose dark pixels are those up to `cut`."""
    table = angles(low, high, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _strips(batches):
            code, keys = _keys(b)
            w, h, y, cut = _longs(b, "w", "h", "y", "cut")
            v, line, x = _flat(b)
            dark = v <= cut[line]
            line, x = line[dark], x[dark]
            sides = np.zeros(len(keys), np.int64)
            sides[code] = h
            yield _part(keys, sides, _profiles(code[line], h[line], w[line], x, y[line], sides, table))

    rows = lines.select(F.col(key).alias("key"), "w", "h", "y", "cut", "v")
    return _skew(rows.mapInArrow(run, f"key {dict(lines.dtypes)[key]}, {_PART}"), key, table, low, step)


def _line_edges(lines: DataFrame, key: str) -> DataFrame:
    """The lines with l, the laplacian() of each pixel; lines come from gathered()."""
    w = Window.partitionBy(key).orderBy("y")
    # Beyond the border, the line next to it stands for the one that isn't there.
    near = lines.select(F.col(key).alias("key"), "w", "h", "y", "v", F.lag("v").over(w).alias("up"), F.lead("v").over(w).alias("down"))
    near = near.withColumns({"up": F.coalesce("up", "down", "v"), "down": F.coalesce("down", "up", "v")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _strips(batches):
            v, line, x = _flat(b)
            last = np.repeat(b.column("v").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), b.column("v").value_lengths().to_numpy(zero_copy_only=False)) - 1
            at = np.arange(len(v))
            left = v[np.where(x > 0, at - 1, at + (last > 0))]
            right = v[np.where(x < last, at + 1, at - (last > 0))]
            l = left + right + _flat(b, "up")[0] + _flat(b, "down")[0] - 4 * v
            ends = np.append(0, np.cumsum(b.column("v").value_lengths().to_numpy(zero_copy_only=False)))
            sums = lambda a: np.add.reduceat(a, ends[:-1])
            cols = [*(b.column(c) for c in ("key", "w", "h", "y", "v")), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(l)), pa.array(np.diff(ends), pa.int64()), pa.array(sums(l)), pa.array(sums(l * l))]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "w", "h", "y", "v", "l", "n", "s", "q"])

    return near.mapInArrow(run, f"key {dict(lines.dtypes)[key]}, w long, h long, y long, v array<long>, l array<long>, n long, s long, q long").withColumnRenamed("key", key)


def _line_bins(lines: DataFrame, key: str) -> DataFrame:
    """key, v, n: partial histograms of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _strips(batches):
            code, keys = _keys(b)
            v, line, _ = _flat(b)
            low = int(v.min())
            wide = int(v.max()) - low + 1
            at, n = np.unique(code[line] * wide + v - low, return_counts=True)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at // wide)), pa.array(at % wide + low), pa.array(n.astype(np.int64))], names=["key", "v", "n"])

    return lines.select(F.col(key).alias("key"), "v").mapInArrow(run, f"key {dict(lines.dtypes)[key]}, v long, n long").withColumnRenamed("key", key)


def prepared(pixels: DataFrame, key: str = "image_id", mode: str = "det", sharp: float = 500.0, least: float = 0.5, most: float = 30.0, low: float = -15.0, high: float = 15.0, step: float = 0.5) -> DataFrame:
    """What the preparation of each image comes to: turned upright, sharpened where it is blurred, the skew that is taken
    out, and its sizes; mode is 'det' or 'rec'. An image's name or number is the key; images are upright or on their head.

    key, w, h, angle_corrected, sharpness, sharpened, deskew_angle, padded_w, padded_h, warning. A skew below `least` counts
    as none; one above `most` is stated, not corrected. Skew is measured on the sharpened pixels.
    """
    if mode not in ("det", "rec"):
        raise ValueError(f"unknown mode {mode}")
    lines = _written(gathered(pixels, key), "lines")
    q = F.greatest(F.lit(1), F.expr("h div 4"))
    total, n = F.aggregate("v", F.lit(0).cast("long"), lambda a, v: a + v), F.size("v")
    mean = lambda c: F.sum(F.when(c, total)).cast("double") / F.sum(F.when(c, n))
    ways = lines.groupBy(key, "w", "h").agg((mean(F.col("y") >= F.col("h") - q) < mean(F.col("y") < q) - 5.0).alias("turned"))
    up = lines.join(ways.select(key, "turned"), key)
    up = up.withColumns({"y": F.when(F.col("turned"), F.col("h") - 1 - F.col("y")).otherwise(F.col("y")), "v": F.when(F.col("turned"), F.reverse("v")).otherwise(F.col("v"))})
    edges = _written(_line_edges(up.drop("turned"), key), "edges")
    s_, q_, n_ = F.sum("s"), F.sum("q"), F.sum("n")
    sharp_ = edges.groupBy(key).agg(((q_ * n_ - s_ * s_).cast("double") / (n_ * n_).cast("double")).alias("sharpness"))
    v = F.when(F.col("sharpness") < sharp, F.zip_with("v", "l", lambda a, b: F.greatest(F.lit(0).cast("long"), F.least(F.lit(255).cast("long"), a - b)))).otherwise(F.col("v"))
    clear = edges.join(sharp_, key).select(key, "w", "h", "y", v.alias("v"))
    cut = _threshold(_line_bins(clear, key).groupBy(key, "v").agg(F.sum("n").alias("n")), key)
    out = ways.join(sharp_, key).join(_line_skew(clear.join(cut, key), key, low, high, step), key, "left")
    angle = F.coalesce("angle", F.lit(0.0))
    shape = detection_resize(F.col("w"), F.col("h")) if mode == "det" else recognition_resize(F.col("w"), F.col("h"))
    pw, ph = ("padded_w", "padded_h") if mode == "det" else ("final_w", "resized_h")
    return out.select(
        key, "w", "h", F.col("turned").alias("angle_corrected"), "sharpness", (F.col("sharpness") < sharp).alias("sharpened"), F.when(F.abs(angle) < least, 0.0).otherwise(angle).alias("deskew_angle"),
        (F.abs(angle).between(least, most)).alias("deskewed"), shape[pw].alias("padded_w"), shape[ph].alias("padded_h"), F.when(F.least("w", "h") < 720, "resolution_below_720px").alias("warning"),
    )

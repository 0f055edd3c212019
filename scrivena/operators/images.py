"""Pixel operators over image structs (height, width, channels, data), as Arrow functions in numpy.

Decoding of files and warping need libraries that are not there; boxes and shapes of such steps are in functions.geometry
and operators.shapes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE = "struct<height: int, width: int, channels: int, data: binary>"


def array_of(row) -> np.ndarray:
    return np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["channels"])


def struct_of(x: np.ndarray) -> dict:
    x = np.ascontiguousarray(x if x.ndim == 3 else x[:, :, None])
    return {"height": x.shape[0], "width": x.shape[1], "channels": x.shape[2], "data": x.tobytes()}


def _rows(v) -> list:
    return v.to_dict("records") if isinstance(v, pd.DataFrame) else list(v)


def mapped(f: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """A pixel function as a column function; null images stay null."""

    @F.pandas_udf(IMAGE)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [struct_of(f(array_of(r))) if isinstance(r["data"], (bytes, bytearray)) else {} for r in _rows(b)]
            yield pd.DataFrame(found, columns=["height", "width", "channels", "data"])

    return run


def measured(f: Callable[[np.ndarray], float]) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([float(f(array_of(r))) if isinstance(r["data"], (bytes, bytearray)) else None for r in _rows(b)], dtype="float64")

    return run


def _clip(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def bgr(x: np.ndarray) -> np.ndarray:
    """Three channels of bytes; transparency lies on white."""
    x = x if x.ndim == 3 else x[:, :, None]
    if x.shape[2] == 1:
        return np.repeat(x, 3, axis=2)
    if x.shape[2] == 4:
        a = x[:, :, 3:].astype(np.float64) / 255
        return _clip(x[:, :, :3] * a + 255 * (1 - a))
    return x


def gray(x: np.ndarray) -> np.ndarray:
    return bgr(x).astype(np.float64) @ np.array([0.114, 0.587, 0.299])


def convolve(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """A small kernel over a plane, borders mirrored."""
    k = kernel.shape[0] // 2
    p = np.pad(x.astype(np.float64), k, mode="reflect" if min(x.shape) > k else "edge")
    return sum(kernel[i, j] * p[i : i + x.shape[0], j : j + x.shape[1]] for i in range(2 * k + 1) for j in range(2 * k + 1))


def rotated(angle: int) -> Callable[[Column], Column]:
    if angle % 90:
        raise ValueError("quarter turns only")
    return mapped(lambda x: np.rot90(x, -(angle // 90) % 4))


def flipped() -> Callable[[Column], Column]:
    return mapped(lambda x: x[:, ::-1])


def brightness(factor: float) -> Callable[[Column], Column]:
    return mapped(lambda x: _clip(x.astype(np.float64) * factor))


def contrast(factor: float) -> Callable[[Column], Column]:
    return mapped(lambda x: _clip((x - (m := x.mean(axis=(0, 1), keepdims=True))) * factor + m))


def noise(sigma: float, seed: int) -> Callable[[Column], Column]:
    """Gaussian noise that depends on the seed and on what the image holds, so that no two images get the same."""

    def f(x: np.ndarray) -> np.ndarray:
        return _clip(x + np.random.default_rng([seed, zlib.crc32(x.tobytes()), x.shape[0], x.shape[1]]).normal(0, sigma, x.shape))

    return mapped(f)


def shadow(least: float, seed: int) -> Callable[[Column], Column]:
    """A ramp from one side to the other, the side by the seed."""

    def f(x: np.ndarray) -> np.ndarray:
        ramp = np.linspace(least, 1.0, x.shape[1])
        return _clip(x * (ramp if seed % 2 else ramp[::-1])[None, :, None])

    return mapped(f)


def grayscale() -> Callable[[Column], Column]:
    return mapped(lambda x: np.repeat(_clip(gray(x))[:, :, None], 3, axis=2))


def sharpened() -> Callable[[Column], Column]:
    kernel = np.array([[0, -1, 0], [-1, 5, -1], [0, -1, 0]], np.float64)
    return mapped(lambda x: _clip(np.stack([convolve(bgr(x)[:, :, c], kernel) for c in range(3)], axis=2)))


def cropped(x1: int, y1: int, x2: int, y2: int) -> Callable[[Column], Column]:
    return mapped(lambda x: x[y1:y2, x1:x2])


def blur_score() -> Callable[[Column], Column]:
    """Variance of the Laplacian."""
    kernel = np.array([[0, 1, 0], [1, -4, 1], [0, 1, 0]], np.float64)
    return measured(lambda x: convolve(gray(x), kernel).var())


def variance() -> Callable[[Column], Column]:
    return measured(lambda x: gray(x).var())


def upside_down() -> Callable[[Column], Column]:
    """180 where the lowest quarter is darker than the highest by more than 5, else 0."""

    def f(x: np.ndarray) -> float:
        g = gray(x)
        q = max(1, g.shape[0] // 4)
        return 180.0 if g[:q].mean() - g[-q:].mean() > 5 else 0.0

    return measured(f)


def normalized(mean: tuple[float, float, float] = (0.485, 0.456, 0.406), std: tuple[float, float, float] = (0.229, 0.224, 0.225)) -> Callable[[Column], Column]:
    """Floats in channel-first order, (rgb / 255 - mean) / std."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        m, s = np.array(mean, np.float32), np.array(std, np.float32)
        for b in batches:
            yield pd.Series([((bgr(array_of(r))[:, :, ::-1].astype(np.float32) / 255 - m) / s).transpose(2, 0, 1).ravel() for r in _rows(b)])

    return run


def padded_batch(arrays: list[np.ndarray], value: float = 0.0) -> np.ndarray:
    """Images of any size as one array (n, channels, height, width)."""
    h, w = (max(a.shape[k] for a in arrays) for k in (0, 1))
    out = np.full((len(arrays), arrays[0].shape[2], h, w), value, np.float32)
    for o, a in zip(out, arrays):
        o[:, : a.shape[0], : a.shape[1]] = a.transpose(2, 0, 1)
    return out


def box_targets(h: int, w: int, boxes: list[list[int]]) -> np.ndarray:
    """Boxes drawn at a quarter of the size, smoothed: rises and falls at the corners, summed along both directions."""
    rows, cols = max(1, h // 4), max(1, w // 4)
    b = np.clip(np.asarray(boxes, np.int64).reshape(-1, 4) // 4, 0, [cols - 1, rows - 1] * 2)
    b = b[(b[:, 2] > b[:, 0]) & (b[:, 3] > b[:, 1])]
    steps = np.zeros((rows + 1, cols + 1))
    for y, x, by in ((1, 0, 1), (1, 2, -1), (3, 0, -1), (3, 2, 1)):
        np.add.at(steps, (b[:, y], b[:, x]), by)
    out = (steps.cumsum(0).cumsum(1)[:-1, :-1] > 0).astype(np.float64)
    k = np.outer([1, 2, 1], [1, 2, 1]) / 16.0
    return convolve(out, k)


def predicted(model: Callable[[], Callable[[list[np.ndarray]], list[list[dict]]]]) -> Callable[[Column], Column]:
    """A recogniser as a column function: model() loads once a worker and gives a function from images to tokens."""

    @F.pandas_udf("array<struct<text: string, bbox: array<double>, score: double>>")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        f = model()
        for b in batches:
            yield pd.Series(f([array_of(r) for r in _rows(b)]), dtype=object)

    return run

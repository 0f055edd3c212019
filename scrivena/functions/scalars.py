"""Arithmetic, flags and repeatable random draws as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """a / b, and 0.0 where b is 0 or anything is null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def half_even(x: Column) -> Column:
    """The nearest integer, ties to even."""
    return F.rint(x).cast("long")


def metric(container: Column, *path: str, default: float = 0.0) -> Column:
    """A number inside nested maps or a JSON text; default where it is missing or null."""
    value = F.get_json_object(container, "$" + "".join(f"['{p}']" for p in path))
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def parse_bool(value: Column) -> Column:
    """Everything is true but 0, false, no and off."""
    return ~F.lower(F.trim(value.cast("string"))).isin("0", "false", "no", "off")


def uniform(seed: int | Column, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only, so that a rerun draws the same."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.pmod(F.xxhash64(seed, *keys), F.lit(1 << 52)) / F.lit(float(1 << 52))


def should_apply(u: Column, enabled: Column | bool, prob: Column | float, multiplier: Column | float = 1.0) -> Column:
    """Whether a step with this chance is applied, for a draw u."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return lit(enabled) & (u < lit(prob) * lit(multiplier))


def sample_float(u: Column, low: Column | float, high: Column | float) -> Column:
    return low + u * (high - low)


def sample_int(u: Column, low: int, high: int) -> Column:
    """An integer from low to high, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("long")


def scale_range(low: float, high: float, strength: float) -> tuple[float, float]:
    """The range shrunk about its centre."""
    mid = (low + high) / 2
    return mid + (low - mid) * strength, mid + (high - mid) * strength


def softmax(values: Column) -> Column:
    """Of an array, stable against large values."""
    top = F.array_max(values)
    e = F.transform(values, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def argmax(values: Column) -> Column:
    """Index from 0 of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")

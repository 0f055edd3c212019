"""Index-addressed training samples: a keyed permutation of row numbers, so that an epoch's order needs no shuffle.

An epoch's order is a bijection of 0 .. n-1 that seed and epoch choose: a Feistel network over pairs of digits, base a and
b with a * b just over n, whose rounds add a hash of one digit to the other; what falls outside walks on until it is inside.
The position of a row is a function of its number, and the number at a position one of the position. So each row finds its
shard and batch alone, and any slice of any epoch can be read without the rest.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.operators.ranks import ranked

#: A prime, as the modulus of the rounds' hashes, which multiply two numbers below it.
PRIME = (1 << 31) - 1
ROUNDS, STEPS = 6, 64


@dataclass(frozen=True)
class Order:
    """One epoch's order of n rows."""

    n: int
    a: int
    b: int
    keys: tuple[tuple[int, int, int], ...]


def order_of(n: int, seed: int = 42, epoch: int = 0) -> Order:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    digest = lambda i: hashlib.sha256(f"{seed}|{epoch}|{i}".encode()).digest()
    keys = tuple(tuple(1 + int.from_bytes(digest(i)[8 * k : 8 * k + 8], "big") % (PRIME - 1) for k in range(3)) for i in range(ROUNDS))
    return Order(n, a, max(1, -(-n // a)), keys)


def _hash(v: Column, key: Column) -> Column:
    h = (v % PRIME + key[0]) * key[1] % PRIME
    return h.bitwiseXOR(F.shiftright(h, 15)) * key[2] % PRIME


def _once(x: Column, o: Order, sign: int) -> Column:
    """All rounds, forwards (1) or backwards (-1). Even rounds move the higher digit, odd ones the lower."""
    keys = [[*k, i % 2] for i, k in enumerate(o.keys)]
    move = lambda y, by, key, base: F.pmod(y + sign * _hash(by, key) % base, F.lit(base))

    def turn(pair: Column, key: Column) -> Column:
        even = key[3] == 0
        return F.struct(F.when(even, move(pair["h"], pair["l"], key, o.a)).otherwise(pair["h"]).alias("h"), F.when(even, pair["l"]).otherwise(move(pair["l"], pair["h"], key, o.b)).alias("l"))

    start = F.struct(F.floor(x / o.b).cast("long").alias("h"), (x % o.b).alias("l"))
    return F.aggregate(F.lit(keys[::sign]).cast("array<array<long>>"), start, turn, lambda pair: pair["h"] * o.b + pair["l"])


def _walked(x: Column, o: Order, sign: int) -> Column:
    if o.n >= 1 << 52:
        raise ValueError("too many rows")
    step = lambda v, _: F.when(v < o.n, v).otherwise(_once(v, o, sign))
    # One value in sqrt(n) walks on; of n rows, fewer than sqrt(n) lie outside, so that small tables always end in time.
    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), _once(x, o, sign), step)
    return F.when(found < o.n, found).otherwise(F.raise_error(F.lit("a walk is longer than STEPS")).cast("long"))


def row_at(position: Column, o: Order) -> Column:
    """The number of the row at a position."""
    return _walked(position.cast("long"), o, 1)


def position_of(row: Column, o: Order) -> Column:
    """The position of a row, by its number."""
    return _walked(row.cast("long"), o, -1)


def indexed(rows: DataFrame, key: str) -> DataFrame:
    """rows with idx, their number from 0 by a unique numeric key."""
    return ranked(rows, key).withColumn("idx", F.col("rank") - 1).drop("rank")


def epoch(rows: DataFrame, o: Order, shards: int = 1, batch: int = 32) -> DataFrame:
    """rows (with idx) with position, shard and batch: a shard's batches are filled by turns. Nothing is shuffled."""
    p = F.col("position")
    return rows.withColumn("position", position_of(F.col("idx"), o)).withColumns({"shard": p % shards, "batch": F.floor(p / (shards * batch)).cast("long")})


def slice_of(spark: SparkSession, o: Order, low: int, high: int) -> DataFrame:
    """position and idx of an epoch's positions from low to high (exclusive), from nothing but the order."""
    return spark.range(max(0, low), min(high, o.n)).select(F.col("id").alias("position"), row_at(F.col("id"), o).alias("idx"))


def taken(rows: DataFrame, positions: DataFrame) -> DataFrame:
    """The rows (with idx) at some positions."""
    return positions.join(rows, "idx")

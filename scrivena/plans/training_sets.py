"""Queries over training sets: epochs addressed by index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.operators import samples
from scrivena.plans.fixtures import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SEED, EPOCH, SHARDS, BATCH = 42, 3, 4, 16


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _forward(x: str) -> str:
    """SQL of all rounds of a position x, for n, a and b of the row."""
    h, low = f"({x} // b)", f"({x} % b)"
    steps = []
    for i, (k, m, e) in enumerate(samples.order_of(1, SEED, EPOCH).keys):
        v = "l" if i % 2 == 0 else "h"
        hashed = f"((xor((({v} % {samples.PRIME} + {k}) * {m} % {samples.PRIME}), (({v} % {samples.PRIME} + {k}) * {m} % {samples.PRIME}) >> 15)) * {e} % {samples.PRIME})"
        steps.append(f"(h + {hashed} % a) % a as h, l" if i % 2 == 0 else f"h, (l + {hashed} % b) % b as l")
    body = f"select start, n, a, b, {h} as h, {low} as l from src"
    for s in steps:
        body = f"select start, n, a, b, {s} from ({body})"
    return f"select start, n, a, b, h * b + l as x from ({body})"


def _order_sql(table_: str) -> str:
    """Position and number (idx) of each row of a table: whoever lies outside walks on."""
    return f"""size as (select count(*) as n, cast(ceil(sqrt(count(*))) as bigint) as a, cast(ceil(count(*) / ceil(sqrt(count(*)))) as bigint) as b from {table_}),
      walk(start, n, a, b, x) as ({_forward('x').replace('from src', 'from (select i as start, i as x, n, a, b from size, range(n) r(i))')} union all {_forward('x').replace('from src', 'from walk where x >= n')}),
      perm as (select start as position, x as idx from walk where x < n)"""


@query(f"""with recursive {_order_sql('rec_samples')}, i as (select *, row_number() over (order by sample_id) - 1 as idx from rec_samples)
    select sample_id, idx, position, position % {SHARDS} as shard, position // {SHARDS * BATCH} as batch from i join perm using (idx)""")
def sample_epoch(s, d):
    """Position, shard and batch of each recognition sample in an epoch."""
    rows = samples.indexed(table(s, d, "rec_samples").select("sample_id"), "sample_id")
    return samples.epoch(rows, samples.order_of(rows.count(), SEED, EPOCH), SHARDS, BATCH).select("sample_id", "idx", "position", "shard", "batch")


@query(f"""with recursive {_order_sql('rec_samples')}, i as (select *, row_number() over (order by sample_id) - 1 as idx from rec_samples)
    select position, sample_id, gt_text as text, length(gt_text) as label_len from i join perm using (idx) where position >= (select n // 3 from size) and position < (select 2 * n // 3 from size)""")
def sample_slice(s, d):
    """The samples of the epoch's middle third, read by position."""
    rows = samples.indexed(table(s, d, "rec_samples"), "sample_id")
    o = samples.order_of(rows.count(), SEED, EPOCH)
    return samples.taken(rows, samples.slice_of(s, o, o.n // 3, 2 * o.n // 3)).select("position", "sample_id", F.col("gt_text").alias("text"), F.char_length("gt_text").cast("long").alias("label_len"))

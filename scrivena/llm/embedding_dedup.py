"""Embedding near-dedup: spherical k-means cells, blocked cosine products, one representative a group.

Vectors are compared only under equal labels (and dimensions). Spherical k-means, fitted on SAMPLE vectors at most with
CELLS centroids at most, assigns each vector to the cell of its most similar centroid, its home. A vector also visits
every cell whose border it is so near that a linked vector could live there; that follows from the angle alone, so no
link is lost whatever the sample was. A cell's home vectors are dealt into blocks and all of its vectors, visitors too,
into wider ones; a block of homes and a wide one make a tile, one dense product in double precision. Visitors are never
compared with each other: a pair counts where the smaller id is at home. Links leave a task as counts and as a spanning
forest, never as pairs. Equal vectors are one class with a weight from the start.

Memory: a tile holds TILE bytes of vectors in each of its two blocks, rows are dealt in slices, and products and distances
to centroids come in strips of STRIP numbers; nothing in a task grows with the table. Where vectors have no clusters, every
cell is near, and a vector goes to n / BLOCK tiles, as all pairs would need.

Defined results: vectors whose id is null are left out; vectors that are null, empty, zero, or hold null or non-finite
components, and those without a label, link with nothing and are kept; repeated rows are vectors of their own, linked
with each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivena.llm._common import scratch
from scrivena.llm.components import components

#: Vectors that the centroids are fitted on, and centroids, at most.
SAMPLE, CELLS = 20_000, 4096
#: Members that a cell should have, homes of a block, and how many times as wide a block of all members is.
CELL, BLOCK, WIDER = 4096, 8192, 4
#: Bytes of vectors in a block at most; numbers of a matrix at once; rows that are dealt or normalised at once.
TILE, STRIP, SLICE = 32 << 20, 1 << 22, 1024


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(s, SLICE) for batch in batches for s in range(0, batch.num_rows, SLICE))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, hash and length of the normalised vector, and the vector; null where it links with nothing."""
    for batch in _slices(batches):
        out = []
        for i, label, vec in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), batch.column("embedding").to_pylist()):
            ok = label is not None and vec and None not in vec
            if ok:
                x = np.array(vec, np.float64)
                ok = np.isfinite(x).all()
            if ok:
                top = np.abs(x).max()
                ok = top > 0
            if ok:
                x = x / top
                x = x / np.linalg.norm(x) + 0.0
                data = x.tobytes()
                out.append((i, label, int(np.uint64(xxhash.xxh3_64_intdigest(data, seed=len(x))).view(np.int64)), data))
            else:
                out.append((i, label, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["vec_id", "label", "h", "data"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k unit centroids (fewer if x has fewer distinct rows) of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1)
        new = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
        if np.allclose(new, centres, atol=1e-6):
            break
        centres = new
    return np.unique(centres, axis=0)


def homes(x: np.ndarray, centres: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector's home, and which cells could hold a vector with a cosine of at least `least` to it.

    A vector is linked into cell c only if the border between home and c is within the angle of `least`.
    """
    dots = x @ centres.T
    home = np.argmax(dots, axis=1)
    gap = dots[np.arange(len(x)), home][:, None] - dots
    width = np.sqrt(np.maximum(2 - 2 * (centres[home] @ centres.T), 0))
    near = gap <= width * np.sqrt(1 - least * least) + 1e-9
    near[np.arange(len(x)), home] = True
    return home, near


def _cells(model, least: float):
    """For each slice and each key of it: the rows, their home cells, and (row, cell) of all cells that they visit."""
    found = model.value

    def run(keys: list[tuple], datas: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
        groups: dict[tuple, list[int]] = {}
        for r, key in enumerate(keys):
            groups.setdefault(key, []).append(r)
        for key, every in groups.items():
            first, c = found.get(key, (-1 - key[1], None))
            step = max(1, STRIP // len(c)) if c is not None else len(every)
            for s in range(0, len(every), step):
                rows = every[s : s + step]
                if c is None:  # the sample had no such vector: one cell for the label and dimension
                    home, near = np.zeros(len(rows), int), np.ones((len(rows), 1), bool)
                else:
                    home, near = homes(np.frombuffer(b"".join([datas[r] for r in rows]), np.float64).reshape(len(rows), key[1]), c, least)
                at, cell = np.nonzero(near)
                yield rows, home + first, at, cell + first

    return run


def _visits(model, least: float):
    """label, size, cell, and how many rows live there and visit it (those that live there too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _cells(model, least)
        for batch in _slices(batches):
            datas = batch.column("data").to_pylist()
            keys = [(label, len(data) // 8) for label, data in zip(batch.column("label").to_pylist(), datas)]
            for rows, home, _, cell in cells(keys, datas):
                some, count = np.unique(cell, return_counts=True)
                label, size = keys[rows[0]]
                at_home = [int((home == c).sum()) for c in some]
                yield pa.RecordBatch.from_arrays([pa.array([v] * len(some), pa.int64()) for v in (label, size)] + [pa.array(v, pa.int64()) for v in (some, at_home, count)], names=["label", "size", "cell", "homes", "members"])

    return run


def block_sizes(size: int) -> tuple[int, int]:
    """Homes of a block and members of a wide one, for vectors of `size` components."""
    held = max(1, TILE // (8 * size))
    return min(BLOCK, held), min(WIDER * BLOCK, held)


def _deal(model, blocks, least: float):
    """Each row once for each tile that it belongs to: as a home one, as one of all members, or as both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, many = _cells(model, least), blocks.value
        for batch in _slices(batches):
            datas = batch.column("data").to_pylist()
            keys = [(label, len(data) // 8) for label, data in zip(batch.column("label").to_pylist(), datas)]
            ids = batch.column("cls").to_numpy()
            mixed = [((i * 0x9E3779B97F4A7C15) & (1 << 64) - 1) >> 17 for i in ids.tolist()]
            out: list[list[int]] = [[] for _ in range(6)]  # cell, i, j, row, home, member

            def ready() -> pa.RecordBatch:
                cell, i, j, row, home, member = (np.array(c, np.int64) for c in out)
                for c in out:
                    c.clear()
                own = batch.take(pa.array(row))
                cols = [own.column("label"), pa.array(cell), pa.array(i), pa.array(j), own.column("cls"), own.column("w"), pa.array(home == 1), pa.array(member == 1), own.column("data")]
                return pa.RecordBatch.from_arrays(cols, names=["label", "cell", "i", "j", "cls", "w", "home", "member", "data"])

            for rows, home, at, cell in cells(keys, datas):
                label, size = keys[rows[0]]
                most = max(SLICE, TILE // (8 * size))
                for a, c in zip(at.tolist(), cell.tolist()):
                    r, lives = rows[a], home[a] == c
                    n, wide = many.get((label, c), (1, 1))
                    i, j = mixed[r] % n, (mixed[r] >> 20) % wide
                    tiles = [(k, j, lives and k == i, True) for k in range(n)]
                    if lives:
                        tiles += [(i, k, True, False) for k in range(wide) if k != j]
                    for col, values in zip(out, zip(*((c, *t[:2], r, *t[2:]) for t in tiles))):
                        col += values
                    if len(out[0]) >= most:
                        yield ready()
            if out[0]:
                yield ready()

    return run


def _tile(least: float):
    def run(table: pa.Table) -> pa.Table:
        ids, w = (table.column(c).to_numpy() for c in ("cls", "w"))
        x = np.frombuffer(b"".join(table.column("data").to_pylist()), np.float64).reshape(len(ids), -1)
        a, b = (np.flatnonzero(table.column(c).to_numpy()) for c in ("home", "member"))
        of, mine = x[b].T, ids[b]
        count, part = np.zeros(len(ids), np.int64), np.arange(len(ids))
        step = max(1, STRIP // max(1, len(b)))
        for s in range(0, len(a), step):
            rows = a[s : s + step]
            p, q = np.nonzero(x[rows] @ of >= least)
            p, q = rows[p], b[q]
            ok = ids[p] < ids[q]
            p, q = p[ok], q[ok]
            count += np.bincount(p, w[q], len(ids)).astype(np.int64) + np.bincount(q, w[p], len(ids)).astype(np.int64)
            for r, links in zip(p[np.flatnonzero(np.diff(p, prepend=-1))].tolist(), np.split(q, np.flatnonzero(np.diff(p)) + 1)):
                # One row's links at a time: components merge, pairs leave no list behind.
                roots = part[links]
                if (roots != part[r]).any():
                    roots = np.unique(np.append(roots, part[r]))
                    part[np.isin(part, roots)] = roots[0]
        some = np.flatnonzero(count)
        least_of = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least_of, part[some], ids[some])
        return pa.table({"u": pa.array(ids[some], pa.int64()), "v": pa.array(least_of[part[some]], pa.int64()), "n": pa.array(count[some], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links (other vectors with a cosine of at least `least`), component_id and kept, for every vector."""
    if not 0 < least < 1:
        raise ValueError("the cosine must lie between 0 and 1")
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null").mapInArrow(_classes, "vec_id long, label long, h long, data binary")
    rows = scratch(rows, "vectors")
    per = rows.where("h is not null").groupBy("label", "h", F.length("data").alias("size"))
    per = scratch(per.agg(F.min("vec_id").alias("cls"), F.count("*").alias("w"), F.first("data").alias("data")), "classes")
    sizes = {(r[0], r[1] // 8): r[2] for r in per.groupBy("label", "size").count().orderBy(F.desc("count"), "label", "size").limit(CELLS).collect()}
    total = sum(sizes.values())
    sample = per.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("label", "data").collect()
    held: dict[tuple, list] = {}
    for label, data in sample:
        held.setdefault((label, len(data) // 8), []).append(np.frombuffer(data, np.float64))
    centres, first = {}, 0
    for key, xs in sorted(held.items()):
        n = sizes.get(key, 0)
        k = min(-(-n // CELL), max(1, CELLS * n // max(total, 1)), len(xs))
        if k >= 1:
            c = spherical_kmeans(np.array(xs), k)
            centres[key] = (first, c)
            first += len(c)
    model = spark.sparkContext.broadcast(centres)  # CELLS centroids at most
    cells = per.mapInArrow(_visits(model, least), "label long, size long, cell long, homes long, members long").groupBy("label", "size", "cell").agg(F.sum("homes").alias("homes"), F.sum("members").alias("members"))
    cells = cells.where((F.col("members") > BLOCK) | (F.col("members") * F.col("size") * 8 > TILE)).collect()  # CELLS rows at most, and a row for each other label that large
    dealt_in = {}
    for label, size, cell, at_home, members in cells:
        narrow, wide = block_sizes(size)
        dealt_in[(label, cell)] = (max(1, -(-at_home // narrow)), -(-members // wide))
    blocks = spark.sparkContext.broadcast(dealt_in)
    dealt = per.mapInArrow(_deal(model, blocks, least), "label long, cell long, i long, j long, cls long, w long, home boolean, member boolean, data binary")
    found = scratch(dealt.groupBy("label", "cell", "i", "j").applyInArrow(_tile(least), "u long, v long, n long"), "links")
    part = components(found.select("u", "v"))
    count = found.groupBy("u").agg(F.sum("n").alias("n"))
    per = per.drop("data").join(count, per.cls == count.u, "left").join(part, F.col("cls") == part.node, "left")
    per = scratch(per.select("label", "h", F.col("size"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component_id")), "classes")
    out = rows.select("vec_id", "label", "h", F.length("data").alias("size")).join(per, ["label", "h", "size"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))

"""Edit traces of many pairs of texts at once.

Pairs of about equal size are padded to one. Costs are filled along anti-diagonals, for all pairs and cells of a diagonal in
one step, and all traces are walked back together. What is kept of a cell is the step that led to it, one byte. Of equal
costs a match goes first, then a delete, an insert and a substitute.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cells of all pairs that are filled at once.
CELLS = 1 << 24
MATCH, DELETE, INSERT, SUBSTITUTE = 0, 1, 2, 3
_NAMES = pa.array(["match", "delete", "insert", "substitute"])
KIND = pa.list_(pa.struct([("op", pa.string()), ("gt", pa.string()), ("pred", pa.string())]))


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, end to end, and where each text starts (and the last one ends)."""
    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    return flat, np.concatenate(([0], np.cumsum(size)))


def _padded(flat: np.ndarray, start: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    at = start[rows][:, None] + np.arange(width)
    return np.where(np.arange(width) < (start[rows + 1] - start[rows])[:, None], flat[np.minimum(at, max(0, len(flat) - 1))] if len(flat) else 0, 0)


def _filled(p: np.ndarray, g: np.ndarray) -> np.ndarray:
    """[diagonal, pair, place in p]: the step into each cell."""
    (b, n), m = p.shape, g.shape[1]
    steps = np.zeros((n + m + 1, b, n + 1), np.uint8)
    before = last = np.zeros((b, n + 1), np.int32)
    for k in range(1, n + m + 1):
        now = np.full((b, n + 1), 1 << 29, np.int32)
        if k <= n:
            now[:, k], steps[k, :, k] = k, DELETE
        if k <= m:
            now[:, 0], steps[k, :, 0] = k, INSERT
        low, high = max(1, k - m), min(n, k - 1)
        if low <= high:
            i = np.arange(low, high + 1)
            same = p[:, i - 1] == g[:, k - i - 1]
            gone, come, other = last[:, i - 1] + 1, last[:, i] + 1, before[:, i - 1] + 1
            cost = np.where(same, other - 1, np.minimum(np.minimum(gone, come), other))
            now[:, i] = cost
            steps[k, :, low : high + 1] = np.where(same, MATCH, np.where(gone == cost, DELETE, np.where(come == cost, INSERT, SUBSTITUTE)))
        before, last = last, now
    return steps


def _walked(steps: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """pair, step and the places in both texts, of all steps but matches; each pair's steps in the texts' order."""
    i, j, b = n.copy(), m.copy(), np.arange(len(n))
    found = []
    while len(b):
        live = (i > 0) | (j > 0)
        b, i, j = b[live], i[live], j[live]
        s = steps[i + j, b, i]
        found.append((b, s, i - 1, j - 1))
        i, j = i - (s != INSERT), j - (s != DELETE)
    b, s, i, j = (np.concatenate([x[k] for x in found[::-1]]) for k in range(4))
    keep = np.flatnonzero(s != MATCH)
    keep = keep[np.argsort(b[keep], kind="stable")]
    return b[keep], s[keep], i[keep], j[keep]


def edit_traces(pred: pa.Array, gt: pa.Array) -> pa.Array:
    """For each pair, what turns pred into gt: list<struct<op, gt, pred>>; null where a text is null."""
    null = pc.or_(pc.is_null(pred), pc.is_null(gt)).to_numpy(zero_copy_only=False)
    (p, ps), (g, gs) = (_points(pc.fill_null(x.cast(pa.string()), "")) for x in (pred, gt))
    n, m = np.diff(ps), np.diff(gs)
    order = np.lexsort((m, n))
    parts, at = [], 0
    while at < len(order):
        # As many pairs as fit, all padded to the largest of them.
        end = at + 1
        width, height = int(n[order[at]]), int(m[order[at]])
        while end < len(order):
            w, h = max(width, int(n[order[end]])), max(height, int(m[order[end]]))
            if (end + 1 - at) * (w + 1) * (w + h + 1) > CELLS:
                break
            width, height, end = w, h, end + 1
        rows = order[at:end]
        b, s, i, j = _walked(_filled(_padded(p, ps, rows, width), _padded(g, gs, rows, height)), n[rows], m[rows])
        parts.append((rows[b], s, np.where(s != INSERT, ps[rows[b]] + i, -1), np.where(s != DELETE, gs[rows[b]] + j, -1)))
        at = end
    if not parts:
        return pa.array([], KIND)
    pair, s, i, j = (np.concatenate([x[k] for x in parts]) for k in range(4))
    by = np.argsort(pair, kind="stable")
    pair, s, i, j = pair[by], s[by], i[by], j[by]

    def letters(flat: np.ndarray, places: np.ndarray) -> pa.Array:
        points, which = np.unique(flat[places[places >= 0]], return_inverse=True)
        names = pa.array([*map(chr, points.tolist()), ""])
        index = np.full(len(places), len(points))
        index[places >= 0] = which
        return names.take(pa.array(index))

    ops = pa.StructArray.from_arrays([_NAMES.take(pa.array(s)), letters(g, j), letters(p, i)], names=["op", "gt", "pred"])
    ends = np.concatenate(([0], np.cumsum(np.bincount(pair, minlength=len(n))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), ops, mask=pa.array(null))

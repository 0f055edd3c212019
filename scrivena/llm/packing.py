"""Sequence packing: shortest-pack-first over the length histogram.

Documents become token ids with an end id; each is cut into full sequences and one shorter piece. Only the histogram of
piece lengths (as many rows as a sequence has tokens) reaches the driver, which places the lengths longest first: a
length goes to the open packs with the most room left, and packs are counted by pattern, not one by one. The patterns
then tell, for each length, which ranks go to which pack and offset; pieces find their place by their rank within their
length. Ranks come from counts by length and salt, so that a length that a third of all pieces share is dealt out evenly.

Defined results: null text is empty and has the end id only; rows without a doc_id are left out; repeated rows are packed
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrivena.llm._common import chunks, documents, raw, scratch

SIZE, END = 2048, 1
#: Ranks within a length are dealt out over so many salts.
SALTS = 64
PIECES = "doc_id long, tk long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> tuple[str, str]:
    """The tokenizer file, and the same vocabulary as ranks."""
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoder(paths: tuple[str, str]):
    """The ids that the tokenizer file gives. The rank file holds the same vocabulary and encodes several times faster;
    texts with the string of a special token go to the tokenizer itself, which gives that token's id."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(paths[0])
    with open(paths[0], encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    with open(paths[1], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def pieces(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """PIECES of each document (with_ids: and their ids): sequences of `size` tokens and what is left."""
    paths = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(paths)
        for part in chunks(batches):
            rows, data = [], []
            for doc, tk, text in zip(part.column("doc_id").to_pylist(), part.column("tk").to_pylist(), raw(part)):
                ids = np.append(encode(text.decode("utf-8", "replace")), np.uint32(end)).astype("<u4")
                for s in range(0, len(ids), size):
                    x = ids[s : s + size]
                    rows.append((doc, tk, s, len(x), zlib.crc32(x), len(ids)))
                    data.append(x)
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            if with_ids:
                cols.append(pa.array(data, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids)

    return docs.mapInArrow(run, PIECES + ", ids array<long>" * with_ids)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of each packing pattern. Lengths are placed longest first, each in the open packs with the most
    room left; patterns split when fewer pieces are left than packs have the pattern."""
    done: list[tuple[int, tuple[int, ...]]] = []
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"length {length} does not fit {size}")
        left = histogram[length]
        # Packs that get a piece are shorter on room; whether they take another of this length shows as room falls.
        free = max(room, default=0)
        while left and free >= length:
            for count, pattern in room.pop(free, ()):
                n = min(count, left)
                if n < count:
                    room.setdefault(free, []).append((count - n, pattern))
                if n:
                    rest = free - length
                    (room.setdefault(rest, []) if rest else done).append((n, (*pattern, length)))
                    left -= n
            free = max((f for f in room if f < free or left and f == free), default=0) if left else 0
        if left:
            (room.setdefault(size - length, []) if length < size else done).append((left, (length,)))
    return done + [x for packs in room.values() for x in packs]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length: the first rank, first sequence and offset of each block of ranks."""
    out: dict[int, tuple[list[int], list[int], list[int]]] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            ranks, sequences, offsets = out.setdefault(length, ([], [], []))
            ranks.append(next_rank.get(length, 0))
            sequences.append(sequence)
            offsets.append(offset)
            next_rank[length] = next_rank.get(length, 0) + count
            offset += length
        sequence += count
    return out


def pack(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset (with_ids: and the ids)."""
    made = scratch(pieces(documents(docs), size, end, tokenizer, with_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # size rows at most
    table = places(shortest_pack_first(histogram, size))
    # Rank of a piece in its length: pieces under smaller salts, then its place under its own.
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tk", "start"), F.lit(SALTS)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").count()
    counts = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "tk")
    ranked = salted.withColumn("own", F.row_number().over(own))
    ranked = ranked.join(F.broadcast(counts), ["length", "salt"])  # size * SALTS rows at most
    ranked = ranked.withColumn("rank", F.col("base") + F.col("own") - 1).drop("salt", "base", "own", "tk")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                ranks, sequences, offsets = table[length]
                i = bisect_right(ranks, rank) - 1
                seq.append(sequences[i] + rank - ranks[i])
                off.append(offsets[i])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*names, "sequence_id", "offset"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, " + "ids array<long>, " * with_ids + "sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)

"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text's words (runs of the space mark and what follows, which no piece crosses) are looked up among those already seen;
the new ones of a chunk lie end to end in one flat array of symbols. Each round finds, by a segmented minimum, every
word's best pair (least rank, then leftmost), merges one pair in each word at once, updates the ranks beside the merges
and compacts the arrays; words without a pair leave. One merge a word and round is the library's own order, so results
are equal where pieces tie or overlap too. Words of more than LONG symbols would need as many rounds; a heap does them.

Defined results: null text is empty, and an empty text has the end id only; characters without a piece become byte
pieces; rows without a doc_id are left out; repeated rows are encoded each; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scrivena.llm._common import chunks, documents, raw

MARK = "▁"
LONG = 128
#: Words that a worker remembers, and those that merge together.
KNOWN = 200_000
BLOCK = 16_384
_NONE = np.int64(1) << np.int64(62)
_DEAD = -(1 << 40)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """A BPE model of the sentencepiece library with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        spec = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or not m.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no other normalisation")
        kinds = np.array([p.type for p in m.pieces])
        if set(kinds.tolist()) - {1, 2, 3, 6}:
            raise ValueError("pieces of a kind that is not handled")
        self.pieces = [p.piece for p in m.pieces]
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == 1}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if kinds[i] == 6}
        self.end = next(i for i, p in enumerate(self.pieces) if p == "</s>")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece crosses words")
        scores = sorted({m.pieces[i].score for i in self.ids.values()}, reverse=True)
        dense = {s: r for r, s in enumerate(scores)}
        n = len(self.pieces)
        self.rank = np.zeros(n, np.int64)
        for i in self.ids.values():
            self.rank[i] = dense[m.pieces[i].score]
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
            if len(p) > 1 and any(c not in self.ids for c in p):
                raise ValueError("a piece has a character that is not a piece")
        # An open hash table: places probed one after the other until a free one.
        self.n, self.bits = n, max(4, (len(pairs) * 8).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.made = np.full(len(self.keys), -1, np.int64)
        self.probes = 1
        for key, i in pairs.items():
            at = self._slot(key)
            k = 0
            while self.keys[at + k] >= 0:
                k += 1
            self.keys[at + k], self.made[at + k] = key, i
            self.probes = max(self.probes, k + 1)
        self.surface = [bytes([int(p[3:5], 16)]) if kinds[i] == 6 else b"" if kinds[i] == 3 else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.surface[0] = " ⁇ ".encode()
        self.text_id = [str(i).encode() for i in range(n)]
        self.text_line, self.text_space = (np.array([t + end for t in self.text_id], object) for end in (b"\n", b" "))
        self.known: dict[str, bytes] = {}  # ids of words, as decimal text

    def _slot(self, key: int) -> int:
        return ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pieces that pairs make; -1 for none."""
        key = np.where((a >= 0) & (b >= 0), a * self.n + b, -2)
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        for k in range(self.probes):
            got = self.keys[at[todo] + k]
            hit = got == key[todo]
            out[todo[hit]] = self.made[at[todo[hit]] + k]
            todo = todo[~hit & (got >= 0)]
            if not len(todo):
                break
        return out

    def merge_rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words after all merges, end to end, and how many each has. A symbol is a piece, or -1 - c for a
        character c that is no piece."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        values, inverse = np.unique(chars, return_inverse=True)
        sym = np.array([self.ids.get(chr(c), -1 - c) for c in values.tolist()], np.int64)[inverse]
        word, sizes = np.arange(len(words)), np.array([len(w) for w in words], np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, symbols, sizes
        made = np.full(len(sym), -1, np.int64)
        key = np.full(len(sym), _NONE)

        def look(at: np.ndarray, nxt: np.ndarray) -> None:
            """Pairs from those places: the piece that each makes, and its key of rank and place."""
            p = self.merged(sym[at], sym[nxt])
            made[at], key[at] = p, np.where(p >= 0, (self.rank[p] << 32) | at, _NONE)

        first = None
        while len(word):
            if first is None:  # after the start and each compaction
                stop = np.cumsum(sizes)
                first = stop - sizes
                after, before = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
                after[stop - 1], before[first] = -1, -1
                at = np.flatnonzero(after >= 0)
                key[:], made[:] = _NONE, -1
                look(at, after[at])
            best = np.minimum.reduceat(key, first)
            is_open = best < _NONE
            at = best[is_open] & 0xFFFFFFFF
            if 2 * len(at) <= len(word):  # half of the words are done: they leave, and merged symbols with them
                live = sym != _DEAD
                left = np.add.reduceat(live, first)
                mine = np.repeat(is_open, sizes)
                done.append((word[~is_open], sym[live & ~mine], left[~is_open]))
                sym, word, sizes = sym[live & mine], word[is_open], left[is_open]
                made, key, first = made[: len(sym)], key[: len(sym)], None
                continue
            gone = after[at]
            sym[at], sym[gone], key[gone] = made[at], _DEAD, _NONE
            nxt = after[gone]
            after[at] = nxt
            has = nxt >= 0
            before[nxt[has]] = at[has]
            key[at[~has]] = _NONE
            look(at[has], nxt[has])
            prv = before[at]
            has = prv >= 0
            look(prv[has], at[has])
        word, sym, sizes = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word)
        start = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        at = np.arange(int(sizes.sum())) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
        return sym[at], sizes

    def merge_heap(self, word: str) -> list[int]:
        """The same for one long word."""
        sym = [self.ids.get(c, -1 - ord(c)) for c in word]
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        pair = self._pair
        heap = [(self.rank[p], i, sym[i], sym[i + 1], p) for i in range(n - 1) if (p := pair(sym[i], sym[i + 1])) >= 0]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, a, b, p = heapq.heappop(heap)
            j = right[i]
            if gone[i] or j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j], right[i] = p, True, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (q := pair(sym[x], sym[y])) >= 0:
                    heapq.heappush(heap, (self.rank[q], x, sym[x], sym[y], q))
        return [s for s, g in zip(sym, gone) if not g]

    def _pair(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return -1
        key, k = a * self.n + b, 0
        at = self._slot(key)
        while (got := self.keys[at + k]) >= 0:
            if got == key:
                return int(self.made[at + k])
            k += 1
        return -1

    def split(self, text: str) -> list[str]:
        """Words without their first space mark."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def learn(self, words: set[str]) -> None:
        """Encodes words that aren't known yet."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        short = [w for w in new if len(w) < LONG]
        for i in range(0, len(short), BLOCK):
            block = short[i : i + BLOCK]
            sym, sizes = self.merge_rounds([MARK + w for w in block])
            # One join for all words: a line each, ids apart by spaces; characters that aren't pieces as their bytes.
            last = np.zeros(len(sym), bool)
            last[np.cumsum(sizes) - 1] = True
            odd = np.flatnonzero(sym < 0)
            parts = np.where(last, self.text_line[np.maximum(sym, 0)], self.text_space[np.maximum(sym, 0)]).tolist()
            for k in odd.tolist():
                parts[k] = self._bytes(int(sym[k])) + (b"\n" if last[k] else b" ")
            self.known.update(zip(block, b"".join(parts).split(b"\n")))
        for w in new:
            if len(w) >= LONG:
                self.known[w] = b" ".join([self.text_id[x] if x >= 0 else self._bytes(x) for x in self.merge_heap(MARK + w)])

    def _bytes(self, symbol: int) -> bytes:
        return b" ".join([self.text_id[self.byte[b]] for b in chr(-1 - symbol).encode()])

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        self.learn(set(words))
        return [int(i) for w in words for i in self.known[w].split()] + [self.end]

    def decode(self, ids) -> str:
        out = b"".join([self.surface[i] for i in ids])
        if out[:1] == b" " and self.pieces[ids[0]].startswith(MARK):
            out = out[1:]
        return out.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t.decode("utf-8", "replace") for t in raw(part)]


def encode(docs: DataFrame, model: str | None = None, form: str = "ids") -> DataFrame:
    """doc_id, n_tokens and the ids with the end id: as ids (array<int>), or with form="text" as id_text, decimal
    ids joined by one space."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        end = m.text_id[m.end]
        for part in chunks(batches):
            words = [m.split(t) for t in _texts(part)]
            m.learn(set().union(*words))
            known = m.known
            ids = part.column("doc_id")
            out = [b" ".join([*[known[w] for w in ws], end]) for ws in words]
            n = pa.array([x.count(b" ") + 1 for x in out], pa.int64())
            if form == "text":
                yield pa.RecordBatch.from_arrays([ids, n, pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "n_tokens", "id_text"])
            else:
                yield pa.RecordBatch.from_arrays([ids, n, pa.array([list(map(int, x.split())) for x in out], pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "ids"])

    return documents(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, " + ("id_text string" if form == "text" else "ids array<int>"))


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """encode()'s rows with the decoded text added; either form."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(path)
        surface = np.array(m.surface, object)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = []
                if "id_text" in part.schema.names:
                    table = dict(zip(m.text_id, m.surface))
                    for t in part.column("id_text").cast(pa.binary()).to_pylist():
                        ids = t.split()
                        s = b"".join([table[i] for i in ids])
                        out.append(s[1:] if s[:1] == b" " and m.pieces[int(ids[0])].startswith(MARK) else s)
                else:
                    for ids in part.column("ids").to_pylist():
                        s = b"".join(surface[ids])
                        out.append(s[1:] if s[:1] == b" " and m.pieces[ids[0]].startswith(MARK) else s)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([s.decode("utf-8", "replace") for s in out], pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in encoded.dtypes) + ", decoded string")

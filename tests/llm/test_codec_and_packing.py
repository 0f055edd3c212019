import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrivena.llm import packing, piece_codec


def texts():
    rng = random.Random(0)
    alphabet = ["a", "b", " ", "  ", "\n", "é", "漢", "😀", "the", "▁", "<s>", "\t", "in", "ing", "\x00", "​", "aaaa", "<0x41>", "<|endoftext|>", "'s", "12"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12 if i % 20 else 300))) for i in range(600)]
    return out + ["", " ", "ab" * 3000, "a" * 777, "é" * 300, " " * 500, "theing" * 400 + " " + "x" * 200]


def test_codec_equals_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    m = piece_codec.load(piece_codec.default_model())
    for t in texts():
        ids = m.encode(t)
        assert ids == lib.encode(t, add_eos=True), repr(t)
        assert m.decode(ids) == lib.decode(ids), repr(t)


def test_codec_frames(spark):
    rows = [(i, t) for i, t in enumerate(texts()[:50])] + [(900, None), (None, "x")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, ids int")
    m = piece_codec.load(piece_codec.default_model())
    want = {d: m.encode(t or "") for d, t in rows if d is not None}
    got = piece_codec.decode(piece_codec.encode(df)).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want
    assert {r.doc_id: r.decoded for r in got} == {d: m.decode(i) for d, i in want.items()}
    text = piece_codec.decode(piece_codec.encode(df, form="text")).collect()
    assert {r.doc_id: (r.n_tokens, r.id_text, r.decoded) for r in text} == {d: (len(i), " ".join(map(str, i)), m.decode(i)) for d, i in want.items()}


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in enumerate(texts())] + [(5, texts()[3]), (900, None), (901, "word " * 9000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int").repartition(3)
    got = packing.pack(df, with_ids=True).collect()
    lib = Tokenizer.from_file(packing.default_tokenizer()[0])
    want = Counter((d, tuple(lib.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in rows)
    parts: dict = {}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) and r.length == len(r.ids) <= 2048
        parts.setdefault(r.sequence_id, []).append(r)
    made: Counter = Counter()
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(tuple(r.ids))
    for (d, n), starts in by_doc.items():
        for whole in zip(*(starts[s] for s in sorted(starts))):
            ids = tuple(i for part in whole for i in part)
            assert len(ids) == n
            made[(d, ids)] += 1
    assert made == want
    for rs in parts.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sorted(parts) == list(range(len(parts)))
    assert packing.pack(df.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("size", [1, 4, 16, 64])
def test_shortest_pack_first(size):
    rng = random.Random(size)
    for _ in range(50):
        h = {rng.randint(1, size): rng.randint(1, 50) for _ in range(rng.randint(0, 20))}
        placed: Counter = Counter()
        for n, lengths in packing.shortest_pack_first(h, size):
            assert n > 0 and sum(lengths) <= size
            for x in lengths:
                placed[x] += n
        assert placed == Counter(h)
    with pytest.raises(ValueError):
        packing.shortest_pack_first({size + 1: 1}, size)


def test_codec_empty_and_repeated(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert piece_codec.decode(piece_codec.encode(none)).count() == 0
    assert packing.pack(none).count() == 0
    rows = spark.createDataFrame([(1, "the same text"), (1, "the same text"), (1, "another"), (2, None)], "doc_id long, text string")
    m = piece_codec.load(piece_codec.default_model())
    got = sorted((r.doc_id, list(r.ids), r.decoded) for r in piece_codec.decode(piece_codec.encode(rows)).collect())
    want = sorted((d, list(m.encode(t)), m.decode(m.encode(t))) for d, t in [(1, "the same text"), (1, "the same text"), (1, "another"), (2, "")])
    assert got == want

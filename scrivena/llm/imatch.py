"""Document fingerprints by I-Match over randomised lexicons, in DataFrame functions only.

Terms (lower-cased words) are kept within a band of inverse document frequency: those that more than `most` of all
documents hold are left out. Two lexicon sizes would suit only documents of one length, so lexicons come in levels: level
r has one in 2**r of all terms (those whose hash ends in r zeros), dealt at random into SLOTS lexicons. A document uses
the levels from the one where about SLOTS / 2 of its terms are left, LEVELS of them. The base lexicon holds all terms of
the band, so that every one of them reaches the fingerprint. For each lexicon its terms are sorted, and their hash is one
part of the fingerprint. Two fingerprints are alike as the share of lexicons with equal hashes among the base and those
that either document has terms in, on the finest level that both use. Fingerprints are equal only where all terms of the
band are; how alike unequal ones of long texts are is told by the terms of a level, about SLOTS / 4 to SLOTS / 2 of them.

Where the band leaves fewer than FEW terms and less than half of a text's, the text is fingerprinted by all its terms, and
compared by all terms with any other.

Document frequencies come from all distinct texts, so that copies count once. Terms above the band number at most (mean distinct terms) / `most`,
whatever the corpus, so that list is held on the driver and put into the plan.

Defined results: null text is empty; a text without terms has the empty fingerprint, alike (1.0) to an empty one and
unlike (0.0) to others; rows without a doc_id are left out; equal ids follow each other in the order of their texts'
hashes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivena.llm._common import documents
from scrivena.operators.ranks import range_of

SLOTS, LEVELS = 64, 3
#: A band that leaves fewer terms than this, and less than half of a text's, says too little about the text.
FEW = 16
#: Terms in more than this share of documents are below the band of inverse document frequency.
MOST = 0.02
#: Ranges of ids in which documents are put in order.
RANGES = 1024


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text, as hashes."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def stop_terms(docs: DataFrame, most: float = MOST) -> list[int] | None:
    """Hashes of the terms above the band: at most (mean distinct terms) / most of them. None where the band is empty,
    as all terms are above it."""
    # Copies count once. Of each text only the terms' hashes are shuffled.
    texts = docs.groupBy(F.xxhash64("text").alias("tk")).agg(F.first(term_hashes(F.col("text"))).alias("ts"))
    limit = most * docs.select(F.xxhash64("text")).distinct().count()
    if limit < 1:
        return None
    terms = texts.select(F.explode("ts").alias("t")).groupBy("t").count()
    return sorted(r[0] for r in terms.where(F.col("count") > limit).select("t").collect())


def fingerprint(text: Column, stop: list[int] | None) -> Column:
    """struct of band and whole: the levels of the terms in the band (null where it leaves too few), and of all terms."""
    inside = lambda ts: F.filter(ts, lambda t: F.lit(False) if stop is None else ~t.isin(stop)) if stop != [] else ts
    pick = F.transform(F.array(term_hashes(text)), lambda ts: F.struct(ts.alias("ts"), inside(ts).alias("band")))
    thin = lambda p: (F.size(p["band"]) < FEW) & (2 * F.size(p["band"]) < F.size(p["ts"]))
    return F.transform(pick, lambda p: F.struct(F.when(~thin(p), _levels(p["band"])).alias("band"), _levels(p["ts"]).alias("whole")))[0]


def _levels(terms: Column) -> Column:
    """array<array<long>>: for each level used, a value per lexicon that the text has terms in: the hash of its sorted
    terms, the lexicon's number in the last bits. The first array holds the first level's number and the hash of all terms,
    which is the base lexicon's value.

    Written for a column of terms that is computed once."""
    pick = F.transform(F.array(terms), lambda ts: F.struct(ts.alias("ts"), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.size(ts), F.lit(1)) / F.lit(SLOTS / 2.0)))).cast("int").alias("r")))
    return F.transform(pick, lambda p: F.concat(F.array(F.array(p["r"].cast("long"), F.xxhash64(F.array_sort(p["ts"])))), F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: _level(p["ts"], p["r"] + k))))[0]


def _level(terms: Column, r: Column) -> Column:
    zero = F.lit(0).cast("long")
    mine = F.filter(terms, lambda t: t.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), r) - 1) == zero)
    # Sorted by lexicon (the six highest bits), then by term: one pass hashes each lexicon's terms in turn.
    mine = F.array_sort(mine)
    start = F.struct(F.array().cast("array<long>").alias("out"), F.lit(-1).cast("long").alias("slot"), zero.alias("h"))
    close = lambda a: F.when(a["slot"] < 0, a["out"]).otherwise(F.concat(a["out"], F.array(a["h"].bitwiseAND(F.lit(-SLOTS)).bitwiseOR(a["slot"]))))

    def step(a: Column, t: Column) -> Column:
        slot = F.shiftrightunsigned(t, 64 - SLOTS.bit_length() + 1)
        same = slot == a["slot"]
        return F.struct(
            F.when(same, a["out"]).otherwise(close(a)).alias("out"), slot.alias("slot"),
            F.when(same, F.xxhash64(a["h"], t)).otherwise(F.xxhash64(r, t)).alias("h"),
        )

    return F.aggregate(mine, start, step, close)


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; by the band if both fingerprints have it, else by all terms."""
    band = a["band"].isNotNull() & b["band"].isNotNull()
    return F.when(band, _likeness(a["band"], b["band"])).otherwise(_likeness(a["whole"], b["whole"])).cast("double")


def _likeness(a: Column, b: Column) -> Column:
    """On the finest level that both use."""
    level = F.greatest(a[0][0], b[0][0])
    x, y = (F.get(v, (level - v[0][0] + 1).cast("int")) for v in (a, b))
    slots = lambda v: F.transform(v, lambda h: h.bitwiseAND(F.lit(SLOTS - 1).cast("long")))
    either = F.size(F.array_union(slots(x), slots(y)))
    alike = F.when(x.isNull() | y.isNull() | (either == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / (either + 1))
    return F.when(a == b, 1.0).when(_empty(a) | _empty(b), 0.0).otherwise(alike)


def _empty(v: Column) -> Column:
    return (v[0][0] == 0) & (F.size(v[1]) == 0)


def as_text(f: Column) -> Column:
    """The fingerprint as one string, of all terms where there is no band; the empty string without terms."""
    used = F.coalesce(f["band"], f["whole"])
    body = F.array_join(F.transform(used, lambda level: F.array_join(F.transform(level, lambda h: F.lower(F.hex(h))), ".")), "-")
    return F.when(_empty(f["whole"]), "").otherwise(body)


def edited(docs: DataFrame, most: float = MOST) -> DataFrame:
    """Each document's fingerprint, and that of its text with the last half replaced by the start of the next document.

    doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next. The next document is the one
    with the next smaller doc_id; after the last comes the first.
    """
    docs = documents(docs).select("doc_id", "tk", F.coalesce("text", F.lit("")).alias("text"))
    stop = stop_terms(docs, most)
    # Ranges of ids with about as many documents each, so that putting documents in order is spread over tasks.
    cuts = docs.select(F.percentile_approx("doc_id", [i / RANGES for i in range(1, RANGES)], 10 * RANGES)).first()[0] or []
    docs = docs.select("*", range_of(F.col("doc_id"), sorted(set(cuts))).alias("range"))
    rows = docs.select("range", "doc_id", "tk", "text", fingerprint(F.col("text"), stop).alias("f"), F.lit(0).alias("extra"))
    # The last document of a range is followed by the first of the next one, which joins it as an extra row.
    heads = docs.groupBy("range").agg(F.max(F.struct("doc_id", "tk")).alias("h"))  # RANGES rows at most
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("range"))
    heads = heads.select("range", "h", F.coalesce(F.lead("h").over(order), F.first("h").over(order)).alias("n"))
    heads = heads.select(F.col("range").alias("before"), F.col("n.doc_id").alias("doc_id"), F.col("n.tk").alias("tk"))
    extra = docs.join(F.broadcast(heads), ["doc_id", "tk"]).dropDuplicates(["before"])
    extra = extra.select(F.col("before").alias("range"), "doc_id", "tk", "text", fingerprint(F.col("text"), stop).alias("f"), F.lit(1).alias("extra"))
    w = Window.partitionBy("range").orderBy("extra", F.desc("doc_id"), F.desc("tk"))
    rows = rows.unionByName(extra).withColumn("next", F.lead(F.struct("text", "f")).over(w)).where("extra = 0")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.substr("text", F.lit(1), n - half), F.substr("next.text", F.lit(1), half)).alias("edited_text"), "f", F.col("next.f").alias("nf"))
    rows = rows.withColumn("ef", fingerprint(F.col("edited_text"), stop))
    return rows.select("doc_id", "n_chars", "edited_text", as_text(F.col("f")).alias("fingerprint"), as_text(F.col("ef")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("ef")).alias("near_edited"), likeness(F.col("f"), F.col("nf")).alias("near_next"))

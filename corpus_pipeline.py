"""The corpus pipeline: quality, toxicity, near duplicates, repeated strings, packing.

STAGES names the stages in order; each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.

Defined results of every stage: null and empty texts are judged as empty; rows that share doc_id and text are copies of one
document and share its fate; rows without a doc_id go in the first stage, as no result can name them; an empty table
gives no rows; other columns go along unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.llm import ngram_join, packing, quality, suffix_sort, toxicity
from scrivena.llm._common import discard, prepare, read, scratch

#: Words of a passage, and of the grams that anchor it.
PASSAGE, PASSAGE_GRAM = 50, 16


def _free(docs: DataFrame, name: str) -> str:
    """The name, with underscores before it until docs has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _matched(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """docs joined with an operator's results by doc_id and the text's hash; `found` brings columns that docs has not."""
    prepare(docs.sparkSession)
    key, tk = _free(docs, "_id"), _free(docs, "_tk")
    rows = docs.where("doc_id is not null").withColumn(key, F.col("doc_id").cast("long")).withColumn(tk, F.xxhash64(F.col("text").cast("string")))
    return rows.join(found.withColumnsRenamed({"doc_id": key, "tk": tk}), [key, tk], how).drop(key, tk)


def _filtered(docs: DataFrame, scores: DataFrame, keep: str) -> DataFrame:
    """The rows of docs whose scores fulfil `keep`."""
    return _matched(docs, scores.where(keep).select("doc_id", "tk"), "left_semi")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality stay (score of 0.7 or more)."""
    return _filtered(docs, quality.classify(docs, read(spark, sf_dir, "labels")), "predicted = 1")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go (score of 0.7 or more)."""
    return _filtered(docs, toxicity.classify(docs, read(spark, sf_dir, "labels")), "predicted = 0")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the least doc_id stays.
    Rows that share a doc_id are one document, of which the row with the least text hash stays."""
    prepare(spark)
    found = ngram_join.join(docs, 5, 80, 100).where("doc_id = component_id")
    return _matched(docs, found.groupBy("doc_id").agg(F.min("tk").alias("tk")), "left_semi").dropDuplicates(["doc_id"])


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of PASSAGE words that also start in a document with a smaller doc_id go, each with the space after
    it; the first copy stays. The text and its n_chars are what is left, which may be nothing; rows stay.

    The operator's 400 bytes are some 60 to 70 words, and would miss passages of little more than 50.
    """
    prepare(spark)
    left = _free(docs, "_kept")
    found = suffix_sort.drop_repeated_strings(docs, PASSAGE, PASSAGE_GRAM, "words", keep_first=True).where("n_removed > 0")
    found = found.select("doc_id", "tk", F.col("kept").cast("string").alias(left)).dropDuplicates(["doc_id", "tk"])
    new = {"text": F.col(left), "n_chars": F.char_length(left).cast("long")}
    out = _matched(docs, found, "left")
    return out.select(*(F.when(F.col(left).isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("packing", sequence_packing),
]

#: Learned scores and tokenization aren't SQL; tests/llm/test_pipeline.py compares the stages and run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents. A stage's table goes when the next one is written, the last one when
    the driver's process ends."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        kept = scratch(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if i:
            discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.llm import divergence, embedding_dedup, fm_index, imatch, ngram_join, packing, piece_codec, prefix_trie, quality, revisit, suffix_sort, toxicity, weak_rules
from scrivena.llm._common import read
from scrivena.llm.oracles import ORACLE_SQL  # noqa: F401


def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revisits among the captures of all pages, resolved."""
    out = revisit.resolve(revisit.captures(read(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.select("record_id", "canonical_url", "ts", "status", "response_id", F.array_join(F.array_sort(lines), "\n").alias("headers"), F.md5("payload").alias("payload_md5"))


def op2_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that also start in a document with a smaller doc_id are removed."""
    out = fm_index.drop_repeated_passages(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op3_quality_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("tk")


def op4_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("tk")


def op5_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


def op6_token_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word n-grams have a Jaccard similarity of 0.9 or more."""
    return ngram_join.join(read(spark, sf_dir, "documents"), 3, 90, 100).drop("tk")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    out = imatch.edited(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 400-byte strings that start anywhere else are removed."""
    out = suffix_sort.drop_repeated_strings(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and representatives of all vectors."""
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to piece ids and decoded again."""
    out = piece_codec.decode(piece_codec.encode(read(spark, sf_dir, "documents"), form="text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return out.select("doc_id", "n_tokens", digest("id_text").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source of all documents against the other sources of its language, and its terms against the language."""
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that they share beginnings."""
    return prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.positions(read(spark, sf_dir, "conversations"))))


def op13_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by base rules and by the posterior of the quality rules' votes."""
    out = weak_rules.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("votes", ",").alias("votes"), F.round("quality", 6).alias("quality"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisit_resolution": op1_revisit_resolution,
    "op2_fm_index_dedup": op2_fm_index_dedup,
    "op3_quality_embeddings": op3_quality_embeddings,
    "op4_counterfactual_toxicity": op4_counterfactual_toxicity,
    "op5_histogram_packing": op5_histogram_packing,
    "op6_token_combination_join": op6_token_combination_join,
    "op7_imatch": op7_imatch,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_piece_codec": op10_piece_codec,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_weak_rules": op13_weak_rules,
}

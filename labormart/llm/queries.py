"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm import classifier, html_text, jaccard, licenses, mixing, nearest, packing, prefix_trie, privacy, quality, repair, substring, token_counts
from labormart.llm.common import settle, table
from labormart.llm.oracle import ORACLE

TOKENIZER = "byte_bpe_50k.json"
#: Key of the registered queries, which run over generated data; real data need a key of their own.
PSEUDONYM_KEY = os.environ.get("LABORMART_PSEUDONYM_KEY", "generated-data-only")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "labormart_workers.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in root.rglob("*.py"):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._llm_shipped = True


def tokenizer_path() -> str:
    return str(public_tokenizers.path(TOKENIZER))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pieces = settle(packing.tokenized_pieces(table(spark, sf_dir, "documents"), tokenizer_path()), "pieces")
    return packing.best_fit_pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", F.col("links").alias("n_links"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), "doc_id", ["source", "lang", "text"], ["text"])
    return found.withColumnRenamed("id", "doc_id")


def op4_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY, counts=True)
    return found


def op9_anchor_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_ngram_jaccard,
        op3_token_counts,
        op4_kmeans_tree_neighbours,
        op5_line_quality,
        op6_mix_sources,
        op7_html_text,
        op8_pseudonyms,
        op9_anchor_repeats,
        op10_license_scan,
        op11_prefix_trie,
        op12_conversation_repair,
        op13_quality_classifier,
    )
}

__all__ = ["ORACLE", "QUERIES", "ship_package", "tokenizer_path"]

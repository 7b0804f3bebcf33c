"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept. Stages are written as Parquet and read again in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labormart.llm import jaccard, mixing, packing, privacy, quality
from labormart.llm.common import remove, scratch_root, scratch_scope, settle, table, write_table
from labormart.llm.queries import PSEUDONYM_KEY, ship_package, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and boilerplate lines leave the texts of the others."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes other data of the same form."""
    return privacy.pseudonymised(docs, PSEUDONYM_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it: not at all, once or twice."""
    ship_package(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    ship_package(spark)
    pieces = settle(packing.tokenized_pieces(docs, tokenizer_path()), "pieces")
    return packing.best_fit_pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("pii", pseudonyms),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; returns the packed pieces.

    A stage's intermediate tables go when its result is written, and a result
    when the next one is. The last stage is computed by the caller: what it reads stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{scratch_root(spark)}/llm-stage-{name}-{uuid.uuid4().hex}"
        with scratch_scope(spark):
            docs = write_table(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hash, permute and tokenize, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None

"""From documents to a tokenised training mix: five stages, each of which works on all that the one before kept.

quality     documents that the pairwise quality ranking rejects go (operator 5)
near_dups   one document of each class of near-equal texts stays: five words, 80 percent (operator 2)
repeats     100-byte strings that occurred earlier go; documents without a word left go (operator 6)
mix         documents are taken by weighted fair queueing, some twice, some not at all (operator 8)
encode      doc_id, source, n_tokens and ids of every taken document (operator 10)

All but the last return the columns of ``documents``. The stages take nulls,
empty texts, repeated rows and empty tables as their operators do.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.llm.bpe import bpe_encode
from tripaudit.llm.common import WORD_SQL, staged, table
from tripaudit.llm.jaccard import jaccard_classes
from tripaudit.llm.mixing import mixed_documents
from tripaudit.llm.quality_model import train, with_scores
from tripaudit.llm.repeats import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS)
    model = train(rows, table(spark, sf_dir, "labels"))
    return with_scores(rows, model).where("predicted = 1").select(*COLUMNS)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(*COLUMNS)
    kept = jaccard_classes(rows, 5, 80).where("component_id = doc_id").select(F.col("doc_id").alias("_id")).distinct()
    # repeated rows of an id that stays are one document; rows without an id always stay
    return rows.join(kept, F.col("doc_id") == F.col("_id")).drop("_id").dropDuplicates(["doc_id"]).union(rows.where(F.col("doc_id").isNull()))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = remove_repeats(docs.select(*COLUMNS), carry=("lang", "source"))
    word = F.regexp_like("kept_text", F.lit(WORD_SQL))
    kept = found.where((F.col("n_removed") == 0) | word)
    text = F.when((F.col("n_bytes") > 0), F.col("kept_text")).otherwise(F.lit(""))
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_encode(docs.select("doc_id", "source", "text"), VOCABULARY).select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_dups", near_dups), ("repeats", repeats), ("mix", mix), ("encode", encode),
]

#: The first stage learns a model, which SQL can't express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written under the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

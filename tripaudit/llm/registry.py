"""The ``opN_*`` queries: each applies its operator to its whole table. name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversations, jaccard, language, mixing, personal, phrases, quality_model, quality_rules, repeats, sharding, token_files, vector_graph
from .common import table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_vector_graph": (lambda spark, d: vector_graph.vector_duplicates(table(spark, d, "embeddings"), 0.95), vector_graph.SQL),
    "op2_jaccard": (lambda spark, d: jaccard.jaccard_classes(table(spark, d, "documents"), 4, 85), jaccard.SQL),
    "op3_sharding": (lambda spark, d: sharding.shard_rows(table(spark, d, "documents"), 24), sharding.SQL),
    "op4_line_rules": (lambda spark, d: quality_rules.line_rules(table(spark, d, "documents"), with_text=False), quality_rules.SQL),
    "op5_pairwise_quality": (lambda spark, d: quality_model.quality_scores(table(spark, d, "documents"), table(spark, d, "labels")), None),
    "op6_repeats": (lambda spark, d: repeats.remove_repeats(table(spark, d, "documents"), 100, with_text=False), None),
    "op7_language": (lambda spark, d: language.languages_of(table(spark, d, "documents")), None),
    "op8_mixing": (lambda spark, d: mixing.mix_plan(table(spark, d, "documents")).drop("source", "_order"), mixing.SQL),
    "op9_token_files": (lambda spark, d: token_files.token_files(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2), None),
    "op10_bpe": (lambda spark, d: bpe.bpe_digests(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json")), None),
    "op11_personal": (lambda spark, d: personal.personal_spans(table(spark, d, "documents")), personal.SQL),
    "op12_conversations": (lambda spark, d: conversations.damage_and_repair(table(spark, d, "conversations")), conversations.SQL),
    "op13_collocations": (lambda spark, d: phrases.collocations(table(spark, d, "documents")), phrases.SQL),
}

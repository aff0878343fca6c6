"""Registered queries of the operators: whole tables in, one digest per row out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from webwinnow.llm.chat_snapshots import render_maximal
from webwinnow.llm.common import table
from webwinnow.llm.compression_classifier import score_quality
from webwinnow.llm.decontamination import contaminated
from webwinnow.llm.jaccard_join import jaccard_components
from webwinnow.llm.licence_scan import licence_digest
from webwinnow.llm.prefix_trie import prefix_trie
from webwinnow.llm.quality_rules import quality_verdicts
from webwinnow.llm.secret_scan import secrets
from webwinnow.llm.structure_repair import damaged, repair_digest
from webwinnow.llm.token_counts import token_counts
from webwinnow.llm.toxicity import toxic_grades
from webwinnow.llm.warc_revisits import revisit_table
from webwinnow.llm.weighted_mix import mixed


def op1_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("source", "epochs")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisit_table(table(spark, sf_dir, "pages"))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_maximal(table(spark, sf_dir, "conversations"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op6_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_grades(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_digest(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair_digest(damaged(turns), turns)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"), shared_leads=True)


QUERIES = {
    run.__name__: run
    for run in (
        op1_weighted_mix, op2_ngram_jaccard_join, op3_warc_revisits, op4_chat_snapshots, op5_quality_rules,
        op6_compression_classifier, op7_toxicity, op8_licence_scan, op9_secret_scan, op10_decontamination,
        op11_token_counts, op12_structure_repair, op13_prefix_trie,
    )
}

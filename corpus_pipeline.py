"""A training-corpus pipeline over ``documents``: good rows, without boilerplate lines, near copies and benchmark text, packed.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``docs``.
``run`` writes each stage's rows as Parquet in the shared folder and reads them back for the next one.
Nulls, empty tables and repeated rows are handled as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caselake.llm import divergence, line_templates, packing, slot_windows, vertical_join
from caselake.llm.queries import WORD_END, WORD_VOCABULARY, read, tokenizer_file
from caselake.llm.store import drop, write_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return divergence.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.drop_lines(docs, counts=False)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vertical_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return slot_windows.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file(WORD_VOCABULARY), WORD_END)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("decontamination", decontamination),
    ("packing", sequence_packing),
]

# Tokenizers, shingle components and template lines are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = write_out(stage(spark, docs, sf_dir), name)
        if last:
            drop(spark, last)
        last = path
    return docs

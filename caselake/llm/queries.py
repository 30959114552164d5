"""The operators bound to the given tables, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from caselake.llm import (block_search, divergence, filter_audit, hard_negatives, hyperdim, line_templates, oracle, packing, page_templates,
                          sentence_spans, signatures, slot_windows, token_planes, vertical_join)
from caselake.llm.store import new_folder

BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 0
WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 2


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    _reach_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _reach_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did."""
    here, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if here not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [here, known.get("PYTHONPATH", "")]))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return slot_windows.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_planes.write_tokens(read(spark, folder, "documents"), path, tokenizer_file(BYTE_VOCABULARY), BYTE_END)
    return token_planes.token_digests(spark, path)


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return vertical_join.similar_components(read(spark, folder, "documents"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = read(spark, folder, "documents"), hyperdim.held_out_fold()
    return hyperdim.predict(docs, hyperdim.learn_prototypes(docs.where(~held_out)), held_out)


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return page_templates.main_texts(read(spark, folder, "pages"))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.drop_lines(read(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.quality_report(read(spark, folder, "documents"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = sentence_spans.deduplicate(read(spark, folder, "documents"), only_changed=True)
    return found.select("doc_id", "first_docs", "n_sentences", "n_removed", "text")


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return signatures.scan(read(spark, folder, "documents"))


def sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_file(WORD_VOCABULARY), WORD_END)


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(read(spark, folder, "embeddings")), hard_negatives.anchors_where())


def filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


def exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.top_k(read(spark, folder, "embeddings"), block_search.queries_where())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontamination, "op2_token_planes": token_output, "op3_ngram_jaccard_join": jaccard_join,
        "op4_language_id": language_id, "op5_html_extraction": html_extraction, "op6_line_dedup": line_dedup,
        "op7_quality_rules": quality_rules, "op8_substring_dedup": substring_dedup, "op9_license_scan": license_scan,
        "op10_packing": sequence_packing, "op11_hard_negatives": mined_negatives, "op12_filter_audit": filter_interactions,
        "op13_exact_search": exact_search,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator; the others are tested against brute force."""
    return {"op11_hard_negatives": oracle.HARD_NEGATIVES, "op12_filter_audit": oracle.FILTER_AUDIT, "op13_exact_search": oracle.TOP_K}

"""Staged files to Bronze: all text, with lineage, checked against the manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from caselake.operators.publish import write_slices
from caselake.plans import domain
from caselake.sources import staging
from caselake.specs import PARTITION_COLUMNS, ContractViolation, Slice

LINEAGE_CONSTANTS = {
    "_source_system": domain.SOURCE_SYSTEM,
    "_ingestion_source": domain.INGESTION_SOURCE,
    "_source_format": domain.SOURCE_FORMAT,
}


def bronze_frame(raw: DataFrame, manifests: DataFrame, part: Slice, batch_id: str, environment: str) -> DataFrame:
    return staging.with_lineage(
        raw, part, manifests, batch_id, environment, domain.SOURCE_COLUMNS, domain.DATE_COLUMN,
        "ID_AGRAVO", domain.DISEASE_OF_CODE, domain.UNKNOWN_DISEASE, LINEAGE_CONSTANTS,
    )


def intake_stats():
    return [
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("_notification_date").isNull()).alias("invalid_notification_date_count"),
        F.count_if(F.col("disease") == domain.UNKNOWN_DISEASE).alias("unknown_disease_count"),
    ]


def check_closure(counted: DataFrame, manifests: DataFrame) -> None:
    open_periods = staging.closure(counted, manifests).filter("NOT closed").limit(20).collect()
    if open_periods:
        shown = ", ".join(
            f"{p['reference_period']}: expected {p['expected_count']}, read {p['actual_count']}"
            for p in open_periods
        )
        raise ContractViolation(f"Staged rows do not match the manifests: {shown}")


def load_bronze(spark: SparkSession, part: Slice, staging_root: str, bronze_root: str, batch_id: str,
                environment: str = "dev", mode: str = "overwrite") -> dict:
    """Check manifests and closure, then write. Returns the intake counts.

    Closure counts lines per period from a scan without columns before anything is written;
    the other counts are observed while writing.
    """
    manifests = staging.read_manifests(spark, part, staging_root)
    periods = staging.require_manifests(manifests, part, domain.MANIFEST_REQUIRED, staging_root)
    raw = staging.read_staging(spark, part, staging_root, domain.SOURCE_COLUMNS, periods)
    counted = (
        raw.groupBy(F.regexp_extract("_source_file", staging.PERIOD_IN_PATH, 1).alias("reference_period"))
        .agg(F.count(F.lit(1)).alias("actual_count"))
    )
    check_closure(counted, manifests)
    seen = Observation("bronze_intake")
    frame = bronze_frame(raw, manifests, part, batch_id, environment).observe(seen, *intake_stats())
    write_slices(frame, bronze_root, PARTITION_COLUMNS, mode)
    return dict(seen.get)

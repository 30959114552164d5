"""Silver to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.functions import coding, identity, temporal
from caselake.operators import keysets, publish, quality, star, versions
from caselake.plans import domain
from caselake.session import materialise
from caselake.sources import paths
from caselake.specs import ContractViolation, Slice, require_columns


def latest_cases(silver: DataFrame) -> DataFrame:
    """Publishable rows first, then the newest version of each record. Runs a job over the ids; Silver comes from files."""
    require_columns(silver.columns, domain.SILVER_REQUIRED, "Silver snapshot")
    usable = silver.filter(F.col(quality.STATUS).isin(*domain.PUBLISHABLE))
    return versions.latest_stored(usable, "record_id", domain.LATEST_FIRST)


def dimensions(cases: DataFrame) -> dict[str, DataFrame]:
    label = domain.UNKNOWN_LABEL
    return {
        "dim_date": star.date_dimension(cases, "notification_date", domain.DATE_ROLES, label),
        "dim_location": star.location_dimension(
            cases, domain.LOCATION_ROLES, domain.LOCATION_ATTRIBUTES, "municipality_code_ibge", label
        ),
        **{d.table: star.junk_dimension(cases, d, label) for d in domain.JUNK_DIMENSIONS},
    }


def fact(cases: DataFrame) -> DataFrame:
    """One row per case: lineage, foreign keys, measures, status and partition columns."""
    return cases.select(
        F.col("record_id").alias(domain.GRAIN),
        "record_hash", "source_batch_id", "source_extraction_batch_id", "source_manifest",
        "ingestion_source", "processing_date", "granularity", "reference_period", "environment",
        *(temporal.date_key(F.col(role)).alias(f"{role}_key") for role in domain.DATE_ROLES),
        *(
            identity.natural_key(F.col(f"{role}_municipality_code_ibge")).alias(f"{role}_location_key")
            for role in domain.LOCATION_ROLES
        ),
        *(identity.surrogate_key(d.key_attributes).alias(d.key) for d in domain.JUNK_DIMENSIONS),
        "notification_epidemiological_week", "symptoms_epidemiological_week",
        F.lit(1).alias("notification_count"),
        *(coding.as_measure(F.col(flag)).alias(m) for m, flag in domain.FLAG_MEASURES.items()),
        (F.size(quality.WARNINGS) > 0).cast("int").alias("quality_warning_count"),
        quality.STATUS, quality.WARNINGS, "source_system", "source_reference_year", "source_file",
        "bronze_loaded_at", "silver_loaded_at",
        F.current_timestamp().alias("gold_loaded_at"),
        F.year("notification_date").alias("notification_year"),
        F.date_format("notification_date", "MM").alias("notification_month"),
    )


def gold_tables(cases: DataFrame) -> dict[str, DataFrame]:
    return dimensions(cases) | {domain.FACT_TABLE: fact(cases)}


def load_gold(spark: SparkSession, part: Slice, silver_root: str, gold_root: str, batch_id: str,
              mode: str = "overwrite") -> dict:
    """Rebuild the star from the whole Silver snapshot into a folder of this batch.

    Readers keep the snapshot they have until the new one has passed reconciliation, so they
    never see tables of two runs together.
    """
    if mode != "overwrite":
        raise ContractViolation(f"Invalid write mode {mode!r}: the Gold snapshot requires overwrite.")
    current = paths.read_slice(spark, silver_root, part)
    require_columns(current.columns, domain.SILVER_REQUIRED, "current Silver slice")
    quality.require_batch(current, "source_batch_id", batch_id)
    cases = materialise(latest_cases(paths.read_snapshot(spark, silver_root)), "gold")
    repeated = keysets.duplicate_keys(cases, "record_id").count()
    if repeated:
        raise ContractViolation(f"Gold grain violation: {repeated} duplicate record_id values.")
    if cases.isEmpty():
        raise ContractViolation("No Silver records available for the Gold layer.")
    folders = gold_folders(spark, gold_root, batch_id)
    for name, table in gold_tables(cases).items():
        keys = domain.FACT_PARTITIONS if name == domain.FACT_TABLE else ()
        publish.write_snapshot(table, folders[name], keys)
    return folders


def gold_folders(spark: SparkSession, gold_root: str, batch_id: str) -> dict[str, str]:
    home = f"{gold_root.rstrip('/')}/snapshot={publish.safe_folder(spark, batch_id)}"
    return {name: f"{home}/{name}" for name in (*domain.DIMENSION_KEYS, domain.FACT_TABLE)}


def read_gold(spark: SparkSession, folders: dict) -> dict[str, DataFrame]:
    return {name: paths.partition_text(spark.read.parquet(path)) for name, path in folders.items()}

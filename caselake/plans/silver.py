"""Bronze to Silver and Quarantine: typed, enriched, decoded and rule-checked."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from caselake.functions import identity
from caselake.functions.text import null_if
from caselake.operators import enrich, projection, quality
from caselake.operators.publish import replace_slices, write_slices
from caselake.operators.versions import mark_repeats_stored
from caselake.plans import domain
from caselake.session import materialise
from caselake.sources import paths
from caselake.specs import PARTITION_COLUMNS, ContractViolation, Slice, require_columns


@dataclass(frozen=True)
class SilverRun:
    """Values of one run that the rules compare with."""

    batch_id: str
    as_of: date
    environment: str = "dev"
    strict_dates: bool = True
    framed_hash: bool = False


def content_columns(bronze: DataFrame) -> list[str]:
    return [c for c in bronze.columns if not c.startswith("_") and c not in domain.DERIVED_COLUMNS]


def cases(bronze: DataFrame, run: SilverRun) -> DataFrame:
    """Typed cases with their identity."""
    return _identified(_typed(bronze, run))


def _typed(bronze: DataFrame, run: SilverRun) -> DataFrame:
    require_columns(bronze.columns, domain.BRONZE_REQUIRED, "Bronze")
    hashed = bronze.withColumn(
        "_source_record_hash", identity.content_hash(content_columns(bronze), run.framed_hash)
    )
    typed = projection.typed(hashed, domain.CASE_COLUMNS, run.strict_dates)
    place = "infection_municipality_code_sinan"
    return typed.withColumn(place, null_if(F.col(place), domain.NO_INFECTION_PLACE))


def _identified(typed: DataFrame) -> DataFrame:
    return typed.withColumn("record_id", identity.record_identity(
        F.col("source_system"), F.col("source_reference_year"), F.col("record_hash")
    ))


def classified(bronze: DataFrame, reference: DataFrame, run: SilverRun) -> DataFrame:
    """All rows with attributes, flags, codes and status.

    The typed rows are written once to the shared folder, without the id, which follows from the hash. Repeats are marked
    over them, first of all: only rows whose id may occur again are shuffled, and labels and places are added afterwards.
    """
    typed = _identified(materialise(_typed(bronze, run), "typed", ("record_hash",)))
    marked = mark_repeats_stored(typed, "record_id", ("bronze_loaded_at", "source_file"), PARTITION_COLUMNS)
    placed = enrich.attach_roles(
        marked, reference,
        {role: f"{role}_municipality_code_sinan" for role in domain.LOCATION_ROLES},
        "municipality_code_sinan", domain.LOCATION_ATTRIBUTES,
    )
    aged = projection.with_age(
        placed, "age_encoded", domain.YEAR_UNIT, domain.SHORTER_UNITS,
        domain.AGE_BANDS, domain.AGE_BAND_MISSING,
    )
    decoded = projection.with_flags(
        projection.with_labels(aged, domain.LABELLED, domain.UNMAPPED), domain.CASE_FLAGS
    ).withColumns({
        "silver_loaded_at": F.current_timestamp(),
        "environment": F.lit(run.environment),
        "notification_month": F.date_format("notification_date", "MM"),
    })
    checked = quality.with_codes(
        decoded, domain.ERROR_RULES, domain.WARNING_RULES,
        {"_as_of": run.as_of, "_run_batch": run.batch_id},
    )
    return quality.with_status(
        quality.append_code(checked, "_repeat", domain.DUPLICATE_CODE).drop("_repeat")
    )


def load_silver(spark: SparkSession, part: Slice, bronze_root: str, silver_root: str,
                quarantine_root: str, reference: DataFrame, run: SilverRun, mode: str = "overwrite",
                periods=None) -> dict:
    """Classify one slice and write both outputs. Returns the counts.

    The classified rows are written once to the shared folder, counted on the way; both
    outputs read them back, so the window and the joins run once.
    """
    bronze = paths.read_slice(spark, bronze_root, part)
    if periods:
        bronze = bronze.filter(F.col("reference_period").isin(*periods))
    seen = Observation("silver_classified")
    rows = materialise(
        classified(bronze, reference, run).observe(seen, *quality.stat_columns()), "silver", domain.DIGESTS
    )
    stats = dict(seen.get)
    if stats["silver_record_count"] == 0:
        raise ContractViolation("No valid records available for the Silver layer.")
    clean, bad = quality.split(rows)
    # Bronze lies in these folders, and classification leaves its rows in the order of their files.
    write_slices(clean, silver_root, PARTITION_COLUMNS, mode, grouped=True)
    bad = bad.withColumn("quarantined_at", F.current_timestamp())
    keys = (*PARTITION_COLUMNS, quality.PRIMARY)
    if mode == "append":
        if stats["quarantine_record_count"]:
            write_slices(bad, quarantine_root, keys, "append")
    else:
        replaced = [part.at(p) for p in periods] if periods else [part]
        replace_slices(bad, quarantine_root, keys, replaced)
    return stats

"""Rule engine: ordered codes, row status, split and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caselake.specs import ContractViolation

ERRORS = "quality_error_codes"
WARNINGS = "quality_warning_codes"
STATUS = "data_quality_status"
PRIMARY = "primary_error_code"


def codes(rules) -> Column:
    """Codes of every rule that holds, in rule order. A NULL predicate does not hold."""
    return F.array_compact(F.array(*(F.when(F.expr(r.predicate), F.lit(r.code)) for r in rules)))


def with_codes(df: DataFrame, errors, warnings, run_values: dict) -> DataFrame:
    """Add error and warning codes. ``run_values`` are literals the predicates may name."""
    return (
        df.withColumns({name: F.lit(value) for name, value in run_values.items()})
        .withColumns({ERRORS: codes(errors), WARNINGS: codes(warnings)})
        .drop(*run_values)
    )


def append_code(df: DataFrame, flag: str, code: str) -> DataFrame:
    """Add a code behind all others where the flag is true."""
    extended = F.array_union(F.col(ERRORS), F.array(F.lit(code)))
    return df.withColumn(ERRORS, F.when(F.col(flag), extended).otherwise(F.col(ERRORS)))


def with_status(df: DataFrame) -> DataFrame:
    status = (
        F.when(F.size(ERRORS) > 0, "quarantined").when(F.size(WARNINGS) > 0, "warning").otherwise("valid")
    )
    return df.withColumn(STATUS, status)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows without the error codes; quarantined rows with their first code."""
    clean = df.filter(F.size(ERRORS) == 0).drop(ERRORS)
    bad = df.filter(F.size(ERRORS) > 0).withColumn(PRIMARY, F.get(F.col(ERRORS), F.lit(0)))
    return clean, bad


def stat_columns() -> list[Column]:
    """Counts for ``agg`` or for ``observe`` during a write."""
    return [
        F.count(F.lit(1)).alias("input_record_count"),
        F.count_if(F.size(ERRORS) == 0).alias("silver_record_count"),
        F.count_if(F.size(ERRORS) > 0).alias("quarantine_record_count"),
        F.count_if((F.size(ERRORS) == 0) & (F.size(WARNINGS) > 0)).alias("warning_record_count"),
    ]


def foreign_batch(column: str, batch_id: str) -> Column:
    """Rows of another batch, or of none."""
    return ~F.col(column).eqNullSafe(F.lit(batch_id))


def require_batch(df: DataFrame, column: str, batch_id: str) -> None:
    """Runs one aggregate; fails on an empty slice or on rows of another batch."""
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(foreign_batch(column, batch_id)).alias("foreign")
    ).first()
    if seen["rows"] == 0:
        raise ContractViolation("No Silver records found for the current slice.")
    if seen["foreign"]:
        raise ContractViolation(f"{seen['foreign']} records do not belong to batch {batch_id}.")

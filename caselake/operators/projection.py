"""Typed projection, decoding and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caselake.functions import coding, temporal, text

CASTS = {
    "text": lambda c: c,
    "upper": F.upper,
    "lower": F.lower,
    "int": temporal.safe_int,
    "date": temporal.strict_date,
    "timestamp": temporal.safe_timestamp,
}


def typed(df: DataFrame, columns, strict_dates: bool = True) -> DataFrame:
    """Project source text to the declared names and types; bad values become NULL."""
    casts = CASTS if strict_dates else CASTS | {"date": temporal.lenient_date}
    return df.select(
        *(casts[spec.kind](text.clean_or_null(df, spec.source)).alias(spec.name) for spec in columns)
    )


def bind(df: DataFrame, columns: dict) -> DataFrame:
    """Add columns that are evaluated once per row.

    A plain projection is copied into every filter pushed below it, which for long expressions
    costs one evaluation per use. A generated row is not: filters on it stay above it.
    """
    row = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select(*(c for c in df.columns if c not in columns), F.inline(F.array(row)))


def with_labels(df: DataFrame, labelled: dict, unmapped: str) -> DataFrame:
    """Add ``<stem>_name`` beside each ``<stem>_code``."""
    return df.withColumns({
        f"{stem}_name": coding.label_of(F.col(f"{stem}_code"), labels, unmapped)
        for stem, labels in labelled.items()
    })


def with_age(df: DataFrame, encoded: str, year_unit: str, shorter_units, bands, missing: str) -> DataFrame:
    """Decode unit and value from the encoded age, then years and band."""
    decoded = df.withColumns({
        "age_unit_code": coding.age_unit(F.col(encoded)),
        "age_value": coding.age_value(F.col(encoded)),
    })
    aged = decoded.withColumn(
        "age_years",
        coding.age_in_years(F.col("age_unit_code"), F.col("age_value"), year_unit, shorter_units),
    )
    return aged.withColumn("age_group_name", coding.band_of(F.col("age_years"), bands, missing))


def with_flags(df: DataFrame, flags) -> DataFrame:
    return df.withColumns({flag.name: coding.flag_value(flag) for flag in flags})

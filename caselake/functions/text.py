"""Text cleaning."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

# Spellings of "no value" in the source, compared without case.
NULL_WORDS = ("", "nan", "null", "none")


def clean_text(column: Column) -> Column:
    """Trimmed text, or NULL for every spelling of an absent value."""
    trimmed = F.trim(column.cast("string"))
    return F.when(~F.lower(trimmed).isin(*NULL_WORDS), trimmed)


def clean_or_null(df: DataFrame, name: str) -> Column:
    """Clean text of a column that an older file may lack."""
    return clean_text(F.col(name)) if name in df.columns else F.lit(None).cast("string")


def null_if(column: Column, sentinel: str) -> Column:
    return F.nullif(column, F.lit(sentinel))


def filled(column: Column) -> Column:
    """True for text with at least one visible character, false for blank and NULL."""
    return F.coalesce(column.rlike(r"\S"), F.lit(False))


def snake_name(raw: str, fallback: str = "unknown_column") -> str:
    """ASCII snake-case spelling of a header cell."""
    plain = "".join(ch for ch in unicodedata.normalize("NFKD", raw) if ch.isascii())
    return "_".join(re.findall(r"[a-z0-9]+", plain.lower())) or fallback


def file_safe(column: Column) -> Column:
    """A value usable as a folder name."""
    return F.regexp_replace(column, r"[^A-Za-z0-9_.-]+", "_")

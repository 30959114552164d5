"""Dates, minutes and numbers read from text. Bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns.
ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ISO_DAY_20TH_21ST = r"^(19|20)[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
ISO_INSTANT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)
ZONED = r"(Z|[+-][0-9]{2}:[0-9]{2})$"


def strict_date(column: Column, pattern: str = ISO_DAY) -> Column:
    """Calendar date of ``yyyy-MM-dd`` text; other spellings and impossible days are NULL."""
    text = F.trim(column)
    return F.when(text.rlike(pattern), F.try_to_date(text, "yyyy-MM-dd"))


def lenient_date(column: Column) -> Column:
    """Also accepts the partial forms a plain cast accepts, such as ``2024-1-5``."""
    return column.try_cast("date")


def safe_timestamp(column: Column) -> Column:
    return column.try_cast("timestamp")


def safe_int(column: Column) -> Column:
    """Whole part of decimal text (``2024`` and ``2024.0``), NULL when it is not a number."""
    whole = F.regexp_extract(F.trim(column), r"^([+-]?[0-9]+)([.][0-9]*)?$", 1)
    return whole.try_cast("int")


def iso_instant(column: Column) -> Column:
    """Timestamp of ISO-8601 text; a value without a zone is taken as UTC."""
    text = F.trim(column)
    zoned = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).when(
        text.rlike(ZONED), text
    ).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(ISO_INSTANT), zoned.try_cast("timestamp"))


def minute_bucket(column: Column) -> Column:
    """Start of the minute that holds an instant."""
    return F.date_trunc("minute", column)


def year_or_unknown(column: Column) -> Column:
    return F.coalesce(F.date_format(column, "yyyy"), F.lit("unknown"))


def month_or_unknown(column: Column) -> Column:
    return F.coalesce(F.date_format(column, "MM"), F.lit("unknown"))


def date_key(column: Column) -> Column:
    """``yyyyMMdd`` as an int, -1 for no date."""
    digits = F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)
    return F.coalesce(digits, F.lit(-1))

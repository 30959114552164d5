"""Codes to labels, ages to bands, predicates to flags, flags to measures."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F

from caselake.functions.temporal import safe_int
from caselake.specs import Flag


def label_of(code: Column, labels: dict[str, str], unmapped: str) -> Column:
    """Label of a code; NULL stays NULL and an unlisted code says so."""
    table = F.create_map(*(F.lit(part) for part in chain.from_iterable(labels.items())))
    return F.when(code.isNotNull(), F.coalesce(F.element_at(table, code), F.lit(unmapped)))


def band_of(number: Column, bands, missing: str) -> Column:
    """Label of the first ``(low, high, label)`` holding the number; an open end is None."""

    def holds(low, high):
        if high is None:
            return number >= low
        return number == low if low == high else number.between(low, high)

    picked = reduce(
        lambda so_far, band: F.coalesce(so_far, F.when(holds(*band[:2]), F.lit(band[2]))),
        bands, F.lit(None).cast("string"),
    )
    return F.coalesce(picked, F.lit(missing))


def decade_band(age: Column) -> Column:
    """``00-09`` … ``70-79``, then ``80+``."""
    low = F.greatest(F.floor(age / 10), F.lit(0)) * 10
    span = F.concat_ws("-", F.lpad(low.cast("string"), 2, "0"), F.lpad((low + 9).cast("string"), 2, "0"))
    return F.when(age >= 80, F.lit("80+")).when(age.isNotNull(), span)


def age_unit(encoded: Column) -> Column:
    return F.substring(encoded, 1, 1)


def age_value(encoded: Column) -> Column:
    return safe_int(F.substring(encoded, 2, 3))


def age_in_years(unit: Column, value: Column, year_unit: str, shorter_units) -> Column:
    """Years lived: the value itself in years, 0 in any shorter unit, else NULL."""
    return F.when(unit == year_unit, value).when(unit.isin(*shorter_units), F.lit(0))


def flag_value(flag: Flag) -> Column:
    """TRUE, FALSE or NULL for not known."""
    return F.when(F.expr(flag.true_when), F.lit(True)).when(F.expr(flag.false_when), F.lit(False))


def as_measure(flag: Column) -> Column:
    """1 for TRUE; 0 for FALSE and for not known."""
    return F.coalesce(flag, F.lit(False)).cast("int")

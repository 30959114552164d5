"""Dimensions with an unknown member, and the fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselake.functions.identity import UNKNOWN_KEY, natural_key, surrogate_key
from caselake.functions.temporal import date_key
from caselake.specs import JunkDimension


def with_unknown(dimension: DataFrame, values: dict) -> DataFrame:
    """Put the unknown member in front; columns without a value are NULL."""
    member = dimension.sparkSession.range(1).select(*(
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dimension.schema.fields
    ))
    return member.unionByName(dimension)


def distinct_values(df: DataFrame, columns) -> DataFrame:
    """Distinct non-NULL values over several columns, in one pass over the rows."""
    return (
        df.select(F.explode(F.array(*map(F.col, columns))).alias("value"))
        .filter("value IS NOT NULL").distinct()
    )


def calendar(df: DataFrame, main: str, roles) -> DataFrame:
    """Every day between the first and last ``main`` date, and each day any role mentions.

    Only ``main`` spans a range: an outlier in another role adds one day, not millions.
    """
    seen = distinct_values(df, roles)
    span = df.agg(F.min(main).alias("first"), F.max(main).alias("last")).filter("first IS NOT NULL")
    days = span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("value"))
    return days.unionByName(seen).distinct().withColumnRenamed("value", "calendar_date")


def date_dimension(df: DataFrame, main: str, roles, unknown_label: str) -> DataFrame:
    day = F.col("calendar_date")
    dimension = calendar(df, main, roles).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("iso_week_of_year"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )
    return with_unknown(dimension, {"date_key": UNKNOWN_KEY, "year_month": unknown_label})


def location_dimension(df: DataFrame, roles, attributes, code: str, unknown_label: str) -> DataFrame:
    """One row per official code over all roles, read in one pass.

    Distinct combinations come first, on the hash path; the pick of one per code then runs on
    a table of the dimension's size.
    """
    combos = F.array(*(
        F.struct(*(F.col(f"{role}_{a}").alias(a) for a in attributes)) for role in roles
    ))
    found = df.select(F.inline(combos)).filter(F.col(code).isNotNull()).distinct()
    picked = found.groupBy(F.col(code).alias("_code")).agg(F.min(F.struct(*attributes)).alias("member"))
    dimension = picked.select(natural_key(F.col("_code")).alias("location_key"), "member.*")
    return with_unknown(dimension, {"location_key": UNKNOWN_KEY} | dict.fromkeys(attributes, unknown_label))


def junk_dimension(df: DataFrame, spec: JunkDimension, unknown_label: str) -> DataFrame:
    """Distinct attribute combinations; those without any key attribute are the unknown member."""
    dimension = (
        df.select(*spec.attributes).distinct()
        .withColumn(spec.key, surrogate_key(spec.key_attributes))
        .filter(F.col(spec.key) != UNKNOWN_KEY)
        .select(spec.key, *spec.attributes)
    )
    text = {f.name: unknown_label for f in dimension.schema.fields if f.dataType.simpleString() == "string"}
    return with_unknown(dimension, text | spec.unknown | {spec.key: UNKNOWN_KEY})


def star_join(fact: DataFrame, members) -> DataFrame:
    """Inner-join ``(dimension, fact key, dimension key, columns)`` tables to the fact.

    No hints: Spark broadcasts a dimension whose measured size is under its threshold and
    shuffles one that is not.
    """
    def step(df, member):
        dimension, fact_key, key, columns = member
        side = dimension.select(F.col(key).alias(f"_{fact_key}"), *columns)
        return df.join(side, F.col(fact_key) == F.col(f"_{fact_key}")).drop(f"_{fact_key}")

    return reduce(step, members, fact)


def invalid_measures(measures, always_one: str) -> Column:
    """True where the count measure is not 1, or another one is not 0 or 1."""
    wrong = [
        F.col(m).isNull() | ((F.col(m) != 1) if m == always_one else ~F.col(m).isin(0, 1))
        for m in measures
    ]
    return reduce(Column.__or__, wrong)

"""Sums by key, rates and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def percentage(part: Column, whole: Column) -> Column:
    """100 · part / whole to two places, NULL when there is no whole."""
    exact = F.lit(100).cast("decimal(5,1)") * part.cast("decimal(20,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, 2).cast("double")


def sum_by(df: DataFrame, keys: dict, measures: dict) -> DataFrame:
    """Group by renamed keys and sum renamed measures (output name to input column)."""
    return df.groupBy(*(F.col(source).alias(name) for name, source in keys.items())).agg(
        *(F.sum(source).alias(name) for name, source in measures.items())
    )


def top_rows(df: DataFrame, order, limit: int) -> DataFrame:
    """First rows in a total order; each task keeps its own best before they meet."""
    return df.orderBy(*order).limit(limit)


def positions(df: DataFrame, order, name: str = "position") -> DataFrame:
    """1..n over a table already reduced to one row per ranked thing."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))

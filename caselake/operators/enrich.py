"""Role-playing joins to a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach_roles(df: DataFrame, reference: DataFrame, roles: dict, code: str, attributes) -> DataFrame:
    """Left-join the reference once per role, prefixing its attributes with the role.

    ``roles`` maps a prefix to the code column of ``df``; ``code`` must be unique in the
    reference. Spark chooses the join by the measured size of the reference: a small one is
    broadcast, beyond that adaptive execution splits the rows of a hot code.
    """
    for prefix, column in roles.items():
        side = reference.select(
            F.col(code).alias(f"_{prefix}_code"),
            *(F.col(a).alias(f"{prefix}_{a}") for a in attributes if f"{prefix}_{a}" != column),
        )
        df = df.join(side, F.col(column) == F.col(f"_{prefix}_code"), "left").drop(f"_{prefix}_code")
    return df

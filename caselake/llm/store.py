"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the warehouse, which is shared as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/caselake-llm/{label}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, label: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Write ``df`` once as Parquet and read it back: a lost executor re-reads files, no plan runs again."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def others(docs: DataFrame, *own: str) -> list[str]:
    """Columns of ``docs`` that are not named like one of ``own``; Spark's names ignore case."""
    return [c for c in docs.columns if c.lower() not in own]


def field(name: str, of: str | None = None) -> Column:
    """A column by its exact name, whatever characters are in it."""
    quoted = f"`{name.replace('`', '``')}`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def free_prefix(docs: DataFrame) -> str:
    """A prefix that no column of ``docs`` starts with."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete folders that this package wrote and no later step reads."""
    jvm = spark._jvm
    for path in paths:
        if "/caselake-llm/" not in path:
            raise ValueError(f"Not a scratch folder: {path}")
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

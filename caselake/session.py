"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps processing_date, year and month folders as text: month "01" must not become 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # Methods beyond this size are never compiled by the JVM; wide rows reach it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "caselake", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a scan with fewer splits than cores, such as one file of one row group.

    A large table has more splits than cores, also in few files, and is returned as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    Only a local session may fall back to the machine's own temporary folder: on a cluster
    the executors could not see it, and it would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        root = tempfile.mkdtemp(prefix="caselake-")
    return f"{root.rstrip('/')}/caselake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, digests=()) -> DataFrame:
    """Write once to the shared folder and read back, cutting the lineage.

    Later readers prune columns from Parquet, and a lost executor re-reads files instead of
    re-running the plan, which neither ``cache`` nor a local checkpoint can promise.
    ``digests`` names columns of lower-case hex text from ``sha2``, which no codec makes smaller: they are kept as bytes.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    packed = df.withColumns({c: F.unhex(c) for c in digests}) if digests else df
    packed.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(packed.schema).parquet(path)
    return stored.withColumns({c: F.lower(F.hex(c)) for c in digests}) if digests else stored

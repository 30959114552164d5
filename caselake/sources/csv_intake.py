"""CSV drops: header contract, load-once ledger, all-text scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.functions.temporal import ISO_DAY_20TH_21ST, strict_date
from caselake.functions.text import snake_name
from caselake.sources import paths
from caselake.sources.staging import text_schema
from caselake.specs import ContractViolation

# What the ledger holds of a file that was loaded.
LEDGER_DDL = "file_sha256 string, source_file string, length bigint, modified_at timestamp, record_count bigint, load_id string"
CSV_FILES = "*.csv.gz"


def header_names(header, date_column: str, known: list[str] | None = None) -> list[str]:
    """Checked snake-case names of a header: non-empty, unique, with the date, as before."""
    names = [snake_name(cell, fallback="") for cell in header]
    if not all(names):
        raise ContractViolation("The header has an empty or invalid column name.")
    if len(set(names)) != len(names):
        raise ContractViolation("The header has names that are equal after normalisation.")
    if snake_name(date_column) not in names:
        raise ContractViolation(f"The required column {date_column} is missing.")
    if known is not None and list(header) != list(known):
        raise ContractViolation("The header differs from the one registered before.")
    return names


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header cells of one file; reads one line."""
    first = spark.read.option("header", "false").option("encoding", "UTF-8").csv(path).limit(1).collect()
    if not first:
        raise ContractViolation(f"Empty file: {path}")
    cells = ["" if cell is None else cell for cell in first[0]]
    cells[0] = cells[0].lstrip("﻿")
    return cells


def _files(spark: SparkSession, folder) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true").load(folder)


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Address, length and time of every compressed CSV under a folder; no content is read."""
    return _files(spark, folder).select(F.col("path").alias("source_file"), "length", F.col("modificationTime").alias("modified_at"))


def file_digests(spark: SparkSession, folder) -> DataFrame:
    """SHA-256 of every compressed CSV under a folder, or of the files named."""
    return _files(spark, folder).select(F.col("path").alias("source_file"), F.sha2("content", 256).alias("file_sha256"))


def new_files(digests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content was never loaded, one per content: a renamed copy is not new."""
    fresh = digests.join(ledger.select("file_sha256"), "file_sha256", "left_anti")
    return fresh.groupBy("file_sha256").agg(F.min("source_file").alias("source_file"))


def read_drop(spark: SparkSession, folder, header, files: DataFrame, date_column: str) -> DataFrame:
    """All-text rows of the new files, with parsed date, file and digest.

    ``folder`` is what the scan opens: a folder, or the new files themselves. Every file must carry the given header: a
    different one fails the scan.
    """
    names = header_names(header, date_column)
    rows = (
        spark.read.schema(text_schema(header)).option("header", "true").option("enforceSchema", "false")
        .option("mode", "FAILFAST").option("multiLine", "true").option("escape", '"')
        .option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true").csv(folder)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    renamed = rows.select(*(F.col(f"`{h}`").alias(n) for h, n in zip(header, names)), "source_file")
    # Both spellings of a local path (file:/ and file:///) mean the same file; the scan's own is URL-encoded.
    decoded = F.url_decode(F.replace("source_file", F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, "^file:/+", "/")
    fresh = files.select("file_sha256", F.regexp_replace("source_file", "^file:/+", "/").alias("_plain"))
    return (
        renamed.withColumn("_plain", plain).join(fresh, "_plain").drop("_plain")
        .withColumn("notification_date", strict_date(F.col(snake_name(date_column)), ISO_DAY_20TH_21ST))
    )


def ledger_rows(loaded: DataFrame) -> DataFrame:
    """Rows loaded of each file."""
    return loaded.groupBy("file_sha256").agg(
        F.min("source_file").alias("source_file"), F.count(F.lit(1)).alias("record_count")
    )


# ---------------------------------------------------------------- load once
def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All files ever loaded; empty before the first load."""
    path = f"{root.rstrip('/')}/ledger"
    return spark.read.schema(LEDGER_DDL).parquet(path) if paths.exists(spark, path) else spark.createDataFrame([], LEDGER_DDL)


def load_drop(spark: SparkSession, folder: str, header, date_column: str, root: str, load_id: str) -> int:
    """Load what is new under a folder into ``<root>/rows`` and enter it in ``<root>/ledger``; returns the number of files.

    Known files (same address, length and time) are neither hashed nor read. The others are hashed: content that the ledger
    holds, as of a renamed copy, is refused. Only the files left are named to the scan; their names come to the
    driver, as those of any scan do. The ledger is written last, so rows of a load that broke off do not count and
    the next load takes their files again.
    """
    ledger = read_ledger(spark, root)
    same = ["source_file", "length", "modified_at"]
    unknown = listed_files(spark, folder).join(ledger.select(*same), same, "left_anti")
    names = [r[0] for r in unknown.select("source_file").collect()]
    if not names:
        return 0
    fresh = new_files(file_digests(spark, names), ledger)
    entries = fresh.join(unknown, "source_file").select("file_sha256", *same)
    entries = spark.createDataFrame(entries.collect(), entries.schema)  # one row a file, as listed above
    chosen = [r[0] for r in entries.select("source_file").collect()]
    if not chosen:
        return 0
    home = f"{root.rstrip('/')}/rows/load_id={load_id}"
    read_drop(spark, chosen, header, entries, date_column).write.mode("overwrite").parquet(home)
    counts = ledger_rows(spark.read.parquet(home)).select("file_sha256", "record_count")
    done = entries.join(counts, "file_sha256", "left").fillna(0, ["record_count"]).withColumn("load_id", F.lit(load_id))
    done.select(*(c.split()[0] for c in LEDGER_DDL.split(", "))).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/ledger")
    return len(chosen)


def loaded_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of finished loads, with ``load_id``."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/rows").withColumn("load_id", F.col("load_id").cast("string"))
    return rows.join(read_ledger(spark, root).select("file_sha256", "load_id"), ["file_sha256", "load_id"], "left_semi")

"""Staged period files: write, audit, check against manifests, read with lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from caselake.functions import temporal
from caselake.functions.text import snake_name
from caselake.sources import paths
from caselake.sources.periods import period_of
from caselake.specs import ContractViolation, Slice

PERIOD_IN_PATH = r"reference_period=([^/]+)"
ROWS_PER_FILE = 2_000_000

MANIFEST_SCHEMA = T.StructType([
    T.StructField(name, T.LongType() if name in ("record_count", "compressed_bytes") else T.StringType())
    for name in (
        "status", "batch_id", "environment", "granularity", "reference_period", "processing_date",
        "record_count", "compressed_bytes", "compressed_sha256", "s3_bucket", "s3_key", "s3_etag",
        "source_host", "started_at", "completed_at",
    )
])


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def write_staging(records: DataFrame, day: str, order, part: Slice, root: str, columns) -> list[str]:
    """Extract periods as gzip JSON lines, one folder per period, sorted by date and id.

    Rows move by period range, so a large period is cut into several files instead of going
    through one task; every file is in order and the files of a period follow each other.
    NULL fields stay in the file, as a reader with the full contract expects. Returns the periods written, which are
    observed on the way, one name per day or month of the calendar.
    """
    seen = Observation("staged")
    out = records.withColumn("reference_period", period_of(F.col(day), part.granularity)).where("reference_period IS NOT NULL")
    out = out.observe(seen, F.collect_set("reference_period").alias("periods"))
    keys = ["reference_period", day, *order]
    (
        out.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select(*columns, "reference_period")
        .write.mode("overwrite").partitionBy("reference_period")
        # Only the periods of this extract are replaced; others of the same day stay.
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip").option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .json(Slice(part.processing_date, part.granularity).under(root))
    )
    return sorted(seen.get["periods"])


def completed_periods(spark: SparkSession, part: Slice, root: str) -> list[str]:
    """Periods of the slice's day whose manifest says they are complete."""
    day = Slice(part.processing_date, part.granularity)
    if not paths.exists(spark, day.under(manifest_root(root))):
        return []
    done = read_manifests(spark, day, root).where("status = 'SUCCEEDED'").select("reference_period").distinct()
    return sorted(r[0] for r in done.collect())


def _combined_digest(digest) -> Column:
    """Order-free digest of many digests: sums of their 64-bit quarters, hashed again."""
    quarters = [
        F.sum(F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")).cast("string")
        for i in range(4)
    ]
    return F.sha2(F.concat_ws(":", *quarters), 256)


def audit_files(spark: SparkSession, folder) -> DataFrame:
    """Per period below a folder or several: files, lines, compressed bytes and digest.

    Lines come from the decompressing text scan, which fails on a truncated gzip file.
    A period with one file has that file's SHA-256, a period with several a combination of
    theirs that does not depend on their order, so nothing is collected per period.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
        .option("recursiveFileLookup", "true").load(folder)
        .select(
            F.regexp_extract("path", PERIOD_IN_PATH, 1).alias("reference_period"),
            "length", F.sha2("content", 256).alias("digest"),
        )
    )
    digest = F.col("digest")
    per_period = files.groupBy("reference_period").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("length").alias("compressed_bytes"),
        F.when(F.count(F.lit(1)) == 1, F.max(digest)).otherwise(_combined_digest(digest)).alias("compressed_sha256"),
    )
    lines = (
        spark.read.option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").text(folder)
        .select(F.regexp_extract("_metadata.file_path", PERIOD_IN_PATH, 1).alias("reference_period"))
        .groupBy("reference_period").agg(F.count(F.lit(1)).alias("record_count"))
    )
    return per_period.join(lines, "reference_period", "left").fillna(0, ["record_count"])


def build_manifests(audited: DataFrame, part: Slice, batch_id: str, environment: str, root: str,
                    started_at: str, completed_at: str) -> DataFrame:
    """One manifest row per audited period."""
    folder = Slice(part.processing_date, part.granularity).under(root)
    return audited.select(
        F.lit("SUCCEEDED").alias("status"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(environment).alias("environment"),
        F.lit(part.granularity).alias("granularity"),
        "reference_period",
        F.lit(part.processing_date).alias("processing_date"),
        "record_count", "compressed_bytes", "compressed_sha256",
        F.lit(root).alias("s3_bucket"),
        F.concat(F.lit(f"{folder}/reference_period="), "reference_period").alias("s3_key"),
        F.lit(started_at).alias("started_at"),
        F.lit(completed_at).alias("completed_at"),
    )


def manifest_root(root: str) -> str:
    return f"{root.rstrip('/')}/_manifests"


def write_manifests(manifests: DataFrame, part: Slice, root: str) -> None:
    """JSON manifests beside the data, one folder per period; re-runs replace their periods."""
    (
        manifests.withColumn("_period", F.col("reference_period"))
        .withColumnRenamed("_period", "period")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period")
        .json(Slice(part.processing_date, part.granularity).under(manifest_root(root)))
    )


def read_manifests(spark: SparkSession, part: Slice, root: str) -> DataFrame:
    """Manifests of a slice with the address each came from."""
    folder = Slice(part.processing_date, part.granularity).under(manifest_root(root))
    df = (
        spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST")
        .option("recursiveFileLookup", "true").json(folder)
        .withColumn("manifest_uri", F.col("_metadata.file_path"))
    )
    if part.reference_period is not None:
        df = df.filter(F.col("reference_period") == part.reference_period)
    return df


def manifest_problems(manifests: DataFrame, part: Slice, required, root: str) -> DataFrame:
    """One row per broken manifest rule, in rule order."""
    folder = Slice(part.processing_date, part.granularity).under(root)
    expected = {
        "s3_bucket": F.lit(root),
        "s3_key": F.concat(F.lit(f"{folder}/reference_period="), F.col("reference_period")),
        "processing_date": F.lit(part.processing_date),
        "granularity": F.lit(part.granularity),
    }
    found = F.array_compact(F.array(
        *(F.when(F.col(f).isNull(), F.lit(f"MISSING_{f.upper()}")) for f in required),
        F.when(F.col("status") != "SUCCEEDED", F.lit("STATUS_NOT_SUCCEEDED")),
        *(
            F.when(F.col(f).isNotNull() & (F.col(f) != want), F.lit(f"MISMATCH_{f.upper()}"))
            for f, want in expected.items()
        ),
    ))
    single = manifests.select("reference_period", F.explode(found).alias("problem"))
    repeated = (
        manifests.groupBy("reference_period").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("reference_period", F.lit("DUPLICATE_MANIFEST").alias("problem"))
    )
    return single.unionByName(repeated)


def closure(counted: DataFrame, manifests: DataFrame) -> DataFrame:
    """Full outer comparison of rows read and rows promised, per period.

    ``counted`` has ``reference_period`` and ``actual_count``.
    """
    promised = manifests.groupBy("reference_period").agg(F.sum("record_count").alias("expected_count"))
    return counted.join(promised, "reference_period", "full_outer").select(
        "reference_period", "expected_count", "actual_count",
        F.col("expected_count").eqNullSafe(F.col("actual_count")).alias("closed"),
    )


def read_staging(spark: SparkSession, part: Slice, root: str, columns, periods=None) -> DataFrame:
    """All-text scan of staged files with an explicit schema; any malformed line fails.

    ``periods`` names the period folders of a backfill, so what an earlier, wider run left
    beside them is not swept in. Without it all periods of the slice are read.
    """
    base = Slice(part.processing_date, part.granularity)
    if part.reference_period is not None:
        periods = [part.reference_period]
    folders = [base.at(p).under(root) for p in periods] if periods else [f"{base.under(root)}/reference_period=*"]
    return (
        spark.read.schema(text_schema(columns)).option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.gz").json(folders)
        .withColumn("_source_file", F.col("_metadata.file_path"))
    )


def with_lineage(raw: DataFrame, part: Slice, manifests: DataFrame, batch_id: str, environment: str,
                 columns, date_column: str, disease_column: str, diseases: dict, unknown_disease: str,
                 constants: dict) -> DataFrame:
    """Snake-case columns plus period, lineage and disease tag, in one projection.

    Manifest values come by a join on the period. ``manifests`` has one row per period, that is
    one per day or month of the calendar, so that side is small by construction.
    """
    day = temporal.strict_date(F.col(date_column))
    tag = F.coalesce(*(
        F.when(F.upper(F.trim(F.col(disease_column))) == code, F.lit(name)) for code, name in diseases.items()
    ), F.lit(unknown_disease))
    period = (
        F.lit(part.reference_period) if part.reference_period is not None
        else F.regexp_extract("_source_file", PERIOD_IN_PATH, 1)
    )
    stamped = raw.select(
        *(F.col(c).alias(snake_name(c)) for c in columns),
        "_source_file",
        period.alias("reference_period"),
        F.lit(part.processing_date).alias("processing_date"),
        F.lit(part.granularity).alias("granularity"),
        F.substring(period, 1, 4).alias("reference_year"),
        day.alias("_notification_date"),
        temporal.year_or_unknown(day).alias("notification_year"),
        temporal.month_or_unknown(day).alias("notification_month"),
        tag.alias("disease"),
        F.lit(batch_id).alias("_batch_id"),
        *(F.lit(value).alias(name) for name, value in constants.items()),
        F.current_timestamp().alias("_bronze_loaded_at"),
        F.lit(environment).alias("_environment"),
    )
    origin = manifests.select(
        "reference_period",
        F.col("batch_id").alias("_source_extraction_batch_id"),
        F.col("manifest_uri").alias("_source_manifest"),
    )
    return stamped.join(F.broadcast(origin), "reference_period", "left")


def require_manifests(manifests: DataFrame, part: Slice, required, root: str) -> list[str]:
    """Check the manifests of a slice, however many, and return the names of their periods.

    The names are what a scan needs to list its folders; one per day or month of the calendar.
    """
    if manifests.isEmpty():
        raise ContractViolation("No source manifests found for the slice.")
    problems = manifest_problems(manifests, part, required, root).limit(20).collect()
    if problems:
        shown = ", ".join(f"{p['reference_period']}: {p['problem']}" for p in problems)
        raise ContractViolation(f"Source manifests break their contract: {shown}")
    return sorted(m["reference_period"] for m in manifests.select("reference_period").distinct().collect())

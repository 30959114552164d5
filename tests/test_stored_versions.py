"""Repeats and latest versions of rows that come from files: only keys that may occur again are ranked and moved."""

from pyspark.sql import functions as F

from caselake.operators import publish, versions
from caselake.plans import gold, silver
from caselake.session import materialise
from caselake.sources.reference import flatten_reference
from caselake.specs import PARTITION_COLUMNS
from caselake.workload import cases, inputs

SCHEMA = "k string, t int, id int"


def _rows(spark):
    """One hot key, pairs, null keys, and as many keys that occur once."""
    hot = [("hot", i % 7, i) for i in range(300)]
    pairs = [(f"p{i % 40}", i, 1000 + i) for i in range(80)]
    return materialise(spark.createDataFrame(
        hot + pairs + [(None, i, 2000 + i) for i in range(3)] + [(f"s{i}", 0, 3000 + i) for i in range(200)], SCHEMA
    ).repartition(5), "rows")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stored_rows_rank_like_all_rows(spark):
    rows = _rows(spark)
    order = ("t", "id")
    assert sorted(versions.latest_stored(rows, "k", order).collect(), key=str) == sorted(
        versions.latest_version(rows, "k", order).collect(), key=str)
    marked = {r["id"]: r["_repeat"] for r in versions.mark_repeats_stored(rows, "k", order, ("k",)).collect()}
    assert marked == {r["id"]: r["_repeat"] for r in versions.mark_repeats(rows, "k", order, buckets=4).collect()}
    assert sum(not again for again in marked.values()) == 1 + 40 + 1 + 200


def test_sift_never_misses_a_repeat(spark, monkeypatch):
    rows = _rows(spark)
    for words in (1, 1 << 20):  # a full filter lets everything through to the ranks
        monkeypatch.setattr(versions, "FILTER_WORDS", words)
        alone, rest = versions.sift(rows, "k")
        assert alone.columns == rest.columns == rows.columns
        assert {r["k"] for r in rest.collect()} >= {"hot", None, *(f"p{i}" for i in range(40))}
        assert alone.count() + rest.count() == rows.count()


def test_digests_are_stored_as_bytes_and_read_as_text(spark):
    rows = spark.range(50).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")
    stored = materialise(rows.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("h"), "id")), "digests", ("h",))
    assert stored.dtypes == rows.dtypes
    assert {r["h"] for r in stored.collect()} == {r["h"] for r in rows.collect()} | {None}


def test_rows_of_single_ids_are_not_shuffled(spark, folder):
    """Classified rows of a batch have one publishable version each: the star needs no ranking of them."""
    rows = materialise(cases.silver_rows(spark, folder), "classified")
    assert "Window" not in _plan(gold.latest_cases(rows))
    once = cases.bronze_rows(spark, folder, which="ln = 1").dropDuplicates([c.lower() for c in inputs.NOTIFICATION])
    classified = silver.classified(materialise(once, "once"), flatten_reference(inputs.reference_nested(spark, folder)), cases.RUN)
    assert "Window" not in _plan(classified)


def test_silver_is_written_without_moving_its_rows(spark, folder, tmp_path, monkeypatch):
    """Bronze files hold few folders each, and so do the classified ones: no second shuffle by folder, and no flood of files."""
    moved = []
    balanced = publish.balanced
    monkeypatch.setattr(publish, "balanced", lambda df, *keys: moved.append(keys) or balanced(df, *keys))
    publish.write_slices(cases.bronze_rows(spark, folder), f"{tmp_path}/bronze", PARTITION_COLUMNS)
    reference = flatten_reference(inputs.reference_nested(spark, folder))
    counts = silver.load_silver(
        spark, cases.PART, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/quarantine", reference, cases.RUN)
    assert moved == [PARTITION_COLUMNS, (*PARTITION_COLUMNS, "primary_error_code")]  # Bronze, and what is put aside
    written = spark.read.parquet(f"{tmp_path}/silver")
    assert written.count() == counts["silver_record_count"]
    folders = written.select(*PARTITION_COLUMNS).distinct().count()
    assert written.select(F.input_file_name()).distinct().count() <= 3 * folders

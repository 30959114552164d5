"""Each reconciliation check fails on its own fault, and only the checks that the fault concerns."""

import pytest
from pyspark.sql import functions as F

from caselake.operators import publish, quality
from caselake.plans import domain, gold, reconcile, silver
from caselake.session import materialise
from caselake.sources.reference import flatten_reference
from caselake.specs import ContractViolation
from caselake.workload import cases, inputs
from caselake.workload.inputs import BATCH_ID

FACT = domain.FACT_TABLE


@pytest.fixture(scope="module")
def layers(spark, folder):
    reference = flatten_reference(inputs.reference_nested(spark, folder))
    bronze = cases.bronze_rows(spark, folder, which="ok % 8 = 0")
    rows = materialise(silver.classified(bronze, reference, cases.RUN), "faults")
    clean, bad = quality.split(rows)
    tables = {name: materialise(df, name) for name, df in gold.gold_tables(gold.latest_cases(clean)).items()}
    one = tables[FACT].agg(F.min(domain.GRAIN)).first()[0]
    return {"bronze": rows.withColumnRenamed("source_batch_id", "_batch_id"), "silver": clean, "quarantine": bad, "snapshot": clean, **tables}, one


def at(df, key, one, column, value):
    return df.withColumn(column, F.when(F.col(key) == one, F.lit(value)).otherwise(F.col(column)))


# Fault: layer, how it is broken, and exactly the checks that must fail.
FAULTS = {
    "nothing": ("bronze", lambda df, one: df, set()),
    "bronze row lost": ("bronze", lambda df, one: df.where(F.col("record_id") != one), {"bronze_equals_silver_plus_quarantine"}),
    "odd status": ("silver", lambda df, one: at(df, "record_id", one, quality.STATUS, "odd"), {"silver_status_totals_close"}),
    "foreign batch": ("silver", lambda df, one: at(df, "record_id", one, "source_batch_id", "other"), {"batch_identity_is_consistent"}),
    "current row unpublished": ("silver", lambda df, one: at(df, "record_id", one, "record_hash", "x"), {"current_silver_batch_is_published_in_gold"}),
    "case lost": (FACT, lambda df, one: df.where(F.col("case_id") != one),
                  {"gold_equals_latest_silver_snapshot", "gold_case_set_matches_silver_snapshot", "current_silver_batch_is_published_in_gold"}),
    "case renamed": (FACT, lambda df, one: at(df, "case_id", one, "case_id", "x"),
                     {"gold_case_set_matches_silver_snapshot", "current_silver_batch_is_published_in_gold"}),
    "content changed": (FACT, lambda df, one: at(df, "case_id", one, "record_hash", "x"),
                        {"gold_record_hashes_match_silver_snapshot", "current_silver_batch_is_published_in_gold"}),
    "case twice": (FACT, lambda df, one: df.union(df.where(F.col("case_id") == one)), {"gold_equals_latest_silver_snapshot", "fact_grain_is_unique"}),
    "measure of two": (FACT, lambda df, one: at(df, "case_id", one, "confirmed_case_count", 2), {"fact_measures_are_binary"}),
    "unknown place": (FACT, lambda df, one: at(df, "case_id", one, "residence_location_key", 12345678901), {"foreign_keys_are_valid"}),
    "member twice": ("dim_location", lambda df, one: df.union(df.where("location_key = -1")), {"dimension_keys_are_unique"}),
}


def test_each_check_fails_on_its_fault(layers):
    given, one = layers
    for fault, (layer, broken, wanted) in FAULTS.items():
        now = given | {layer: broken(given[layer], one)}
        numbers = reconcile.observed(now["bronze"], now["silver"], now["quarantine"], now["snapshot"], now, BATCH_ID)
        failed = {r.check_name for r in reconcile.checks_as_rows(numbers).collect() if not r.passed}
        assert failed == wanted, fault
    assert set().union(*(wanted for _, _, wanted in FAULTS.values())) == set(reconcile.check_columns())


def test_a_failing_report_is_written_before_the_batch_stops(spark, layers, tmp_path):
    given, one = layers
    fact = given[FACT].where(F.col("case_id") != one)
    with pytest.raises(ContractViolation, match="gold_case_set_matches_silver_snapshot"):
        reconcile.reconcile(spark, *(given[n] for n in ("bronze", "silver", "quarantine", "snapshot")), given | {FACT: fact}, BATCH_ID, "dev", str(tmp_path))
    report = spark.read.json(str(tmp_path)).first()
    assert report.status == "FAILED" and report.counts.expected_missing == 1


def test_register_tables_keeps_the_old_table_if_the_new_folder_fails(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        spark.range(n).withColumn("m", F.col("id") % 2).write.partitionBy("m").parquet(str(tmp_path / name))
    publish.register_tables(spark, {"t": str(tmp_path / "a")}, "caselake_register")
    assert spark.newSession().table("caselake_register.t").count() == 3
    with pytest.raises(Exception):
        publish.register_tables(spark, {"t": str(tmp_path / "missing")}, "caselake_register")
    assert spark.table("caselake_register.t").count() == 3
    publish.register_tables(spark, {"t": str(tmp_path / "b")}, "caselake_register")
    assert spark.newSession().table("caselake_register.t").count() == 5

"""Bound queries against their SQL, at the smallest scale."""

import decimal

import duckdb
import pytest

from caselake import workload

TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKED = (
    "q_clean_text", "q_typed_projection", "q_code_map", "q_bands", "q_flags_measures", "q_content_hash",
    "q_id_checksum", "q_keyed_fingerprint", "q_shard", "q_enrich_roles", "q_orphans", "q_set_compare",
    "q_dedup_rank", "q_latest_version", "q_quality_codes", "q_quality_split", "q_period_slice",
    "q_backfill_plan", "q_dim_date", "q_dim_junk", "q_monthly_by_nation", "q_report_band_rate",
    "q_star_enriched", "q_case_codes", "q_gold_enriched", "q_acceptance", "q_reconcile",
    "q_event_contract", "q_minute_counters", "q_state_ranking", "q_manifest_closure",
    "q_csv_intake", "q_csv_ledger", "q_extract_skip", "q_stream_counters", "q_stream_replay",
)


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(round(float(value), 6))
    return str(value)


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, folder, name):
    result = workload.queries()[name](spark, folder)
    columns = sorted(result.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in result.collect())
    cursor = duck.execute(workload.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert got == expected


def test_every_query_has_sql():
    assert set(workload.queries()) == set(workload.oracle_sql())

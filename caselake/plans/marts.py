"""Enriched cases, monthly views, reports and the acceptance suite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caselake.operators import keysets, star
from caselake.operators.publish import publish_views
from caselake.operators.rollup import percentage, sum_by, top_rows
from caselake.plans import domain

PERIOD = ("notification_year", "notification_month")
TOP_MUNICIPALITIES = 100


def enriched(tables: dict) -> DataFrame:
    """The star as one flat view: residence location, notification date, all junk attributes."""
    fact = tables[domain.FACT_TABLE]
    place = tables["dim_location"].select(
        "location_key", *(F.col(a).alias(f"residence_{a}") for a in domain.LOCATION_ATTRIBUTES)
    )
    day = tables["dim_date"].select("date_key", F.col("calendar_date").alias("notification_date"))
    joined = star.star_join(fact, [
        (day, "notification_date_key", "date_key", ["notification_date"]),
        (place, "residence_location_key", "location_key",
         [f"residence_{a}" for a in domain.LOCATION_ATTRIBUTES]),
        *((tables[d.table], d.key, d.key, d.attributes) for d in domain.JUNK_DIMENSIONS),
    ])
    return joined.select(
        domain.GRAIN, "environment", *domain.DISEASE.attributes, "notification_date", *PERIOD,
        "notification_epidemiological_week",
        *(f"residence_{a}" for a in domain.LOCATION_ATTRIBUTES),
        *domain.DEMOGRAPHIC.attributes, *domain.CLINICAL.attributes, *domain.MEASURES,
        "data_quality_status", "quality_warning_codes", "gold_loaded_at",
    )


def monthly_views(cases: DataFrame) -> dict[str, DataFrame]:
    return {v.name: sum_by(cases, v.keys, {m: m for m in v.measures}) for v in domain.MONTHLY_VIEWS}


def publish_marts(tables: dict, prefix: str = "") -> list[str]:
    """Views in dependency order: base tables, enriched cases, monthly views."""
    cases = enriched(tables)
    return publish_views(tables | {"cases_enriched": cases} | monthly_views(cases), prefix)


def catalog_sql(folders: dict, database: str, prefix: str = "") -> dict[str, str]:
    """Name and text of every view over the folders of one snapshot, base tables first.

    The texts name other views and folders only, so any session of the catalog can read them.
    """
    def named(table: str) -> str:
        return f"`{database}`.`{prefix}{table}`"

    def listed(alias: str, names) -> list[str]:
        return [f"{alias}.`{n}`" for n in names]

    base = {name: f"SELECT * FROM parquet.`{path}`" for name, path in folders.items() if name != domain.FACT_TABLE}
    # Month folders read as text or as numbers, by session.
    fact = (
        "SELECT * EXCEPT (notification_month), lpad(CAST(notification_month AS STRING), 2, '0') AS notification_month"
        f" FROM parquet.`{folders[domain.FACT_TABLE]}`"
    )
    columns = [
        *listed("f", (domain.GRAIN, "environment")), *listed(domain.DISEASE.table, domain.DISEASE.attributes),
        "day.calendar_date AS notification_date", *listed("f", (*PERIOD, "notification_epidemiological_week")),
        *(f"place.`{a}` AS `residence_{a}`" for a in domain.LOCATION_ATTRIBUTES),
        *listed(domain.DEMOGRAPHIC.table, domain.DEMOGRAPHIC.attributes), *listed(domain.CLINICAL.table, domain.CLINICAL.attributes),
        *listed("f", (*domain.MEASURES, "data_quality_status", "quality_warning_codes", "gold_loaded_at")),
    ]
    joins = " ".join(f"JOIN {named(d.table)} AS {d.table} ON f.{d.key} = {d.table}.{d.key}" for d in domain.JUNK_DIMENSIONS)
    cases = (
        f"SELECT {', '.join(columns)} FROM {named(domain.FACT_TABLE)} AS f"
        f" JOIN {named('dim_date')} AS day ON f.notification_date_key = day.date_key"
        f" JOIN {named('dim_location')} AS place ON f.residence_location_key = place.location_key {joins}"
    )
    monthly = {
        v.name: f"SELECT {', '.join([f'`{source}` AS `{name}`' for name, source in v.keys.items()] + [f'sum(`{m}`) AS `{m}`' for m in v.measures])}"
                f" FROM {named('cases_enriched')} GROUP BY {', '.join(f'`{source}`' for source in v.keys.values())}"
        for v in domain.MONTHLY_VIEWS
    }
    return base | {domain.FACT_TABLE: fact, "cases_enriched": cases} | monthly


# Report column to the measure it sums.
_TOTALS = {
    "notifications": "notification_count", "confirmed_cases": "confirmed_case_count",
    "discarded_cases": "discarded_case_count", "alarm_cases": "alarm_case_count",
    "severe_cases": "severe_case_count", "under_investigation": "under_investigation_count",
    "hospitalized_cases": "hospitalized_case_count", "deaths": "death_by_disease_count",
}


def _report(df: DataFrame, keys, totals) -> DataFrame:
    return sum_by(df, {k: k for k in keys}, {t: _TOTALS[t] for t in totals})


def report_monthly(fact: DataFrame) -> DataFrame:
    totals = ("notifications", "confirmed_cases", "discarded_cases", "alarm_cases", "severe_cases",
              "hospitalized_cases", "deaths")
    return _report(fact, PERIOD, totals).orderBy(*PERIOD)


def report_states(view: DataFrame) -> DataFrame:
    keys = (*PERIOD, "uf_abbreviation", "uf_name", "region_name")
    totals = ("notifications", "confirmed_cases", "alarm_cases", "severe_cases",
              "hospitalized_cases", "deaths")
    return _report(view, keys, totals).orderBy(*PERIOD, F.desc("confirmed_cases"), *keys[2:])


def report_age_groups(view: DataFrame) -> DataFrame:
    totals = ("notifications", "confirmed_cases", "hospitalized_cases", "deaths")
    return (
        _report(view, (*PERIOD, "age_group_name"), totals)
        .withColumn(
            "hospitalization_percentage_among_confirmed",
            percentage(F.col("hospitalized_cases"), F.col("confirmed_cases")),
        )
        .orderBy(*PERIOD, F.desc("confirmed_cases"), "age_group_name")
    )


def report_municipalities(view: DataFrame, limit: int = TOP_MUNICIPALITIES) -> DataFrame:
    """The largest municipality months. Ties end in the keys, so the cut is always the same."""
    keys = (*PERIOD, "municipality_code_ibge", "municipality_name", "uf_abbreviation")
    totals = ("notifications", "confirmed_cases", "hospitalized_cases", "deaths")
    report = _report(view, keys, totals).withColumn(
        "confirmation_percentage", percentage(F.col("confirmed_cases"), F.col("notifications"))
    )
    return top_rows(report, [F.desc("confirmed_cases"), F.desc("notifications"), *keys], limit)


def report_classifications(view: DataFrame) -> DataFrame:
    keys = (*PERIOD, "classification_code", "classification_name", "confirmation_criterion_name")
    totals = ("notifications", "confirmed_cases", "discarded_cases", "alarm_cases", "severe_cases",
              "under_investigation", "deaths")
    return _report(view, keys, totals).orderBy(*PERIOD, F.desc("notifications"), *keys[2:])


def reports(tables: dict) -> dict[str, DataFrame]:
    views = monthly_views(enriched(tables))
    return {
        "cases_monthly": report_monthly(tables[domain.FACT_TABLE]),
        "cases_by_uf": report_states(views["monthly_uf"]),
        "cases_by_age_group": report_age_groups(views["monthly_age_group"]),
        "cases_by_municipality": report_municipalities(views["monthly_municipality"]),
        "cases_by_classification": report_classifications(views["monthly_classification"]),
    }


# ---------------------------------------------------------------- acceptance
def _details(**values: Column) -> Column:
    return F.concat_ws(", ", *(F.concat(F.lit(f"{n}="), v.cast("string")) for n, v in values.items()))


def _verdict(name: str, passed: Column, **details: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), _details(**details).alias("details"))


def _verdicts(numbers: DataFrame, *verdicts: Column) -> DataFrame:
    return numbers.select(F.inline(F.array(*verdicts)))


def acceptance(tables: dict) -> DataFrame:
    """Five checks as (check_name, passed, details).

    Measures and totals share one pass over the fact. The grain compares rows with distinct
    case ids; identity accepts any non-NULL batches, as the fact holds many.
    """
    fact = tables[domain.FACT_TABLE]
    c = F.col
    totals = fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(star.invalid_measures(domain.MEASURES, "notification_count")).alias("invalid_measure_row_count"),
        F.sum("notification_count").alias("notifications"),
        F.sum("confirmed_case_count").alias("confirmed"),
        F.sum("discarded_case_count").alias("discarded"),
        F.sum("hospitalized_case_count").alias("hospitalized"),
        F.sum("death_by_disease_count").alias("deaths"),
    )
    grain = fact.groupBy(domain.GRAIN).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(domain.GRAIN).alias("distinct_case_count"),
    )
    batches = fact.groupBy("source_batch_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(c("source_batch_id").isNull(), c("n"))), F.lit(0)).alias("missing_batch_id_count"),
        F.count("source_batch_id").alias("distinct_batch_id_count"),
    )
    by_column = {fk.column: fk for fk in domain.FOREIGN_KEYS}
    orphans = keysets.orphan_rows(
        fact, {n: tables[n] for n in domain.DIMENSION_KEYS}, domain.DIMENSION_KEYS,
        {label: by_column[column] for label, column in domain.CORE_FOREIGN_KEYS.items()},
    )
    subtotals = ("confirmed", "discarded", "hospitalized", "deaths")
    sane = reduce(Column.__and__, (c(s).between(0, c("notifications")) for s in subtotals), c("notifications") > 0)
    closed = reduce(Column.__and__, (c(label) == 0 for label in domain.CORE_FOREIGN_KEYS))

    def show(*names):
        return {n: c(n) for n in names}

    return reduce(DataFrame.unionByName, [
        _verdicts(grain, _verdict(
            "fact_grain_is_unique", c("row_count") == c("distinct_case_count"),
            **show("row_count", "distinct_case_count"),
        )),
        _verdicts(batches, _verdict(
            "batch_identity_is_consistent",
            (c("missing_batch_id_count") == 0) & (c("distinct_batch_id_count") >= 1),
            **show("row_count", "missing_batch_id_count", "distinct_batch_id_count"),
        )),
        _verdicts(orphans, _verdict(
            "core_dimension_keys_are_valid", closed, **show(*domain.CORE_FOREIGN_KEYS),
        )),
        _verdicts(
            totals,
            _verdict("fact_measures_are_binary", c("invalid_measure_row_count") == 0,
                     **show("row_count", "invalid_measure_row_count")),
            _verdict("metric_totals_are_sane", sane, **show("notifications", *subtotals)),
        ),
    ])

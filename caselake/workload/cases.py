"""The surveillance plans over notifications derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.operators import quality
from caselake.plans import bronze, domain, gold, marts, reconcile, silver
from caselake.session import materialise
from caselake.sources.reference import flatten_reference
from caselake.specs import Slice
from caselake.workload import inputs
from caselake.workload.inputs import AS_OF, BATCH_ID, NOTIFICATIONS_SQL, PROCESSING_DATE, REFERENCE_SQL
from caselake.workload.registry import query
from caselake.workload.shaping import sql_clean, sql_date, sql_int

PART = Slice(PROCESSING_DATE, "month")
RUN = silver.SilverRun(BATCH_ID, AS_OF)
SOURCE_FILE = "'staging/reference_period=' || {period} || '/part.json.gz'"


def bronze_rows(spark: SparkSession, folder: str, part: Slice = PART, batch_id: str = BATCH_ID, which: str = "true") -> DataFrame:
    """Notifications as Bronze holds them, without the trip through files."""
    raw = inputs.notifications(spark, folder, which).withColumn(
        "_source_file", F.expr(SOURCE_FILE.format(period="period"))
    )
    manifests = inputs.periods(spark, folder).select(
        F.col("period").alias("reference_period"),
        F.lit("extract-1").alias("batch_id"), F.lit("manifest.json").alias("manifest_uri"),
    )
    return bronze.bronze_frame(raw, manifests, part, batch_id, "dev")


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    reference = flatten_reference(inputs.reference_nested(spark, folder))
    return silver.classified(bronze_rows(spark, folder), reference, RUN)


def star_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """Classified rows, which are written once, and the star over their latest versions."""
    rows = materialise(silver_rows(spark, folder), "classified", domain.DIGESTS)
    return rows, gold.gold_tables(gold.latest_cases(quality.split(rows)[0]))


# ---------------------------------------------------------------- the same in SQL
_CASTS = {
    "text": sql_clean,
    "upper": lambda c: f"upper({sql_clean(c)})",
    "lower": lambda c: f"lower({sql_clean(c)})",
    "int": sql_int,
    "date": sql_date,
}
_FROM_SOURCE = [s for s in domain.CASE_COLUMNS if s.source.upper() in domain.SOURCE_COLUMNS]
_TYPED_SQL = ",\n    ".join(f"{_CASTS[s.kind](s.source)} AS {s.name}" for s in _FROM_SOURCE)
_HASH_SQL = " || '||' || ".join(
    f"coalesce({c}, '<null>')" for c in sorted(name.lower() for name in domain.SOURCE_COLUMNS)
)


def _label_sql(stem: str, labels: dict) -> str:
    whens = " ".join(f"WHEN {stem}_code = '{code}' THEN '{label}'" for code, label in labels.items())
    return f"CASE WHEN {stem}_code IS NULL THEN NULL {whens} ELSE 'Não mapeado' END AS {stem}_name"


_LABELS_SQL = ",\n    ".join(_label_sql(s, m) for s, m in domain.LABELLED.items())
_BAND_SQL = " ".join(
    f"WHEN age_years >= {low}" + (f" AND age_years <= {high}" if high is not None else "") + f" THEN '{label}'"
    for low, high, label in domain.AGE_BANDS
)
_AS_OF = f"DATE '{AS_OF}'"


def _era_sql(code: str, column: str) -> str:
    return f"CASE WHEN {column} < DATE '2000-01-01' OR {column} > {_AS_OF} THEN '{code}' END"


def _place_sql(alias: str, role: str) -> str:
    return ", ".join(
        f"{alias}.{a} AS {role}_{a}" for a in domain.LOCATION_ATTRIBUTES if a != "municipality_code_sinan"
    )


CASES_SQL = f"""
{NOTIFICATIONS_SQL},
{REFERENCE_SQL},
typed AS (
  SELECT {_TYPED_SQL},
    CASE WHEN upper(trim(id_agravo)) = 'A90' THEN 'dengue' ELSE 'unknown' END AS disease_name,
    CAST(substring(reference_period, 1, 4) AS INTEGER) AS source_reference_year,
    reference_period, sha256({_HASH_SQL}) AS record_hash
  FROM notif),
placed AS (
  SELECT t.* EXCLUDE (infection_municipality_code_sinan),
    CASE WHEN t.infection_municipality_code_sinan = '0' THEN NULL ELSE t.infection_municipality_code_sinan END
      AS infection_municipality_code_sinan,
    {_place_sql('a', 'residence')}, {_place_sql('b', 'notification')}, {_place_sql('c', 'infection')},
    substring(age_encoded, 1, 1) AS age_unit_code,
    TRY_CAST(substring(age_encoded, 2, 3) AS INTEGER) AS age_value,
    sha256('opendatasus_sinan||' || CAST(source_reference_year AS VARCHAR) || '||' || record_hash) AS record_id,
    row_number() OVER (PARTITION BY source_reference_year, record_hash ORDER BY 1) AS copy
  FROM typed t
  LEFT JOIN muni a ON t.residence_municipality_code_sinan = a.municipality_code_sinan
  LEFT JOIN muni b ON t.notification_municipality_code_sinan = b.municipality_code_sinan
  LEFT JOIN muni c ON t.infection_municipality_code_sinan = c.municipality_code_sinan),
aged AS (SELECT *, CASE WHEN age_unit_code = '4' THEN age_value WHEN age_unit_code IN ('1', '2', '3') THEN 0 END AS age_years
  FROM placed),
labelled AS (SELECT *, CASE {_BAND_SQL} ELSE 'Ignorada' END AS age_group_name, {_LABELS_SQL} FROM aged),
coded AS (SELECT *,
  CASE WHEN disease_name = 'dengue' AND classification_code IN ('10', '11', '12') THEN true
       WHEN classification_code IN ('5', '8') THEN false END AS is_confirmed_case,
  CASE WHEN classification_code IN ('5', '8') THEN true
       WHEN classification_code IN ('10', '11', '12', '13') THEN false END AS is_discarded_case,
  classification_code = '11' AS is_alarm_case,
  classification_code = '12' AS is_severe_case,
  (coalesce(confirmation_criterion_code = '3', false) OR classification_code IS NULL) AS is_under_investigation,
  CASE hospitalization_code WHEN '1' THEN true WHEN '2' THEN false END AS is_hospitalized,
  case_outcome_code = '2' AS is_death_by_disease,
  case_outcome_code = '3' AS is_death_other_cause,
  CASE autochthonous_code WHEN '1' THEN true WHEN '2' THEN false END AS is_autochthonous,
  list_filter([
    CASE WHEN disease_name = 'unknown' THEN 'UNKNOWN_DISEASE' END,
    CASE WHEN notification_date IS NULL THEN 'INVALID_NOTIFICATION_DATE' END,
    CASE WHEN notification_date > {_AS_OF} THEN 'FUTURE_NOTIFICATION_DATE' END,
    CASE WHEN notification_date < DATE '2000-01-01' THEN 'IMPLAUSIBLE_NOTIFICATION_DATE' END,
    CASE WHEN residence_municipality_code_sinan IS NULL THEN 'MISSING_RESIDENCE_MUNICIPALITY' END,
    CASE WHEN residence_municipality_code_sinan IS NOT NULL AND residence_municipality_code_ibge IS NULL
      THEN 'RESIDENCE_MUNICIPALITY_NOT_FOUND' END,
    CASE WHEN symptoms_start_date > notification_date THEN 'SYMPTOMS_AFTER_NOTIFICATION' END,
    CASE WHEN investigation_date < notification_date THEN 'INVESTIGATION_BEFORE_NOTIFICATION' END,
    CASE WHEN closure_date < investigation_date THEN 'CLOSURE_BEFORE_INVESTIGATION' END,
    CASE WHEN death_date < symptoms_start_date THEN 'DEATH_BEFORE_SYMPTOMS' END,
    {_era_sql('IMPLAUSIBLE_INVESTIGATION_DATE', 'investigation_date')},
    {_era_sql('IMPLAUSIBLE_DIGITIZATION_DATE', 'digitization_date')},
    {_era_sql('IMPLAUSIBLE_CLOSURE_DATE', 'closure_date')},
    {_era_sql('IMPLAUSIBLE_HOSPITALIZATION_DATE', 'hospitalization_date')},
    {_era_sql('IMPLAUSIBLE_DEATH_DATE', 'death_date')},
    CASE WHEN notification_year <> year(notification_date) THEN 'NOTIFICATION_YEAR_MISMATCH' END,
    CASE WHEN copy > 1 THEN 'DUPLICATE_RECORD' END], lambda x: x IS NOT NULL) AS errors,
  list_filter([
    CASE WHEN classification_code IS NULL THEN 'MISSING_CLASSIFICATION' END,
    CASE WHEN classification_name = 'Não mapeado' THEN 'UNMAPPED_CLASSIFICATION' END,
    CASE WHEN confirmation_criterion_code IS NULL THEN 'MISSING_CONFIRMATION_CRITERION' END,
    CASE WHEN case_outcome_code IS NULL THEN 'MISSING_CASE_OUTCOME' END,
    CASE WHEN hospitalization_code IS NULL OR hospitalization_code = '9' THEN 'UNKNOWN_HOSPITALIZATION' END,
    CASE WHEN notification_municipality_code_sinan IS NOT NULL AND notification_municipality_code_ibge IS NULL
      THEN 'NOTIFICATION_MUNICIPALITY_NOT_FOUND' END,
    CASE WHEN infection_municipality_code_sinan IS NOT NULL AND infection_municipality_code_ibge IS NULL
      THEN 'INFECTION_MUNICIPALITY_NOT_FOUND' END,
    CASE WHEN age_encoded IS NOT NULL AND age_unit_code NOT IN ('1', '2', '3', '4') THEN 'INVALID_AGE_UNIT' END,
    CASE WHEN source_reference_year <> notification_year THEN 'REFERENCE_YEAR_DIFFERS_FROM_NOTIFICATION_YEAR' END
  ], lambda x: x IS NOT NULL) AS warnings
  FROM labelled),
cases AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'quarantined' WHEN len(warnings) > 0 THEN 'warning' ELSE 'valid' END
  AS data_quality_status FROM coded)"""

_MEASURE_SQL = ", ".join(
    f"CASE WHEN {flag} THEN 1 ELSE 0 END AS {measure}" for measure, flag in domain.FLAG_MEASURES.items()
)
_JUNK_UNKNOWN = {
    "demographic": " AND ".join(f"{a} IS NULL" for a in domain.DEMOGRAPHIC.key_attributes),
    "clinical": " AND ".join(f"{a} IS NULL" for a in domain.CLINICAL.key_attributes),
}
FACT_SQL = f"""{CASES_SQL},
fact AS (SELECT * EXCLUDE (notification_year), 1 AS notification_count, {_MEASURE_SQL},
  CASE WHEN len(warnings) > 0 THEN 1 ELSE 0 END AS quality_warning_count,
  year(notification_date) AS notification_year, strftime(notification_date, '%m') AS notification_month
  FROM cases WHERE data_quality_status <> 'quarantined')"""


# ---------------------------------------------------------------- Bronze and Silver
@query("q_case_lineage", f"""
WITH {NOTIFICATIONS_SQL},
b AS (SELECT reference_period, substring(reference_period, 1, 4) AS reference_year,
  CASE WHEN upper(trim(id_agravo)) = 'A90' THEN 'dengue' ELSE 'unknown' END AS disease, {sql_date('dt_notific')} AS day
  FROM notif)
SELECT reference_period, reference_year, disease,
  CASE WHEN day IS NULL THEN 'unknown' ELSE strftime(day, '%Y') END AS notification_year,
  CASE WHEN day IS NULL THEN 'unknown' ELSE strftime(day, '%m') END AS notification_month,
  'extract-1' AS extraction, '{PROCESSING_DATE}' AS processing_date, count(*) AS n_rows
FROM b GROUP BY 1, 2, 3, 4, 5""")
def case_lineage(spark, folder):
    """PRJ1 to PRJ6."""
    return bronze_rows(spark, folder).groupBy(
        "reference_period", "reference_year", "disease", "notification_year", "notification_month",
        F.col("_source_extraction_batch_id").alias("extraction"), "processing_date",
    ).agg(F.count(F.lit(1)).alias("n_rows"))


_TEXT_DATES = [s.name for s in _FROM_SOURCE if s.kind == "date"]
_PLAIN = [s.name for s in _FROM_SOURCE if s.kind != "date"]


@query("q_case_projection", f"""
WITH {CASES_SQL}
SELECT {', '.join(_PLAIN)}, {', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in _TEXT_DATES)},
       disease_name, source_reference_year FROM cases""")
def case_projection(spark, folder):
    """PRJ7 to PRJ10: the typed contract, row by row."""
    rows = silver.cases(bronze_rows(spark, folder), RUN)
    return rows.select(
        *_PLAIN, *(F.col(d).cast("string").alias(d) for d in _TEXT_DATES), "disease_name", "source_reference_year"
    )


@query("q_case_identity", f"WITH {CASES_SQL} SELECT record_hash, record_id, count(*) AS copies FROM cases GROUP BY 1, 2")
def case_identity(spark, folder):
    """KEY1, KEY2 over all source columns."""
    return silver.cases(bronze_rows(spark, folder), RUN).groupBy("record_hash", "record_id").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query("q_case_labels", f"""
WITH {CASES_SQL}
SELECT {', '.join(f'{s}_name' for s in domain.LABELLED)}, age_group_name, age_years, count(*) AS n_rows
FROM cases GROUP BY ALL""")
def case_labels(spark, folder):
    """PRJ11 to PRJ13: all ten code maps and the age bands."""
    keys = [*(f"{s}_name" for s in domain.LABELLED), "age_group_name", "age_years"]
    return silver_rows(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


@query("q_case_flags", f"""
WITH {CASES_SQL} SELECT {', '.join(f.name for f in domain.CASE_FLAGS)}, count(*) AS n_rows FROM cases GROUP BY ALL""")
def case_flags(spark, folder):
    """PRJ15: nine three-valued flags."""
    return silver_rows(spark, folder).groupBy(*(f.name for f in domain.CASE_FLAGS)).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("q_case_places", f"""
WITH {CASES_SQL}
SELECT residence_municipality_name, notification_uf_name, infection_region_name,
       infection_municipality_code_sinan, count(*) AS n_rows FROM cases GROUP BY ALL""")
def case_places(spark, folder):
    """SRC5, JON1, PRJ10."""
    return silver_rows(spark, folder).groupBy(
        "residence_municipality_name", "notification_uf_name", "infection_region_name",
        "infection_municipality_code_sinan",
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query("q_case_codes", f"""
WITH {CASES_SQL}
SELECT 'error' AS severity, code, count(*) AS n_rows FROM (SELECT unnest(errors) AS code FROM cases) GROUP BY 1, 2
UNION ALL
SELECT 'warning', code, count(*) FROM (SELECT unnest(warnings) AS code FROM cases) GROUP BY 1, 2""")
def case_codes(spark, folder):
    """QLT1 to QLT3, WIN1."""
    def tagged(name, severity):
        return F.transform(name, lambda c: F.struct(F.lit(severity).alias("severity"), c.alias("code")))

    both = F.concat(tagged(quality.ERRORS, "error"), tagged(quality.WARNINGS, "warning"))
    return silver_rows(spark, folder).select(F.inline(both)).groupBy("severity", "code").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("q_case_split", f"""
WITH {CASES_SQL}
SELECT data_quality_status, errors[1] AS primary_error_code, reference_period, count(*) AS n_rows
FROM cases GROUP BY ALL""")
def case_split(spark, folder):
    """QLT4, QLT5, SNK3."""
    # Both sides read the few columns that they need of the rows; classified once, not once for each side.
    rows = silver_rows(spark, folder).select(quality.STATUS, quality.ERRORS, "reference_period")
    clean, bad = quality.split(materialise(rows, "split"))
    columns = (quality.STATUS, quality.PRIMARY, "reference_period")
    rows = clean.withColumn(quality.PRIMARY, F.lit(None).cast("string")).select(*columns)
    return rows.unionByName(bad.select(*columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- Gold
def _date_keys_sql() -> str:
    return " UNION ".join(f"SELECT {role} AS d FROM fact WHERE {role} IS NOT NULL" for role in domain.DATE_ROLES)


@query("q_gold_dim_date", f"""
WITH {FACT_SQL},
b AS (SELECT min(notification_date) AS first, max(notification_date) AS last FROM fact),
c AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d FROM b UNION {_date_keys_sql()})
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS calendar_date, year(d) AS year,
       quarter(d) AS quarter, month(d) AS month, day(d) AS day, weekofyear(d) AS iso_week_of_year,
       dayofweek(d) + 1 AS day_of_week, strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend
FROM c
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Desconhecido', NULL""")
def gold_dim_date(spark, folder):
    """DIM1 over seven roles."""
    dimension = star_tables(spark, folder)[1]["dim_date"]
    return dimension.withColumn("calendar_date", F.col("calendar_date").cast("string"))


@query("q_gold_dim_location", f"""
WITH {FACT_SQL}, used AS ({' UNION '.join(
    f'SELECT {r}_municipality_code_ibge AS code FROM fact' for r in domain.LOCATION_ROLES)})
SELECT CAST(code AS BIGINT) AS location_key, muni.* FROM used JOIN muni ON code = municipality_code_ibge
UNION ALL SELECT -1, {', '.join(["'Desconhecido'"] * len(domain.LOCATION_ATTRIBUTES))}""")
def gold_dim_location(spark, folder):
    """DIM2 over three roles."""
    return star_tables(spark, folder)[1]["dim_location"]


_DEMOGRAPHIC_UNKNOWN = ", ".join(
    "NULL" if a in ("age_value", "age_years") else "'Desconhecido'" for a in domain.DEMOGRAPHIC.attributes
)


@query("q_gold_dim_demographic", f"""
WITH {FACT_SQL}
SELECT DISTINCT {', '.join(domain.DEMOGRAPHIC.attributes)} FROM fact WHERE NOT ({_JUNK_UNKNOWN['demographic']})
UNION ALL SELECT {_DEMOGRAPHIC_UNKNOWN}""")
def gold_dim_demographic(spark, folder):
    """DIM4."""
    return star_tables(spark, folder)[1]["dim_demographic"].select(*domain.DEMOGRAPHIC.attributes)


@query("q_gold_dim_clinical", f"""
WITH {FACT_SQL}
SELECT DISTINCT {', '.join(domain.CLINICAL.attributes)} FROM fact WHERE NOT ({_JUNK_UNKNOWN['clinical']})
UNION ALL SELECT {', '.join(["'Desconhecido'"] * len(domain.CLINICAL.attributes))}""")
def gold_dim_clinical(spark, folder):
    """DIM5."""
    return star_tables(spark, folder)[1]["dim_clinical"].select(*domain.CLINICAL.attributes)


@query("q_gold_dim_disease", f"""
WITH {FACT_SQL}
SELECT DISTINCT disease_code, disease_name FROM fact UNION ALL SELECT 'UNKNOWN', 'unknown'""")
def gold_dim_disease(spark, folder):
    """DIM3."""
    return star_tables(spark, folder)[1]["dim_disease"].select("disease_code", "disease_name")


def _key_sql(role: str) -> str:
    return f"coalesce(CAST(strftime({role}, '%Y%m%d') AS INTEGER), -1) AS {role}_key"


_FACT_COLUMNS = [
    domain.GRAIN, *(f"{r}_key" for r in domain.DATE_ROLES), *(f"{r}_location_key" for r in domain.LOCATION_ROLES),
    *domain.MEASURES, "data_quality_status", "source_reference_year", *domain.FACT_PARTITIONS,
    "notification_epidemiological_week", "symptoms_epidemiological_week", "reference_period",
]


@query("q_gold_fact", f"""
WITH {FACT_SQL}
SELECT record_id AS case_id, {', '.join(map(_key_sql, domain.DATE_ROLES))},
  {', '.join(f'coalesce(CAST({r}_municipality_code_ibge AS BIGINT), -1) AS {r}_location_key' for r in domain.LOCATION_ROLES)},
  {', '.join(domain.MEASURES)}, data_quality_status, source_reference_year, notification_year, notification_month,
  notification_epidemiological_week, symptoms_epidemiological_week, reference_period,
  array_to_string(warnings, ',') AS warning_text FROM fact""")
def gold_fact(spark, folder):
    """DIM6, KEY4, KEY5, PRJ16, WIN2, row by row. The codes of a clean row are '' in both."""
    fact = star_tables(spark, folder)[1][domain.FACT_TABLE]
    return fact.select(*_FACT_COLUMNS, F.concat_ws(",", quality.WARNINGS).alias("warning_text"))


def _junk_sql(name: str, attribute: str) -> str:
    unknown = "NULL" if attribute in ("age_value", "age_years") else "'Desconhecido'"
    return f"CASE WHEN {_JUNK_UNKNOWN[name]} THEN {unknown} ELSE {attribute} END AS {attribute}"


ENRICHED_SQL = f"""{FACT_SQL},
enriched AS (SELECT record_id AS case_id, disease_code, disease_name, notification_date, notification_year,
  notification_month, notification_epidemiological_week,
  {', '.join(f"coalesce(m.{a}, 'Desconhecido') AS residence_{a}" for a in domain.LOCATION_ATTRIBUTES)},
  {', '.join(_junk_sql('demographic', a) for a in domain.DEMOGRAPHIC.attributes)},
  {', '.join(_junk_sql('clinical', a) for a in domain.CLINICAL.attributes)},
  {', '.join(domain.MEASURES)}, data_quality_status
  FROM fact LEFT JOIN muni m ON residence_municipality_code_ibge = m.municipality_code_ibge)"""


@query("q_gold_enriched", f"""
WITH {ENRICHED_SQL}
SELECT * EXCLUDE (notification_date), CAST(notification_date AS VARCHAR) AS notification_date FROM enriched""")
def gold_enriched(spark, folder):
    """JON2, DIM8: the flat case view, row by row."""
    flat = marts.enriched(star_tables(spark, folder)[1])
    return flat.drop("environment", "gold_loaded_at", "quality_warning_codes").withColumn(
        "notification_date", F.col("notification_date").cast("string")
    )


def _sum_sql(measures) -> str:
    return ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in measures)


def _monthly(view):
    keys = ", ".join(f"{source} AS {name}" for name, source in view.keys.items())
    sql = f"WITH {ENRICHED_SQL} SELECT {keys}, {_sum_sql(view.measures)} FROM enriched GROUP BY ALL"

    @query(f"q_gold_{view.name}", sql)
    def monthly(spark, folder):
        """AGG5 to AGG8 over the enriched view."""
        return marts.monthly_views(marts.enriched(star_tables(spark, folder)[1]))[view.name]


for _view in domain.MONTHLY_VIEWS:
    _monthly(_view)


def _rate_sql(part: str, whole: str) -> str:
    return (
        f"CASE WHEN sum({whole}) = 0 THEN NULL ELSE"
        f" CAST((20000 * sum({part}) + sum({whole})) // (2 * sum({whole})) AS DOUBLE) / 100 END"
    )


def _total_sql(*names: str) -> str:
    source = {
        "notifications": "notification_count", "confirmed_cases": "confirmed_case_count",
        "discarded_cases": "discarded_case_count", "alarm_cases": "alarm_case_count",
        "severe_cases": "severe_case_count", "under_investigation": "under_investigation_count",
        "hospitalized_cases": "hospitalized_case_count", "deaths": "death_by_disease_count",
    }
    return ", ".join(f"CAST(sum({source[n]}) AS BIGINT) AS {n}" for n in names)


_MONTH = "notification_year, notification_month"
REPORT_SQL = {
    "cases_monthly": f"SELECT {_MONTH}, " + _total_sql(
        "notifications", "confirmed_cases", "discarded_cases", "alarm_cases", "severe_cases",
        "hospitalized_cases", "deaths") + " FROM fact GROUP BY ALL",
    "cases_by_uf": f"SELECT {_MONTH}, residence_uf_abbreviation AS uf_abbreviation, residence_uf_name AS uf_name,"
        " residence_region_name AS region_name, " + _total_sql(
        "notifications", "confirmed_cases", "alarm_cases", "severe_cases", "hospitalized_cases", "deaths")
        + " FROM enriched GROUP BY ALL",
    "cases_by_age_group": f"SELECT {_MONTH}, age_group_name, " + _total_sql(
        "notifications", "confirmed_cases", "hospitalized_cases", "deaths") + ", "
        + _rate_sql("hospitalized_case_count", "confirmed_case_count")
        + " AS hospitalization_percentage_among_confirmed FROM enriched GROUP BY ALL",
    "cases_by_municipality": f"SELECT {_MONTH}, residence_municipality_code_ibge AS municipality_code_ibge,"
        " residence_municipality_name AS municipality_name, residence_uf_abbreviation AS uf_abbreviation, "
        + _total_sql("notifications", "confirmed_cases", "hospitalized_cases", "deaths") + ", "
        + _rate_sql("confirmed_case_count", "notification_count")
        + " AS confirmation_percentage FROM enriched GROUP BY ALL"
        " ORDER BY confirmed_cases DESC, notifications DESC, 1, 2, 3, 4, 5 LIMIT 100",
    "cases_by_classification": f"SELECT {_MONTH}, classification_code, classification_name,"
        " confirmation_criterion_name, " + _total_sql(
        "notifications", "confirmed_cases", "discarded_cases", "alarm_cases", "severe_cases",
        "under_investigation", "deaths") + " FROM enriched GROUP BY ALL",
}


def _report(name: str):
    @query(f"q_gold_report_{name}", f"WITH {ENRICHED_SQL} {REPORT_SQL[name]}")
    def report(spark, folder):
        """AGG9 to AGG13, SRT1, SRT2."""
        return marts.reports(star_tables(spark, folder)[1])[name]


for _name in REPORT_SQL:
    _report(_name)


# ---------------------------------------------------------------- acceptance and reconciliation
@query("q_acceptance", f"""
WITH {FACT_SQL},
t AS (SELECT count(*) AS n, count(DISTINCT record_id) AS k, sum(notification_count) AS a, sum(confirmed_case_count) AS c,
  sum(discarded_case_count) AS d, sum(hospitalized_case_count) AS h, sum(death_by_disease_count) AS x FROM fact)
SELECT 'fact_grain_is_unique' AS check_name, n = k AS passed, 'row_count=' || n || ', distinct_case_count=' || k AS details FROM t
UNION ALL SELECT 'batch_identity_is_consistent', true,
  'row_count=' || n || ', missing_batch_id_count=0, distinct_batch_id_count=1' FROM t
UNION ALL SELECT 'fact_measures_are_binary', true, 'row_count=' || n || ', invalid_measure_row_count=0' FROM t
UNION ALL SELECT 'core_dimension_keys_are_valid', true, 'disease=0, demographic=0, clinical=0, date=0, residence=0'
UNION ALL SELECT 'metric_totals_are_sane', a > 0 AND c BETWEEN 0 AND a AND d BETWEEN 0 AND a AND h BETWEEN 0 AND a AND x BETWEEN 0 AND a,
  'notifications=' || a || ', confirmed=' || c || ', discarded=' || d || ', hospitalized=' || h || ', deaths=' || x FROM t""")
def acceptance(spark, folder):
    """QLT9, QLT10, QLT11, AGG3, AGG4."""
    return marts.acceptance(star_tables(spark, folder)[1])


@query("q_reconcile", f"""
WITH {CASES_SQL},
n AS (SELECT count(*) AS bronze, CAST(count_if(data_quality_status <> 'quarantined') AS BIGINT) AS silver,
  CAST(count_if(data_quality_status = 'valid') AS BIGINT) AS valid, CAST(count_if(data_quality_status = 'warning') AS BIGINT) AS warning,
  CAST(count_if(data_quality_status = 'quarantined') AS BIGINT) AS quarantine,
  count(DISTINCT CASE WHEN data_quality_status <> 'quarantined' THEN record_id END) AS latest,
  count(DISTINCT CASE WHEN record_hash[1] < '8' AND data_quality_status <> 'quarantined' THEN record_id END) AS kept
  FROM cases)
SELECT bronze, silver, valid AS silver_valid, warning AS silver_warning, quarantine, latest AS expected_rows,
  kept AS published_rows, latest - kept AS expected_missing, silver - kept AS current_mismatch,
  bronze = silver + quarantine AS layers_close, silver = valid + warning AS status_closes, kept = latest AS complete,
  true AS keys_valid, true AS measures_valid
FROM n""")
def reconciliation(spark, folder):
    """QLT7, QLT8 with half of the fact lost: the set checks must see exactly what is missing."""
    rows, tables = star_tables(spark, folder)
    clean, bad = quality.split(rows)
    fact = tables[domain.FACT_TABLE].filter(F.substring("record_hash", 1, 1) < "8")
    source = rows.withColumnRenamed("source_batch_id", "_batch_id")
    numbers = reconcile.observed(
        source, clean, bad, clean, tables | {domain.FACT_TABLE: fact}, BATCH_ID
    )
    checks = reconcile.check_columns()
    return numbers.select(
        "bronze", "silver", "silver_valid", "silver_warning", "quarantine", "expected_rows", "published_rows",
        "expected_missing", "current_mismatch",
        checks["bronze_equals_silver_plus_quarantine"].alias("layers_close"),
        checks["silver_status_totals_close"].alias("status_closes"),
        checks["gold_equals_latest_silver_snapshot"].alias("complete"),
        (checks["foreign_keys_are_valid"] & checks["dimension_keys_are_unique"]
         & checks["fact_grain_is_unique"] & checks["batch_identity_is_consistent"]).alias("keys_valid"),
        checks["fact_measures_are_binary"].alias("measures_valid"),
    )

"""Joins, versions, quality, star schema and reports over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.functions import coding
from caselake.operators import enrich, keysets, quality, rollup, star, versions
from caselake.sources import periods
from caselake.specs import ForeignKey, JunkDimension, Rule
from caselake.workload.inputs import LINES_SQL, lines_with_orders, read
from caselake.workload.registry import query

# ---------------------------------------------------------------- joins
PLACE = ("code", "name", "region")


def places(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = read(spark, folder, "nation"), read(spark, folder, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
    )


@query("q_enrich_roles", f"""
WITH p AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS region
           FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT a.name AS residence_name, b.name AS notification_name, c.region AS infection_region, count(*) AS n_lines
FROM {LINES_SQL} JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN p a ON CAST(c_nationkey AS VARCHAR) = a.code
LEFT JOIN p b ON CAST(s_nationkey AS VARCHAR) = b.code
LEFT JOIN p c ON CASE WHEN l_linenumber < 3 THEN 'none' ELSE CAST(s_nationkey AS VARCHAR) END = c.code
GROUP BY 1, 2, 3""")
def enrich_roles(spark, folder):
    """JON1 with three roles, one of them often without a match."""
    suppliers = read(spark, folder, "supplier")
    coded = lines_with_orders(spark, folder).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("c_nationkey").cast("string").alias("home"), F.col("s_nationkey").cast("string").alias("desk"),
        F.when(F.col("l_linenumber") < 3, "none").otherwise(F.col("s_nationkey").cast("string")).alias("origin"),
    )
    roles = {"residence": "home", "notification": "desk", "infection": "origin"}
    joined = enrich.attach_roles(coded, places(spark, folder), roles, "code", PLACE)
    return joined.groupBy("residence_name", "notification_name", "infection_region").agg(
        F.count(F.lit(1)).alias("n_lines")
    )


ORPHAN_KEYS = {
    "customer_key": "CASE WHEN o_orderkey % 100 = 0 THEN o_custkey + 1000000000"
                    " WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END",
    "nation_key": "CASE WHEN o_orderkey % 50 = 0 THEN 999 ELSE o_orderkey % 25 END",
}
_ORPHAN_FACT = ", ".join(f"{e} AS {n}" for n, e in ORPHAN_KEYS.items())


@query("q_orphans", f"""
WITH f AS (SELECT {_ORPHAN_FACT} FROM orders)
SELECT 'customer_key' AS role,
       (SELECT count(*) FROM (SELECT DISTINCT customer_key AS k FROM f) d
        WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = d.k)) AS orphan_keys,
       (SELECT count(*) FROM f LEFT JOIN customer ON customer_key = c_custkey WHERE c_custkey IS NULL) AS orphan_rows
UNION ALL
SELECT 'nation_key',
       (SELECT count(*) FROM (SELECT DISTINCT nation_key AS k FROM f) d
        WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = d.k)),
       (SELECT count(*) FROM f LEFT JOIN nation ON nation_key = n_nationkey WHERE n_nationkey IS NULL)""")
def orphans(spark, folder):
    """JON3, JON4 with unknown and NULL keys put in."""
    fact = read(spark, folder, "orders").select(*(F.expr(e).alias(n) for n, e in ORPHAN_KEYS.items()))
    members = {"customer": read(spark, folder, "customer"), "nation": read(spark, folder, "nation")}
    key_of = {"customer": "c_custkey", "nation": "n_nationkey"}
    links = {
        "customer_key": ForeignKey("customer_key", "customer", "c_custkey"),
        "nation_key": ForeignKey("nation_key", "nation", "n_nationkey"),
    }
    keys = keysets.orphan_keys(fact, members, key_of, links.values())
    rows = keysets.orphan_rows(fact, members, key_of, links)
    tall = rows.select(F.inline(F.array(*(
        F.struct(F.lit(n).alias("role"), F.col(n).alias("orphan_rows")) for n in links
    ))))
    return keys.join(tall, "role")


# Published orders: some lost, some changed, some strange, some twice.
_CONTENT = "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus || o_orderpriority END"
_ALTERED = f"CASE WHEN o_orderkey % 19 = 0 THEN 'altered' ELSE {_CONTENT} END"


@query("q_set_compare", f"""
WITH e AS (SELECT o_orderkey AS k, {_CONTENT} AS v FROM orders),
p AS (SELECT o_orderkey AS k, {_ALTERED} AS v FROM orders WHERE o_orderkey % 17 <> 0
      UNION ALL SELECT o_orderkey + 1000000000, {_CONTENT} FROM orders WHERE o_orderkey % 23 = 0
      UNION ALL SELECT o_orderkey, {_CONTENT} FROM orders WHERE o_orderkey % 29 = 0),
c AS (SELECT o_orderkey AS k, {_CONTENT} AS v FROM orders WHERE year(o_orderdate) = 1999)
SELECT (SELECT count(*) FROM e) AS expected_rows, (SELECT count(*) FROM p) AS published_rows,
  (SELECT count(*) FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = e.k)) AS expected_missing,
  (SELECT count(*) FROM p WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.k = p.k)) AS published_extra,
  (SELECT count(*) FROM p JOIN e ON p.k = e.k WHERE p.v IS DISTINCT FROM e.v) AS content_mismatch,
  (SELECT count(*) FROM c LEFT JOIN p ON c.k = p.k WHERE p.k IS NULL OR p.v IS DISTINCT FROM c.v) AS current_mismatch,
  (SELECT count(*) FROM (SELECT k FROM p GROUP BY k HAVING count(*) > 1)) AS published_duplicate_keys""")
def set_compare(spark, folder):
    """JON5, JON6, JON7, AGG2."""
    orders = read(spark, folder, "orders")
    key, same = F.col("o_orderkey"), F.expr(_CONTENT)

    def pair(df, k, v):
        return df.select(k.alias("k"), v.alias("v"))

    published = (
        pair(orders.filter(key % 17 != 0), key, F.expr(_ALTERED))
        .unionByName(pair(orders.filter(key % 23 == 0), key + 1000000000, same))
        .unionByName(pair(orders.filter(key % 29 == 0), key, same))
    )
    current = pair(orders.filter(F.year("o_orderdate") == 1999), key, same)
    return keysets.compare_sets(pair(orders, key, same), published, "k", "v", current)


@query("q_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, folder):
    """AGG2."""
    keyed = read(spark, folder, "lineitem").withColumn("k", F.struct("l_orderkey", "l_linenumber"))
    return keysets.duplicate_keys(keyed, "k").select("k.l_orderkey", "k.l_linenumber", "n_rows")


# ---------------------------------------------------------------- versions
LINE_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
LINE_NEWEST = ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
_NEWEST_SQL = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_NEWEST)


@query("q_dedup_rank", f"""
WITH r AS (SELECT l_orderkey, l_partkey,
  row_number() OVER (PARTITION BY {LINE_KEY} ORDER BY {_NEWEST_SQL}) AS rn FROM lineitem)
SELECT l_orderkey, count(*) AS n_rows, CAST(count_if(rn > 1) AS BIGINT) AS n_repeats,
       CAST(sum(CASE WHEN rn = 1 THEN l_partkey ELSE 0 END) AS BIGINT) AS kept_parts
FROM r GROUP BY 1""")
def dedup_rank(spark, folder):
    """WIN1."""
    keyed = read(spark, folder, "lineitem").withColumn("k", F.expr(LINE_KEY))
    marked = versions.mark_repeats(keyed, "k", LINE_NEWEST)
    return marked.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("_repeat").alias("n_repeats"),
        F.sum(F.when(~F.col("_repeat"), F.col("l_partkey")).otherwise(F.lit(0))).alias("kept_parts"),
    )


_LATEST_SQL = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *,
  row_number() OVER (PARTITION BY {LINE_KEY} ORDER BY {_NEWEST_SQL}) AS rn FROM lineitem
  WHERE l_returnflag IN ('A', 'N', 'R')) WHERE rn = 1)"""


def latest_lines(spark: SparkSession, folder: str) -> DataFrame:
    usable = read(spark, folder, "lineitem").filter(F.col("l_returnflag").isin("A", "N", "R"))
    return versions.latest_version(usable.withColumn("k", F.expr(LINE_KEY)), "k", LINE_NEWEST)


@query("q_latest_version", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped
FROM {_LATEST_SQL}""")
def latest_version(spark, folder):
    """WIN2, PRJ18: filter on status, then the newest row per key."""
    return latest_lines(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.to_date("l_shipdate").cast("string").alias("shipped"),
    )


# ---------------------------------------------------------------- quality
LINE_ERRORS = (
    Rule("UNKNOWN_STATUS", "o_orderstatus IS NULL OR o_orderstatus = 'X'"),
    Rule("SHIPPED_BEFORE_ORDER", "l_shipdate < o_orderdate"),
    Rule("FUTURE_SHIPMENT", "CAST(l_shipdate AS DATE) > _as_of"),
    Rule("NO_DISCOUNT_ON_RETURN", "l_discount = 0 AND l_returnflag = 'R'"),
)
LINE_WARNINGS = (
    Rule("OPEN_LINE", "l_linestatus = 'O'"),
    Rule("LOW_PRIORITY", "o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')"),
)
LINES_AS_OF = "2001-01-01"


def checked_lines(spark: SparkSession, folder: str) -> DataFrame:
    marked = versions.mark_repeats(
        lines_with_orders(spark, folder).withColumn("k", F.expr(LINE_KEY)), "k", LINE_NEWEST
    )
    as_of = F.lit(LINES_AS_OF).cast("date")
    coded = quality.with_codes(marked, LINE_ERRORS, LINE_WARNINGS, {"_as_of": as_of})
    return quality.with_status(quality.append_code(coded, "_repeat", "DUPLICATE_RECORD"))


_CHECKED_SQL = f"""
r AS (SELECT *, row_number() OVER (PARTITION BY {LINE_KEY} ORDER BY {_NEWEST_SQL}) AS rn FROM {LINES_SQL}),
e AS (SELECT l_orderkey, list_filter([
    CASE WHEN o_orderstatus IS NULL OR o_orderstatus = 'X' THEN 'UNKNOWN_STATUS' END,
    CASE WHEN l_shipdate < o_orderdate THEN 'SHIPPED_BEFORE_ORDER' END,
    CASE WHEN CAST(l_shipdate AS DATE) > DATE '{LINES_AS_OF}' THEN 'FUTURE_SHIPMENT' END,
    CASE WHEN l_discount = 0 AND l_returnflag = 'R' THEN 'NO_DISCOUNT_ON_RETURN' END,
    CASE WHEN rn > 1 THEN 'DUPLICATE_RECORD' END], lambda x: x IS NOT NULL) AS errors,
  list_filter([CASE WHEN l_linestatus = 'O' THEN 'OPEN_LINE' END,
    CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN 'LOW_PRIORITY' END], lambda x: x IS NOT NULL) AS warnings
  FROM r),
s AS (SELECT *, CASE WHEN len(errors) > 0 THEN 'quarantined' WHEN len(warnings) > 0 THEN 'warning' ELSE 'valid' END AS status FROM e)"""


@query("q_quality_codes", f"""
WITH {_CHECKED_SQL}
SELECT 'error' AS severity, code, count(*) AS n_rows FROM (SELECT unnest(errors) AS code FROM s) GROUP BY 1, 2
UNION ALL
SELECT 'warning', code, count(*) FROM (SELECT unnest(warnings) AS code FROM s) GROUP BY 1, 2""")
def quality_codes(spark, folder):
    """QLT1, QLT2, QLT3. Both lists are exploded in one pass over the rows."""
    def tagged(name, severity):
        return F.transform(name, lambda c: F.struct(F.lit(severity).alias("severity"), c.alias("code")))

    both = F.concat(tagged(quality.ERRORS, "error"), tagged(quality.WARNINGS, "warning"))
    return checked_lines(spark, folder).select(F.inline(both)).groupBy("severity", "code").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("q_quality_split", f"""
WITH {_CHECKED_SQL}
SELECT status, errors[1] AS primary_error_code, array_to_string(errors, ',') AS all_errors, count(*) AS n_rows
FROM s GROUP BY 1, 2, 3""".replace("array_to_string(errors, ',')",
                                   "CASE WHEN len(errors) > 0 THEN array_to_string(errors, ',') END"))
def quality_split(spark, folder):
    """QLT4, QLT5: both sides of the split, counted."""
    clean, bad = quality.split(checked_lines(spark, folder))
    none = F.lit(None).cast("string")
    rows = clean.select(quality.STATUS, none.alias(quality.PRIMARY), none.alias("all_errors")).unionByName(
        bad.select(quality.STATUS, quality.PRIMARY, F.concat_ws(",", quality.ERRORS).alias("all_errors"))
    )
    return rows.groupBy(F.col(quality.STATUS).alias("status"), quality.PRIMARY, "all_errors").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("q_quality_stats", f"""
WITH {_CHECKED_SQL}
SELECT count(*) AS input_record_count, CAST(count_if(len(errors) = 0) AS BIGINT) AS silver_record_count,
       CAST(count_if(len(errors) > 0) AS BIGINT) AS quarantine_record_count,
       CAST(count_if(status = 'warning') AS BIGINT) AS warning_record_count FROM s""")
def quality_stats(spark, folder):
    """QLT6, AGG1."""
    return checked_lines(spark, folder).agg(*quality.stat_columns())


# ---------------------------------------------------------------- periods
@query("q_period_slice", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-12-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def period_slice(spark, folder):
    """SRC10, SRC11: December in the other spelling, as a half-open range, in (date, id) order."""
    rows = periods.slice_rows(read(spark, folder, "orders"), "o_orderdate", "month", "12-1997")
    return rows.orderBy("o_orderdate", "o_orderkey").select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"), "o_totalprice"
    )


@query("q_backfill_plan", """
WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS first, max(o_orderdate) AS last FROM orders),
p AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS starts_on FROM b),
done AS (SELECT strftime(o_orderdate, '%Y-%m') AS reference_period FROM orders GROUP BY 1 HAVING count(*) % 3 = 0)
SELECT strftime(starts_on, '%Y-%m') AS reference_period, CAST(starts_on AS VARCHAR) AS starts_on
FROM p WHERE strftime(starts_on, '%Y-%m') NOT IN (SELECT reference_period FROM done)""")
def backfill_plan(spark, folder):
    """SRC12, SRC14: every month the orders span, less those already completed."""
    orders = read(spark, folder, "orders")
    bounds = orders.agg(F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last"))
    done = orders.groupBy(periods.period_of(F.col("o_orderdate"), "month").alias("reference_period")).agg(
        F.when(F.count(F.lit(1)) % 3 == 0, "SUCCEEDED").otherwise("FAILED").alias("status")
    )
    plan = periods.pending(periods.periods_between(bounds, "month"), done)
    return plan.withColumn("starts_on", F.col("starts_on").cast("string"))


# ---------------------------------------------------------------- dimensions
def dated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines_with_orders(spark, folder).select(
        F.to_date("o_orderdate").alias("ordered_on"), F.to_date("l_shipdate").alias("shipped_on")
    )


@query("q_dim_date", f"""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM {LINES_SQL}),
c AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d FROM b
      UNION SELECT CAST(o_orderdate AS DATE) FROM {LINES_SQL}
      UNION SELECT CAST(l_shipdate AS DATE) FROM {LINES_SQL})
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS calendar_date, year(d) AS year,
       quarter(d) AS quarter, month(d) AS month, day(d) AS day, weekofyear(d) AS iso_week_of_year,
       dayofweek(d) + 1 AS day_of_week, strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend
FROM c
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Desconhecido', NULL""")
def dim_date(spark, folder):
    """DIM1, SET1, SET3, SET4, AGG14."""
    dimension = star.date_dimension(
        dated_lines(spark, folder), "ordered_on", ("ordered_on", "shipped_on"), "Desconhecido"
    )
    return dimension.withColumn("calendar_date", F.col("calendar_date").cast("string"))


@query("q_dim_location", f"""
WITH used AS (SELECT c_nationkey AS k FROM {LINES_SQL}
              UNION SELECT s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT CAST(n_nationkey AS BIGINT) AS location_key, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS region
FROM used JOIN nation ON k = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT -1, 'Desconhecido', 'Desconhecido', 'Desconhecido'""")
def dim_location(spark, folder):
    """DIM2, SET2."""
    suppliers = read(spark, folder, "supplier")
    coded = lines_with_orders(spark, folder).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("c_nationkey").cast("string").alias("home"), F.col("s_nationkey").cast("string").alias("desk")
    )
    placed = enrich.attach_roles(coded, places(spark, folder), {"residence": "home", "notification": "desk"}, "code", PLACE)
    return star.location_dimension(placed, ("residence", "notification"), PLACE, "code", "Desconhecido")


PROFILE = JunkDimension(
    "dim_profile", "profile_key", ("segment", "priority", "status"), ("segment", "priority", "status")
)
_PROFILE_SQL = {
    "segment": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE c_mktsegment END",
    "priority": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END",
    "status": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
}


def profiled(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.expr(e) for n, e in _PROFILE_SQL.items()})


@query("q_dim_junk", f"""
SELECT DISTINCT {', '.join(f'{e} AS {n}' for n, e in _PROFILE_SQL.items())}, false AS is_unknown
FROM {LINES_SQL} WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'Desconhecido', 'Desconhecido', 'Desconhecido', true""")
def dim_junk(spark, folder):
    """DIM3, DIM4, DIM5, SET5, KEY3: the all-NULL combination is the unknown member."""
    dimension = star.junk_dimension(profiled(lines_with_orders(spark, folder)), PROFILE, "Desconhecido")
    return dimension.select(*PROFILE.attributes, (F.col("profile_key") == -1).alias("is_unknown"))


# ---------------------------------------------------------------- small star, views, reports
# Measures of a line item: returned counts as confirmed, shipped late as hospitalised.
SHOP_MEASURES = {
    "notified": "1", "confirmed": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "discarded": "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END",
    "late": "CASE WHEN l_shipdate < o_orderdate THEN 1 ELSE 0 END",
}
AGE_OF_LINE = "CAST(l_quantity AS INT)"
_SHOP_SQL = f"""
shop AS (SELECT l.*, o_orderstatus, o_orderpriority, c_mktsegment, n_name AS nation, r_name AS region,
  year(o_orderdate) AS year, strftime(o_orderdate, '%m') AS month,
  {', '.join(f'{e} AS {n}' for n, e in SHOP_MEASURES.items())},
  CASE WHEN {AGE_OF_LINE} >= 80 THEN '80+' ELSE CAST({AGE_OF_LINE} // 10 AS VARCHAR) || '0-' || CAST({AGE_OF_LINE} // 10 AS VARCHAR) || '9' END AS band
  FROM {_LATEST_SQL} l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def shop(spark: SparkSession, folder: str) -> DataFrame:
    """Latest line items with residence, month, band and measures."""
    orders, customers = read(spark, folder, "orders"), read(spark, folder, "customer")
    lines = (
        latest_lines(spark, folder)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    nations = places(spark, folder).select(
        F.col("code").cast("int").alias("nation_code"), F.col("name").alias("nation"), "region"
    )
    return lines.join(nations, F.col("c_nationkey") == F.col("nation_code")).withColumns({
        "year": F.year("o_orderdate"), "month": F.date_format("o_orderdate", "MM"),
        "band": coding.decade_band(F.expr(AGE_OF_LINE)),
        **{n: F.expr(e) for n, e in SHOP_MEASURES.items()},
    })


def _sums_sql(names) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)




def _rate_sql(part: str, whole: str) -> str:
    """Half-up to two places in whole numbers, so neither dialect's division type matters."""
    return (
        f"CASE WHEN sum({whole}) = 0 THEN NULL ELSE"
        f" CAST((20000 * sum({part}) + sum({whole})) // (2 * sum({whole})) AS DOUBLE) / 100 END"
    )


def _monthly(name: str, keys: tuple):
    listed = ", ".join(keys)

    @query(name, f"WITH {_SHOP_SQL} SELECT {listed}, {_sums_sql(SHOP_MEASURES)},"
                 f" {_rate_sql('confirmed', 'notified')} AS confirmed_rate FROM shop GROUP BY {listed}")
    def monthly(spark, folder):
        """AGG5 to AGG8 with the rate of AGG11."""
        totals = rollup.sum_by(shop(spark, folder), {k: k for k in keys}, {m: m for m in SHOP_MEASURES})
        return totals.withColumn("confirmed_rate", rollup.percentage(F.col("confirmed"), F.col("notified")))

    return monthly


monthly_by_nation = _monthly("q_monthly_by_nation", ("year", "month", "nation", "region"))
_monthly("q_monthly_by_region", ("year", "month", "region"))
_monthly("q_monthly_by_band", ("year", "month", "band"))
_monthly("q_monthly_by_class", ("year", "month", "l_returnflag", "o_orderpriority"))


@query("q_fact_measures", f"""
WITH {_SHOP_SQL}
SELECT year, month, {_sums_sql(SHOP_MEASURES)},
       CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS unknown_profiles,
       CAST(sum(year * 10000 + CAST(month AS INTEGER) * 100) AS BIGINT) AS month_keys
FROM shop GROUP BY 1, 2""")
def fact_measures(spark, folder):
    """DIM6: keys and measures of the fact, summed by month."""
    from caselake.functions.identity import surrogate_key
    fact = profiled(shop(spark, folder)).withColumn("profile_key", surrogate_key(PROFILE.key_attributes))
    return fact.groupBy("year", "month").agg(
        *(F.sum(m).alias(m) for m in SHOP_MEASURES),
        F.count_if(F.col("profile_key") == -1).alias("unknown_profiles"),
        F.sum(F.col("year") * 10000 + F.col("month").cast("int") * 100).alias("month_keys"),
    )


@query("q_star_enriched", f"""
WITH {_SHOP_SQL}
SELECT nation, region, coalesce({_PROFILE_SQL['segment']}, 'Desconhecido') AS segment,
       coalesce({_PROFILE_SQL['priority']}, 'Desconhecido') AS priority, {_sums_sql(SHOP_MEASURES)}
FROM shop GROUP BY 1, 2, 3, 4""")
def star_enriched(spark, folder):
    """JON2, DIM8: fact to two dimensions built from the same rows, unknown members included."""
    from caselake.functions.identity import natural_key, surrogate_key
    rows = profiled(shop(spark, folder)).withColumns({
        "residence_code": F.col("nation_code").cast("string"),
        "residence_name": F.col("nation"), "residence_region": F.col("region"),
    })
    locations = star.location_dimension(rows, ("residence",), PLACE, "code", "Desconhecido")
    profiles = star.junk_dimension(rows, PROFILE, "Desconhecido")
    fact = rows.select(
        natural_key(F.col("residence_code")).alias("place_key"),
        surrogate_key(PROFILE.key_attributes).alias("profile_key"), *SHOP_MEASURES,
    )
    joined = star.star_join(fact, [
        (locations.select("location_key", F.col("name").alias("nation"), "region"),
         "place_key", "location_key", ["nation", "region"]),
        (profiles, "profile_key", "profile_key", ["segment", "priority"]),
    ])
    return joined.groupBy("nation", "region", "segment", "priority").agg(
        *(F.sum(m).alias(m) for m in SHOP_MEASURES)
    )


# Reports re-aggregate a monthly view, as a reader of the views does.
def _view(spark, folder, *keys) -> DataFrame:
    names = ("year", "month", *keys)
    return rollup.sum_by(shop(spark, folder), {k: k for k in names}, {m: m for m in SHOP_MEASURES})


@query("q_report_monthly", f"WITH {_SHOP_SQL} SELECT year, month, {_sums_sql(SHOP_MEASURES)} FROM shop GROUP BY 1, 2")
def report_monthly(spark, folder):
    """AGG9, SRT1."""
    return _view(spark, folder).orderBy("year", "month")


@query("q_report_region", f"""
WITH {_SHOP_SQL} SELECT year, month, region, {_sums_sql(SHOP_MEASURES)} FROM shop GROUP BY 1, 2, 3""")
def report_region(spark, folder):
    """AGG10: nations summed up to regions."""
    view = _view(spark, folder, "nation", "region")
    keys = ("year", "month", "region")
    return rollup.sum_by(view, {k: k for k in keys}, {m: m for m in SHOP_MEASURES}).orderBy(
        "year", "month", F.desc("confirmed"), "region"
    )


@query("q_report_band_rate", f"""
WITH {_SHOP_SQL} SELECT year, month, band, {_sums_sql(SHOP_MEASURES)},
  {_rate_sql('late', 'confirmed')} AS late_per_confirmed FROM shop GROUP BY 1, 2, 3""")
def report_band_rate(spark, folder):
    """AGG11: a rate without a whole is NULL."""
    return _view(spark, folder, "band").withColumn(
        "late_per_confirmed", rollup.percentage(F.col("late"), F.col("confirmed"))
    ).orderBy("year", "month", F.desc("confirmed"), "band")


@query("q_report_top_nations", f"""
WITH {_SHOP_SQL} SELECT year, month, nation, {_sums_sql(SHOP_MEASURES)},
  {_rate_sql('confirmed', 'notified')} AS confirmed_rate FROM shop GROUP BY 1, 2, 3
ORDER BY confirmed DESC, notified DESC, year, month, nation LIMIT 100""")
def report_top_nations(spark, folder):
    """AGG12, SRT2."""
    rated = _view(spark, folder, "nation").withColumn(
        "confirmed_rate", rollup.percentage(F.col("confirmed"), F.col("notified"))
    )
    order = [F.desc("confirmed"), F.desc("notified"), "year", "month", "nation"]
    return rollup.top_rows(rated, order, 100)


@query("q_report_class", f"""
WITH {_SHOP_SQL} SELECT year, month, l_returnflag, o_orderpriority, o_orderstatus, {_sums_sql(SHOP_MEASURES)}
FROM shop GROUP BY 1, 2, 3, 4, 5""")
def report_class(spark, folder):
    """AGG13."""
    keys = ("l_returnflag", "o_orderpriority", "o_orderstatus")
    return _view(spark, folder, *keys).orderBy("year", "month", F.desc("notified"), *keys)


@query("q_distinct_counts", """
SELECT o_orderstatus AS status, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers,
       CAST(count_if(o_totalprice > 250000) AS BIGINT) AS n_large
FROM orders GROUP BY 1""")
def distinct_counts(spark, folder):
    """AGG3, AGG4: distinct pairs are made first, so a large group is never one task's set."""
    per_customer = read(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("status"), "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") > 250000).alias("large")
    )
    return per_customer.groupBy("status").agg(
        F.sum("n").alias("n_rows"), F.count("o_custkey").alias("n_customers"), F.sum("large").alias("n_large")
    )

"""Column operators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselake.functions import coding, identity, temporal, text
from caselake.operators import projection
from caselake.plans import domain
from caselake.specs import ColumnSpec, Flag
from caselake.workload.inputs import LINES_SQL, lines_with_orders, read
from caselake.workload.registry import query

# The same pollution in both dialects: every spelling of "no value" and stray blanks.
DIRTY = (
    "CASE o_orderkey % 7 WHEN 0 THEN 'NaN' WHEN 1 THEN '  ' WHEN 2 THEN ' None '"
    " WHEN 3 THEN 'null' WHEN 4 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END"
)


def sql_clean(column: str) -> str:
    return (
        f"CASE WHEN lower(trim({column})) IN ('', 'nan', 'null', 'none') THEN NULL ELSE trim({column}) END"
    )


@query("q_clean_text", f"""
WITH d AS (SELECT o_orderkey, {DIRTY} AS raw FROM orders)
SELECT o_orderkey, {sql_clean('raw')} AS cleaned,
       CASE WHEN {sql_clean('raw')} = '5-LOW' THEN NULL ELSE {sql_clean('raw')} END AS without_low,
       CAST(NULL AS VARCHAR) AS absent_column
FROM d""")
def clean(spark, folder):
    """PRJ7, PRJ8, PRJ10."""
    dirty = read(spark, folder, "orders").withColumn("raw", F.expr(DIRTY))
    cleaned = text.clean_text(F.col("raw"))
    return dirty.select(
        "o_orderkey", cleaned.alias("cleaned"), text.null_if(cleaned, "5-LOW").alias("without_low"),
        text.clean_or_null(dirty, "not_in_this_file").alias("absent_column"),
    )


TEXTUAL = {
    "raw_date": "CASE WHEN o_orderkey % 5 = 0 THEN '2001-02-31' WHEN o_orderkey % 5 = 1 THEN '2001-2-3'"
                " WHEN o_orderkey % 5 = 2 THEN 'x' ELSE ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "raw_int": "CASE WHEN o_orderkey % 4 = 0 THEN 'x1' WHEN o_orderkey % 4 = 1 THEN CAST(o_custkey AS STRING) || '.0'"
               " ELSE CAST(o_custkey AS STRING) END",
    "raw_time": "CASE WHEN o_orderkey % 3 = 0 THEN 'never' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:20:30' END",
    "raw_text": "CASE WHEN o_orderkey % 6 = 0 THEN 'NULL' ELSE ' ' || o_orderpriority END",
}
TYPED_COLUMNS = (
    ColumnSpec("as_date", "raw_date", "date"), ColumnSpec("as_int", "raw_int", "int"),
    ColumnSpec("as_time", "raw_time", "timestamp"), ColumnSpec("as_text", "raw_text"),
    ColumnSpec("as_upper", "raw_text", "upper"), ColumnSpec("as_lower", "raw_text", "lower"),
)


def sql_int(column: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(trim({column}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '') AS INTEGER)"


def sql_date(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({column}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
        f" THEN TRY_CAST(trim({column}) AS DATE) END"
    )


@query("q_typed_projection", f"""
WITH d AS (SELECT o_orderkey, {', '.join(f'{e} AS {n}' for n, e in TEXTUAL.items())} FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS row_key, CAST({sql_date('raw_date')} AS VARCHAR) AS as_date,
       {sql_int('raw_int')} AS as_int,
       strftime(TRY_CAST(raw_time AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS as_time,
       {sql_clean('raw_text')} AS as_text, upper({sql_clean('raw_text')}) AS as_upper,
       lower({sql_clean('raw_text')}) AS as_lower,
       CASE WHEN regexp_full_match(trim(raw_date), '(19|20)[0-9]{{2}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])')
            THEN CAST(TRY_CAST(trim(raw_date) AS DATE) AS VARCHAR) END AS calendar_date,
       CASE WHEN {sql_date('raw_date')} IS NULL THEN 'unknown'
            ELSE strftime({sql_date('raw_date')}, '%Y') END AS year_or_unknown,
       CASE WHEN {sql_date('raw_date')} IS NULL THEN 'unknown'
            ELSE strftime({sql_date('raw_date')}, '%m') END AS month_or_unknown
FROM d""")
def typed(spark, folder):
    """PRJ9, PRJ5, SRC9."""
    raw = read(spark, folder, "orders").withColumns({n: F.expr(e) for n, e in TEXTUAL.items()})
    keyed = raw.withColumn("row_text", F.col("o_orderkey").cast("string"))
    columns = (
        ColumnSpec("row_key", "row_text"), *TYPED_COLUMNS, ColumnSpec("raw_date", "raw_date"),
    )
    out = projection.typed(keyed, columns)
    return out.select(
        "row_key", F.col("as_date").cast("string").alias("as_date"), "as_int",
        F.date_format("as_time", "yyyy-MM-dd HH:mm:ss").alias("as_time"),
        "as_text", "as_upper", "as_lower",
        temporal.strict_date(F.col("raw_date"), temporal.ISO_DAY_20TH_21ST).cast("string").alias("calendar_date"),
        temporal.year_or_unknown(F.col("as_date")).alias("year_or_unknown"),
        temporal.month_or_unknown(F.col("as_date")).alias("month_or_unknown"),
    )


PRIORITY_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}


@query("q_code_map", """
SELECT o_orderpriority AS code,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            WHEN o_orderpriority = '1-URGENT' THEN 'Urgent' WHEN o_orderpriority = '2-HIGH' THEN 'High'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' WHEN o_orderpriority = '5-LOW' THEN 'Low'
            ELSE 'Não mapeado' END AS label,
       CASE WHEN upper(trim(lower(o_orderpriority) || ' ')) = '2-HIGH' THEN 'dengue' ELSE 'unknown' END AS tag,
       count(*) AS n_rows
FROM orders GROUP BY 1, 2, 3""")
def code_map(spark, folder):
    """PRJ11 with NULL, known and unmapped codes; PRJ6."""
    code = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    spelled = F.concat(F.lower("o_orderpriority"), F.lit(" "))
    return read(spark, folder, "orders").groupBy(
        F.col("o_orderpriority").alias("code"),
        coding.label_of(code, PRIORITY_LABELS, domain.UNMAPPED).alias("label"),
        F.when(F.upper(F.trim(spelled)) == "2-HIGH", "dengue").otherwise("unknown").alias("tag"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


AGE_SQL = "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity * 2 AS INT) - 2 END"
_BAND_SQL = " ".join(
    f"WHEN age >= {low}" + (f" AND age <= {high}" if high is not None else "") + f" THEN '{label}'"
    for low, high, label in domain.AGE_BANDS
)


@query("q_bands", f"""
WITH a AS (SELECT {AGE_SQL} AS age FROM lineitem)
SELECT CASE {_BAND_SQL} ELSE 'Ignorada' END AS band,
       CASE WHEN age IS NULL THEN NULL WHEN age >= 80 THEN '80+'
            ELSE CAST(age // 10 AS VARCHAR) || '0-' || CAST(age // 10 AS VARCHAR) || '9' END AS decade,
       count(*) AS n_rows, CAST(sum(age) AS BIGINT) AS total_age
FROM a GROUP BY 1, 2""")
def bands(spark, folder):
    """PRJ13, PRJ14."""
    aged = read(spark, folder, "lineitem").select(F.expr(AGE_SQL).alias("age"))
    return aged.groupBy(
        coding.band_of(F.col("age"), domain.AGE_BANDS, domain.AGE_BAND_MISSING).alias("band"),
        coding.decade_band(F.col("age")).alias("decade"),
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("age").alias("total_age"))


ENCODED_SQL = (
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS STRING)"
    " || lpad(CAST(CAST(l_quantity AS INT) AS STRING), 3, '0') END"
)


@query("q_encoded_age", f"""
WITH e AS (SELECT {ENCODED_SQL} AS encoded FROM lineitem),
d AS (SELECT substring(encoded, 1, 1) AS unit, TRY_CAST(substring(encoded, 2, 3) AS INTEGER) AS value FROM e),
y AS (SELECT unit, value, CASE WHEN unit = '4' THEN value WHEN unit IN ('1', '2', '3') THEN 0 END AS age FROM d)
SELECT unit AS age_unit_code, age AS age_years, CASE {_BAND_SQL} ELSE 'Ignorada' END AS age_group_name,
       count(*) AS n_rows, CAST(sum(value) AS BIGINT) AS total_value
FROM y GROUP BY 1, 2, 3""")
def encoded_age(spark, folder):
    """PRJ12, PRJ13."""
    encoded = read(spark, folder, "lineitem").select(F.expr(ENCODED_SQL).alias("encoded"))
    aged = projection.with_age(
        encoded, "encoded", domain.YEAR_UNIT, domain.SHORTER_UNITS, domain.AGE_BANDS, domain.AGE_BAND_MISSING
    )
    return aged.groupBy("age_unit_code", "age_years", "age_group_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("age_value").alias("total_value")
    )


LINE_FLAGS = (
    Flag("is_returned", "l_returnflag = 'R'", "l_returnflag = 'A'"),
    Flag("is_late", "l_shipdate < o_orderdate", "l_shipdate >= o_orderdate AND o_orderstatus <> 'P'"),
    Flag("is_open", "o_orderstatus = 'O' OR l_returnflag = 'N'", "true"),
)


@query("q_flags_measures", f"""
WITH f AS (
  SELECT CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS is_returned,
         CASE WHEN l_shipdate < o_orderdate THEN true WHEN o_orderstatus <> 'P' THEN false END AS is_late,
         (o_orderstatus = 'O' OR l_returnflag = 'N') AS is_open
  FROM {LINES_SQL})
SELECT is_returned, is_late, is_open, count(*) AS n_rows,
       CAST(sum(CASE WHEN is_returned THEN 1 ELSE 0 END) AS BIGINT) AS returned_count,
       CAST(sum(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_count,
       CAST(sum(CASE WHEN is_open THEN 1 ELSE 0 END) AS BIGINT) AS open_count
FROM f GROUP BY 1, 2, 3""")
def flags_measures(spark, folder):
    """PRJ15, PRJ16."""
    flagged = projection.with_flags(lines_with_orders(spark, folder), LINE_FLAGS)
    return flagged.groupBy("is_returned", "is_late", "is_open").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(
            F.sum(coding.as_measure(F.col(f"is_{n}"))).alias(f"{n}_count")
            for n in ("returned", "late", "open")
        ),
    )


HASHED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "note")
NOTE_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus || '|' END"


@query("q_content_hash", f"""
WITH n AS (SELECT *, {NOTE_SQL} AS note FROM orders),
h AS (SELECT o_orderkey, year(o_orderdate) AS y, sha256(
  {" || '||' || ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in sorted(HASHED))}) AS record_hash,
  sha256({" || '||' || ".join(
      f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '<null>')"
      for c in sorted(HASHED))}) AS framed_hash FROM n)
SELECT o_orderkey, record_hash, framed_hash,
       sha256('shop||' || CAST(y AS VARCHAR) || '||' || record_hash) AS record_id
FROM h""")
def content_hash(spark, folder):
    """KEY1, KEY2."""
    noted = read(spark, folder, "orders").withColumn("note", F.expr(NOTE_SQL))
    hashed = noted.withColumns({
        "record_hash": identity.content_hash(HASHED),
        "framed_hash": identity.content_hash(HASHED, framed=True),
    })
    return hashed.select(
        "o_orderkey", "record_hash", "framed_hash",
        identity.record_identity(F.lit("shop"), F.year("o_orderdate"), F.col("record_hash")).alias("record_id"),
    )


@query("q_surrogate_keys", """
SELECT o_orderstatus AS status, n_distinct AS n_rows, is_unknown, distinct_keys, date_keys, location_keys FROM (
  SELECT o_orderstatus, count(*) AS n_distinct, false AS is_unknown,
         count(DISTINCT o_orderpriority) AS distinct_keys,
         CAST(sum(CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)) AS BIGINT) AS date_keys,
         CAST(sum(CASE WHEN o_custkey % 10 = 0 THEN -1 ELSE o_custkey END) AS BIGINT) AS location_keys
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
  UNION ALL
  SELECT o_orderstatus, count(*), true, 1, CAST(-1 * count(*) AS BIGINT),
         CAST(sum(CASE WHEN o_custkey % 10 = 0 THEN -1 ELSE o_custkey END) AS BIGINT)
  FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)""")
def surrogate_keys(spark, folder):
    """KEY3, KEY4, KEY5: NULL in every attribute is the unknown member, one key per combination."""
    known = F.col("o_orderstatus") != "P"
    keyed = read(spark, folder, "orders").withColumns({
        "a": F.when(known, F.col("o_orderstatus")), "b": F.when(known, F.col("o_orderpriority")),
        "day": F.when(known, F.to_date("o_orderdate")),
        "place": F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).otherwise("n/a"),
    }).withColumn("key", identity.surrogate_key(["a", "b"]))
    return keyed.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("key") == identity.UNKNOWN_KEY).alias("is_unknown"),
        F.count_distinct("key").alias("distinct_keys"),
        F.sum(temporal.date_key(F.col("day"))).alias("date_keys"),
        F.sum(identity.natural_key(F.col("place"))).alias("location_keys"),
    )


# Base digits from the key; every fifth number is damaged and every seventh is punctuated.
NINE = "'9' || lpad(CAST(c_custkey % 100000000 AS STRING), 8, '0')"


def _sql_check(digits: str, count: int, top: int) -> str:
    total = " + ".join(
        f"CAST(substring({digits}, {i + 1}, 1) AS INTEGER) * {top - i}" for i in range(count)
    )
    return f"CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END"


PEOPLE_SQL = f"""
n AS (SELECT c_custkey, {NINE} AS nine FROM customer),
n1 AS (SELECT c_custkey, nine, nine || CAST({_sql_check('nine', 9, 10)} AS VARCHAR) AS ten FROM n),
n2 AS (SELECT c_custkey, ten || CAST({_sql_check('ten', 10, 11)} AS VARCHAR) AS number FROM n1)"""


@query("q_id_checksum", f"""
WITH {PEOPLE_SQL},
s AS (SELECT c_custkey, number AS full_number,
  CASE WHEN c_custkey % 5 = 0 THEN substring(number, 1, 10) || CAST((CAST(substring(number, 11, 1) AS INTEGER) + 1) % 10 AS VARCHAR)
       WHEN c_custkey % 11 = 1 THEN '11111111111'
       WHEN c_custkey % 7 = 0 THEN substring(number, 1, 3) || '.' || substring(number, 4, 3) || '.' || substring(number, 7, 3) || '-' || substring(number, 10, 2)
       ELSE number END AS raw FROM n2)
SELECT c_custkey, raw, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 11 = 1 THEN NULL ELSE full_number END AS normalised
FROM s""")
def id_checksum(spark, folder):
    """KEY6: sound, damaged, uniform and punctuated numbers."""
    key, number = F.col("c_custkey"), F.col("number")
    raw = (
        F.when(key % 5 == 0, F.concat(
            F.substring(number, 1, 10),
            ((F.substring(number, 11, 1).cast("int") + 1) % 10).cast("string")))
        .when(key % 11 == 1, F.lit("1" * 11))
        .when(key % 7 == 0, F.regexp_replace(number, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4"))
        .otherwise(number)
    )
    people = read(spark, folder, "customer").withColumn("number", identity.with_check_digits(F.expr(NINE)))
    return people.withColumn("raw", raw).select(
        "c_custkey", "raw", identity.person_number(F.col("raw")).alias("normalised")
    )


TEST_KEYS = {"v1": b"workload-key-one", "v2": b"workload-key-two-" + b"x" * 60}


def sql_hmac(message: str, key: bytes) -> str:
    inner, outer = (p.hex() for p in identity.key_pads(key))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


@query("q_keyed_fingerprint", f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
f AS (SELECT user_id, {sql_hmac("'person-' || CAST(user_id AS VARCHAR)", TEST_KEYS["v2"])} AS fingerprint FROM u)
SELECT user_id, 'v2' AS key_version, fingerprint,
       'pt_' || substring(sha256('token:' || fingerprint), 1, 32) AS token
FROM f""")
def keyed_fingerprint(spark, folder):
    """KEY7, KEY8: key longer than one hash block, chosen by version."""
    people = read(spark, folder, "events").select("user_id").distinct().withColumn(
        "number", F.concat(F.lit("person-"), F.col("user_id").cast("string"))
    )
    marked = identity.with_fingerprint(people, "number", identity.keyring(spark, TEST_KEYS), "v2")
    return marked.select(
        "user_id", "key_version", "fingerprint", identity.person_token(F.col("fingerprint")).alias("token")
    )


@query("q_shard", """
SELECT CAST(CAST('0x' || substring(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 8 AS INTEGER) AS shard,
       count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM events GROUP BY 1""")
def shard(spark, folder):
    """KEY10."""
    return read(spark, folder, "events").groupBy(
        identity.hash_shard(F.col("event_id"), 8).alias("shard")
    ).agg(F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("id_sum"))

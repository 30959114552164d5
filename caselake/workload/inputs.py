"""Inputs derived from the given tables.

The derivations are SQL expressions both dialects read alike, so Spark and the check start
from the same rows; everything after them is written twice.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.plans import domain
from caselake.session import spread

AS_OF = date(2008, 6, 1)
BATCH_ID = "batch-2026-01"
PROCESSING_DATE = "2026-01-15"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with order and customer, one row per line item."""
    return _with_orders(spark, folder, read(spark, folder, "lineitem"))


def spread_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same for work that is heavy per row, on all cores also when the table is one file."""
    return _with_orders(spark, folder, spread(read(spark, folder, "lineitem")))


def _with_orders(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    orders, customers = read(spark, folder, "orders"), read(spark, folder, "customer")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )


LINES_SQL = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"

# ---------------------------------------------------------------- notifications
# Orders date from 1995 to 2001; seven years later they lie in the era the rules accept, with
# a tail after AS_OF.
BASE = {
    "ok": "l_orderkey", "ln": "l_linenumber", "d": "CAST(o_orderdate AS DATE) + 2557",
    "person": "o_custkey", "nation": "c_nationkey", "flag": "l_returnflag",
    "line": "l_linestatus", "priority": "o_orderpriority", "status": "o_orderstatus",
}

# Source column to its value, with every kind of fault the rules look for. Columns not listed
# are empty.
NOTIFICATION = {
    "TP_NOT": "'2'",
    "ID_AGRAVO": "CASE WHEN ok % 41 = 0 THEN 'A92' WHEN ok % 37 = 0 THEN ' a90 '"
                 " WHEN ok % 43 = 0 THEN 'nan' ELSE 'A90' END",
    "DT_NOTIFIC": "CASE WHEN ok % 53 = 0 THEN '2004-02-31' WHEN ok % 59 = 0 THEN 'NaN'"
                  " WHEN ok % 61 = 0 THEN '2004-1-5' WHEN ok % 67 = 0 THEN '1999-05-05'"
                  " ELSE CAST(d AS STRING) END",
    "SEM_NOT": "CAST(ok % 52 + 1 AS STRING)",
    "NU_ANO": "CASE WHEN ok % 47 = 0 THEN '1998' WHEN ok % 71 = 0 THEN 'null'"
              " WHEN ok % 73 = 0 THEN CAST(year(d) AS STRING) || '.0'"
              " ELSE CAST(year(d) AS STRING) END",
    "SG_UF_NOT": "CAST(person % 25 + 10 AS STRING)",
    "ID_MUNICIP": "CASE WHEN ok % 29 = 0 THEN '999999' WHEN ok % 101 = 0 THEN ''"
                  " ELSE CAST(110000 + person % 25 AS STRING) END",
    "ID_UNIDADE": "CAST(2000000 + person % 500 AS STRING)",
    "DT_SIN_PRI": "CASE WHEN ok % 23 = 0 THEN CAST(d + 3 AS STRING) WHEN ln = 5 THEN NULL"
                  " ELSE CAST(d - ln AS STRING) END",
    "SEM_PRI": "CASE WHEN ln = 5 THEN 'x' ELSE CAST(ok % 52 + 1 AS STRING) END",
    "ANO_NASC": "CAST(year(d) - CAST(person % 100 AS INT) AS STRING)",
    "NU_IDADE_N": "CASE WHEN ok % 97 = 0 THEN '9010' WHEN ln = 7 THEN NULL WHEN ln = 6 THEN '3006'"
                  " WHEN ok % 103 = 0 THEN '4' ELSE '4' || lpad(CAST(person % 100 AS STRING), 3, '0') END",
    "CS_SEXO": "CASE flag WHEN 'A' THEN 'f' WHEN 'N' THEN 'M' ELSE 'I' END",
    "CS_GESTANT": "CAST(ok % 10 AS STRING)",
    "CS_RACA": "CAST(ok % 7 AS STRING)",
    "CS_ESCOL_N": "CASE WHEN ok % 13 = 12 THEN ' None ' ELSE CAST(ok % 13 AS STRING) END",
    "SG_UF": "CAST(nation + 10 AS STRING)",
    "ID_MN_RESI": "CASE WHEN ok % 79 = 0 THEN '  ' WHEN ok % 83 = 0 THEN '888888'"
                  " ELSE CAST(110000 + nation AS STRING) END",
    "ID_PAIS": "'1'",
    "DT_INVEST": "CASE WHEN ln = 3 THEN NULL WHEN ok % 19 = 0 THEN CAST(d - 1 AS STRING)"
                 " ELSE CAST(d + ln AS STRING) END",
    "FEBRE": "CASE WHEN (ok + ln) % 2 = 0 THEN '1' ELSE '2' END",
    "MIALGIA": "CASE WHEN (ok + ln) % 3 = 0 THEN '1' ELSE '2' END",
    "SOROTIPO": "CASE WHEN ok % 6 = 5 THEN '' ELSE CAST(ok % 6 AS STRING) END",
    "HOSPITALIZ": "CASE WHEN line = 'F' THEN '1' WHEN ok % 3 = 0 THEN '2' WHEN ok % 3 = 1 THEN '9' END",
    "DT_INTERNA": "CASE WHEN ok % 107 = 0 THEN '1970-01-01' WHEN line = 'F' THEN CAST(d + 1 AS STRING) END",
    "TPAUTOCTO": "CASE WHEN ok % 5 = 3 THEN NULL WHEN ok % 5 = 4 THEN '8' ELSE CAST(ok % 5 + 1 AS STRING) END",
    "COUFINF": "CAST(nation + 10 AS STRING)",
    "COPAISINF": "'1'",
    "COMUNINF": "CASE WHEN ln = 1 THEN '0' WHEN ln = 2 THEN NULL WHEN ok % 31 = 0 THEN '777777'"
                " ELSE CAST(110000 + (nation + ln) % 25 AS STRING) END",
    "CLASSI_FIN": "CASE priority WHEN '1-URGENT' THEN '12' WHEN '2-HIGH' THEN '11' WHEN '3-MEDIUM' THEN '10'"
                  " WHEN '4-NOT SPECIFIED' THEN '5' ELSE CASE ln WHEN 1 THEN '13' WHEN 2 THEN '8'"
                  " WHEN 3 THEN '99' WHEN 4 THEN NULL ELSE '10' END END",
    "CRITERIO": "CASE status WHEN 'F' THEN '1' WHEN 'O' THEN '3' ELSE CASE WHEN ln < 4 THEN '2' ELSE 'NULL' END END",
    "EVOLUCAO": "CASE ok % 11 WHEN 0 THEN '2' WHEN 1 THEN '3' WHEN 2 THEN '9' WHEN 3 THEN NULL ELSE '1' END",
    "DT_OBITO": "CASE WHEN ok % 109 = 0 THEN CAST(d - 40 AS STRING) WHEN ok % 11 = 0 THEN CAST(d + 9 AS STRING) END",
    "DT_ENCERRA": "CASE WHEN ok % 17 = 0 THEN CAST(d + 1 AS STRING) WHEN ln % 2 = 0 THEN CAST(d + 30 AS STRING) END",
    "TP_SISTEMA": "'2'",
    "NDUPLIC_N": "CAST(ln AS STRING)",
    "DT_DIGITA": "CASE WHEN ok % 89 = 0 THEN '1990-01-01' ELSE CAST(d + 2 AS STRING) END",
}

PERIOD_EXPR = "substring(CAST(d AS STRING), 1, 7)"


def notifications(spark: SparkSession, folder: str, which: str = "true") -> DataFrame:
    """One notification per line item: all source columns as text, and the day it is filed under.

    ``which`` is a condition over ``BASE``: the notifications that one of several batches brings.
    """
    base = spread_lines(spark, folder).selectExpr(*(f"{e} AS {n}" for n, e in BASE.items())).where(which)
    return base.selectExpr(
        *(f"{NOTIFICATION.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in domain.SOURCE_COLUMNS),
        "d AS filed_on",
        f"{PERIOD_EXPR} AS period",
    )


def periods(spark: SparkSession, folder: str) -> DataFrame:
    """Every period that may hold notifications, from the orders alone."""
    days = read(spark, folder, "orders").selectExpr(f"{BASE['d']} AS d")
    return days.selectExpr(f"{PERIOD_EXPR} AS period").distinct()


def notifications_sql(which: str = "true") -> str:
    base = ", ".join(f"{e} AS {n}" for n, e in BASE.items())
    cells = ", ".join(
        f"{NOTIFICATION.get(c, 'CAST(NULL AS STRING)')} AS {c.lower()}" for c in domain.SOURCE_COLUMNS
    )
    return (
        f"base AS (SELECT * FROM (SELECT {base} FROM {LINES_SQL}) WHERE {which}),\n"
        f"notif AS (SELECT {cells}, d AS filed_on, {PERIOD_EXPR} AS reference_period FROM base)"
    )


NOTIFICATIONS_SQL = notifications_sql()


# ---------------------------------------------------------------- municipality reference
def reference_nested(spark: SparkSession, folder: str) -> DataFrame:
    """A nested municipality record per nation, in the shape of the reference file."""
    nations, regions = read(spark, folder, "nation"), read(spark, folder, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "CAST(1100005 + n_nationkey * 10 AS BIGINT) AS id",
        "n_name AS nome",
        """named_struct('mesorregiao', named_struct('UF', named_struct(
            'id', CAST(11 + r_regionkey * 2 + n_nationkey % 2 AS BIGINT),
            'sigla', concat('U', 11 + r_regionkey * 2 + n_nationkey % 2),
            'nome', concat('State ', 11 + r_regionkey * 2 + n_nationkey % 2),
            'regiao', named_struct('id', CAST(r_regionkey AS BIGINT), 'sigla', substring(r_name, 1, 1),
                                   'nome', r_name)))) AS microrregiao""",
    )


REFERENCE_SQL = """muni AS (
  SELECT CAST(110000 + n_nationkey AS VARCHAR) AS municipality_code_sinan,
         CAST(1100005 + n_nationkey * 10 AS VARCHAR) AS municipality_code_ibge,
         n_name AS municipality_name,
         CAST(11 + r_regionkey * 2 + n_nationkey % 2 AS VARCHAR) AS uf_code,
         'U' || (11 + r_regionkey * 2 + n_nationkey % 2) AS uf_abbreviation,
         'State ' || (11 + r_regionkey * 2 + n_nationkey % 2) AS uf_name,
         CAST(r_regionkey AS VARCHAR) AS region_code,
         substring(r_name, 1, 1) AS region_abbreviation,
         r_name AS region_name
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

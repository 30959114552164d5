"""The municipality reference: nested JSON to one flat row per join code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

JOIN_CODE_DIGITS = 6

_REGION = "struct<id: bigint, sigla: string, nome: string>"
_STATE = f"struct<id: bigint, sigla: string, nome: string, regiao: {_REGION}>"
# Text, as only a session can parse it, and the module is imported before there is one.
REFERENCE_SCHEMA = f"id bigint, nome string, microrregiao struct<mesorregiao: struct<UF: {_STATE}>>"

_STATE_PATH = "microrregiao.mesorregiao.UF"
# Output column to its place in the nested record, with numbers as text.
FLAT = {
    "municipality_code_ibge": "id",
    "municipality_name": "nome",
    "uf_code": f"{_STATE_PATH}.id",
    "uf_abbreviation": f"{_STATE_PATH}.sigla",
    "uf_name": f"{_STATE_PATH}.nome",
    "region_code": f"{_STATE_PATH}.regiao.id",
    "region_abbreviation": f"{_STATE_PATH}.regiao.sigla",
    "region_name": f"{_STATE_PATH}.regiao.nome",
}


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array, read with its declared schema; a file without records fails later checks."""
    return spark.read.schema(REFERENCE_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def flatten_reference(nested: DataFrame) -> DataFrame:
    """Flat attributes, one row per six-digit join code: the lowest official code wins."""
    flat = nested.select(*(F.col(path).cast("string").alias(name) for name, path in FLAT.items()))
    coded = flat.withColumn(
        "municipality_code_sinan", F.substring("municipality_code_ibge", 1, JOIN_CODE_DIGITS)
    ).filter("municipality_code_sinan IS NOT NULL")
    picked = coded.groupBy("municipality_code_sinan").agg(F.min(F.struct(*FLAT)).alias("m"))
    return picked.select("municipality_code_sinan", "m.*")

"""Which copy of a record counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caselake.session import materialise

SALT_BUCKETS = 256
# Words of 64 bits in the filter of repeated keys. They bound what is broadcast, whatever the number of keys.
FILTER_WORDS = 1 << 20


def newest_first(columns):
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_version(df: DataFrame, key: str, newest) -> DataFrame:
    """One row per key: the newest by the given columns.

    Spark keeps the best row per key inside every map task (``WindowGroupLimit``) before the
    shuffle, so a key with very many versions sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first(newest)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def mark_repeats(df: DataFrame, key: str, newest, flag: str = "_repeat",
                 buckets: int = SALT_BUCKETS) -> DataFrame:
    """Keep every row and flag all but the newest of each key.

    Ranked twice so that no task gets a whole hot key. First within (key, salt), the salt
    being the scan task the row came from. Then the best of each salt meet, at most
    ``buckets`` rows per key, while the rows already beaten stay spread over their salts.
    """
    order = newest_first(newest)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(buckets)))
    local = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))
    ranked = salted.withColumn("_local", local).withColumn(
        "_salt", F.when(F.col("_local") == 1, F.lit(-1).cast("long")).otherwise(F.col("_salt"))
    )
    final = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))
    return ranked.withColumn(flag, (F.col("_local") > 1) | (final > 1)).drop("_salt", "_local")


def _word(digest: str) -> Column:
    return F.col(digest).bitwiseAND(F.lit(FILTER_WORDS - 1).cast("long"))


def _bits(digest: str) -> Column:
    """Three bits of a word, from other parts of the digest than its number."""
    one = (f"shiftleft(1L, CAST(shiftrightunsigned({digest}, {at}) & 63 AS INT))" for at in (24, 34, 44))
    return F.expr(" | ".join(one))


def sift(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key occurs once, and rows whose key may occur more often; None where no key does.

    Runs one job, which moves a 64-bit digest per key and no other column. The digests that occur more than once fill a
    filter, which meets the rows where they are. It never misses one of its digests, and digests that are equal by
    chance are only taken for repeats; where it is full, all rows are. ``df`` is read three times in all: it should
    come from files, and ``key`` must not change between reads.
    """
    digest = F.xxhash64(F.col(key)).alias("_digest")
    repeated = df.select(digest).groupBy("_digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    words = materialise(
        repeated.groupBy(_word("_digest").alias("_word")).agg(F.bit_or(_bits("_digest")).alias("_seen")), "repeats"
    )
    if words.isEmpty():
        return df, None
    tested = df.withColumn("_digest", digest).withColumn("_at", _word("_digest")).join(
        F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    met = F.coalesce(F.col("_seen").bitwiseAND(_bits("_digest")) == _bits("_digest"), F.lit(False))
    return tuple(tested.where(side).select(*df.columns) for side in (~met, met))


def latest_stored(df: DataFrame, key: str, newest) -> DataFrame:
    """``latest_version`` over rows that come from files: only rows whose key may occur again are ranked and moved.

    Runs a job, see ``sift``. The newest of repeated keys are written once.
    """
    alone, rest = sift(df, key)
    return alone if rest is None else alone.unionByName(materialise(latest_version(rest, key, newest), "latest"))


def mark_repeats_stored(df: DataFrame, key: str, newest, together=(), flag: str = "_repeat") -> DataFrame:
    """``mark_repeats`` over rows that come from files: only rows whose key may occur again are ranked and moved.

    Runs a job, see ``sift``. Ranked rows come back grouped by ``together``; all others stay in the order of their files.
    """
    alone, rest = sift(df, key)
    single = alone.withColumn(flag, F.lit(False))
    if rest is None:
        return single
    marked = mark_repeats(rest, key, newest, flag)
    return single.unionByName(marked.hint("rebalance", *map(F.col, together)) if together else marked)

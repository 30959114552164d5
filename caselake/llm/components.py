"""Connected components of a link table, by labels that only fall."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caselake.llm.store import drop, write_out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the smallest node it is linked with, itself included.

    Each round takes the least label among a node's neighbours and then that label's own label, so long
    chains shrink by jumps. Labels are written out after each round; only a count reaches the driver.
    Links from null or to null are ignored; no links give no rows.
    """
    spark = links.sparkSession
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both, both_path = write_out(both, "links")
    labels, path = write_out(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).select(F.col("a").alias("node"), "root"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        step = step.join(up, "low", "left").select("node", F.col("root").alias("old"), F.least("low", F.coalesce("jump", "low")).alias("root"))
        fresh, fresh_path = write_out(step, "labels")
        changed = fresh.where("old != root").limit(1).count()
        drop(spark, path)
        labels, path = fresh.select("node", "root"), fresh_path
        if not changed:
            drop(spark, both_path)
            return labels

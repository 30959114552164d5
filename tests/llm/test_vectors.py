"""Vector operators against brute force, with odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import block_search, hard_negatives, oracle, queries, vector_cells

SCHEMA = "vec_id long, embedding array<float>, label int, z string, side int, score double, `a b` string, rank int"
RANDOM = np.random.default_rng(7)


def rows_of(table):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in table.select("vec_id", "embedding", "label").collect()]


@pytest.fixture(scope="module")
def vectors(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    one = given.where("vec_id = 7").first()["embedding"]
    odd = [
        (600, None, 1), (601, [], 2), (602, [float("nan")] * 64, 3), (603, [float("inf")] + [0.0] * 63, 3), (604, [None] * 64, 1), (None, one, 4),
        (None, one, None), (605, one, 5), (606, one, 5), (700, one, 5), (700, one, 5), (800, one[:10], 6), (-100, [-x for x in one], 6), (608, one + [9.0], 7),
        (609, [3e4] * 64, 1), (900, [-3e4] * 64, 1), (1000, one, None),
    ]
    extra = spark.createDataFrame(odd, given.schema)
    return given.unionByName(extra).select(
        "*", F.lit("z").alias("z"), F.lit(1).alias("side"), F.lit(0.5).alias("score"), F.lit("x").alias("a b"), F.lit(3).alias("rank")).repartition(5).cache()


def whole(rows, scale, labelled):
    kept = []
    for vec_id, vector, label in rows:
        if vector is None or (labelled and label is None) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(scale * x) for x in vector], label))
    return kept


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def ranked(rows, query, k):
    """The first k of ``rows`` for a query by score and id, null ids last."""
    scored = [(product(query[1], r[1]), r[0]) for r in rows if r[0] != query[0]]
    return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]


def test_search_equals_brute_force(vectors):
    rows = whole(rows_of(vectors), 1024, False)
    want = sorted((q[0], i + 1, v, s) for q in rows if q[0] is not None and q[0] % 100 == 0 for i, (s, v) in enumerate(ranked(rows, q, 10)))
    got = block_search.top_k(vectors, block_search.queries_where())
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_negatives_equal_brute_force(vectors):
    moved = hard_negatives.relabelled(vectors)
    rows = []
    for vec_id, z, label in whole(rows_of(vectors), 256, True):
        rows.append((vec_id, z, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    want = []
    for anchor in rows:
        if anchor[0] is None or anchor[0] % 100:
            continue
        for score, positive in ranked([r for r in rows if r[2] == anchor[2]], anchor, 5):
            others = [r for r in rows if r[2] != anchor[2] and 30 * score <= 100 * product(anchor[1], r[1]) <= 90 * score]
            want += [(anchor[0], positive, i + 1, n, score, s) for i, (s, n) in enumerate(ranked(others, anchor, 10))]
    got = hard_negatives.mine(moved, hard_negatives.anchors_where())
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables_give_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert block_search.top_k(none, block_search.queries_where()).count() == 0
    assert hard_negatives.mine(hard_negatives.relabelled(none), hard_negatives.anchors_where()).count() == 0
    alone = spark.createDataFrame([(100, [0.5, 0.25], 1)], "vec_id long, embedding array<float>, label int")
    assert block_search.top_k(alone, block_search.queries_where()).count() == 0
    assert hard_negatives.mine(alone, hard_negatives.anchors_where()).count() == 0


@pytest.mark.parametrize("most", [1, 5, 300, 1 << 20])
def test_subset_sums_give_exact_products(most):
    for dims in (1, 8, 13, 64):
        left, right = (RANDOM.integers(-most, most + 1, (n, dims)) for n in (9, 33))
        tables, planes = hard_negatives.subset_tables(left), hard_negatives.bit_planes(right)
        assert np.array_equal(hard_negatives.scores(tables, planes), right @ left.T)


def test_products_that_may_pass_64_bits_are_refused():
    big = np.full((1, 64), 1 << 30)
    with pytest.raises(OverflowError):
        vector_cells.largest_score(big, big)
    assert 1 << 38 <= vector_cells.largest_score(big, np.full((1, 64), 4)) < 1 << 39


def test_blocks_below_the_kth_score_are_not_scored():
    centres = RANDOM.normal(size=(40, 16)) * 1000
    matrix = np.repeat(centres, 64, axis=0) + RANDOM.normal(size=(2560, 16))
    matrix = np.floor(matrix)[RANDOM.permutation(2560)]
    index = block_search.BlockIndex(None, matrix)
    bounds = index.bounds(matrix[:50])
    for q in range(50):
        allowed = np.arange(len(matrix)) != q
        places, values, scored = block_search.search(index, matrix[q], bounds[q], allowed, 10, None)
        exact = matrix @ matrix[q]
        exact[q] = -np.inf
        assert sorted(values)[-10:] == sorted(exact)[-10:]
        assert set(np.flatnonzero(exact >= sorted(exact)[-10])) <= set(places)
        assert scored < index.blocks / 2


def test_groups_are_bounded(spark):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("vec_id"), F.lit(1).cast("long").alias("label"), F.array(F.lit(1).cast("long")).alias("z"))
    packs = vector_cells.grouped(rows, vector_cells.group_count(20_000, 5_000, 100, 1)).groupBy("side").agg(F.sum("size"), F.max("size")).collect()
    assert sum(p[1] for p in packs) == 20_000
    assert max(p[1] for p in packs) < 6_000 and max(p[2] for p in packs) <= vector_cells.ROWS_PER_PACK


def test_sql_is_registered():
    assert {"op11_hard_negatives", "op12_filter_audit", "op13_exact_search"} <= set(queries.oracle_sql())
    assert oracle.TOP_K and set(queries.oracle_sql()) <= set(queries.queries())

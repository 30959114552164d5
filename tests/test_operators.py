import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caselake.operators import enrich, keysets, publish, quality, rollup, versions
from caselake.sources import paths
from caselake.specs import ContractViolation, ForeignKey, Rule, Slice


def hot_rows(n=3000):
    """A third of all rows under one key."""
    rng = random.Random(1)
    return [("hot" if i % 3 == 0 else f"k{rng.randrange(700)}", rng.randrange(50), i) for i in range(n)]


def test_repeats_match_brute_force_on_a_hot_key(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, t int, id int").repartition(8)
    marked = versions.mark_repeats(df, "k", ("t", "id"), buckets=4)
    kept = {r["k"]: (r["t"], r["id"]) for r in marked.filter("NOT _repeat").collect()}
    best = {}
    for k, t, i in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, i))
    assert kept == best
    assert marked.count() == len(rows)
    assert marked.filter("_repeat").count() == len(rows) - len(best)


def test_latest_version_is_cut_before_the_shuffle(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, t int, id int")
    latest = versions.latest_version(df, "k", ("t", "id"))
    best = defaultdict(lambda: (-1, -1))
    for k, t, i in rows:
        best[k] = max(best[k], (t, i))
    assert {r["k"]: (r["t"], r["id"]) for r in latest.collect()} == dict(best)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_compare_sets_against_joins(spark):
    rng = random.Random(2)

    def pairs(n):
        return [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"])) for _ in range(n)]

    schema = "k int, v string"
    expected = list({k: (k, v) for k, v in pairs(60) if k is not None}.values())
    published, current = pairs(80), pairs(50)
    got = keysets.compare_sets(
        spark.createDataFrame(expected, schema), spark.createDataFrame(published, schema), "k", "v",
        spark.createDataFrame(current, schema),
    ).first().asDict()

    def joined(left, right):
        return [(a, b) for a in left for b in right if a[0] is not None and a[0] == b[0]]

    def missing(left, right):
        keys = {k for k, _ in right if k is not None}
        return sum(k is None or k not in keys for k, _ in left)

    copies = Counter(k for k, _ in published)
    assert got == {
        "expected_rows": len(expected), "published_rows": len(published),
        "expected_missing": missing(expected, published), "published_extra": missing(published, expected),
        "content_mismatch": sum(a[1] != b[1] for a, b in joined(published, expected)),
        "current_mismatch": missing(current, published) + sum(a[1] != b[1] for a, b in joined(current, published)),
        "published_duplicate_keys": sum(n > 1 for n in copies.values()),
    }


def test_orphans_count_null_and_unknown_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "fk int")
    dims = {"d": spark.createDataFrame([(1,), (2,)], "k int")}
    link = ForeignKey("fk", "d", "k")
    assert keysets.orphan_keys(fact, dims, {"d": "k"}, [link]).first()["orphan_keys"] == 2
    assert keysets.orphan_rows(fact, dims, {"d": "k"}, {"fk": link}).first()["fk"] == 3


def test_codes_keep_rule_order_and_ignore_null(spark):
    rules = (Rule("A", "x > 1"), Rule("B", "x > 0"), Rule("C", "y = 1"))
    df = spark.createDataFrame([(2, None), (1, 1), (None, None)], "x int, y int")
    out = [r[0] for r in df.select(quality.codes(rules)).collect()]
    assert out == [["A", "B"], ["B", "C"], []]


def test_duplicate_code_comes_last(spark):
    df = spark.createDataFrame([(2, True), (0, True), (0, False)], "x int, r boolean")
    coded = quality.with_codes(df, (Rule("A", "x > 1"),), (), {})
    rows = quality.with_status(quality.append_code(coded, "r", "DUP"))
    clean, bad = quality.split(rows)
    assert sorted(r[quality.PRIMARY] for r in bad.collect()) == ["A", "DUP"]
    assert [tuple(r[quality.ERRORS]) for r in bad.orderBy("x").collect()] == [("DUP",), ("A", "DUP")]
    assert clean.count() == 1 and quality.ERRORS not in clean.columns


def test_batch_gate(spark):
    df = spark.createDataFrame([("b1",), (None,)], "b string")
    with pytest.raises(ContractViolation):
        quality.require_batch(df, "b", "b1")
    with pytest.raises(ContractViolation):
        quality.require_batch(df.filter("b = 'x'"), "b", "b1")
    quality.require_batch(df.filter("b = 'b1'"), "b", "b1")


def test_roles_join_alike_with_and_without_broadcast(spark):
    ref = spark.createDataFrame([("1", "x"), ("2", "y")], "code string, name string")
    df = spark.createDataFrame([("1", "2"), ("3", None)], "a string, b string")

    def joined(side):
        return enrich.attach_roles(df, side, {"home": "a", "desk": "b"}, "code", ("code", "name"))

    small, large = joined(ref.hint("broadcast")), joined(ref.hint("merge"))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.filter("home_name = 'x' AND desk_name = 'y'").count() == 1


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 0), (0, 5)], "a long, b long")
    got = [r[0] for r in df.select(rollup.percentage(F.col("a"), F.col("b"))).collect()]
    assert got == [33.33, 66.67, None, 0.0]


def test_slices_are_replaced_with_their_old_codes(spark, tmp_path):
    root = str(tmp_path / "q")
    keys = ("processing_date", "granularity", "reference_period", "code")
    part = Slice("2026-01-01", "month", "2025-01")

    def rows(*codes):
        return spark.createDataFrame([("2026-01-01", "month", "2025-01", c, 1) for c in codes],
                                     "processing_date string, granularity string, reference_period string, code string, n int")

    publish.replace_slices(rows("A", "B"), root, keys, [part])
    publish.replace_slices(rows("B"), root, keys, [part])
    assert [r["code"] for r in paths.read_slice(spark, root, part).collect()] == ["B"]


def test_write_modes(spark):
    with pytest.raises(ContractViolation):
        publish.write_slices(spark.range(1), "/nowhere", ("id",), mode="ignore")

"""The filter audit against a replay of every order, with odd rows."""

import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from caselake.llm import filter_audit

LONG = " ".join(f"word{i}" for i in range(250))
ROWS = [
    (1, None, "de"), (2, "", "de"), (3, "a a a a", None), (4, LONG, "de"), (5, LONG, ""), (5, LONG, "de"), (None, LONG, "fr"), (None, "x", None), (6, LONG.upper(), "fr"),
    (7, "A#b", "fr"), (8, "A#b", "fr"), (8, "A#b", "fr"), (9, LONG + " %", "de"), (10, "\t\n\x0b \r", "de"), (11, "É Ü 漢字 🙂", "de"), (12, LONG, "de"), (13, "w " * 40_000, "fr"),
]
LABELS = [(4, 1, 0), (5, 1, 1), (5, 0, 0), (7, 0, 1), (8, None, 1), (None, 1, 1), (12, 1, None), (99, 1, 1)]


def replay(rows, labels):
    good, toxic = ({d for d, *flags in labels if d is not None and flags[k] == 1} for k in (0, 1))
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    docs = []
    for doc, text, lang in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc is not None and first[text] < doc,
        }
        docs.append((lang or "", {f for f, bad in fails.items() if bad}, doc in good, doc in toxic))
    out, shares = [], {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            kept = [d for d in docs if d[0] == part]
            everyone = kept
            for step, name in enumerate(order, 1):
                gone, kept = [d for d in kept if name in d[1]], [d for d in kept if name not in d[1]]
                failing = [d for d in everyone if name in d[1]]
                shares[part, name] = shares.get((part, name), 0) + len(gone)
                out.append((part, "".join(order), step, name, len(kept), len(gone), len(failing) - len(gone), sum(d[1] == {name} for d in failing),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*row, shares[row[0], row[3]]) for row in out)


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.select("*", *(F.lit(1).alias(c) for c in ("_id", "part", "mask", "n", "good", "a b", "filter"))).repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("_id", F.lit(2))


def test_audit_equals_a_replay_of_every_order(spark):
    got = filter_audit.audit(*frames(spark, ROWS, LABELS))
    assert dict(got.dtypes)["step"] == "int" and {dict(got.dtypes)[c] for c in ("kept", "removed", "redundant", "unique_fails", "shapley")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == replay(ROWS, LABELS)


def test_given_documents_equal_a_replay(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    want = replay([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert sorted(map(tuple, filter_audit.audit(docs, labels).collect())) == want


def test_empty_tables(spark):
    docs, labels = frames(spark, [], [])
    assert filter_audit.audit(docs, labels).count() == 0
    assert filter_audit.audit(frames(spark, ROWS, [])[0], labels).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


@pytest.mark.parametrize("n", range(1, 7))
def test_least_squares_give_shapley_values(n):
    for i, weights in enumerate(filter_audit.coalition_weights(n)):
        for s in range(1, 1 << n):
            size = s.bit_count()
            sign, k = (1, size - 1) if s >> i & 1 else (-1, size)
            assert weights.get(s, 0) == sign * Fraction(factorial(k) * factorial(n - k - 1), factorial(n))


def test_coalitions_without_copies(spark):
    docs, labels = frames(spark, ROWS, LABELS)
    counts = filter_audit.failures(docs, labels, copies=None)
    table = {(r["part"], r["coalition"]): r["removed"] for r in filter_audit.coalition_table(counts, list("ABCD")).collect()}
    assert len(table) == 3 * 16 and all(table[p, ""] == 0 for p in ("", "de", "fr"))
    assert all(table[p, "ABCD"] >= table[p, c] for p, c in table)

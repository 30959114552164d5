"""Benchmark windows: only texts that hold one are searched for slot values, and words are trimmed as one by one."""

import re

from pyspark.sql import functions as F

from caselake.llm import slot_windows

ODD = ['(Foo) "bar." Baz', "...  x... - Next, ¿Qué? “So” he… said!) Then", "a b.  C   D", "$5. 3 kg. Ⓐ ÉCOLE, İ. ΑΣ) ΑΣ.", ". , !", "", " \t one\n", "x(y \"$.50\" 7% %"]


def test_words_are_trimmed_as_one_by_one(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, text string").select("i", slot_windows._tokens(F.col("text")).alias("t"))
    letter = lambda c: c.isalpha() or c.isnumeric() or c in "%$€£"
    for i, t in rows.collect():
        text = re.sub(r"([$€£])(?=[.]?[0-9])", r" \1 ", ODD[i])
        words = []
        for w in re.split("[ \t\n\x0b\f\r]+", text):
            at = [k for k, c in enumerate(w) if letter(c)]
            if at:
                words.append((w[at[0]:at[-1] + 1], w[-1] in ".!?"))
        assert t.raw == [w for w, _ in words], ODD[i]
        assert [m != r for m, r in zip(t.marked, t.raw)] == [e for _, e in words] and len(t.low) == len(t.raw)


def test_only_texts_with_a_window_are_searched_for_slots(spark):
    item = "A train leaves the old station at 40 km per hour and another leaves at 60 km per hour after Peter waves goodbye"
    docs = spark.createDataFrame([(1, f"So: {item.replace('40', '35')}."), (2, "unrelated text of no interest to anyone at all"), (None, item), (4, None)], "doc_id long, text string")
    found = slot_windows.contaminations(docs, spark.createDataFrame([(9, item), (8, "old station")], "item_id long, text string"))
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 9), (None, 9), (1, 8), (None, 8)}

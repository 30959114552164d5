"""Extra columns named like the operators' own ones, or with odd characters."""

from pyspark.sql import functions as F

from caselake.llm import line_templates, sentence_spans, slot_windows, vertical_join
from corpus_pipeline import line_dedup

EXTRA = ["n_lines", "N_Dropped", "n_removed", "n_sentences", "first_docs", "_key", "_n", "_s1", "__id", "a b", "a`b", "x.y", "key", "row", "gone"]
OWN = {"n_lines", "n_dropped", "n_removed", "n_sentences", "first_docs"}
FOOT = "Visit our site daily for more news"
PASSAGE = "Seven grey ships left port at dawn with salt and timber. No one on the quay knew when the ships would ever return from there. "


def table(spark):
    own = [" ".join(chr(97 + i) * n for n in range(4, 14)) for i in range(12)]
    rows = [(i, f"{line}\n{FOOT}") for i, line in enumerate(own)]
    rows += [(20, "One. " + PASSAGE), (21, "Two. " + PASSAGE), (22, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("doc_id", *(F.lit(f"v{i}").alias(name) for i, name in enumerate(EXTRA)), "text")


def values(df, names):
    return {tuple(r[n] for n in names) for r in df.collect()}


def test_extra_columns_pass_or_give_way(spark):
    docs = table(spark)
    wanted = tuple(f"v{i}" for i in range(len(EXTRA)))
    kept = [n for n in EXTRA if n.lower() not in OWN - {"n_removed", "n_sentences", "first_docs"}]
    got = line_templates.drop_lines(docs)
    assert got.columns == ["doc_id", *kept, "text", "n_lines", "n_dropped"] and got.count() == docs.count()
    assert got.where("n_dropped = 1").count() == 12 and values(got, kept) == {tuple(f"v{EXTRA.index(n)}" for n in kept)}

    kept = [n for n in EXTRA if n.lower() not in OWN - {"n_lines", "n_dropped"}]
    got = sentence_spans.deduplicate(docs)
    assert got.columns == ["doc_id", *kept, "text", "n_sentences", "n_removed", "first_docs"]
    assert values(got, kept) == {tuple(f"v{EXTRA.index(n)}" for n in kept)}
    assert [(r.doc_id, r.first_docs) for r in got.where("doc_id >= 20 AND n_removed > 0").collect()] == [(21, [20])]

    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    for stage in (line_dedup(spark, docs, ""), vertical_join.keep_one(docs), slot_windows.keep_uncontaminated(docs, bench)):
        assert stage.columns == docs.columns and values(stage, EXTRA) == {wanted}
    assert slot_windows.keep_uncontaminated(docs, bench).where("doc_id IN (20, 21)").count() == 0

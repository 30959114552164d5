"""Repeated runs of sentences.

A text's sentences end at ., ! or ? before white space, or at a line feed. At every sentence starts one run
and ends one run: the shortest stretch of sentences with at least ``RUN_WORDS`` words that has two sentences, or
one of ``LONG_WORDS`` words. Runs are compared by a 64-bit hash of their words in lower case. Of all occurrences
the first by (doc_id, place) stays; sentences that any other occurrence covers are removed.

Null and empty texts have no sentences; a null doc_id sorts first; rows with the same doc_id and text count
as one document, so none of them is emptied by the other; an empty table gives no rows; other columns pass,
but n_sentences, n_removed and first_docs are replaced by the results.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from caselake.llm.store import field, others, write_out

RUN_WORDS = 24
LONG_WORDS = 40
_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+(?!\s|\Z)[^\n.!?]*)*(?:[.!?]+(?=\s|\Z)|\n|\Z)\s*")


def sentences(text: str) -> list[str]:
    """The text cut into sentences, each with the white space behind it; joined they are the text."""
    return [s for s in _SENTENCE.findall(text) if s]


def runs(parts: list[str]) -> list[tuple[int, int, int]]:
    """(hash, number of the first sentence, sentences) of every run. Sentences without words belong to no run."""
    import xxhash

    words = [(i, w) for i, s in enumerate(parts) if (w := s.lower().split())]
    marks = [xxhash.xxh64_digest(" ".join(w)) for _, w in words]
    upto = [0, *accumulate(len(w) for _, w in words)]
    found = set()
    for k in range(len(words)):
        end = max(k + 1, bisect_left(upto, upto[k] + RUN_WORDS))
        end += end == k + 1 and upto[k + 1] - upto[k] < LONG_WORDS
        if end <= len(words):
            found.add((k, end))
        start = min(k, bisect_right(upto, upto[k + 1] - RUN_WORDS) - 1)
        start -= start == k and upto[k + 1] - upto[k] < LONG_WORDS
        if start >= 0:
            found.add((start, k + 1))
    return [(xxhash.xxh64_intdigest(b"".join(marks[k:end])) - (1 << 63), words[k][0], words[end - 1][0] - words[k][0] + 1) for k, end in found]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "doc_id", "run", "start", "size"]
    for batch in batches:
        held, docs = [], batch.column("doc_id").to_pylist()
        keys = batch.column("key").to_pylist()
        for key, doc, text in zip(keys, docs, batch.column("text")):
            held += [(key, doc, *r) for r in runs(sentences(text.as_py() or ""))]
            if len(held) > 100_000:
                yield _rows(held, names)
                held = []
        yield _rows(held, names)


def _rows(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(types)], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, total, gone = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            parts = sentences(text.as_py() or "")
            drop = {i for s in spans.as_py() for i in range(s["start"], s["start"] + s["size"])}
            texts.append("".join(p for i, p in enumerate(parts) if i not in drop))
            total.append(len(parts))
            gone.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("first_docs"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
            ["row", "first_docs", "n_sentences", "n_removed", "cleaned"])


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, spans, first_docs) of every document with a run whose first occurrence lies elsewhere.

    ``spans`` has start and size of its repeated runs in sentences, ``first_docs`` the documents of their first occurrences.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).select(_key().alias("key"), "doc_id", "text")
    found, _ = write_out(rows.mapInArrow(_runs, "key long, doc_id long, run long, start int, size int"), "runs")
    place = F.struct("doc_id", "start", "key")
    first = found.groupBy("run").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").select("run", "first")
    later = found.join(first, "run").where(~place.eqNullSafe(F.col("first"))).distinct()
    return later.groupBy("key").agg(F.collect_list(F.struct("start", "size")).alias("spans"),
                                    F.array_sort(F.collect_set("first.doc_id")).alias("first_docs"))


def deduplicate(docs: DataFrame, only_changed: bool = False) -> DataFrame:
    """``docs`` without repeated sentences, with first_docs, n_sentences and n_removed; or only the rows that lost some."""
    spans = repeated_spans(docs).select(F.col("key").alias("_key"), "spans", "first_docs")
    kept = others(docs, "text", "n_sentences", "n_removed", "first_docs")
    rows = docs.select(F.struct(*map(field, kept)).alias("row"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("_key"))
    joined = rows.join(spans, "_key", "inner" if only_changed else "left")
    none = F.array().cast("array<struct<start:int,size:int>>")
    joined = joined.select("row", F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs"), "text", F.coalesce("spans", none).alias("spans"))
    schema = StructType([joined.schema["row"], joined.schema["first_docs"]]).add("n_sentences", "long").add("n_removed", "long").add("cleaned", "string")
    cleaned = joined.mapInArrow(_cut, schema)
    return cleaned.select("row.*", F.col("cleaned").alias("text"), "n_sentences", "n_removed", "first_docs")

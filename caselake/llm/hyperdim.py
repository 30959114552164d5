"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point, so all tasks agree without
sharing a table. A run of three letters is bound into one vector: the first letter's vector permuted
twice, times the second's permuted once, times the third's. A text is the bundle (sum) of its runs, a
language the bundle of its training texts, and a text gets the language with the largest cosine.

Null texts and texts without a letter get ``und`` and score 0; ties go to the alphabetically first
language; without training rows every text is ``und``; rows without lang are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIMENSIONS = 1024
CHARS_AT_ONCE = 200_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LOWER: np.ndarray | None = None


def _lower_table() -> np.ndarray:
    """Code point to its lower-case letter; 0 for whatever is no letter."""
    global _LOWER
    if _LOWER is None:
        _LOWER = np.array([ord(c.lower()[0]) if c.isalpha() else 0 for c in map(chr, range(0x110000))], np.int64)
    return _LOWER


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row of random signs per code point (0 stands for the gap between words)."""
    words = points.astype(np.uint64)[:, None] * np.uint64(dimensions) + np.arange(dimensions // 64, dtype=np.uint64)
    bits = np.unpackbits(_mix((words + np.uint64(1)) * _GOLDEN).view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of three of all texts (one row of code points each), and for each text's run: (text * runs + run), count."""
    table = _lower_table()
    letters = [table[np.frombuffer(("  " + t + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in letters])
    flat = np.concatenate(letters)
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0) | (owner[1:] != owner[:-1])  # one gap between words
    flat, owner = flat[keep], owner[keep]
    key = flat[:-2] << 42 | flat[1:-1] << 21 | flat[2:]
    same = (owner[:-2] == owner[2:]) & (flat[1:-1] != 0)  # the middle is a letter
    runs, number = np.unique(key[same], return_inverse=True)
    cells, counts = np.unique(owner[:-2][same] * max(1, len(runs)) + number, return_counts=True)
    points = np.stack([runs >> 42, runs >> 21 & 0x1FFFFF, runs & 0x1FFFFF], axis=1)
    return points, cells, counts


def bind(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Vectors of runs: permuted letter vectors (here rotated), multiplied."""
    letters, number = np.unique(points, return_inverse=True)
    vectors, number = letter_vectors(letters, dimensions), number.reshape(points.shape)
    return np.roll(vectors, 2, axis=1)[number[:, 0]] * np.roll(vectors, 1, axis=1)[number[:, 1]] * vectors[number[:, 2]]


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One summed vector per text."""
    points, cells, counts = letter_runs(texts)
    if not len(points):
        return np.zeros((len(texts), dimensions), np.float32)
    weights = np.zeros((len(texts), len(points)), np.float32)
    weights.ravel()[cells] = counts
    return weights @ bind(points, dimensions)


def _portions(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    low, size = 0, 0
    for high, text in enumerate(texts):
        size += len(text or "")
        if size >= CHARS_AT_ONCE or high == len(texts) - 1:
            yield low, [t or "" for t in texts[low:high + 1]]
            low, size = high + 1, 0


def _learn(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                mine = [t for t, la in zip(texts, langs) if la == lang]
                for _, some in _portions(mine):
                    # Bundling is a sum: the texts' runs are counted together, then bound once.
                    points, cells, counts = letter_runs(some)
                    if len(points):
                        weights = np.bincount(cells % len(points), counts, len(points)).astype(np.float32)
                        sums[lang] = sums.get(lang, 0) + (weights @ bind(points, dimensions)).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                         ["lang", "vector"])

    return run


def learn_prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototype of each language of ``labelled`` (text, lang): languages x dimensions numbers reach the driver."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = rows.mapInArrow(_learn(dimensions), "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for lang, i, x in sums.collect():
        out.setdefault(lang, np.zeros(dimensions))[i] = x
    return {k: out[k] / max(np.linalg.norm(out[k]), 1e-12) for k in sorted(out)}


def _predict(prototypes: dict[str, np.ndarray], dimensions: int):
    langs = np.array(list(prototypes))
    matrix = np.stack(list(prototypes.values()), axis=1).astype(np.float32) if prototypes else np.zeros((dimensions, 0), np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in _portions(batch.column("text").to_pylist()):
                vectors = bundles(texts, dimensions)
                norms = np.linalg.norm(vectors, axis=1)
                known = np.array([any(map(str.isalpha, t)) for t in texts]) & bool(len(langs))
                cosine = vectors @ matrix / np.maximum(norms, 1e-12)[:, None]
                best = cosine.argmax(axis=1) if len(langs) else np.zeros(len(texts), int)
                named = np.where(known, langs[best] if len(langs) else "und", "und")
                score = np.where(known, np.clip(cosine.max(axis=1, initial=-1), 0, 1), 0.0)
                rest = [batch.column(c).slice(low, len(texts)) for c in ("doc_id", "held_out")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(named.tolist(), pa.string()), pa.array(score, pa.float64())],
                                                 ["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], held_out: Column, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs``; only the text is looked at."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    return rows.mapInArrow(_predict(prototypes, dimensions), "doc_id long, held_out boolean, lang_pred string, score double")


def held_out_fold(doc_id: str = "doc_id") -> Column:
    """True for the quarter of the documents that is never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))

"""Order-preserving packing of token streams into windows of a fixed size.

The documents of a task form one stream in their given order. A dynamic program picks the cuts of each
stretch of the stream so that padding plus cut penalties is least: a cut between documents is free, one
between sentences costs a little, one inside a very long sentence a lot. As a window's padding is linear
in its start, the best start lies at the minimum of a sliding window, kept in a monotone queue. Nothing is
shuffled: each task packs its own stream, a stretch at a time, and hands the last window on to the next.

Null texts count as empty and still give their end id; ids are cut, never dropped; an empty table gives no
rows; repeated rows are packed like any other. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caselake.llm.tokens import encoder, with_end

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SENTENCE_PENALTY = 24
INSIDE_PENALTY = 512
STRETCH_WINDOWS = 256


def best_cuts(positions: np.ndarray, penalties: np.ndarray, window: int) -> list[int]:
    """Numbers of the chosen cut positions, the last one included.

    ``positions`` ascend from above 0, no two more than ``window`` apart; a cut at ``positions[j]`` costs
    ``penalties[j]``, a window of length n costs ``window - n``.
    """
    at, cost = [0, *positions.tolist()], [0, *penalties.tolist()]
    best, back = [0] * len(at), [0] * len(at)
    queue = deque([0])  # starts whose best + position ascend, the least in front
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        back[j] = i
        best[j] = value = best[i] + at[i] + window - here + cost[j]
        value += here
        while queue and best[queue[-1]] + at[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def cut_positions(ids: np.ndarray, ends: np.ndarray, stops: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of a stream and their penalties. ``ends``: where documents end; ``stops``: is this id a sentence's end."""
    sentence = np.flatnonzero(stops[ids]) + 1
    known = np.union1d(np.union1d(sentence, ends), [len(ids)])
    gaps = np.diff(known, prepend=0)
    step = max(1, window // 16)
    long = np.flatnonzero(gaps > 2 * step)
    inside = [np.arange(known[k] - gaps[k] + step, known[k], step) for k in long]
    positions = np.union1d(known, np.concatenate([np.zeros(0, np.int64), *inside]).astype(np.int64))
    penalties = np.where(np.isin(positions, ends), 0, np.where(np.isin(positions, known), SENTENCE_PENALTY, INSIDE_PENALTY))
    return positions, penalties


def _pack(file: str, end: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file)
        stops = np.array([n.removesuffix("</w>").endswith((".", "!", "?", "…")) for n in encode.names])
        sequence = TaskContext.get().partitionId() << 32
        names: list = []            # documents of the open stretch, with what went before of the first
        ids, lengths, skipped = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def close(last: bool) -> pa.RecordBatch:
            """Pack the stretch; unless it is the last, its last window stays open."""
            nonlocal names, ids, lengths, skipped, sequence
            ends = np.cumsum(lengths)
            positions, penalties = cut_positions(ids, ends, stops, window)
            cuts = positions[best_cuts(positions, penalties, window)]
            if not last:
                cuts = cuts[:-1]
            elif (tail := len(ids) - (int(cuts[-2]) if len(cuts) > 1 else 0)) & (tail - 1):
                # Lengths that are powers of two need no padding: the last window falls into those that add up to it.
                powers = [1 << k for k in range(tail.bit_length() - 1, -1, -1) if tail >> k & 1]
                cuts = np.append(cuts[:-1], len(ids) - tail + np.cumsum(powers))
            used = int(cuts[-1]) if len(cuts) else 0
            marks = np.union1d(ends[ends <= used], cuts)
            begins = np.concatenate([[0], marks[:-1]]).astype(np.int64)
            doc, seq = np.searchsorted(ends, begins, side="right"), np.searchsorted(cuts, begins, side="right")
            starts = begins - (ends - lengths)[doc] + skipped[doc]
            raw = memoryview(ids.astype("<u4").tobytes())
            columns = [
                pa.array([names[d] for d in doc], pa.int64()), pa.array(starts, pa.int64()), pa.array(marks - begins, pa.int64()),
                pa.array([zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(begins.tolist(), marks.tolist())], pa.int64()),
                pa.array((lengths + skipped)[doc], pa.int64()), pa.array(sequence + seq, pa.int64()),
                pa.array(begins - np.concatenate([[0], cuts])[seq], pa.int64()),
            ]
            sequence += len(cuts)
            kept = int(np.searchsorted(ends, used, side="right"))
            cut = used - int(ends[kept - 1] if kept else 0)  # ids of the first kept document that are placed
            ids, names = ids[used:], names[kept:]
            lengths, skipped = lengths[kept:].copy(), skipped[kept:].copy()
            if len(lengths):
                lengths[0] -= cut
                skipped[0] += cut
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            for low, flat, count in encode.encode(batch.column("text").to_pylist()):
                flat, count = with_end(flat, count, end)
                names += docs[low:low + len(count)]
                ids, lengths = np.append(ids, flat), np.append(lengths, count)
                skipped = np.append(skipped, np.zeros(len(count), np.int64))
                if len(ids) >= STRETCH_WINDOWS * window:
                    yield close(False)
        if len(ids):
            yield close(True)

    return run


def pack(docs: DataFrame, file: str, end: int, window: int = 4096) -> DataFrame:
    """One row per piece of a document: its place in the document and in a sequence of at most ``window`` ids.

    ``end`` follows each document's ids. Sequences keep the order of the rows; their numbers ascend with it
    inside a task. A task's last window is cut into powers of two, which need no padding.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_pack(file, end, window), PIECES)

"""Hard negatives by exact scores from subset-sum tables (Four Russians).

Anchors' whole-number vectors are cut into groups of eight dimensions. For each group all 256 sums of subsets
of its components are tabulated. A candidate is stored as bit planes in two's complement: bit p of its eight
components of a group is one byte. Its score with an anchor is the sum over planes of 2^p (the top plane counts
negative) times the sum over groups of the anchor's table at that byte: lookups, shifts and additions only, and
nothing is rounded. Tables stand side by side for a run of anchors, so a lookup fetches one row for all of them.

Two passes over the cells of ``vector_cells``: the first keeps each anchor's best rows of its own label (its
positives), the second the best rows of other labels whose scores lie within a share of each positive's score.

Rows without label or usable vector take no part. Every other row counts for itself, also repeated ones; only rows
that carry the anchor's own id are never its partners. Ties go to the smaller id, rows without id come
last. Fewer partners than asked for are all returned; an anchor without positive gives no rows, an empty table
gives none. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from caselake.llm.store import drop, write_out
from caselake.llm.vector_cells import Group, Grid, grid_of, grouped, largest_score, meet, same_width, unpack, whole_vectors

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
ANCHOR_STEP = 100
TABLE_DIMS = 8
ANCHORS_AT_ONCE = 64
FOUND = "query_group int, slot long, anchor_id long, positive_id long, positive_score long"
MINED = "query_group int, slot long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"


def anchors_where(step: int = ANCHOR_STEP) -> Column:
    return F.col("vec_id") % step == 0


def subset_tables(anchors: np.ndarray, kind=np.int64) -> np.ndarray:
    """(groups, 256, anchors): the sum of each subset of each group of eight components."""
    count, dims = anchors.shape
    groups = -(-dims // TABLE_DIMS)
    parts = np.pad(anchors, ((0, 0), (0, groups * TABLE_DIMS - dims))).reshape(count, groups, TABLE_DIMS).astype(kind)
    tables = np.zeros((groups, 1 << TABLE_DIMS, count), kind)
    for bit in range(TABLE_DIMS):  # each half repeats the half below it, plus one component
        size = 1 << bit
        tables[:, size:2 * size] = tables[:, :size] + parts[:, :, bit].T[:, None, :]
    return tables


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of two's complement; as many planes as the largest component needs."""
    count, dims = rows.shape
    groups = -(-dims // TABLE_DIMS)
    parts = np.pad(rows.astype(np.int64), ((0, 0), (0, groups * TABLE_DIMS - dims))).reshape(count, groups, TABLE_DIMS)
    planes = 1 + max((int(v).bit_length() if v >= 0 else int(~v).bit_length() for v in (rows.min(initial=0), rows.max(initial=0))), default=0)
    out = np.empty((planes, groups, count), np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((parts >> p) & 1).astype(np.uint8), axis=2, bitorder="little")[:, :, 0].T
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products: the top plane first, then doubled and added plane by plane."""
    count = planes.shape[2]
    total, row = np.zeros((count, tables.shape[2]), tables.dtype), np.empty((count, tables.shape[2]), tables.dtype)
    for p in range(len(planes) - 1, -1, -1):
        top = p == len(planes) - 1
        if not top:
            total <<= 1
        for table, index in zip(tables, planes[p]):
            np.take(table, index, axis=0, out=row, mode="clip")
            if top:
                total -= row
            else:
                total += row
    return total


def _scored(anchors: Group, rows: Group):
    """Yield (anchor place, scores with all rows), a bounded run of anchors at a time."""
    left, right = same_width(anchors.matrix, rows.matrix)
    # Partial sums stay below twice the bound of a score.
    kind = np.int32 if 2 * largest_score(left, right) + 256 * max(1, left.shape[1]) < 1 << 31 else np.int64
    planes = bit_planes(right)
    for low in range(0, len(left), ANCHORS_AT_ONCE):
        run = left[low:low + ANCHORS_AT_ONCE]
        for k, column in enumerate(np.ascontiguousarray(scores(subset_tables(run, kind), planes).T)):
            yield low + k, column


def _others(anchors: Group, k: int, rows: Group) -> np.ndarray:
    """Rows that do not carry the anchor's id; an id is always known for an anchor."""
    return (rows.ids != anchors.ids[k]) | ~rows.known


def first_places(values: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` greatest values, greatest first, the earlier place first on ties."""
    if len(values) > 4 * count:
        least = np.partition(values, len(values) - count)[len(values) - count]
        near = np.flatnonzero(values >= least)
        return near[np.argsort(-values[near].astype(np.int64), kind="stable")[:count]]
    return np.argsort(-values.astype(np.int64), kind="stable")[:count]


def _positives(most: int):
    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        anchors, rows = unpack(one), unpack(other)
        of_label = {label: np.flatnonzero(rows.labels == label) for label in np.unique(rows.labels)}
        slots, found, values = [], [], []
        for k, score in _scored(anchors, rows):
            alike = of_label.get(anchors.labels[k])
            if alike is None:
                continue
            alike = alike[_others(anchors, k, rows)[alike]]
            best = alike[first_places(score[alike], most)]
            slots.append(np.full(len(best), k))
            found.append(best)
            values.append(score[best].astype(np.int64))
        slot, best = _joined(slots), _joined(found)
        return pa.table({
            "query_group": pa.array(np.full(len(slot), anchors.side), pa.int32()), "slot": pa.array(anchors.slots[slot], pa.int64()),
            "anchor_id": anchors.columns(slot), "positive_id": rows.columns(best), "positive_score": pa.array(_joined(values), pa.int64())})

    return cell


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _negatives(most: int, low: int, high: int):
    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        anchors, rows = unpack(one.drop_columns(["found"])), unpack(other)
        known: dict[int, list] = {row["slot"]: row["positives"] for row in one.column("found")[0].as_py() or []}
        unlike = {label: np.flatnonzero(rows.labels != label) for label in np.unique(anchors.labels)}
        columns: list[list] = [[], [], [], [], []]
        picked = []
        for k, score in _scored(anchors, rows):
            wanted = known.get(int(anchors.slots[k]))
            if not wanted:
                continue
            others = unlike[anchors.labels[k]]
            others = others[_others(anchors, k, rows)[others]]
            # 100 * score is compared by whole numbers: at least ceil(low * s / 100), at most floor(high * s / 100).
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in wanted]
            score = score[others].astype(np.int64)
            inside = np.flatnonzero((score >= min(w[0] for w in windows)) & (score <= max(w[1] for w in windows)))
            inside = inside[np.argsort(-score[inside], kind="stable")]
            ordered = -score[inside]
            for place, (positive, (least, greatest)) in enumerate(zip(wanted, windows)):
                start, stop = np.searchsorted(ordered, -greatest, "left"), np.searchsorted(ordered, -least, "right")
                best = inside[start:min(stop, start + most)]
                picked.append(others[best])
                for column, value in zip(columns, (k, place, positive["id"], positive["score"])):
                    column.extend([value] * len(best))
                columns[4].append(score[best])
        slot, best = np.array(columns[0], np.int64), _joined(picked)
        return pa.table({
            "query_group": pa.array(np.full(len(slot), anchors.side), pa.int32()), "slot": pa.array(anchors.slots[slot], pa.int64()),
            "anchor_id": anchors.columns(slot), "place": pa.array(columns[1], pa.int32()), "positive_id": pa.array(columns[2], pa.int64()),
            "positive_score": pa.array(columns[3], pa.int64()), "negative_id": rows.columns(best), "negative_score": pa.array(_joined(columns[4]), pa.int64())})

    return cell


def best_positives(packed: DataFrame, anchors: DataFrame, grid: Grid, count: int = POSITIVES) -> DataFrame:
    """Per anchor row (query_group, slot) its first ``count`` rows of the same label, by score and id."""
    met = meet(anchors, packed, grid, _positives(count), FOUND)
    order = Window.partitionBy("query_group", "slot").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def mine(rows: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LEAST_PERCENT, high: int = MOST_PERCENT, column: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id, label and the vector; ``is_anchor``: which of them are anchors. A negative's score lies
    between ``low`` and ``high`` percent of the positive's.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows.where("label IS NOT NULL"), scale, column, "label")
    sizes = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    grid = grid_of(sizes[1], sizes[0], 4 * spark.sparkContext.defaultParallelism)
    packed, _ = write_out(grouped(vectors, grid.rows), "vectors")
    anchors, _ = write_out(grouped(vectors.where(is_anchor), grid.queries), "anchors")
    found, found_path = write_out(best_positives(packed, anchors, grid, positives), "positives")
    # Sorted arrays by place; an anchor has few positives and a query group a bounded number of anchors.
    each = found.groupBy("query_group", "slot").agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    told, _ = write_out(
        each.groupBy(F.col("query_group").cast("long").alias("side")).agg(F.collect_list(F.struct("slot", "positives")).alias("found")), "found")
    drop(spark, found_path)
    met = meet(anchors.join(told, "side", "left"), packed, grid, _negatives(negatives, low, high), MINED)
    order = Window.partitionBy("query_group", "slot", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Noise of known size: rows whose id is divisible by ``every`` move to the next label."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", moved.alias("label"))

"""Exact top-k search by block-at-a-time pruning.

The terms are the dimensions with their sign. Rows are cut into ranges of a few rows, the blocks; each has a
forward index (its rows' whole vectors) and, per term, the greatest and the least value that occurs. A
query's bound for a block is the sum over its terms of weight times maximum (minimum for negative
weights); no row of the block can score more. Blocks are taken in falling order of their bounds, a few at a
time, and scored through the forward index, until the next bound is below the k-th score so far. A bound
equal to it is still scored, as a smaller id wins ties. So pruning never changes a result; how much it saves
depends on the data: where blocks hold alike rows much, for vectors spread evenly over 64 dimensions little.

Within a row group, rows are first dealt to blocks by halving along the dimension that spreads most, so that
alike rows share a block; a block is a range of that order.

Queries meet row groups in cells of ``vector_cells``; before the scoring pass, every query meets one of the
row groups, and its k-th score there is where its pruning starts everywhere else.

Vectors that are null or hold null or non-finite components take no part. Rows with the query's own id are never
returned to it; repeated rows each count, ties go to the smaller id, rows without id come last and are no queries.
Fewer rows than k are all returned; empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from caselake.llm.store import drop, write_out
from caselake.llm.vector_cells import EXACT_DOUBLE, Grid, Group, grid_of, grouped, largest_score, meet, same_width, unpack, whole_vectors

SCALE = 1024
K = 10
QUERY_STEP = 100
BLOCK_ROWS = 16
FIRST_BLOCKS = 8
HITS = "query_group int, slot long, query_id long, vec_id long, score long"


def queries_where(step: int = QUERY_STEP) -> Column:
    return F.col("vec_id") % step == 0


def block_order(matrix: np.ndarray, rows: int = BLOCK_ROWS) -> np.ndarray:
    """An order in which ranges of ``rows`` rows are alike: halves along the widest dimension, again and again."""
    order = np.arange(len(matrix))
    work = [(0, len(order))]
    while work:
        low, high = work.pop()
        if high - low <= rows or not matrix.shape[1]:
            continue
        part = matrix[order[low:high]]
        widest = int(np.argmax(part.std(axis=0)))
        middle = max(1, (high - low) // (2 * rows)) * rows
        order[low:high] = order[low:high][np.argpartition(part[:, widest], middle)]
        work += [(low, low + middle), (low + middle, high)]
    return order


class BlockIndex:
    """Forward index and term bounds of one row group."""

    def __init__(self, group: Group, matrix: np.ndarray, rows: int = BLOCK_ROWS) -> None:
        self.rows, order = rows, block_order(matrix, rows)
        self.blocks = -(-len(order) // rows)
        # The last block is filled up; place -1 marks what is no row, and its terms are those of the block's first row.
        self.place = np.concatenate([order, np.full(self.blocks * rows - len(order), -1)]).reshape(self.blocks, rows)
        self.forward = matrix[self.place]
        filled = np.where((self.place >= 0)[:, :, None], self.forward, self.forward[:, :1])
        self.greatest, self.least = filled.max(axis=1), filled.min(axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(queries, blocks) sums of term maxima."""
        return np.maximum(queries, 0) @ self.greatest.T + np.minimum(queries, 0) @ self.least.T


def search(index: BlockIndex, query: np.ndarray, bound: np.ndarray, allowed: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the rows that may be among the first ``k``, and how many blocks were scored.

    ``allowed`` marks the rows a query may get, by place; ``floor`` is a score that k rows elsewhere reach.
    """
    order = np.argsort(-bound, kind="stable")
    places, values = np.zeros(0, np.int64), np.zeros(0, bound.dtype)
    low, step = 0, FIRST_BLOCKS
    kth = floor
    while low < len(order) and (kth is None or bound[order[low]] >= kth):
        some = order[low:low + step]
        if kth is not None:
            some = some[bound[some] >= kth]
        score, place = (index.forward[some] @ query).ravel(), index.place[some].ravel()
        usable = (place >= 0) & allowed[place]
        if kth is not None:
            usable &= score >= kth
        places, values = np.append(places, place[usable]), np.append(values, score[usable])
        if len(values) >= k:
            least = np.partition(values, len(values) - k)[len(values) - k]
            kth = least if kth is None else max(kth, least)
            near = values >= kth
            places, values = places[near], values[near]
        low, step = low + len(some), 2 * step
    return places, values, low


def _cell(k: int):
    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        floors = dict(zip(*(one.column("floors")[0].as_py()[n] for n in ("slots", "scores")))) if "floors" in one.column_names and one.column("floors")[0].as_py() else {}
        queries = unpack(one.drop_columns(["floors"]) if "floors" in one.column_names else one)
        rows = unpack(other)
        left, right = same_width(queries.matrix, rows.matrix)
        # Products and sums below 2^53 are whole in doubles; otherwise 64-bit numbers, slower.
        kind = np.float64 if largest_score(left, right) < EXACT_DOUBLE else np.int64
        left, index = left.astype(kind), BlockIndex(rows, right.astype(kind))
        bounds = index.bounds(left)
        slots, found, values = [], [], []
        for q in range(len(left)):
            allowed = (rows.ids != queries.ids[q]) | ~rows.known
            places, score, _ = search(index, left[q], bounds[q], allowed, k, floors.get(int(queries.slots[q])))
            best = np.lexsort((places, -score))[:k]  # places ascend with ids
            slots.append(np.full(len(best), q))
            found.append(places[best])
            values.append(score[best].astype(np.int64))
        slot, best = np.concatenate(slots), np.concatenate(found)
        return pa.table({
            "query_group": pa.array(np.full(len(slot), queries.side), pa.int32()), "slot": pa.array(queries.slots[slot], pa.int64()),
            "query_id": queries.columns(slot), "vec_id": rows.columns(best), "score": pa.array(np.concatenate(values), pa.int64())})

    return cell


def _floors(hits: DataFrame, k: int) -> DataFrame:
    """Per query group the k-th score that each of its queries has reached; queries with fewer hits have none."""
    kth = hits.groupBy("query_group", "slot").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    pairs = kth.groupBy(F.col("query_group").cast("long").alias("side")).agg(F.collect_list(F.struct("slot", "score")).alias("p"))
    return pairs.select("side", F.struct(F.col("p.slot").alias("slots"), F.col("p.score").alias("scores")).alias("floors"))


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of each query among all other rows."""
    spark = rows.sparkSession
    vectors = whole_vectors(rows, scale, column)
    sizes = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    grid = grid_of(sizes[1], sizes[0], 4 * spark.sparkContext.defaultParallelism)
    packed, _ = write_out(grouped(vectors, grid.rows), "vectors")
    asked, _ = write_out(grouped(vectors.where(is_query), grid.queries), "queries")
    first, first_path = write_out(meet(asked, packed.where("side = 0"), Grid(grid.queries, 1), _cell(k), HITS), "first")
    floors, _ = write_out(_floors(first, k), "floors")
    rest = packed.where("side > 0").withColumn("side", F.col("side") - 1)
    if grid.rows > 1:
        hits = first.unionByName(meet(asked.join(floors, "side", "left"), rest, Grid(grid.queries, grid.rows - 1), _cell(k), HITS))
    else:
        hits = first
    order = Window.partitionBy("query_group", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

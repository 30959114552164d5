"""Whole-number vectors in packed groups, and a grid of cells in which every query meets every row once.

Rows are dealt evenly, whatever their ids or labels, into row groups; the much fewer queries into query
groups. A cell is one query group with one row group, both of bounded size, so no key, label or group of
copies makes a task larger. A cell's task returns a few rows for each query; a window merges them.

Vectors that are null or hold a null or non-finite component take no part. Vectors of different lengths
are filled with zeros. Scores that may pass 64 bits end the job with an error, they are never rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

ROWS_PER_GROUP = 32_768
LEAST_ROWS_PER_GROUP = 2_048
QUERIES_PER_GROUP = 4_096
ROWS_PER_PACK = 8_192
MOST_TASKS = 50_000
PACKED = "side long, pack long, ids binary, known binary, labels binary, size long, width long, kind string, vectors binary"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 63


def whole_vectors(rows: DataFrame, scale: int, column: str = "embedding", label: str | None = None) -> DataFrame:
    """(vec_id, label, z): each component x as floor(scale * x), x taken as a double; rows that take no part are left out."""
    usable = F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    chosen = rows.where(usable)
    return chosen.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col(label) if label else F.lit(None)).cast("long").alias("label"),
        F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("z"),
    )


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    most = max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0
    return values.astype(next(t for t, limit in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", EXACT_LONG)) if most < limit or t == "<i8"))


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pack of a partition's rows, in order of (null last) id inside the pack."""
    side, number, held, count = TaskContext.get().partitionId(), 0, [], 0

    def pack(table: pa.Table) -> pa.RecordBatch:
        ids, labels = table.column("vec_id").combine_chunks(), table.column("label").combine_chunks()
        z = table.column("z").combine_chunks()
        lengths = np.diff(z.offsets.to_numpy())
        flat = z.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(lengths.max(initial=0))
        matrix = np.zeros((len(ids), width), np.int64)
        matrix[np.repeat(np.arange(len(ids)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
        order = np.lexsort((values, ~known))
        matrix = _narrow(matrix[order])
        row = [
            side, number, values[order].tobytes(), known[order].tobytes(), labels.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")[order].tobytes(),
            len(ids), width, matrix.dtype.str, matrix.tobytes(),
        ]
        return pa.RecordBatch.from_pydict(dict(zip(_NAMES, ([v] for v in row))))

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        while count >= ROWS_PER_PACK:
            table = pa.Table.from_batches(held)
            yield pack(table.slice(0, ROWS_PER_PACK))
            rest = table.slice(ROWS_PER_PACK)
            held, count, number = rest.to_batches(), rest.num_rows, number + 1
    if count:
        yield pack(pa.Table.from_batches(held))


def grouped(vectors: DataFrame, groups: int) -> DataFrame:
    """Packs of ``vectors`` with their group (``side``), dealt out evenly."""
    return vectors.select("vec_id", "label", "z").repartition(groups).mapInArrow(_pack_rows, PACKED)


def group_count(rows: int, most: int, least: int, tasks: int) -> int:
    """Groups of at most about ``most`` rows; smaller ones, down to ``least``, where that keeps ``tasks`` busy."""
    return max(1, -(-rows // most), min(tasks, rows // least))


@dataclass(frozen=True)
class Grid:
    """Number of query groups and of row groups."""

    queries: int
    rows: int


def grid_of(queries: int, rows: int, tasks: int) -> Grid:
    return Grid(group_count(queries, QUERIES_PER_GROUP, QUERIES_PER_GROUP, 1), group_count(rows, ROWS_PER_GROUP, LEAST_ROWS_PER_GROUP, tasks))


@dataclass(frozen=True)
class Group:
    """Unpacked rows of one side of a cell, in order of id, rows without id last."""

    side: int
    ids: np.ndarray
    known: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    slots: np.ndarray  # place of each row in the packs as stored

    def columns(self, chosen: np.ndarray) -> pa.Array:
        return pa.array(self.ids[chosen], pa.int64(), mask=~self.known[chosen])


def unpack(table: pa.Table) -> Group:
    rows = sorted(table.to_pylist(), key=lambda r: r["pack"])
    width = max(r["width"] for r in rows)
    parts = [np.frombuffer(r["vectors"], r["kind"]).reshape(r["size"], r["width"]) for r in rows]
    matrix = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
    ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows])
    known = np.concatenate([np.frombuffer(r["known"], bool) for r in rows])
    labels = np.concatenate([np.frombuffer(r["labels"], "<i8") for r in rows])
    order = np.lexsort((ids, ~known))
    return Group(rows[0]["side"], ids[order], known[order], labels[order], matrix[order], order)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def largest_score(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of every absolute score, refused where 64 bits might not hold it."""
    if not a.size or not b.size:
        return 0
    most = [max(abs(int(m.min())), abs(int(m.max()))) for m in (a, b)]
    # The greatest sum of a row's magnitudes, in doubles with room for their rounding.
    sums = [int(np.abs(m.astype(np.float64)).sum(axis=1).max() * (1 + 1e-9)) + 1 for m in (a, b)]
    bound = min(sums[0] * most[1], sums[1] * most[0])
    if bound >= EXACT_LONG:
        raise OverflowError("Inner products may pass 64 bits.")
    return bound


def meet(queries: DataFrame, rows: DataFrame, grid: Grid, cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``cell`` on every pair of a query group and a row group.

    Each query group goes to every row group and the other way round, under a key for each cell. The cost that
    grows fastest, scoring, is spread over all cells.
    """
    keys = ["_query_group", "_row_group"]
    left = queries.withColumns({keys[0]: F.col("side").cast("int"), keys[1]: F.explode(F.sequence(F.lit(0), F.lit(grid.rows - 1)))})
    right = rows.withColumns({keys[1]: F.col("side").cast("int"), keys[0]: F.explode(F.sequence(F.lit(0), F.lit(grid.queries - 1)))})
    # A stated number: cells are small in bytes and long in time, so they must not be merged by size.
    parts = min(2 * grid.queries * grid.rows, MOST_TASKS)
    empty = _empty(schema)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        return cell(one, other) if one.num_rows and other.num_rows else empty

    return left.repartition(parts, *keys).groupby(*keys).cogroup(right.repartition(parts, *keys).groupby(*keys)).applyInArrow(run, schema)


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))]).empty_table()

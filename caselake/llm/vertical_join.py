"""Set similarity join of documents on word shingles, by vertical partitioning.

Tasks count, by hash range, in how many sets each shingle occurs; that gives the global order, rare before
frequent. A set can only be linked if enough of its shingles occur elsewhere. The shared shingles of the few
sets left are ordered and cut into fragments: stretches of the global order that end at fixed frequencies, the
same for all sets. Two sets are compared only if they share a shingle of their prefixes at places that still
allow the threshold (length and place filter). A pair's overlap is counted fragment by fragment and summed.

Groups of copies stay small: equal sets are one class from the start, and inside a list of sets that share
a shingle each is first compared with one leader only, then, if it is not yet in the leader's component, with
other members of it in a few turns. Sets in one component need no further pairs; all other pairs of the
list are compared in the end, so no link between components is lost.

Shingles so frequent that one task might not hold their places are ordered last from an upper estimate of
their counts (their number is bounded by ``HOT_SHINGLES``, the counts only set the order, never a result).

Sets are told apart by 128-bit signatures, shingles by 64-bit hashes. Null and empty texts have no set and
are linked with nothing; a null doc_id is never chosen as a component's id unless it has no other; repeated
rows are copies of each other; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from caselake.llm.components import components
from caselake.llm.shingles import portions, set_signatures, shingle_sets
from caselake.llm.store import drop, field, others, write_out

SHINGLES_PER_BUCKET = 1_500_000
# A fragment ends behind the shingles that occur in this many sets; the last one holds all more frequent ones.
FRAGMENT_ENDS = (2, 8, 64)
LINKING_TURNS = 2
LISTS_PER_TURN = 4
HOT_SHINGLES = 50_000
HOT_LEAST = 64
BUFFERED_SHINGLES = 1_000_000


def _profile(width: int):
    """Size and signature of each row's set; shingles that are frequent in a stretch of the task, with their count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0

        def rows(hot, doc_id, n, s1, s2):
            return pa.RecordBatch.from_arrays([pa.array(hot, pa.bool_()), doc_id, pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64())],
                                              ["hot", "doc_id", "n", "s1", "s2"])

        def frequent():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 3
            k = int(often.sum())
            return rows(np.ones(k, bool), pa.nulls(k, pa.int64()), counts[often], values[often].view(np.int64), np.zeros(k, np.int64))

        for part in portions(batches):
            values, sizes = shingle_sets(part.column("text"), width)
            marks = set_signatures(values, sizes)
            ends = np.cumsum(sizes)
            for i, mark in enumerate(marks[:, 0].tolist()):
                if mark not in seen:
                    seen.add(mark)
                    held.append(values[ends[i] - sizes[i]:ends[i]])
                    size += int(sizes[i])
            yield rows(np.zeros(len(sizes), bool), part.column("doc_id"), sizes, marks[:, 0], marks[:, 1])
            if size > BUFFERED_SHINGLES:
                yield frequent()
                held, size = [], 0
        if held:
            yield frequent()

    return run


def _spread(width: int, buckets: int, hot: np.ndarray):
    """Shingles by bucket: one row per stretch of a task and bucket; a negative bucket has a stretch's set names and hot shingles."""
    names = ["bucket", "stretch", "s1", "sizes", "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        stretch = TaskContext.get().partitionId() << 32

        def row(bucket, s1, sizes, shingles):
            cells = [bucket, stretch, s1.astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), shingles.astype("<u8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, (*[pa.int64()] * 2, *[pa.binary()] * 3))], names)

        for part in portions(batches, 6_000_000):
            held, counts, marks = [], [], []
            for small in portions(iter([part])):
                values, sizes = shingle_sets(small.column("text"), width)
                s1 = set_signatures(values, sizes)[:, 0]
                fresh = np.array([n > 0 and m not in seen and not seen.add(m) for m, n in zip(s1.tolist(), sizes.tolist())], bool)
                held.append(values[np.repeat(fresh, sizes)])
                counts.append(sizes[fresh])
                marks.append(s1[fresh])
            values, sizes, s1 = np.concatenate(held), np.concatenate(counts), np.concatenate(marks)
            if not len(sizes):
                continue
            owner = np.repeat(np.arange(len(sizes)), sizes)
            is_hot = np.isin(values, hot) if len(hot) else np.zeros(len(values), bool)
            yield row(-1 - stretch, s1, np.concatenate([sizes, np.bincount(owner[is_hot], minlength=len(sizes))]), values[is_hot])
            values, owner = values[~is_hot], owner[~is_hot]
            bucket = (values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            values, owner, bucket = values[order], owner[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            for k in np.flatnonzero(np.diff(cuts)):
                some = slice(cuts[k], cuts[k + 1])
                who, many = np.unique(owner[some], return_counts=True)
                yield row(int(k), np.zeros(0), np.concatenate([who, many]), values[some])
            stretch += 1

    return run


def _frequencies(table: pa.Table) -> pa.Table:
    """Of a bucket: the shingles that occur in several sets and their counts, again by stretch."""
    if table.column("bucket")[0].as_py() < 0:
        head = table.select(["stretch", "s1", "sizes", "shingles"]).rename_columns(["stretch", "s1", "owners", "shingles"])
        return head.append_column("counts", pa.array([b""] * head.num_rows, pa.binary()))
    shingles = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
    distinct, number, counts = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    out, at = [], 0
    for stretch, sizes, own in zip(table.column("stretch").to_pylist(), table.column("sizes").to_pylist(), shingles):
        who, many = np.frombuffer(sizes, "<u4").reshape(2, -1)
        count = counts[number[at:at + len(own)]]
        at += len(own)
        shared = count > 1
        if shared.any():
            out.append((stretch, b"", np.repeat(who, many)[shared].tobytes(), own[shared].tobytes(), count[shared].astype("<u4").tobytes()))
    return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), *[pa.binary()] * 4))],
                    names=["stretch", "s1", "owners", "shingles", "counts"])


def _order(hot: np.ndarray, hot_counts: np.ndarray, percent: int):
    """Of a stretch: each set that can be linked, its shared shingles in global order, cut into fragments."""
    width = len(FRAGMENT_ENDS) + 1

    def run(table: pa.Table) -> pa.Table:
        head = next(r for r in table.to_pylist() if r["s1"])
        marks = np.frombuffer(head["s1"], "<i8")
        total, n_hot = np.frombuffer(head["owners"], "<u4").reshape(2, -1)
        values = [np.frombuffer(head["shingles"], "<u8")]
        owners = [np.repeat(np.arange(len(marks)), n_hot)]
        counts = [hot_counts[np.searchsorted(hot, values[0])] if len(values[0]) else np.zeros(0, np.int64)]
        for r in table.to_pylist():
            if not r["s1"]:
                values.append(np.frombuffer(r["shingles"], "<u8"))
                owners.append(np.frombuffer(r["owners"], "<u4"))
                counts.append(np.frombuffer(r["counts"], "<u4"))
        value, owner, count = np.concatenate(values), np.concatenate(owners).astype(np.int64), np.concatenate(counts).astype(np.int64)
        need = -(-percent * total.astype(np.int64) // 100)
        enough = np.bincount(owner, minlength=len(marks)) >= need
        keep = enough[owner]
        value, owner, count = value[keep], owner[keep], count[keep]
        order = np.lexsort((value, count, owner))
        value, cell = value[order], owner[order] * width + np.searchsorted(FRAGMENT_ENDS, count[order])
        chosen = np.flatnonzero(enough)
        sizes = np.bincount(cell, minlength=len(marks) * width).reshape(-1, width)[chosen].ravel()
        parts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(value.view(np.int64)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(chosen) + 1) * width, pa.int32()), parts)
        return pa.table([pa.array(marks[chosen], pa.int64()), pa.array(total[chosen].astype(np.int64)), lists], names=["s1", "n", "parts"])

    return run


def _fits(a: str, b: str, percent: int):
    """Length and place filter: can two sets still reach the threshold if this is their first common shingle?"""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return (100 * small >= percent * large) & ((100 + percent) * rest >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n")))


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs of sets."""
    first = F.col(f"{a}.s1") < F.col(f"{b}.s1")
    return df.where(F.col(f"{a}.s1") != F.col(f"{b}.s1")).select(
        F.least(f"{a}.s1", f"{b}.s1").alias("a"), F.greatest(f"{a}.s1", f"{b}.s1").alias("b"),
        F.when(first, F.col(f"{a}.n")).otherwise(F.col(f"{b}.n")).alias("na"),
        F.when(first, F.col(f"{b}.n")).otherwise(F.col(f"{a}.n")).alias("nb"),
    ).distinct()


def _links(pairs: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """Pairs at or above the threshold: overlaps counted in each fragment, then summed."""
    def side(name: str) -> DataFrame:
        cut = able.select(F.col("s1").alias(name), F.posexplode("parts").alias("fragment", f"part_{name}"))
        return cut.where(F.size(f"part_{name}") > 0)

    of_a, of_b = side("a"), side("b")
    met = pairs.join(of_a, "a").join(of_b, ["b", "fragment"])
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("part_a", "part_b")).alias("common"))
    total = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _linked(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, s1, s2) of every row, and (node, root) of the sets that are linked with others."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    profile, _ = write_out(rows.mapInArrow(_profile(width), "hot boolean, doc_id long, n long, s1 long, s2 long"), "profile")
    sets = profile.where("NOT hot").select("doc_id", "n", "s1", "s2")
    top = profile.where("hot").groupBy("s1").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_LEAST)
    top = top.orderBy(F.desc("n"), "s1").limit(HOT_SHINGLES).collect()
    hot = np.array([r[0] for r in top], np.int64).view(np.uint64)
    hot_counts = np.array([r[1] for r in top], np.int64)[np.argsort(hot)]
    hot = np.sort(hot)
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // SHINGLES_PER_BUCKET))

    spread = rows.mapInArrow(_spread(width, buckets, hot), "bucket long, stretch long, s1 binary, sizes binary, shingles binary")
    shared = spread.groupBy("bucket").applyInArrow(_frequencies, "stretch long, s1 binary, owners binary, shingles binary, counts binary")
    ordered = shared.groupBy("stretch").applyInArrow(
        _order(hot, hot_counts, percent), "s1 long, n long, parts array<array<long>>")
    able, able_path = write_out(ordered.dropDuplicates(["s1"]), "able")

    shared = F.flatten("parts")
    singles = F.col("n") - F.size(shared)
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    in_prefix = F.slice(shared, F.lit(1), F.greatest(F.lit(0), prefix - singles).cast("int"))
    places = able.select("s1", "n", singles.alias("singles"), F.posexplode(in_prefix).alias("k", "shingle"))
    places = places.select("shingle", F.struct("s1", "n", (F.col("singles") + F.col("k")).alias("pos")).alias("m"))
    # The leader has the fewest rarer shingles before this one: the likely origin of a group of near copies.
    places = places.withColumn("rank", F.struct("m.pos", "m.n", "m.s1"))
    led = places.withColumn("leader", F.min("rank").over(Window.partitionBy("shingle"))).drop("rank")
    led, led_path = write_out(led, "places")

    links, *link_paths = write_out(_links(_pairs(led.where(_fits("m", "leader", percent)), "m", "leader"), able, percent), "links")
    joined = components(links)
    by_list, by_set = Window.partitionBy("shingle"), Window.partitionBy("s1")
    for turn in range(LINKING_TURNS + 1):
        node = joined.select(F.col("node").alias("s1"), "root")
        mine = led.select("shingle", "m", "leader", F.col("m.s1").alias("s1")).join(node, "s1", "left").withColumn("root", F.coalesce("root", "s1"))
        mine = mine.withColumn("main", F.max(F.when(F.col("s1") == F.col("leader.s1"), F.col("root"))).over(by_list))
        # A list whose sets are all in the leader's component has nothing left to compare.
        mine = mine.withColumn("open", F.max(F.col("root") != F.col("main")).over(by_list)).where("open")
        mine, mine_path = write_out(mine.select("shingle", "s1", "m", "leader", "root", "main"), "joined")
        apart = mine.where("root != main")
        if not apart.limit(1).count():
            drop(spark, mine_path)
            break
        if turn < LINKING_TURNS:
            # Sets outside the leader's component meet other members of it, on a few of their lists.
            lot = F.xxhash64("s1", "shingle", F.lit(turn))
            met = mine.withColumn("y", F.min(F.when(F.col("root") == F.col("main"), F.struct(lot.alias("lot"), "m"))).over(by_list)["m"])
            met = met.where("root != main").select("s1", "shingle", F.col("m").alias("x"), "y").where(_fits("x", "y", percent))
            met = met.withColumn("k", F.row_number().over(by_set.orderBy(F.xxhash64("shingle", F.lit(turn)))))
            pairs = _pairs(met.where(F.col("k") <= LISTS_PER_TURN), "x", "y")
        else:
            # All pairs left: of different components, and not compared with the leader before.
            apart = apart.select("shingle", F.col("m").alias("x"), F.col("root").alias("root_x"))
            rest = mine.select("shingle", F.col("m").alias("y"), F.col("root").alias("root_y"), "leader")
            other = apart.join(rest, "shingle").where((F.col("root_x") != F.col("root_y")) & (F.col("y.s1") != F.col("leader.s1")) & _fits("x", "y", percent))
            pairs = _pairs(other, "x", "y")
        more, path = write_out(_links(pairs, able, percent), "links")
        link_paths.append(path)
        drop(spark, mine_path)
        if more.limit(1).count():
            links = links.union(more)
            joined = components(links)
    drop(spark, led_path, able_path, *link_paths)

    return sets, joined


def similar_components(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Two rows are linked where 100 * intersection >= percent * union of their shingle sets; a component's id
    is its smallest doc_id.
    """
    sets, joined = _linked(docs, percent, width)
    full = sets.where("n > 0")
    classes = full.groupBy("s1", "s2").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = classes.join(joined.select(F.col("node").alias("s1"), "root"), "s1", "left")
    lowest = classes.where("root IS NOT NULL").groupBy("root").agg(F.min("least").alias("lowest"))
    named = classes.join(lowest, "root", "left").where("copies > 1 OR lowest IS NOT NULL").select("s1", "s2", F.coalesce("lowest", "least").alias("component_id"))
    linked = full.join(named, ["s1", "s2"], "left")
    alone = sets.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")).union(
        alone.select("doc_id", "n", "component_id"))


def _marked(width: int):
    """Each row as it is, with the size and signature of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            values, sizes = shingle_sets(part.column("text"), width)
            marks = set_signatures(values, sizes)
            cells = (sizes, marks[:, 0], marks[:, 1])
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, pa.int64()) for c in cells)], [*part.schema.names, "n", "s1", "s2"])

    return run


def keep_one(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id. Rows without words all stay.

    Rows are told apart by doc_id and set, so another text under the same doc_id stays. A null doc_id is the
    largest; of several rows alike in both one stays.
    """
    sets, joined = _linked(docs, percent, width)
    rows = sets.where("n > 0").groupBy("doc_id", "s1", "s2").agg(F.count("*").alias("alike"))
    rows = rows.join(joined.select(F.col("node").alias("s1"), "root"), "s1", "left")
    # A set linked with no other is a component of its own.
    component = (F.coalesce("root", "s1"), F.when(F.col("root").isNull(), F.col("s2")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "s1", "s2", "alike")).alias("first")
    chosen = rows.groupBy(*component).agg(first).select("first.doc_id", "first.s1", "first.s2", "first.alike")
    chosen, _ = write_out(chosen.toDF("id", "k1", "k2", "alike"), "chosen")
    # Each row travels as one struct, so its columns may have any name.
    packed = docs.select(F.struct(*map(field, others(docs, "text"))).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = packed.mapInArrow(_marked(width), StructType([*packed.schema.fields]).add("n", "long").add("s1", "long").add("s2", "long"))
    match = (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2")) & F.col("doc_id").eqNullSafe(F.col("id"))
    kept = marked.join(chosen.where("alike = 1"), match, "left_semi")
    alike = marked.join(chosen.where("alike > 1"), match, "left_semi").dropDuplicates(["doc_id", "s1", "s2"])
    rows = kept.union(alike).union(marked.where("n = 0"))
    return rows.select(*(F.col("text") if c.lower() == "text" else field(c, "row").alias(c) for c in docs.columns))

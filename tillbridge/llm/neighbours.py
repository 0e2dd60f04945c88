"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Vectors of one direction (to 2**-40 in each component) are one node, which keeps its smallest ids.
Nodes carry their vectors unrounded: single precision if the column is of that type, else double.
All ranking is by the distance of unit vectors in double precision, so near copies are told apart
as far as the cosine tells them apart in doubles. The first graph takes each node's best
among its block: nodes sorted by the signs of a few random projections and cut into blocks of
``BLOCK``, ``TABLES`` times over. NN-descent then repeats: a node's neighbours and reverse
neighbours (``SAMPLE`` of them, those not tried yet first) are compared with each other, as
neighbours of neighbours are likely neighbours, and every node keeps its best ``NEIGHBOURS``.

The search keeps a beam of the best nodes met for each query, expands the best ones not expanded
yet by their neighbours and reverse neighbours, and ends when the beam has none left. It
starts at the nearest of ``ENTRIES`` sampled nodes, and at the query's own node if it has one.
Lists and beams hold ids; a step joins each vector, with its node's list, once to a query that meets it,
and a query's beam advances in one group of its own, at most ``BEAM`` nodes and ``EXPAND`` lists.
The best of the beam are scored again on the original vectors in double precision.

Blocks, samples, lists and beams bound every group, whatever the number of rows that share a
vector; record batches are bounded by ``BATCH_BYTES``. Nearness is the cosine. Vectors that are
null, zero or hold null or non-finite components take no part. A cosine needs vectors of one
length, so each length has a graph of its own, one after the other, and its queries find vectors
of that length. Rows that repeat id and vector count once, and ask once if they repeat id and
direction; an id never finds itself. Ties go to the smaller id, null ids last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tillbridge.llm.common import Scratch

NEIGHBOURS, SAMPLE, PROPOSALS = 32, 40, 8
BLOCK, TABLES, SIGNS = 256, 4, 16
ITERATIONS, LEAST_CHANGE = 6, 0.02
DEGREE = 56  # neighbours and reverse neighbours that the search sees
BEAM, EXPAND, ENTRIES, STARTS = 128, 64, 512, 16
MOST_STEPS = 60
AGAIN = 64  # of the beam, whose cosines are computed
BATCH_BYTES = 1 << 23
FAR = -9.0  # less than any similarity, which is minus the squared distance of unit vectors


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Distinct (id, vector, direction, size) whose vectors take part; the vector as array<double>."""
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = (rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
             .where(v.isNotNull()).where(~bad).where(F.exists(v, lambda x: x != 0)))
    return found.distinct().withColumn("size", F.size(v)).mapInArrow(
        _directed, "id long, vector array<double>, size int, direction binary")


def _directed(batches):
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            grid = np.rint(_unit(_matrix(part.column("vector"))) * 2.0**40).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([hashlib.md5(row.tobytes()).digest() for row in grid], pa.binary())],
                [*part.schema.names, "direction"])


def _matrix(lists) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def nodes_of(rows: DataFrame, ids: int, single: bool = False) -> DataFrame:
    """(node, direction, vector, unit, rows): each direction with the rows (id, vector) of its smallest ids.

    ``unit`` holds the vector. An id that comes with several vectors of the direction is listed for
    each, ``ids`` times at most.
    """
    of_id = Window.partitionBy("direction", F.col("id")).orderBy("vector")
    order = Window.partitionBy("direction").orderBy(F.col("id").asc_nulls_last())
    small = rows.withColumn("copy", F.row_number().over(of_id)).where(F.col("copy") <= ids)
    small = small.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= ids)
    distinct = small.groupBy("direction").agg(F.min(F.struct("place", "copy", "vector"))["vector"].alias("vector"),
                                              F.collect_list(F.struct("id", "vector")).alias("rows"))
    distinct = distinct.select("direction", "vector", "rows", F.monotonically_increasing_id().alias("node"))
    kind = np.float32 if single else np.float64

    def run(batches):
        for batch in batches:
            mark = bytes([np.dtype(kind).itemsize])
            units = [v.astype(kind).tobytes() + mark for v in _matrix(batch.column("vector"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(units, pa.binary())], [*batch.schema.names, "unit"])

    return distinct.mapInArrow(run, "direction binary, vector array<double>, rows array<struct<id:long,vector:array<double>>>, node long, unit binary")


def _unit(x):
    x = x / np.abs(x).max(1, keepdims=True, initial=0)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _units(column) -> np.ndarray:
    """The unit vectors of a binary column, or of the values of a list of binaries, as a matrix of doubles."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.zeros((len(column), 1))
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(len(column), -1)
    return _unit(np.ascontiguousarray(data[:, :-1]).view(f"f{data[0, -1]}").astype(np.float64))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minus the squared distances of unit vectors, so that nearer is larger."""
    return 2 * (a @ b.T) - (a * a).sum(1)[:, None] - (b * b).sum(1)


def _pairs(a, b, s, names=("node", "nbr", "sim")):
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64)),
                                       pa.array(np.asarray(s, np.float64))], list(names))


def _best(sims: np.ndarray, many: int):
    """Rows, columns and values of each row's best entries above FAR."""
    many = min(many, sims.shape[1])
    top = np.argpartition(-sims, many - 1, axis=1)[:, :many] if many < sims.shape[1] else np.tile(np.arange(many), (len(sims), 1))
    value = np.take_along_axis(sims, top, 1)
    row, place = np.nonzero(value > FAR)
    return row, top[row, place], value[row, place]


def first_graph(nodes: DataFrame, neighbours: int) -> DataFrame:
    """(node, nbr, sim) among the nodes of each block."""

    def signed(batches):
        for batch in batches:
            units = _units(batch.column("unit"))
            for t in range(TABLES):
                draw = np.random.default_rng(t).normal(size=(units.shape[1], SIGNS + 1)) if len(batch) else np.zeros((1, SIGNS + 1))
                spread = units @ draw
                sign = (spread[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS - 1, -1, -1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(batch), t, np.int32)), pa.array(sign.astype(np.int32)), pa.array(spread[:, SIGNS]),
                     batch.column("node"), batch.column("unit")], ["part", "sign", "place", "node", "unit"])

    def block(ids, units):
        sims = _near(units, units)
        np.fill_diagonal(sims, FAR)
        row, column, value = _best(sims, neighbours // 2 if len(ids) > neighbours else len(ids))
        return _pairs(ids[row], ids[column], value)

    def blocks(batches):
        held = {}
        for batch in batches:
            part, ids, units = batch.column("part").to_numpy(), batch.column("node").to_numpy(), _units(batch.column("unit"))
            for t in np.unique(part):
                own = part == t
                a, b = held.get(t, (ids[:0], units[:0]))
                a, b = np.concatenate([a, ids[own]]), np.concatenate([b, units[own]])
                while len(a) >= 2 * BLOCK:
                    yield block(a[:BLOCK], b[:BLOCK])
                    a, b = a[BLOCK:], b[BLOCK:]
                held[t] = a, b
        for a, b in held.values():
            if len(a) > 1:
                yield block(a, b)

    spread = nodes.select("node", "unit").mapInArrow(signed, "part int, sign int, place double, node long, unit binary")
    parts = max(1, -(-nodes.count() * TABLES // (1 << 15)))
    return (spread.repartitionByRange(parts, "part", "sign", "place").sortWithinPartitions("part", "sign", "place")
            .mapInArrow(blocks, "node long, nbr long, sim double"))


def _nearest(pairs: DataFrame, neighbours: int) -> DataFrame:
    """Each node's best distinct neighbours; fresh unless the pair was there before."""
    once = pairs.repartition("node").groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= neighbours).drop("place")


def _local_joins(proposals: int):
    def run(batches):
        for batch in batches:
            lists = batch.column("near")
            fields = lists.values
            ids, fresh = fields.field("nbr").to_numpy(), fields.field("fresh").to_numpy(zero_copy_only=False)
            worst, units = fields.field("worst").to_numpy(), _units(fields.field("unit"))
            ends = lists.offsets.to_numpy()
            a, b, s = [], [], []
            for k in range(len(lists)):
                at = slice(ends[k], ends[k + 1])
                own, new = ids[at], fresh[at]
                if len(own) < 2 or not new.any():
                    continue
                sims = _near(units[at], units[at])
                sims[~(new[:, None] | new)] = FAR
                np.fill_diagonal(sims, FAR)
                sims[sims <= worst[at][:, None]] = FAR
                row, column, value = _best(sims, proposals)
                a.append(own[row])
                b.append(own[column])
                s.append(value)
            if a:
                yield _pairs(np.concatenate(a), np.concatenate(b), np.concatenate(s))

    return run


def build(nodes: DataFrame, scratch: Scratch, neighbours: int = NEIGHBOURS, iterations: int = ITERATIONS) -> DataFrame:
    """The neighbour graph (node, nbr, sim, fresh) of stored nodes."""
    graph = scratch.keep(_nearest(first_graph(nodes, neighbours).withColumn("fresh", F.lit(True)), neighbours), "graph")
    for turn in range(iterations):
        total, fresh = graph.agg(F.count("*"), F.coalesce(F.sum(F.col("fresh").cast("long")), F.lit(0))).first()
        if fresh <= LEAST_CHANGE * total:
            break
        around = graph.select("node", "nbr", "fresh").union(graph.select("nbr", "node", "fresh"))
        around = around.repartition("node").groupBy("node", "nbr").agg(F.max("fresh").alias("fresh"))
        order = Window.partitionBy("node").orderBy(F.desc("fresh"), F.xxhash64("node", "nbr", F.lit(turn)))
        around = around.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE).drop("place")
        worst = graph.groupBy("node").agg(F.when(F.count("*") >= neighbours, F.min("sim")).otherwise(F.lit(FAR)).alias("worst"))
        known = nodes.select("node", "unit").join(worst, "node", "left").select(
            F.col("node").alias("nbr"), "unit", F.coalesce("worst", F.lit(FAR)).alias("worst"))
        near = around.join(known, "nbr").groupBy("node").agg(F.collect_list(F.struct("nbr", "fresh", "worst", "unit")).alias("near"))
        found = near.select("near").mapInArrow(_local_joins(PROPOSALS), "node long, nbr long, sim double")
        pairs = graph.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True)))
        better = scratch.keep(_nearest(pairs, neighbours), "graph")
        scratch.drop(graph)
        graph = better
    return graph


def adjacency(graph: DataFrame, degree: int = DEGREE) -> DataFrame:
    """(node, near): the best of each node's neighbours and reverse neighbours."""
    both = graph.select("node", "nbr", "sim").union(graph.select("nbr", "node", "sim")).withColumn("fresh", F.lit(False))
    return _nearest(both, degree).groupBy("node").agg(F.collect_list("nbr").alias("near"))


def _entries(nodes: DataFrame):
    rows = nodes.select("node", "unit").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).toArrow()
    return rows.column("node").to_numpy(), _units(rows.column("unit").combine_chunks())


STEP = "query long, node long, sim double, near array<long>, unit binary"
STEP_NAMES = ["query", "node", "sim", "near", "unit"]
LISTS = pa.list_(pa.int64())


def _advance(beam: int):
    """The next step of a query, from its rows of the last one and the nodes that it met.

    Rows are of three kinds: the query's vector (without node), the beam (``near`` until the node is
    expanded), and the nodes met next (without sim).
    """
    def run(held: pa.Table, met: pa.Table) -> pa.Table:
        asks, held = held.filter(pc.is_null(held.column("node"))), held.filter(pc.is_valid(held.column("sim")))
        apart = _units(met.column("unit").combine_chunks()) - _units(asks.column("unit").combine_chunks())
        ids = np.concatenate([held.column("node").to_numpy(), met.column("node").to_numpy()])
        sims = np.concatenate([held.column("sim").to_numpy(), -(apart * apart).sum(1)[:len(met)]])
        best = np.lexsort((ids, -sims))[:beam]
        near = pa.chunked_array([*held.column("near").chunks, *met.column("near").chunks], LISTS).take(pa.array(best))
        ids, sims, queue, found = ids[best], sims[best], np.flatnonzero(near.is_valid().to_numpy()), np.zeros(0, np.int64)
        while len(queue) and not len(found):
            turn, queue = queue[:EXPAND], queue[EXPAND:]
            found = np.setdiff1d(near.take(pa.array(turn)).combine_chunks().flatten().to_numpy(), ids)
        waits = np.zeros(len(ids), bool)
        waits[queue] = True
        n, m = len(ids), len(found)
        near = pc.if_else(pa.array(waits), near.combine_chunks(), pa.nulls(n, LISTS))
        return pa.table([
            pa.array(np.full(1 + n + m, asks.column("query")[0].as_py())),
            pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(ids), pa.array(found)]),
            pa.concat_arrays([pa.nulls(1, pa.float64()), pa.array(sims), pa.nulls(m, pa.float64())]),
            pa.concat_arrays([pa.nulls(1, LISTS), near, pa.nulls(m, LISTS)]),
            pa.concat_arrays([asks.column("unit").combine_chunks().cast(pa.binary()), pa.nulls(n + m, pa.binary())])], STEP_NAMES)

    return run


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, scratch: Scratch, beam: int = BEAM) -> DataFrame:
    """(query, node, sim): the beam of each query at the end; queries have columns query, unit, node (or null)."""
    spark = nodes.sparkSession
    points = scratch.keep(nodes.select("node", "unit").join(adjacency(graph), "node", "left"), "points")
    shared = spark.sparkContext.broadcast(_entries(nodes))

    def start(batches):
        ids, units = shared.value
        for batch in batches:
            if not len(batch):
                continue
            row, column, _ = _best(_near(_units(batch.column("unit")), units), STARTS)
            query, own = batch.column("query").to_numpy(), batch.column("node").drop_null().to_numpy()
            asks = query[batch.column("node").is_valid().to_numpy(zero_copy_only=False)]
            pairs = np.unique(np.stack([np.append(query[row], asks), np.append(ids[column], own)], 1), axis=0)
            n = len(pairs)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column("query"), pa.array(pairs[:, 0])]),
                pa.concat_arrays([pa.nulls(len(batch), pa.int64()), pa.array(pairs[:, 1])]), pa.nulls(len(batch) + n, pa.float64()),
                pa.nulls(len(batch) + n, LISTS), pa.concat_arrays([batch.column("unit"), pa.nulls(n, pa.binary())])], STEP_NAMES)

    step = scratch.keep(queries.select("query", "unit", "node").mapInArrow(start, STEP), "beam")
    for _ in range(MOST_STEPS):
        asked = step.where("node IS NOT NULL AND sim IS NULL").select(F.col("query").alias("asks"), F.col("node").alias("node"))
        if asked.isEmpty():
            break
        met = asked.join(points, "node")
        held = step.where("node IS NULL OR sim IS NOT NULL")
        after = scratch.keep(held.groupBy("query").cogroup(met.groupBy("asks")).applyInArrow(_advance(beam), STEP), "beam")
        scratch.drop(step)
        step = after
    scratch.drop(points)
    return step.where("sim IS NOT NULL").select("query", "node", "sim")


def _cosines(batches):
    """Rows of two vectors a and b: the other columns and their cosine."""
    for batch in batches:
        size = len(batch)
        a, b = (batch.column(c).flatten().to_numpy().reshape(size, -1) if size else np.zeros((0, 1)) for c in ("a", "b"))
        with np.errstate(all="ignore"):
            a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
            score = (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))
        yield batch.drop_columns(["a", "b"]).append_column("score", pa.array(score))


def nearest_rows(rows: DataFrame, wanted: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                 many: int = 5, **options) -> DataFrame:
    """(query_id, rank, id, score): for every row of ``wanted``, a subset of rows, its nearest other rows."""
    scratch = Scratch(rows.sparkSession, "neighbours", {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)})
    known = scratch.keep(usable(rows, id_column, vector), "vectors")
    single = isinstance(rows.schema[vector].dataType.elementType, FloatType)
    ids = wanted.select(F.col(id_column).cast("long").alias("id")).distinct()
    found = [_nearest_of(known.where(F.col("size") == size), ids, scratch, single, many, options)
             for size in sorted(r["size"] for r in known.select("size").distinct().collect())]
    scratch.drop(known)
    result = found[0] if found else rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    for more in found[1:]:
        result = result.unionByName(more)
    return result.withColumnRenamed("id", id_column)


def _nearest_of(known: DataFrame, ids: DataFrame, scratch: Scratch, single: bool, many: int, options: dict) -> DataFrame:
    """The result among vectors of one length."""
    nodes = scratch.keep(nodes_of(known, many + 1, single), "nodes")
    graph = build(nodes, scratch, **options)
    asked = known.join(ids, "id").groupBy(F.col("id").alias("query_id"), "direction").agg(F.min("vector").alias("a"))
    asked = scratch.keep(asked.join(nodes.select("direction", F.col("node").alias("query")), "direction").drop("direction"), "asked")
    queries = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node").select(
        F.col("node").alias("query"), "unit", "node")
    beams = search(queries, graph, nodes, scratch)
    order = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    again = beams.withColumn("place", F.row_number().over(order)).where(F.col("place") <= AGAIN).select("query", "node")
    exact = (again.join(nodes.select("node", "rows"), "node")
             .join(asked, "query").select("query", "query_id", "a", F.explode("rows").alias("row"))
             .where("NOT (query_id <=> row.id)")
             .select("query_id", "query", F.col("row.id").alias("id"), "a", F.col("row.vector").alias("b"))
             .mapInArrow(_cosines, "query_id long, query long, id long, score double"))
    of_id = Window.partitionBy("query_id", "query", "id").orderBy(F.desc("score"))
    nearest = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    result = (exact.withColumn("copy", F.row_number().over(of_id)).where(F.col("copy") <= many)
              .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= many)
              .select("query_id", "rank", "id", "score"))
    kept = scratch.keep(result, "nearest")
    scratch.drop(nodes, graph, asked, beams)
    return kept

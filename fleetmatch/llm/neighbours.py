"""Approximate nearest neighbours: NN-descent builds the graph, greedy search walks it.

Equal vectors are one node of the graph with the smallest of their ids; the
others come back when results are put together. The graph begins with exact
neighbours inside small blocks of nodes that share a nearest pivot, and pivots as
neighbours of all. Rings through hash-chosen nodes hold the graph together: they
take part in the first round where a list is not full, and in every search. Each
round joins every node with its neighbours and the nodes
it is a neighbour of, compares those among each other where one of the two is
new, and keeps the ``GRAPH_DEGREE`` nearest of each; rounds end when few lists
change. The comparisons use vectors of 8-bit components with a scale each, so
little is moved; a search measures on the original vectors, in double precision.

A search begins at the nearest and some hash-chosen pivots, and at the query itself if it is a node.
It expands all unexpanded nodes among the ``BEAM`` nearest found, round by round,
until there are none. Queries go through in blocks of bounded size.

Vectors that are null, zero, or hold null or non-finite components take no part,
and neither do those of another length than the most frequent one (of equally
frequent ones, the shortest). Rows with equal id and vector count once; rows with
a null id are left out. If there are fewer candidates than asked for, all of
them are returned: a query that the search leaves with too few is compared with
all nodes. An empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmatch.llm.common import pick, stored

GRAPH_DEGREE = 24
REVERSE = 24           # incoming neighbours that take part in a round
PIVOTS = 256           # sampled nodes; a bounded sample, all nodes are indexed
CELLS = 3              # nearest pivots whose blocks a node joins
BLOCK = 512            # nodes in a block
STOP_SHARE = 0.02      # of list places; fewer changes end the building
MAX_ROUNDS = 12
RINGS = 2              # of about BLOCK hash-chosen nodes that each node lies on
FAR_PIVOTS = 2         # hash-chosen pivots from which a search begins as well
BEAM = 256
QUERY_BLOCK = 4096


def _top(df: DataFrame, key: str, n: int, *order) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits them before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= n).drop("place")


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part, each pair once."""
    rows = pick(df, {"id": id_col, "vector": vector_col}).filter("id is not null and vector is not null")
    rows = rows.filter(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").first()
    return rows.filter(F.size("vector") == (usual["length"] if usual else 0)).distinct()


def _coded(vectors: DataFrame) -> DataFrame:
    """``node`` and ``code``: a scale and the components in 8 bits."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), np.float64)
            scale = np.abs(x).max(axis=1).astype(np.float32)
            scale = np.where(scale > 0, scale, np.float32(1e-38))
            parts = np.clip(np.rint(x / scale[:, None] * 127), -127, 127).astype(np.int8)
            data = np.concatenate([(scale / 127).astype("<f4").view(np.int8).reshape(-1, 4), parts], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in data], pa.binary())],
                                             ["node", "code"])

    return vectors.select("node", "vector").mapInArrow(run, "node bigint, code binary")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _decoded(codes) -> np.ndarray:
    data = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    return data[:, 4:].astype(np.float32) * data[:, :4].copy().view("<f4")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def _blocks(coded: DataFrame, pivots: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Edges of each node to its nearest ones within blocks, and to its nearest pivots."""
    shared = coded.sparkSession.sparkContext.broadcast(pivots)

    def place(batches):
        nodes, matrix = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            far = _squares(_decoded(batch.column(1).to_pylist()), matrix)
            near = np.argsort(far, axis=1, kind="stable")[:, :CELLS]
            count = near.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(near.ravel().astype(np.int32)), pa.array(np.repeat(batch.column(0).to_numpy(), count)),
                batch.column(1).take(pa.array(np.repeat(np.arange(batch.num_rows), count))),
                pa.array(nodes[near].ravel()), pa.array(np.take_along_axis(far, near, 1).ravel().astype(np.float32))],
                ["cell", "node", "code", "pivot", "d"])

    placed = stored(coded.mapInArrow(place, "cell int, node bigint, code binary, pivot bigint, d float"), "cells")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))  # one row per pivot
    parts = F.ceil(F.col("n") / BLOCK).cast("long")
    cells = (placed.join(F.broadcast(sizes), "cell")
             .withColumn("part", F.pmod(F.xxhash64("node", "cell"), parts)))

    def nearest(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = frame["node"].to_numpy()
        x = _decoded(frame["code"].tolist())
        far = _squares(x, x)
        np.fill_diagonal(far, np.inf)
        order = np.argsort(far, axis=1)[:, :min(GRAPH_DEGREE, len(nodes) - 1)]
        return pd.DataFrame({"u": np.repeat(nodes, order.shape[1]), "v": nodes[order].ravel(),
                             "d": np.take_along_axis(far, order, 1).ravel().astype(np.float32)})

    inside = cells.select("cell", "part", "node", "code").groupBy("cell", "part").applyInPandas(
        nearest, "u bigint, v bigint, d float")
    to_pivots = placed.filter("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v"), "d")
    return inside.unionByName(to_pivots)


def _nearest_lists(edges: DataFrame) -> DataFrame:
    """The nearest distinct ``v`` of each ``u``; an edge that was there before is not new."""
    distinct = edges.groupBy("u", "v").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    return _top(distinct, "u", GRAPH_DEGREE, "d", "v")


def _round(graph: DataFrame, coded: DataFrame, blocks: int, turn: int) -> DataFrame:
    """Edges found by comparing the neighbours of each node among each other."""
    reverse = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "new")
    reverse = _top(reverse, "u", REVERSE, F.desc("new"), F.xxhash64("u", "v", F.lit(turn)))
    around = graph.select("u", "v", "new").unionByName(reverse)
    around = around.groupBy("u", "v").agg(F.max("new").alias("new"))
    around = around.withColumn("active", F.max("new").over(Window.partitionBy("u"))).filter("active = 1")
    worst = graph.groupBy("u").agg(F.max("d").alias("worst"), F.count("*").alias("n"))
    known = coded.join(worst, F.col("u") == F.col("node"), "left").select(
        F.col("node").alias("v"), "code",
        F.when(F.col("n") == GRAPH_DEGREE, F.col("worst")).otherwise(float("inf")).cast("float").alias("worst"))
    rows = around.join(known, "v").select(F.pmod(F.xxhash64("u"), F.lit(blocks)).alias("block"),
                                          "u", "v", "new", "code", "worst")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["u", "new"], ascending=[True, False], kind="stable")
        us, vs = frame["u"].to_numpy(), frame["v"].to_numpy()
        new, worst, x = frame["new"].to_numpy(), frame["worst"].to_numpy(), _decoded(frame["code"].tolist())
        starts = np.flatnonzero(np.diff(us, prepend=us[:1] - 1))
        found = []
        for begin, end in zip(starts, [*starts[1:], len(us)]):
            fresh = begin + int(new[begin:end].sum())
            far = _squares(x[begin:fresh], x[begin:end]).astype(np.float32)
            np.fill_diagonal(far, np.inf)
            limit_new, limit_all = worst[begin:fresh, None], worst[begin:end]
            for i, j, turned in ((*np.nonzero(far < limit_new), False), (*np.nonzero(far < limit_all), True)):
                a, b = vs[begin + i], vs[begin + j]
                found.append((b, a, far[i, j]) if turned else (a, b, far[i, j]))
        columns = [np.concatenate(part) for part in zip(*found)] if found else [[], [], []]
        edges = pd.DataFrame({"u": columns[0], "v": columns[1], "d": columns[2]})
        return edges.drop_duplicates(["u", "v"])

    return rows.groupBy("block").applyInPandas(compare, "u bigint, v bigint, d float")


def _rings(coded: DataFrame, count: int) -> DataFrame:
    """``u``, ``v``: for each node the next ones on its rings, which overlap at random."""
    parts = -(-count // BLOCK) or 1
    links = None
    for turn in range(RINGS if parts > 1 else 1):
        rows = coded.select(F.col("node").alias("u"), F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(parts)).alias("ring"))
        whole = Window.partitionBy("ring").orderBy(F.xxhash64("u", F.lit(turn)), "u")
        after = F.coalesce(F.lead("u").over(whole),
                           F.first("u").over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        ring = rows.select("u", after.alias("v")).filter("u <> v")
        links = ring if links is None else links.unionByName(ring)
    return links.distinct()


def build_graph(coded: DataFrame, pivots: tuple[np.ndarray, np.ndarray], count: int) -> DataFrame:
    """``u``, ``v``: the nearest found of each node, and its rings."""
    rings = stored(_rings(coded, count), "rings")
    first = _blocks(coded, pivots).unionByName(rings.withColumn("d", F.lit(float("inf")).cast("float")))
    graph = stored(_nearest_lists(first.withColumn("new", F.lit(1))), "graph")
    blocks = -(-count // (BLOCK // 2))
    for turn in range(MAX_ROUNDS):
        found = _round(graph, coded, blocks, turn).withColumn("new", F.lit(1))
        graph = stored(_nearest_lists(graph.withColumn("new", F.lit(0)).unionByName(found)), "graph")
        changed = graph.agg(F.sum("new")).first()[0] or 0
        if changed <= STOP_SHARE * GRAPH_DEGREE * count:
            break
    return graph.select("u", "v").unionByName(rings)


def _query_blocks(queries: DataFrame) -> Iterator[pd.DataFrame]:
    """The distinct query nodes with their vectors, a bounded number at a time."""
    total = queries.count()
    blocks = -(-total // QUERY_BLOCK)
    for block in range(blocks):
        yield queries.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block).toPandas()


def search(queries: DataFrame, vectors: DataFrame, graph: DataFrame, pivots: tuple[np.ndarray, np.ndarray],
           beam: int = BEAM, is_node: bool = True) -> DataFrame:
    """``q``, ``w``, ``first``, ``d``: the nearest nodes found for each query (``q``, ``vector``), with their distances.

    ``vectors`` has each node's smallest id as ``first``; of nodes at one distance the smaller comes first.
    ``is_node`` says that ``q`` is the query's own node, from which it then begins too.
    """
    spark = vectors.sparkSession
    around = stored(graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "around")
    kind = f"q bigint, w bigint, first {vectors.schema['first'].dataType.simpleString()}, d double"
    results = None
    for block in _query_blocks(queries):
        ids = block["q"].to_numpy(np.int64)
        order = np.argsort(ids)
        ids, matrix = ids[order], np.array(block["vector"].tolist(), np.float64).reshape(len(ids), -1)[order]
        shared = spark.sparkContext.broadcast((ids, matrix))

        def measure(batches, shared=shared):
            ids, matrix = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                q, x = batch.column(0).to_numpy(), _matrix(batch.column(3), np.float64)
                d = np.sqrt(((matrix[np.searchsorted(ids, q)] - x) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(d)], ["q", "w", "first", "d"])

        def measured(pairs):
            joined = pairs.join(vectors.withColumnRenamed("node", "w"), "w").select("q", "w", "first", "vector")
            return joined.mapInArrow(measure, kind).withColumn("done", F.lit(0))

        nodes, places = pivots
        near = np.argsort(_squares(matrix.astype(np.float32), places), axis=1)[:, :CELLS]
        far = ids[:, None] * 2654435761 % 4294967291 // 65536 + np.arange(FAR_PIVOTS) * max(len(nodes) // FAR_PIVOTS, 1)
        near = np.concatenate([near, far % max(len(nodes), 1)], axis=1)
        pairs = [(int(q), int(nodes[w])) for q, row in zip(ids, near) for w in row]
        if is_node:
            pairs += [(int(q), int(q)) for q in ids]
        begin = spark.createDataFrame(pairs, "q bigint, w bigint").distinct()
        state = stored(_top(measured(begin), "q", beam, "d", "first", "w"), "beam")
        while not state.filter("done = 0").isEmpty():
            frontier = state.filter("done = 0").select("q", F.col("w").alias("u"))
            fresh = (frontier.join(around, "u").select("q", F.col("v").alias("w")).distinct()
                     .join(state.select("q", "w"), ["q", "w"], "left_anti"))
            state = state.withColumn("done", F.lit(1)).unionByName(measured(fresh))
            state = stored(_top(state, "q", beam, "d", "first", "w"), "beam")
        part = state.select("q", "w", "first", "d")
        results = part if results is None else results.unionByName(part)
    return results if results is not None else spark.createDataFrame([], kind)


def exact_search(queries: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """``q``, ``w``, ``d``: the ``n`` nearest nodes of each query, and more at the same distances, by comparing with all."""
    spark = vectors.sparkSession
    results = spark.createDataFrame([], "q bigint, w bigint, d double")
    for block in _query_blocks(queries):
        shared = spark.sparkContext.broadcast((block["q"].tolist(), np.array(block["vector"].tolist(), np.float64)))

        def compare(batches, shared=shared):
            for batch in batches:
                if not batch.num_rows:
                    continue
                nodes, x = batch.column(0).to_numpy(), _matrix(batch.column(1), np.float64)
                for q, vector in zip(*shared.value):
                    d = np.sqrt(((x - vector) ** 2).sum(axis=1))
                    near = np.flatnonzero(d <= np.partition(d, min(n, len(d)) - 1)[min(n, len(d)) - 1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), q)), pa.array(nodes[near]),
                                                      pa.array(d[near])], ["q", "w", "d"])

        results = results.unionByName(vectors.select("node", "vector").mapInArrow(compare, "q bigint, w bigint, d double"))
    return results


def nearest_neighbours(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id``, ``score`` (Euclidean distance): the ``k`` nearest found to each query row.

    ``is_query`` is a condition on ``id``. A row is not its own neighbour; ties go to the smaller id.
    """
    rows = stored(usable_vectors(df, id_col, vector_col), "vectors")
    # Of a vector's ids only the k + 1 smallest can be among the k nearest to a query with another id.
    smallest = _top(rows, "vector", k + 1, "id")
    nodes = smallest.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "vector", "ids"), "nodes")
    count = nodes.count()
    coded = stored(_coded(nodes), "codes")
    sample = coded.orderBy(F.xxhash64("node"), "node").limit(PIVOTS).toPandas()
    pivots = (sample["node"].to_numpy(np.int64), _decoded(sample["code"].tolist()) if count else np.zeros((0, 0)))
    graph = build_graph(coded, pivots, count)

    asked = stored(rows.filter(is_query).join(nodes, "vector").select("id", F.col("node").alias("q")), "queries")
    vectors = nodes.select("node", "vector", F.element_at("ids", 1).alias("first"))
    queries = asked.select("q").distinct().join(vectors, F.col("q") == F.col("node")).select("q", "vector")
    found = search(queries, vectors, graph, pivots, max(BEAM, k + 1)).select("q", "w", "first", "d")
    met = found.groupBy("q").agg(F.count("*").alias("n"))
    few = stored(queries.join(met, "q", "left").filter(F.coalesce("n", F.lit(0)) < min(k + 1, count)).select("q", "vector"),
                 "few")
    if not few.isEmpty():
        found = found.join(few.select("q"), "q", "left_anti").unionByName(
            exact_search(few, vectors, k + 1).join(vectors.select(F.col("node").alias("w"), "first"), "w"))
    found = _top(found, "q", k + 1, "d", "first", "w")  # at most one of these nodes holds nothing but the query
    candidates = (found.join(nodes.select(F.col("node").alias("w"), "ids"), "w")
                  .select("q", "d", F.explode("ids").alias("other")))
    results = (asked.join(candidates, "q").filter("other <> id")
               .withColumn("rank", F.row_number().over(Window.partitionBy("id", "q").orderBy("d", "other")))
               .filter(F.col("rank") <= k))
    return results.select(F.col("id").alias("query_id"), "rank", F.col("other").alias("id"), F.col("d").alias("score"))


def neighbour_digest(df: DataFrame) -> DataFrame:
    """The contract's rows: the 10 nearest of each row whose id is divisible by 100."""
    return nearest_neighbours(df, F.col("id") % 100 == 0, 10).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")

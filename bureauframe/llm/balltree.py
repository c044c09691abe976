"""Exact top-k inner products by ball trees, one for each shard of the rows.

A node is a ball (centre and radius) around its rows, so no row of it scores above
q.centre + |q| * radius. A block of queries walks a tree best bound first and leaves out, query by
query, the nodes that cannot beat the current k-th score.

Rows are sharded by cells around centres learned from a bounded sample, so that shards lie apart. A
query searches one shard of its most promising cell first, then the next cells in the order of their
bounds, then all others; before each round the cells whose ball cannot beat its k-th score so far are
dropped, and neither the query nor a tree travels for them. Centres and rounds decide the work only,
never the result.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import durable, importable, partitions
from bureauframe.llm.vectors import TOP, best, is_query, matrix, usable

SCALE = 64
SHARD_ROWS = 4_096
BLOCK_QUERIES = 4_096  #: queries that meet a tree together, about
CELLS = 256  #: most cells; of all rows, the driver and the workers hold their balls only
CELL_SAMPLE = 32  #: rows for each cell that its centre is learned from, about
WAVE = 8  #: cells of a query's second round
TASKS = 32  #: most tasks of a round, times the shuffle partitions
SEED = 11
LEAF_ROWS = 64
_EXACT = 2**52  #: integers below this are exact in double precision
_NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Tree:
    """Rows in tree order, so that a node is a range of them. children is -1 for leaves."""

    ids: np.ndarray
    rows: np.ndarray
    start: np.ndarray
    end: np.ndarray
    children: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def build(ids: np.ndarray, rows: np.ndarray) -> Tree:
    """Split at the median of the direction between two far points until a node is a leaf. Equal
    rows split too, so the depth is logarithmic whatever the data."""
    order = np.argsort(ids, kind="stable")
    x = rows.astype(np.float64)
    start, end, children, centre, radius = [], [], [], [], []
    waiting = [(0, len(ids), -1, 0)]
    while waiting:
        lo, hi, parent, side = waiting.pop()
        node = len(start)
        if parent >= 0:
            children[parent][side] = node
        own = x[order[lo:hi]]
        mid = own.mean(axis=0)
        away = np.sqrt(((own - mid) ** 2).sum(axis=1))
        start.append(lo)
        end.append(hi)
        centre.append(mid)
        radius.append(float(away.max()))
        children.append([-1, -1])
        if hi - lo > LEAF_ROWS:
            far = own[np.argmax(away)]
            axis = far - own[np.argmax(((own - far) ** 2).sum(axis=1))]
            order[lo:hi] = order[lo:hi][np.argsort(own @ axis, kind="stable")]
            cut = (lo + hi) // 2
            waiting += [(cut, hi, node, 1), (lo, cut, node, 0)]
    return Tree(
        ids[order], rows[order], np.array(start), np.array(end), np.array(children), np.array(centre), np.array(radius)
    )


def search(tree: Tree, own: np.ndarray, queries: np.ndarray, floor: np.ndarray):
    """The TOP best rows of each query that reach its `floor`: (row of the query, id, score).

    Scores and ids are held in one integer, score * n + (n - 1 - rank of the id), whose order is
    the order of the result.
    """
    n = len(tree.ids)
    largest = int(np.abs(tree.rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * queries.shape[1]
    if largest >= min(_EXACT, 2**62 // n):
        return _plain(tree, own, queries, floor)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), tree.ids))] = np.arange(n)
    x, q = tree.rows.astype(np.float64), queries.astype(np.float64)
    length = np.sqrt((q**2).sum(axis=1))
    top = np.full((len(q), TOP), _NONE)
    kth = floor.astype(np.float64)  # of the scores alone
    slack = 1e-9 * (1 + largest)
    heap = [(0.0, 0, np.arange(len(q)))]
    while heap:
        _, node, active = heapq.heappop(heap)
        bound = q[active] @ tree.centre[node] + length[active] * tree.radius[node] + slack
        active = active[bound >= kth[active]]
        if not len(active):
            continue
        if tree.children[node][0] >= 0:
            for child in tree.children[node]:
                bound = q[active] @ tree.centre[child] + length[active] * tree.radius[child]
                heapq.heappush(heap, (-float((bound - kth[active]).max()), int(child), active))
            continue
        lo, hi = tree.start[node], tree.end[node]
        score = (q[active] @ x[lo:hi].T).astype(np.int64)
        key = score * n + (n - 1 - rank[lo:hi])
        key[(own[active][:, None] == tree.ids[lo:hi]) | (score < floor[active][:, None])] = _NONE
        both = np.concatenate([top[active], key], axis=1)
        top[active] = both = np.partition(both, both.shape[1] - TOP, axis=1)[:, -TOP:]
        least = both.min(axis=1)
        kth[active] = np.maximum(kth[active], np.where(least == _NONE, -np.inf, least // n))
    at, col = np.nonzero(top != _NONE)
    key = top[at, col]
    by_rank = np.sort(tree.ids)
    return at, by_rank[n - 1 - key % n], key // n


def _plain(tree: Tree, own: np.ndarray, queries: np.ndarray, floor: np.ndarray):
    """Components too large for double precision: Python integers, no bounds."""
    at, ids, scores = [], [], []
    rows = [r.tolist() for r in tree.rows]
    for i, q in enumerate(queries.tolist()):
        found = [
            (-sum(a * b for a, b in zip(q, row, strict=True)), int(v))
            for v, row in zip(tree.ids, rows, strict=True)
            if v != own[i]
        ]
        for score, vec in sorted(found)[:TOP]:
            if -score >= floor[i]:
                at.append(i)
                ids.append(vec)
                scores.append(-score)
    return np.array(at, np.int64), np.array(ids, np.int64), np.array(scores, np.int64)


def _small(rows: np.ndarray) -> np.ndarray:
    most = int(np.abs(rows).max(initial=0))
    return rows.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of at most `cells` cells, by a few rounds of k-means from evenly spaced rows."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    x = sample.astype(np.float64)
    out = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(6):
        own = nearest(x, out)
        sizes = np.bincount(own, minlength=len(out))
        sums = np.zeros_like(out)
        np.add.at(sums, own, x)
        out = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], out)
    return out


def nearest(x: np.ndarray, middles: np.ndarray) -> np.ndarray:
    return np.argmin((middles**2).sum(axis=1) - 2 * (x @ middles.T), axis=1)


def bounds(queries: np.ndarray, middles: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """What no row of a cell scores above, for each query and cell; -inf for cells without rows."""
    length = np.sqrt((queries**2).sum(axis=1))[:, None]
    slack = 1e-9 * (1 + length * (np.sqrt((middles**2).sum(axis=1)) + np.maximum(reach, 0)))
    return np.where(reach >= 0, queries @ middles.T + length * reach + slack, -np.inf)


def blocks_of(asked: dict[int, int], pieces: dict[int, int], one_piece: bool) -> tuple[dict[int, int], int]:
    """Blocks of queries for each cell that `asked` queries go to, and the pairs of block and tree."""
    size = {c: BLOCK_QUERIES * (pieces[c] if one_piece else 1) for c in asked}
    blocks = {c: -(-n // size[c]) for c, n in asked.items()}
    return blocks, sum(n * pieces[c] for c, n in blocks.items())


def _lookup(values: dict[int, int]):
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col("cell")]


RESULT = "query_id long, vec_id long, score long"


def search_all(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the exact TOP of every query over all shards.

    Components are floor(64 * x). A query sees no row with its own vec_id. Rows that `usable`
    leaves out take no part; zero vectors do. Query rows that share a vec_id share its TOP. Scores
    must fit a long.
    """
    spark = vectors.sparkSession
    integers = F.transform("v", lambda x: F.floor(x * SCALE).cast("long"))
    rows = durable(usable(importable(vectors), zero=True).select("vec_id", integers.alias("v")))
    total = rows.count()
    cells = min(CELLS, max(1, -(-total // SHARD_ROWS)))
    drawn = int(min(1.0, CELL_SAMPLE * cells / max(1, total)) * (1 << 30))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30)) < drawn).toArrow()
    order = np.argsort(sample.column("vec_id").to_numpy(), kind="stable")
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if len(order):
        learned = centres(matrix(sample.column("v"))[order], cells)
    else:
        learned = np.zeros((1, len(rows.first()["v"])))
    shared = spark.sparkContext.broadcast(learned)

    def celled(batches):
        for batch in batches:
            if batch.num_rows:
                own = nearest(matrix(batch.column("v")), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())], ["vec_id", "v", "cell"])

    def planted(key: tuple, own: pa.Table) -> pa.Table:
        x = matrix(own.column("v"), np.int64)
        away = np.sqrt(((x - shared.value[key[0].as_py()]) ** 2).sum(axis=1))
        tree = pickle.dumps(build(own.column("vec_id").to_numpy(), _small(x)))
        return pa.table(
            {"cell": pa.array([key[0].as_py()], pa.int32()), "piece": pa.array([key[1].as_py()], pa.int32()),
             "reach": [float(away.max())], "tree": pa.array([tree], pa.binary())}
        )

    placed = durable(rows.mapInArrow(celled, "vec_id long, v array<long>, cell int"))
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # CELLS rows
    pieces = {c: -(-n // SHARD_ROWS) for c, n in sizes.items()}
    piece = F.pmod(F.xxhash64("vec_id"), _lookup(pieces)).cast("int")
    trees = placed.withColumn("piece", piece).groupBy("cell", "piece")
    trees = durable(trees.applyInArrow(planted, "cell int, piece int, reach double, tree binary"))
    reach = np.full(len(learned), -1.0)
    for r in trees.groupBy("cell").agg(F.max("reach").alias("reach")).collect():  # CELLS rows
        reach[r["cell"]] = r["reach"]

    def routed(first: int, last: int):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                q, floor = matrix(batch.column("v")), batch.column("floor").to_numpy().astype(np.float64)
                most = bounds(q, shared.value, reach)
                order = np.argsort(-most, axis=1, kind="stable")
                alive = (most >= floor[:, None]) & (most > -np.inf)
                to = [row[live[row]].tolist() for row, live in zip(order[:, first:last], alive, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(order[:, 0], pa.int32()), pa.array(to, pa.list_(pa.int32()))],
                    ["vec_id", "v", "floor", "home", "cells"],
                )

        return run

    def packed(key: tuple, own: pa.Table) -> pa.Table:
        columns = [own.column(c).to_numpy() for c in ("vec_id", "floor", "skip")]
        block = pickle.dumps((*columns, _small(matrix(own.column("v"), np.int64))))
        return pa.table(
            {"cell": pa.array([key[0].as_py()], pa.int32()), "piece": pa.array([key[1].as_py()], pa.int32()),
             "block": pa.array([key[2].as_py()], pa.int32()), "queries": pa.array([block], pa.binary())}
        )

    def walk(batches):
        for batch in batches:
            for piece, tree, queries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, floor, skip, q = pickle.loads(queries)
                use = skip != piece
                at, ids, scores = search(pickle.loads(tree), own[use], q[use], floor[use])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[use][at]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"]
                )

    def visit(queries: DataFrame, first: int, last: int, one_piece: bool) -> DataFrame | None:
        """Search the cells `first` to `last` of each query's order: one piece of the home cell, or
        all pieces but that one."""
        schema = "vec_id long, v array<long>, floor long, home int, cells array<int>"
        routes = durable(queries.select("vec_id", "v", "floor").mapInArrow(routed(first, last), schema))
        counts = routes.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()  # CELLS rows
        if not counts:
            return None
        blocks, pairs = blocks_of({r["cell"]: r["count"] for r in counts}, pieces, one_piece)
        own = F.pmod(F.xxhash64("vec_id", F.lit(2)), _lookup(pieces)).cast("int")
        asked = routes.withColumn("cell", F.explode("cells")).withColumn(
            "block", F.pmod(F.xxhash64("vec_id", F.lit(1)), _lookup(blocks)).cast("int")
        )
        if one_piece:
            asked = asked.select("vec_id", "v", "floor", "cell", "block", own.alias("piece"), F.lit(-1).alias("skip"))
        else:
            skip = F.when(F.col("cell") == F.col("home"), own).otherwise(-1)
            asked = asked.select("vec_id", "v", "floor", "cell", "block", F.lit(-1).alias("piece"), skip.alias("skip"))
        keys = ["cell", "piece", "block"]
        packs = asked.groupBy(*keys).applyInArrow(packed, "cell int, piece int, block int, queries binary")
        if not one_piece:
            packs = packs.withColumn("piece", F.explode(F.sequence(F.lit(0), _lookup(pieces) - 1)))
        here = trees.filter(_lookup(blocks).isNotNull())
        here = here.withColumn("block", F.explode(F.sequence(F.lit(0), _lookup(blocks) - 1)))
        tasks = min(pairs, TASKS * partitions(spark))
        both = packs.repartition(tasks, *keys).join(here.repartition(tasks, *keys), keys)
        return both.select("piece", "tree", "queries").mapInArrow(walk, RESULT)

    queries = rows.filter(is_query()).withColumn("floor", F.lit(_NONE))
    found = visit(queries, 0, 1, True)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for first, last in ((0, WAVE), (WAVE, len(learned))):
        if first >= len(sizes):
            break
        found = durable(best(found, "long")).drop("rank")
        kth = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= TOP, F.min("score")).alias("kth"))
        floors = rows.filter(is_query()).join(kth, F.col("vec_id") == F.col("query_id"), "left")
        more = visit(floors.withColumn("floor", F.coalesce("kth", F.lit(_NONE))), first, last, False)
        if more is not None:
            found = found.unionByName(more)
    return best(found, "long")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""

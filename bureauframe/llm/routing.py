"""Approximate nearest neighbours by learned partitions.

On a bounded sample: a neighbour graph, a balanced partition of it, and a small classifier that is
trained to say in which parts a vector's neighbours lie. The classifier files every row under one
part and routes each query to its most probable parts, whose rows are then scored exactly. How many
parts a query visits is measured on the part of the sample kept from training.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import durable, importable
from bureauframe.llm.vectors import TOP, best, is_query, matrix, usable

SAMPLE = 6_144  #: rows the partitions are learned from, about, at least
SAMPLE_A_PART = 24  #: and of these for each part, at least
HELD_OUT = 1 / 3  #: of the sample, to measure recall
NEIGHBOURS = 10
ROWS_A_PART = 4_096
PARTS = (8, 1_024)  #: fewest and most
SLACK = 1.05  #: largest part, times the mean
HIDDEN = 128
EPOCHS = 30
RECALL = 0.95  #: aimed at on the held-out part; neighbours lie closer in the whole table
CELL_ROWS = 8_192  #: a part is searched in cells of about this many rows
BLOCK_QUERIES = 4_096  #: and about this many queries
SEED = 7


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """For each row the k others with the largest inner product."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 1024):
        scores = x[i : i + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(i, i + len(scores))] = -np.inf
        out[i : i + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def partition(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Balanced parts (a power of two) of a neighbour graph that cut few of its edges: halve along
    the widest direction, then move nodes to the part most of their neighbours are in, while no
    part outgrows SLACK times the mean."""
    label = np.zeros(len(x), np.int64)
    for level in range(parts.bit_length() - 1):
        for part in range(1 << level):
            own = np.flatnonzero(label == part)
            centred = x[own] - x[own].mean(axis=0) if len(own) else x[own]
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1] if len(own) else x[:0]
            order = own[np.argsort(centred @ axis, kind="stable")] if len(own) else own
            label[order[len(order) // 2 :]] += 1 << level
    sizes = np.bincount(label, minlength=parts)
    most = int(np.ceil(SLACK * len(x) / parts))
    both = [[] for _ in range(len(x))]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            both[i].append(j)
            both[j].append(i)
    rng = np.random.default_rng(SEED)
    for _ in range(8):
        moved = 0
        for i in rng.permutation(len(x)).tolist():
            votes = np.bincount(label[both[i]], minlength=parts)
            votes[(sizes >= most) & (np.arange(parts) != label[i])] = -1
            to = int(np.argmax(votes))
            if votes[to] > votes[label[i]]:
                sizes[label[i]] -= 1
                sizes[to] += 1
                label[i] = to
                moved += 1
        if moved < len(x) // 200:
            break
    return label


@dataclass(frozen=True)
class Router:
    """One hidden layer from vectors to log-probabilities of parts, and how many to visit."""

    layers: tuple[np.ndarray, ...]
    probes: int
    parts: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train(x: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cross-entropy against the share of each row's neighbours in each part, by Adam."""
    rng = np.random.default_rng(SEED)
    d, parts = x.shape[1], wanted.shape[1]
    scale = 1 / max(1e-12, float(np.sqrt((x**2).mean() * d)))
    layers = [rng.normal(0, scale * np.sqrt(2), (d, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    rates = [0.003 * scale, 0.003, 0.003, 0.003]
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            step += 1
            hidden = np.maximum(x[at] @ layers[0] + layers[1], 0)
            out = hidden @ layers[2] + layers[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - wanted[at]) / len(at)
            back = (error @ layers[2].T) * (hidden > 0)
            grads = [x[at].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                gain = first[k] / (1 - 0.9**step)
                layers[k] -= rates[k] * gain / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def fit(sample: np.ndarray, parts: int) -> Router:
    """A router from sample rows, in any fixed order. Fewer parts if some would have under four rows
    to learn from; a single one, hence exact search, if there are too few rows for PARTS[0]."""
    keep = np.random.default_rng(SEED).random(len(sample)) >= HELD_OUT
    x, test = sample[keep], sample[~keep]
    k = min(NEIGHBOURS, len(x) - 1)
    while parts > PARTS[0] and len(x) < 4 * parts:
        parts //= 2
    if k < 1 or len(test) <= TOP or len(x) < 4 * parts:
        d = sample.shape[1] if sample.size else 1
        return Router((np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1, 1)
    graph = neighbours(x, k)
    label = partition(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), k), label[graph].ravel()), 1 / (k + 1))
    wanted[np.arange(len(x)), label] += 1 / (k + 1)
    router = Router(train(x, wanted), parts, parts)
    logits = router.logits(test)
    place = np.argsort(np.argsort(-logits, axis=1, kind="stable"), axis=1)
    home = np.argmax(logits, axis=1)
    visits = place[np.arange(len(test))[:, None], home[neighbours(test, TOP)]]
    share = [float((visits < p).mean()) for p in range(1, parts + 1)]
    return Router(router.layers, next(p for p, s in enumerate(share, 1) if s >= RECALL), parts)


def learn(rows: DataFrame) -> tuple[Router, int]:
    """A router for `rows` (vec_id, v) and their number. About SAMPLE rows, or SAMPLE_A_PART for each
    part if that is more, chosen by a hash of vec_id, come to the driver; PARTS bounds both."""
    total = rows.count()
    power = int(round(np.log2(max(1, total) / ROWS_A_PART)))
    parts = min(PARTS[1], max(PARTS[0], 1 << max(0, power)))
    rate = min(1.0, max(SAMPLE, SAMPLE_A_PART * parts) / max(1, total))
    chosen = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 20)) < int(rate * (1 << 20))
    sample = rows.filter(chosen).toArrow()
    order = np.argsort(sample.column("vec_id").to_numpy(), kind="stable")
    x = matrix(sample.column("v"))[order]
    return fit(x, parts), total


def scored(queries: np.ndarray, ids: np.ndarray, x: np.ndarray, own: np.ndarray):
    """For each query the TOP rows by inner product, ties to the smaller id, its own id left out:
    (row of the query, id, score). A matrix product finds candidates with a margin for rounding;
    the scores that count are summed row by row, alike for equal vectors."""
    rough = queries @ x.T
    rough[own[:, None] == ids[None, :]] = -np.inf
    k = min(TOP, len(ids))
    kth = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
    size = np.abs(queries).max(axis=1) * max(1e-300, np.abs(x).max()) * x.shape[1]
    at, row = np.nonzero((rough >= (kth - 1e-12 * size)[:, None]) & (rough > -np.inf))
    score = np.empty(len(at))
    for i in range(0, len(at), 65_536):
        score[i : i + 65_536] = (queries[at[i : i + 65_536]] * x[row[i : i + 65_536]]).sum(axis=1)
    order = np.lexsort((ids[row], -score, at))
    at, row, score = at[order], row[order], score[order]
    first = np.searchsorted(at, at)
    kept = np.arange(len(at)) - first < TOP
    return at[kept], ids[row[kept]], score[kept]


def blocks_of(visits: dict[int, int]) -> dict[int, int]:
    """Blocks of queries for each part, from the number of queries routed to it."""
    return {part: -(-n // BLOCK_QUERIES) for part, n in visits.items()}


def search(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every query, nearest first.

    A query sees no row with its own vec_id; rows that share a vec_id are candidates each. Rows
    that `usable` leaves out take no part; no rows, no result.
    """
    rows = durable(usable(importable(vectors), zero=False))
    router, _ = learn(rows)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def filed(batches):
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                logits = model.logits(matrix(batch.column("v")))
                parts = pa.array(np.argmax(logits, axis=1), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, parts], ["vec_id", "v", "part"])

    def routed(batches):
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-model.logits(matrix(batch.column("v"))), axis=1, kind="stable")
                parts = pa.array(order[:, : model.probes].tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, parts], ["vec_id", "v", "parts"])

    index = durable(rows.mapInArrow(filed, "vec_id long, v array<double>, part int"))
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # PARTS rows
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cells = F.create_map(*(F.lit(x) for p, n in sizes.items() for x in (p, -(-n // CELL_ROWS))))
    # Stored rows are copied once for each block of the queries that were routed to their part.
    routes = durable(rows.filter(is_query()).mapInArrow(routed, "vec_id long, v array<double>, parts array<int>"))
    to_part = routes.select(F.explode("parts").alias("part")).groupBy("part").count().collect()  # PARTS rows
    visits = {r["part"]: r["count"] for r in to_part if r["part"] in sizes}
    if not visits:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = F.create_map(*(F.lit(x) for p, n in blocks_of(visits).items() for x in (p, n)))[F.col("part")]
    stored = index.filter(blocks.isNotNull()).select(
        "vec_id", "v", "part",
        F.pmod(F.xxhash64("vec_id"), cells[F.col("part")]).cast("int").alias("cell"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
    )
    asked = (
        routes.select("vec_id", "v", F.explode("parts").alias("part"))
        .filter(blocks.isNotNull())
        .select(
            "vec_id", "v", "part",
            F.explode(F.sequence(F.lit(0), cells[F.col("part")] - 1)).alias("cell"),
            F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks).cast("int").alias("block"),
        )
    )

    def compare(asked: pa.Table, stored: pa.Table) -> pa.Table:
        own = asked.column("vec_id").to_numpy()
        ids = stored.column("vec_id").to_numpy()
        queries, x = matrix(asked.column("v")), matrix(stored.column("v"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i in range(0, len(own) if len(ids) else 0, 512):
            at, vec, score = scored(queries[i : i + 512], ids, x, own[i : i + 512])
            found.append((own[i + at], vec, score))
        q, v, s = (np.concatenate([f[k] for f in found]) for k in range(3))
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    keys = ("part", "cell", "block")
    pairs = asked.groupBy(*keys).cogroup(stored.groupBy(*keys))
    found = pairs.applyInArrow(compare, "query_id long, vec_id long, score double")
    return best(found, "double")

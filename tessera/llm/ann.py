"""Approximate nearest neighbours with learned partitions.

On a bounded sample the neighbour graph is cut into balanced parts by recursive bisection (a spectral split at the median,
then swaps that lower the cut), and a small network learns which parts hold a vector's neighbours. Every vector is indexed
in its most probable part; a query goes to the several parts that are most probable for it and all their vectors are
ranked by exact inner product in double precision, ties to the smaller id.

Parts are dealt out in cells of bounded size (by the id's hash), and so are the queries that meet them, so a part that
holds a third of all vectors is many tasks, and a task never holds more than a cell of each. A cell returns its best for
each query, and the best of those are taken by query.

Defined cases: a vector that is null, empty, zero, of another length than most of the sample, or has null or non-finite
components takes no part, nor does a null id; rows that repeat an id count once, with the largest vector; a query goes to
as many parts as hold enough candidates, so it finds all of them if there are fewer than asked for; an empty table gives
an empty result; other columns are not read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import materialise


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the vectors that the index is fitted on; of at most `parts` parts a query searches the most probable
    ones that together reach a probability. That is set so that held-out vectors of the sample find `recall` of their
    `neighbours`, so vectors in clear clusters cost few parts and vectors without structure many."""

    sample: int = 8000
    parts: int = 32
    recall: float = 0.94
    neighbours: int = 20
    hidden: int = 128
    epochs: int = 30
    cell: int = 4096
    query_cell: int = 1024
    least_part: int = 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(n, k) nearest others of each vector by inner product."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        scores = x[at : at + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        out[at : at + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """The part of each node: recursive bisection into halves as even as `parts` allows."""
    n, k = graph.shape
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    edges = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(seed)
    todo = [(np.arange(n), edges, 0, parts)]
    while todo:
        nodes, inner, first, count = todo.pop()
        if count == 1:
            part[nodes] = first
            continue
        left = count // 2
        right = _bisect(len(nodes), inner, round(len(nodes) * left / count), rng)
        for side, start, share in ((~right, first, left), (right, first + left, count - left)):
            number = np.full(len(nodes), -1)
            number[side] = np.arange(side.sum())
            held = number[inner]
            todo.append((nodes[side], held[(held >= 0).all(axis=1)], start, share))
    return part


def _bisect(n: int, edges: np.ndarray, n_left: int, rng: np.random.Generator) -> np.ndarray:
    """True for the right side: the smoothest vector of the graph split at a rank, then swaps of the best pairs."""
    u, v = edges.T if len(edges) else np.zeros((2, 0), np.int64)
    degree = np.bincount(u, minlength=n) + np.bincount(v, minlength=n) + 1.0
    x = rng.normal(size=n)
    for _ in range(60):
        x -= (x @ degree) / degree.sum()
        pushed = (np.bincount(u, x[v], n) + np.bincount(v, x[u], n) + x) / degree
        x = 0.5 * (x + pushed)
        x /= np.abs(x).max() or 1.0
    right = np.ones(n, bool)
    right[np.argsort(x, kind="stable")[:n_left]] = False
    for _ in range(20):  # gain: edges across minus edges within
        across = np.where(right[u] != right[v], 1.0, -1.0)
        gain = np.bincount(u, across, n) + np.bincount(v, across, n)
        from_left, from_right = (np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")] for side in (~right, right))
        m = min(len(from_left), len(from_right), max(1, n // 50))
        good = gain[from_left[:m]] + gain[from_right[:m]] > 2
        if not good.any():
            break
        right[from_left[:m][good]] = True
        right[from_right[:m][good]] = False
    return right


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer from vectors to probabilities of parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    reach: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def routes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parts of each vector, most probable first; the probability of those before)."""
        z = self.logits(x)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        order = np.argsort(-p, axis=1, kind="stable")
        p = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(p, axis=1) - p


def fit_router(x: np.ndarray, soft: np.ndarray, hidden: int, epochs: int, seed: int = 6) -> Router:
    """Cross-entropy to the shares of a vector's neighbourhood in each part."""
    rng = np.random.default_rng(seed)
    scale = 1 / max(float(np.sqrt((x * x).sum(axis=1)).mean()), 1e-12)
    w = [rng.normal(0, 1.5, (x.shape[1], hidden)) * scale, np.zeros(hidden), rng.normal(0, 0.1, (hidden, soft.shape[1])), np.zeros(soft.shape[1])]
    mean, square = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 256):
            some = order[at : at + 256]
            h = np.maximum(x[some] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - soft[some]) / len(some)
            back = (d @ w[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x[some].T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0))):
                mean[i] += 0.1 * (g - mean[i])
                square[i] += 0.01 * (g * g - square[i])
                pace = (0.01 if i > 1 else 0.01 * scale if i == 0 else 0.01) * (1 - epoch / epochs)
                w[i] = w[i] - pace * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-9)
    return Router(*w)


def fit(sample: np.ndarray, parts: int, s: Settings) -> Router | None:
    """None: one part holds everything."""
    if parts < 2 or len(sample) < 4 * parts:
        return None
    x = sample.astype(np.float64)
    graph = neighbour_graph(x, min(s.neighbours, len(x) - 1))
    part = balanced_parts(graph, parts)
    soft = np.zeros((len(x), parts))
    for column in (*graph.T, np.arange(len(x))):
        np.add.at(soft, (np.arange(len(x)), part[column]), 1.0)
    learn = np.arange(len(x)) % 5 != 0
    router = fit_router(x[learn], soft[learn] / soft[learn].sum(axis=1, keepdims=True), s.hidden, s.epochs)
    placed = router.logits(x).argmax(axis=1)
    order, before = router.routes(x[~learn])
    position = np.empty_like(order)
    np.put_along_axis(position, order, np.arange(parts)[None, :].repeat(len(order), axis=0), axis=1)
    # the probability that had been passed when each true neighbour's part came up
    passed = np.take_along_axis(before, np.take_along_axis(position, placed[graph[~learn]], axis=1), axis=1)
    reach = float(np.quantile(passed, s.recall)) + 1e-9
    return Router(router.w1, router.b1, router.w2, router.b2, reach)


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part."""
    e = F.col("embedding")
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    ok = F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, number) & F.exists(e, lambda v: v != 0)
    if dimension is not None:
        ok &= F.size(e) == dimension
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).filter(ok)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64, copy=False)


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its number, ids, scores) of its k best others, best first."""
    rough = queries @ vectors.T
    for i, (q, q_id) in enumerate(zip(queries, query_ids, strict=True)):
        row = np.where(ids == q_id, -np.inf, rough[i])
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            near = np.flatnonzero(row >= least - 1e-9 * (1 + abs(least)) if np.isfinite(least) else row > -np.inf)
        else:
            near = np.flatnonzero(row > -np.inf)
        exact = (vectors[near] * q).sum(axis=1)  # one order of summation, so equal vectors score alike
        order = np.lexsort((ids[near], -exact))[:k]
        yield i, ids[near][order], exact[order]


def search(vectors: DataFrame, is_query: Column, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that `is_query` picks, among all other rows."""
    spark = vectors.sparkSession
    drawn = usable(vectors).orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample).select("embedding").toArrow().column(0).to_pylist()
    dimension = Counter(map(len, drawn)).most_common(1)[0][0] if drawn else 1
    sample = np.array([v for v in drawn if len(v) == dimension], np.float64).reshape(-1, dimension)
    rows = usable(vectors, dimension).groupBy("vec_id").agg(F.max("embedding").alias("embedding"))
    n = usable(vectors, dimension).count()
    parts = max(1, min(settings.parts, n // settings.least_part))
    sent = spark.sparkContext.broadcast(fit(sample, parts, settings))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = sent.value
        for batch in batches:
            x = _matrix(batch.column("embedding"), dimension)
            part = np.zeros(len(x), np.int64) if router is None else router.logits(x).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=["vec_id", "embedding", "part"])

    indexed = materialise(rows.mapInArrow(index, "vec_id long, embedding array<double>, part long"), "index")
    held = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}  # a row for each part
    sizes = np.array([held.get(p, 0) for p in range(parts)])
    n_queries = indexed.filter(is_query).count()
    cells = np.maximum(1, -(-sizes // settings.cell))
    query_cells = max(1, -(-n_queries // settings.query_cell))
    cells_of = F.element_at(F.array(*[F.lit(int(c)) for c in cells]), (F.col("part") + 1).cast("int"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = sent.value
        for batch in batches:
            x = _matrix(batch.column("embedding"), dimension)
            order, before = (np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))) if router is None else router.routes(x)
            few = np.cumsum(sizes[order], axis=1) - sizes[order] <= k  # in the parts before
            take = few | (before < (1.0 if router is None else router.reach))
            who, which = np.nonzero(take)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(who)), batch.column("embedding").take(pa.array(who)), pa.array(order[who, which])], names=["vec_id", "embedding", "part"])

    hashed = lambda count: F.pmod(F.xxhash64("vec_id"), count).cast("int")
    asked = indexed.filter(is_query).select("vec_id", "embedding").mapInArrow(route, "vec_id long, embedding array<double>, part long")
    asked = asked.select("vec_id", "embedding", "part", F.explode(F.sequence(F.lit(0), cells_of - 1)).alias("cell"), hashed(F.lit(query_cells)).alias("query_cell"))
    offered = indexed.select("vec_id", "embedding", "part", hashed(cells_of).alias("cell"), F.explode(F.sequence(F.lit(0), F.lit(query_cells - 1))).alias("query_cell"))
    keys = ["part", "cell", "query_cell"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            q_ids, ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
            q, x = (_matrix(t.column("embedding").combine_chunks(), dimension) for t in (left, right))
            out = [(np.full(len(found), q_ids[i]), found, scores) for i, found, scores in best(q, q_ids, x, ids, k)]
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample: the exact neighbour graph of the sample is cut into parts of equal size
(recursive bisection by the graph's slowest-mixing direction, then swaps between parts that reduce the cut),
and a small neural classifier learns each vector's share of neighbours in every part. Where the table has more than
``LEAF_ROWS`` rows a part, each part is cut again in the same way, by a router fitted on a bounded sample of its own
rows; those are fitted on executors. The number of parts thus grows with the table, to ``MAX_PARTS`` for each of the first 16.

Indexing: the classifiers put every row of the table into its most probable part. Searching: a query is routed
to its most probable parts, by the product of both levels' probabilities, and reranked there by exact cosine in double
precision. How many parts is measured against the whole table: for up to ``ASKED`` sample vectors held out from
fitting, the true neighbours among all rows are found in one pass, and the fewest parts that hold ``TARGET`` of them
are taken. Vectors without any structure need most of the parts; no partition can spare them the work.

Equal vectors are one class, which carries only the smallest ids that an answer could need, so a vector
that is repeated without end costs no more than another. Parts are dealt out in chunks of bounded size,
for queries too, and only each chunk's nearest few are returned: tasks stay bounded and what moves grows with
the number of queries.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components take no
part, nor do those of another length than most; vectors are scaled by a power of two first, so that no square over- or
underflows; ids are whole numbers (others, as of texts that spell none, are refused); null ids take no part; a query's own id is never its answer, nor
are other rows of that id; ties go to the smaller id; with fewer candidates than k all are returned; an
empty table gives none.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import materialise, private

SAMPLE = 4096
PART_ROWS = 128  # of the sample
GRAPH_NEIGHBOURS = 16
TARGET = 0.95
HELD_OUT = 0.2
CHUNK = 4096
#: Rows of a part above which parts are cut again, and most parts that a level has.
LEAF_ROWS = 8192
MAX_PARTS = 64
#: Held-out vectors whose true neighbours in the table are sought.
ASKED = 256


@dataclass
class Router:
    """Classifier weights, and the number of parts."""

    mean: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    @property
    def parts(self) -> int:
        return self.second.shape[1]

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum((unit - self.mean) @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """Indices of each sample vector's k nearest others."""
    out = np.empty((len(unit), k), dtype=np.int64)
    for at in range(0, len(unit), 512):
        near = unit[at : at + 512] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, levels: int, seed: int = 0) -> np.ndarray:
    """Part of each node: 2 ** levels parts whose sizes differ by one at most, few edges between them."""
    rng, n = np.random.default_rng(seed), len(graph)
    part = np.zeros(n, dtype=np.int64)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    for _ in range(levels):
        inside = part[a] == part[b]
        ia, ib = a[inside], b[inside]
        degree = np.bincount(ia, minlength=n) + 1e-9
        sizes = np.bincount(part)
        x = rng.standard_normal(n)
        for _ in range(150):  # lazy random walk, each part's constant direction taken out
            x = 0.5 * x + 0.5 * np.bincount(ia, x[ib], minlength=n) / degree
            x -= (np.bincount(part, x * degree) / np.bincount(part, degree))[part]
            x /= np.sqrt(np.bincount(part, x * x) / sizes + 1e-300)[part]
        order = np.lexsort((x, part))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        high = place - starts[part] >= (sizes[part] + 1) // 2
        for _ in range(20):  # swap pairs across each cut that gain most together
            side = np.where(high, 1.0, -1.0)
            gain = -np.bincount(ia, side[ia] * side[ib], minlength=n)
            moved = False
            for p in range(len(sizes)):
                own = np.nonzero(part == p)[0]
                up, down = own[~high[own]], own[high[own]]
                up, down = up[np.argsort(-gain[up], kind="stable")], down[np.argsort(-gain[down], kind="stable")]
                m = min(len(up), len(down))
                good = int((gain[up[:m]] + gain[down[:m]] > 4).sum() * 0.5)
                if good:
                    high[up[:good]], high[down[:good]], moved = True, False, True
            if not moved:
                break
        part = 2 * part + high
    return part


def train(unit: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 60, seed: int = 0) -> Router:
    """Softmax classifier with one hidden layer, fitted to shares of neighbours by Adam."""
    rng = np.random.default_rng(seed)
    d, parts = unit.shape[1], targets.shape[1]
    mean = unit.mean(axis=0)
    x = unit - mean
    scale = 1 / max(float(x.std()), 1e-12)
    w = [rng.standard_normal((d, hidden)) * math.sqrt(2 / d) * scale, np.zeros(hidden), rng.standard_normal((hidden, parts)) * math.sqrt(1 / hidden), np.zeros(parts)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(x), 128):
            own = order[at : at + 128]
            h = np.maximum(x[own] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            e = (p - targets[own]) / len(own)
            back = (e @ w[2].T) * (h > 0)
            grads, step = [x[own].T @ back, back.sum(axis=0), h.T @ e, e.sum(axis=0)], step + 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                size = (rate * scale if i == 0 else rate)
                w[i] -= size * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-9)
    return Router(mean, *w)


def scaled(v: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, which changes no cosine, with a largest component from 0.5 to 1."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


def units(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def fit(unit: np.ndarray, parts: int, seed: int = 0) -> Router:
    """A router to ``parts`` parts (a power of two) from sample vectors of length one."""
    if len(unit) < 2:
        unit = np.concatenate([unit, unit])
    levels = min(int(math.log2(parts)), int(math.log2(len(unit))))
    graph = neighbour_graph(unit, min(GRAPH_NEIGHBOURS, len(unit) - 1))
    part = balanced_parts(graph, levels, seed)
    targets = np.zeros((len(unit), 2**levels))
    np.add.at(targets, (np.repeat(np.arange(len(unit)), graph.shape[1]), part[graph].reshape(-1)), 1.0)
    np.add.at(targets, (np.arange(len(unit)), part), float(graph.shape[1]) / 2)
    return train(unit, targets / targets.sum(axis=1, keepdims=True), seed=seed)


@dataclass
class Index:
    """A router, and one for each of its parts that is cut again. A leaf's number is its part's times ``width``, and its place there."""

    top: Router
    below: dict[int, Router]

    @property
    def width(self) -> int:
        return max((r.parts for r in self.below.values()), default=1)

    @property
    def leaves(self) -> int:
        return self.top.parts * self.width

    def leaf(self, unit: np.ndarray) -> np.ndarray:
        """The most probable leaf of the most probable part of each vector."""
        part = self.top.scores(unit).argmax(axis=1)
        leaf = part * self.width
        for p in np.unique(part).tolist():
            if p in self.below:
                leaf[part == p] += self.below[p].scores(unit[part == p]).argmax(axis=1)
        return leaf

    def order(self, unit: np.ndarray) -> np.ndarray:
        """All leaves of each vector, the most probable first."""
        logs = np.full((len(unit), self.leaves), -np.inf)
        top = _log_shares(self.top.scores(unit))
        for p in range(self.top.parts):
            own = _log_shares(self.below[p].scores(unit)) if p in self.below else np.zeros((len(unit), 1))
            logs[:, p * self.width : p * self.width + own.shape[1]] = top[:, [p]] + own
        return np.argsort(-logs, axis=1, kind="stable")


def _log_shares(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def build(classes: DataFrame, total: int, *, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> tuple[Index, np.ndarray]:
    """An index fitted to ``classes`` (``cls``, ``v``), and the held-out vectors: ``HELD_OUT`` of the sample, at most ``ASKED``."""
    by_chance = [F.xxhash64("cls", F.lit("sample")), F.col("cls")]

    def share(of: F.Column | int, wanted: int) -> F.Column:  # of rows whose number is ``of``, about ``wanted``
        return F.pmod(by_chance[0], F.lit(1_000_000)) < F.ceil(F.least(F.lit(1.0), F.lit(1.2 * wanted) / of) * 1_000_000)

    chosen = classes.where(share(F.lit(total), sample)).orderBy(F.xxhash64("cls"), "cls").limit(sample)
    held = units(_matrix(chosen.select("v").toArrow().column(0).combine_chunks()))
    asked = min(ASKED, int(HELD_OUT * len(held)))
    asked, unit = held[:asked], held[asked:]
    top = fit(unit, 2 ** max(0, min(int(math.log2(MAX_PARTS)), int(math.log2(max(1.0, len(unit) / PART_ROWS))))))
    cuts = 2 ** max(0, min(int(math.log2(MAX_PARTS)), math.ceil(math.log2(total / (top.parts * leaf_rows)))))
    if cuts == 1:
        return Index(top, {}), asked
    weights = classes.sparkSession.sparkContext.broadcast(top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = weights.value.scores(units(_matrix(batch.column(1)))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=["cls", "v", "part"])

    routed = materialise(classes.select("cls", "v").mapInArrow(route, "cls long, v array<double>, part long"), "routed-vectors")
    sizes = routed.groupBy("part").agg(F.count("*").alias("n"))
    own = F.row_number().over(W.Window.partitionBy("part").orderBy(*by_chance))
    few = routed.join(F.broadcast(sizes), "part").where(share(F.col("n"), sample)).select("part", "v", own.alias("k")).where(F.col("k") <= sample)

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "router": [pickle.dumps(fit(units(_matrix(rows["v"])), cuts))]})

    made = few.select("part", "v").groupBy("part").applyInPandas(fitted, "part long, router binary").collect()  # a router of some 100 kB for each of MAX_PARTS parts
    return Index(top, {r.part: pickle.loads(r.router) for r in made}), asked


def calibrate(index: Index, placed: DataFrame, asked: np.ndarray, target: float, k: int = 5) -> int:
    """Fewest leaves that hold ``target`` of the ``k`` nearest of all ``placed`` rows of each of ``asked``, one pass over them."""
    if not len(asked):
        return index.leaves
    queries = placed.sparkSession.sparkContext.broadcast(asked)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None  # of this task's rows: at most k + 1 for each of ASKED vectors
        for batch in batches:
            if not batch.num_rows:
                continue
            score = queries.value @ units(_matrix(batch.column(0))).T
            leaf = np.broadcast_to(batch.column(1).to_numpy()[None, :], score.shape)
            if best is not None:
                score, leaf = np.concatenate([best[0], score], axis=1), np.concatenate([best[1], leaf], axis=1)
            top = np.argpartition(-score, min(k + 1, score.shape[1]) - 1, axis=1)[:, : k + 1]
            best = np.take_along_axis(score, top, axis=1), np.take_along_axis(leaf, top, axis=1)
        if best is not None:
            n, width = best[0].shape
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n), width)), pa.array(best[0].reshape(-1)), pa.array(best[1].reshape(-1))], names=["q", "score", "leaf"])

    found = placed.select("v", "part").mapInArrow(near, "q long, score double, leaf long")
    rank = F.row_number().over(W.Window.partitionBy("q").orderBy(F.desc("score"), "leaf"))
    found = found.select("q", "leaf", rank.alias("n")).where(F.col("n").between(2, k + 1)).collect()  # at most k for each of ASKED; the first is itself
    if not found:
        return index.leaves
    place = np.argsort(index.order(asked), axis=1)
    depth = sorted(int(place[r.q, r.leaf]) for r in found)
    return depth[math.ceil(target * len(depth)) - 1] + 1


def search(vectors: DataFrame, is_query: F.Column, *, k: int = 5, target: float = TARGET, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, chunk: int = CHUNK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query row's ``k`` nearest found. ``is_query`` is a condition on ``id``."""
    raw = private(vectors, id=id_col, v=vector_col).select(F.col("id").cast("long"), F.col("v").cast("array<double>"))
    sound = F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("v", lambda x: x != 0)
    rows = raw.where(F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("v") == lengths[0]["d"])

    # classes of equal vectors with their smallest ids: k and the query's own; cut down map-side first
    few = F.row_number().over(W.Window.partitionBy("v").orderBy("id"))
    members = rows.distinct().select("id", "v", few.alias("n")).where(F.col("n") <= k + 1)
    classes = materialise(members.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("cls"), "v", "ids"), "vector-classes")

    total = classes.count()
    index, held = build(classes, total, sample=sample, leaf_rows=leaf_rows)
    weights = vectors.sparkSession.sparkContext.broadcast(index)  # at most MAX_PARTS + 1 routers

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights.value.leaf(units(_matrix(batch.column(1)))))], names=["cls", "v", "ids", "part"])

    placed = materialise(classes.mapInArrow(put, "cls long, v array<double>, ids array<long>, part long"), "placed-vectors")
    probes = calibrate(index, placed, held, target, k)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                own = batch.slice(at, 1024)
                order = weights.value.order(units(_matrix(own.column(1))))[:, :probes]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(list(order), pa.list_(pa.int64()))], names=["cls", "v", "parts"])

    asking = rows.where(is_query).select("id", "v").distinct()
    named = materialise(placed.select("cls", "v").join(asking, "v").select("cls", F.col("id").alias("query_id")), "queries")
    asked = placed.join(named.select("cls").distinct(), "cls").select("cls", "v")
    queries = materialise(asked.mapInArrow(routed, "cls long, v array<double>, parts array<long>"), "routed-queries").select("cls", "v", F.explode("parts").alias("part"))

    width = {r[0]: max(1, math.ceil(r[1] / chunk)) for r in placed.groupBy("part").count().collect()}  # a row for each part
    deep = {r[0]: max(1, math.ceil(r[1] / chunk)) for r in queries.groupBy("part").count().collect()}

    def lot(column: F.Column, sizes: dict[int, int]) -> F.Column:
        return F.coalesce(F.element_at(F.lit([sizes.get(i, 1) for i in range(index.leaves)]), (column + 1).cast("int")), F.lit(1))

    spread = lambda n: F.sequence(F.lit(0), (n - 1).cast("int"))
    mark = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    left = placed.where(F.col("part").isin(list(deep)))
    left = left.select("cls", "v", "ids", "part", mark(lot(F.col("part"), width)).alias("a"), F.explode(spread(lot(F.col("part"), deep))).alias("b"))
    right = queries.select(F.col("cls").alias("asked"), F.col("v").alias("w"), F.col("part").alias("part_"), mark(lot(F.col("part"), deep)).alias("b_"), F.explode(spread(lot(F.col("part"), width))).alias("a_"))

    def rerank(ours: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"cls": [], "id": [], "score": []}
        if len(ours) and len(asked):
            x, ids = _matrix(ours["v"]), ours["ids"].to_numpy()
            least = ours["cls"].to_numpy()
            x = scaled(x)
            norms = np.sqrt((x * x).sum(axis=1))
            for at in range(0, len(asked), 256):
                q = scaled(_matrix(asked["w"].iloc[at : at + 256]))
                near = (q @ x.T) / (np.sqrt((q * q).sum(axis=1))[:, None] * norms[None, :])
                top = min(k + 1, len(x))
                edge = -np.partition(-near, top - 1, axis=1)[:, top - 1]
                for row, name, floor in zip(near, asked["asked"].iloc[at : at + 256], edge):
                    at_least = np.nonzero(row >= floor)[0]
                    at_least = at_least[np.lexsort((least[at_least], -row[at_least]))][:top]
                    for j in at_least.tolist():
                        out["cls"] += [name] * len(ids[j])
                        out["id"] += list(ids[j])
                        out["score"] += [float(row[j])] * len(ids[j])
        return pd.DataFrame(out).astype({"cls": "int64", "id": "int64", "score": "float64"})

    found = left.groupBy("part", "a", "b").cogroup(right.groupBy("part_", "a_", "b_")).applyInPandas(rerank, "cls long, id long, score double")
    best = F.row_number().over(W.Window.partitionBy("cls").orderBy(F.desc("score"), "id"))
    short = found.select("cls", "id", "score", best.alias("n")).where(F.col("n") <= k + 1).groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return named.join(short, "cls").select("query_id", F.posexplode(others).alias("at", "hit")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))

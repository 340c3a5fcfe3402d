"""Approximate nearest neighbours with learned partitions (operator 8).

A neighbour graph of a bounded sample is split into balanced parts that cut
few of its edges; a small classifier (one hidden layer) learns to tell a
vector's part from its components. Every row is indexed under the part that
the classifier holds most probable. A query is routed to its several most
probable parts, and everything found there is reranked by exact cosine in
double precision.

The number of parts probed is set while fitting: the fewest that reach
``recall_target`` on sample vectors held out from the fit. The sample is at
most twice ``sample_rows`` distinct vectors (about ``sample_rows`` as a rule),
taken by a hash of id and vector, so model and sample have a fixed bound,
repeated ids or not; the model's arrays alone are broadcast.

Rows of a part and queries routed to it are dealt into blocks, as many as that
part needs, and each pair of blocks is one group of bounded size, so neither a part that a third of all
rows falls into nor a large query set meets in one task. Each group returns
its k best per query.

Defined results: vectors that are null, zero, of another length than most, without an id, or
hold null or non-finite components take no part; ties go to the smaller id; a
query's own id, repeated or not, is never found; with fewer candidates than k
all are returned, for which parts are probed until enough rows are seen; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.llm.common import col, pieces_for, table
from farelane.session import materialize

K = 5
QUERY_EVERY = 50
SAMPLE_ROWS = 8192
ROWS_A_PART = 256  # of the sample
MAX_PARTS = 64
GRAPH_NEIGHBOURS = 10
RECALL_TARGET = 0.95
HIDDEN = 128
EPOCHS = 40
SEED = 7
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 4096


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int, of: np.ndarray | None = None) -> np.ndarray:
    """Numbers of the k nearest rows of ``x`` (unit vectors) by cosine, for each of its rows or of ``of``."""
    q = x if of is None else of
    out = np.empty((len(q), k), np.int64)
    for at in range(0, len(q), 1024):
        sims = q[at:at + 1024] @ x.T
        if of is None:
            sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -2
        out[at:at + 1024] = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int, seed: int = SEED, slack: float = 0.05, passes: int = 8) -> np.ndarray:
    """A part for each node of the graph: grown breadth first to equal sizes, then nodes move where most neighbours are, within the slack."""
    n = len(near)
    links: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(near.tolist()):
        for j in row:
            links[i].append(j)
            links[j].append(i)
    rng = np.random.default_rng(seed)
    part, size, at = np.full(n, -1), -(-n // parts), 0
    left = rng.permutation(n).tolist()
    for p in range(parts):
        todo, grown = [], 0
        while grown < size:
            if at >= len(todo):
                while left and part[left[-1]] >= 0:
                    left.pop()
                if not left:
                    break
                todo.append(left.pop())
            i = todo[at]
            at += 1
            if part[i] >= 0:
                continue
            part[i] = p
            grown += 1
            todo += [j for j in links[i] if part[j] < 0]
        at = 0
    sizes, most = np.bincount(part, minlength=parts), int(size * (1 + slack)) + 1
    for _ in range(passes):
        moved = 0
        for i in rng.permutation(n).tolist():
            votes = np.bincount(part[links[i]], minlength=parts)
            room = sizes < most
            room[part[i]] = True
            best = int(np.argmax(np.where(room, votes, -1)))
            if votes[best] > votes[part[i]]:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 200:
            break
    return part


@dataclass
class Router:
    """The classifier: probable parts of unit vectors, and how many of them to probe."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        """What tasks are sent: plain arrays, which need no class of this package there."""
        return self.w1, self.b1, self.w2, self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return part_scores(self.arrays, x)


def part_scores(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """How probable each part is for unit vectors, higher for more probable."""
    w1, b1, w2, b2 = arrays
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train_router(x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = SEED) -> Router:
    """Fit the classifier to the parts of each vector and of its neighbours (Adam on cross-entropy)."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    p = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    goal = np.zeros((len(x), parts))
    goal[np.arange(len(x)), part] = 0.5
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 0.5 / near.shape[1])
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 3e-3 * (1 - epoch / epochs)
        for at in range(0, len(x), 256):
            i = order[at:at + 256]
            h = np.maximum(x[i] @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            g = (e / e.sum(axis=1, keepdims=True) - goal[i]) / len(i)
            back = (g @ p[2].T) * (h > 0)
            step += 1
            for a, grad in enumerate((x[i].T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m[a] = 0.9 * m[a] + 0.1 * grad
                v[a] = 0.999 * v[a] + 0.001 * grad * grad
                p[a] -= rate * (m[a] / (1 - 0.9**step)) / (np.sqrt(v[a] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def fit(sample: np.ndarray, k: int = K, recall_target: float = RECALL_TARGET, rows_a_part: int = ROWS_A_PART, max_parts: int = MAX_PARTS) -> Router:
    """Parts, classifier and probes from distinct sample vectors; a tiny sample gives one part."""
    x = _unit(np.unique(sample, axis=0)) if len(sample) else sample.reshape(0, 1)
    x = x[np.random.default_rng(SEED).permutation(len(x))]
    parts = min(max_parts, len(x) // rows_a_part)
    if parts < 2:
        d = x.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    held = len(x) // 10
    asked, known = x[:held], x[held:]
    near = neighbour_graph(known, min(GRAPH_NEIGHBOURS, len(known) - 1))
    router = train_router(known, near, balanced_parts(near, parts), parts)
    home = router.scores(known).argmax(axis=1)
    order = np.argsort(-router.scores(asked), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    ranks = np.take_along_axis(place, home[neighbour_graph(known, min(k, len(known)), asked)], axis=1)
    router.probes = next(p for p in range(1, parts + 1) if (ranks < p).mean() >= recall_target)
    return router


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors that take part, in double precision."""
    df = vectors.select(col(id_col).cast("bigint").alias("vec_id"), col(vec_col).cast("array<double>").alias("v"))
    df = df.where("v IS NOT NULL AND vec_id IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)")
    most = df.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return df.where(F.size("v") == (most.d if most else 0))


def _matrix(a: pa.Array) -> np.ndarray:
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1) if len(a) else np.zeros((0, 1))


def _block_search(k: int):
    """A function of a block of rows and a block of queries: each query's k best of the block."""

    def run(_, rows, queries):
        out = {"query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            v, ids = _matrix(rows.column("v")), rows.column("vec_id").to_numpy()
            q, qids = _matrix(queries.column("v")), queries.column("vec_id").to_numpy()
            norm_v, norm_q = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            unit = v / norm_v[:, None]
            for at in range(0, len(q), 256):
                sims = (q[at:at + 256] / norm_q[at:at + 256, None]) @ unit.T
                sims[qids[at:at + 256][:, None] == ids[None, :]] = -9
                floor = np.partition(sims, -min(k, len(v)), axis=1)[:, -min(k, len(v))]
                for i in range(len(sims)):
                    # all that rounding could place among the best, then the exact measure
                    some = np.flatnonzero((sims[i] >= floor[i] - 1e-9) & (sims[i] > -5))
                    score = (v[some] * q[at + i]).sum(axis=1) / (norm_v[some] * norm_q[at + i])
                    best = np.lexsort((ids[some], -score))[:k]
                    out["query_id"] += [qids[at + i]] * len(best)
                    out["vec_id"] += ids[some][best].tolist()
                    out["score"] += score[best].tolist()
        return pa.table([pa.array(out["query_id"], pa.int64()), pa.array(out["vec_id"], pa.int64()), pa.array(out["score"], pa.float64())], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, sample_rows: int = SAMPLE_ROWS, recall_target: float = RECALL_TARGET, **blocks) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for rows (vec_id, v) for which ``is_query`` holds."""
    spark = vectors.sparkSession
    vectors = materialize(vectors)
    n = vectors.count()
    # by id and content, equal vectors once, and never more than the bound, whatever is repeated
    one_in = pieces_for(n, sample_rows)
    some = vectors.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(one_in)) == 0).select("v").distinct()
    sample = some.orderBy(F.xxhash64("v"), "v").limit(2 * sample_rows).toArrow().column("v")
    router = fit(_matrix(sample), k, recall_target)
    sent, probes = spark.sparkContext.broadcast(router.arrays), router.probes

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = part_scores(sent.value, _unit(_matrix(b.column(1)))).argmax(axis=1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(part, pa.int32())], ["vec_id", "v", "part"])

    indexed = materialize(vectors.select("vec_id", "v").mapInArrow(home, "vec_id bigint, v array<double>, part int"))
    sizes = np.zeros(router.parts, np.int64)
    for r in indexed.groupBy("part").count().collect():
        sizes[r.part] = r["count"]

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            order = np.argsort(-part_scores(sent.value, _unit(_matrix(b.column(1)))), axis=1, kind="stable")
            seen = np.cumsum(sizes[order], axis=1)
            need = np.maximum(probes, (seen <= k).sum(axis=1) + 1)  # enough parts for k rows beside its own
            probed = np.arange(order.shape[1])[None, :] < need[:, None]
            row, at = np.nonzero(probed)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(order[row, at], pa.int32())], ["vec_id", "v", "part"])

    queries = materialize(indexed.where(is_query).select("vec_id", "v").mapInArrow(routes, "vec_id bigint, v array<double>, part int"))
    asked = np.zeros(router.parts, np.int64)
    for r in queries.groupBy("part").count().collect():
        asked[r.part] = r["count"]
    # each part has blocks of its own number: a row meets the blocks of queries routed to its part, and no others
    per_part = lambda counts, each: F.array(*[F.lit(pieces_for(float(c), each)) for c in counts])[F.col("part")]
    rows_in = per_part(sizes, blocks.get("block_rows", BLOCK_ROWS))
    queries_in = per_part(asked, blocks.get("block_queries", BLOCK_QUERIES))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = indexed.select("vec_id", "v", "part", deal(rows_in, 1).alias("rb"), every(queries_in).alias("qb"))
    right = queries.select("vec_id", "v", "part", every(rows_in).alias("rb"), deal(queries_in, 2).alias("qb"))
    found = left.groupBy("part", "rb", "qb").cogroup(right.groupBy("part", "rb", "qb")).applyInArrow(
        _block_search(k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the 5 nearest rows found for every row whose id is divisible by 50."""
    return search(usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % QUERY_EVERY == 0)

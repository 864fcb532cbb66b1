"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a documented bounded sample (max_fit vectors, in hash order, and at most MAX_VALUES numbers);
every vector is indexed. A query walks the tree best bin first: a priority queue holds the nodes seen so far by the
inner product with their centre, and leaves are taken as they come out. How many leaves are visited is calibrated:
for a bounded set of queries the true neighbours are found by brute force over all vectors, and the visits widen
until the calibration queries' recall reaches the target. A query also goes on until its leaves hold enough candidates.

Leaves are cut into blocks of vectors, so a leaf that holds a third of all rows is many tasks; small leaves that lie side
by side in the tree share one, to which a query goes once. Leaves are read in rounds, each over WIDER times the vectors
of all before: the k-th best so far is the query's bound, and of the next leaves those are read that can reach it, for
vectors that do. So a query's finds grow with the number of rounds, not with that of the leaves. Every leaf keeps its radius, so its best possible inner product is that of its centre and the radius times the query's length
(Cauchy and Schwarz); leaves that are left out for it could not have changed the result. Scores are inner products in
double precision of the original vectors, summed in one fixed order, so equal vectors tie exactly.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite numbers take no
part, nor do rows without vec_id; of rows that repeat a vec_id the one with the smallest vector takes part; with fewer
than k other vectors all are returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import materialize, only

MAX_FIT, MAX_VALUES = 20_000, 8_000_000
LEAF, BRANCHES = 256, 8
CALIBRATION, TARGET = 200, 0.94
#: A query's first leaves hold about so many times k vectors.
FIRST = 20
#: A round goes on until a query's leaves hold so many times the vectors of all rounds before.
WIDER = 8
#: Vectors and queries that meet in a task.
BLOCK, QUERIES = 4_096, 65_536


class Tree:
    """Nodes in arrays: centre, children (empty for a leaf) and the leaf's number."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 7):
        self.centres, self.children, self.leaf_of = [], [], []
        self.leaves = 0
        rng = np.random.default_rng(seed)
        per_leaf = max(4, len(sample) // max(1, leaves))
        self._grow(sample, per_leaf, rng)

    def _grow(self, x: np.ndarray, per_leaf: int, rng) -> int:
        me = len(self.centres)
        self.centres.append(x.mean(0) if len(x) else np.zeros(x.shape[1]))
        self.children.append([])
        self.leaf_of.append(-1)
        parts = self._split(x, rng) if len(x) > per_leaf * 1.5 else []
        if len(parts) > 1:
            self.children[me] = [self._grow(p, per_leaf, rng) for p in parts]
        else:
            self.leaf_of[me] = self.leaves
            self.leaves += 1
        return me

    @staticmethod
    def _split(x: np.ndarray, rng) -> list[np.ndarray]:
        distinct = np.unique(x, axis=0)
        if len(distinct) < 2:
            return []
        c = distinct[rng.choice(len(distinct), min(BRANCHES, len(distinct)), replace=False)]
        for _ in range(12):
            to = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
            c = np.stack([x[to == i].mean(0) for i in np.unique(to)])
        to = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        return [x[to == i] for i in np.unique(to)]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest child's centre."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            kids = self.children[node]
            if not kids:
                out[at] = self.leaf_of[node]
                continue
            c = np.stack([self.centres[k] for k in kids])
            to = ((c * c).sum(1) - 2 * x[at] @ c.T).argmin(1)
            todo += [(k, at[to == i]) for i, k in enumerate(kids) if (to == i).any()]
        return out

    def middles(self) -> np.ndarray:
        """The leaves' centres, by leaf."""
        out = np.zeros((self.leaves, len(self.centres[0])))
        for node, leaf in enumerate(self.leaf_of):
            if leaf >= 0:
                out[leaf] = self.centres[node]
        return out

    def walk(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf_of[node] >= 0:
                yield self.leaf_of[node]
            for k in self.children[node]:
                heapq.heappush(heap, (-float(q @ self.centres[k]), k))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>): the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    given = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    sound = given.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return sound.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _best(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of a block of vectors (those that reach least, if given): query ids, vec ids, exact scores."""
    out = ([], [], [])
    for lo in range(0, len(q), 256):
        rough = q[lo : lo + 256] @ v.T
        rough[qid[lo : lo + 256, None] == ids[None, :]] = -np.inf
        for i, row in enumerate(rough):
            floor = -np.inf if len(row) <= k else np.partition(row, len(row) - k)[len(row) - k]
            if least is not None:
                floor = max(floor, least[lo + i])
            at = np.flatnonzero((row >= floor - 1e-9 * (1 + abs(floor) if np.isfinite(floor) else 1)) & (row > -np.inf))
            score = (v[at] * q[lo + i]).sum(1)
            top = np.lexsort((ids[at], -score))[:k]
            out[0].append(np.full(len(top), qid[lo + i]))
            out[1].append(ids[at][top])
            out[2].append(score[top])
    return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, (np.int64, np.int64, np.float64), strict=True))


_FOUND = "query_id long, vec_id long, score double"


def _found(parts: tuple) -> dict:
    return {"query_id": parts[0], "vec_id": parts[1], "score": parts[2]}


def _top(found: DataFrame, k: int) -> DataFrame:
    per = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(per)).filter(F.col("rank") <= k)


def exact(vectors: DataFrame, qid: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """The true neighbours of a bounded set of queries, which every task has, over all vectors in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict(_found(_best(qid, q, b.column("vec_id").to_numpy(), _matrix(b.column("v")), k)))

    return _top(vectors.select("vec_id", "v").mapInArrow(run, _FOUND), k)


def search(vectors: DataFrame, is_query, k: int = 20, target: float = TARGET, max_fit: int = MAX_FIT) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found. is_query: which rows of vectors are queries."""
    spark = vectors.sparkSession
    sound = materialize(usable(vectors), "ann-vectors")
    sizes = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes["d"], sizes["count"]
    sound = sound.filter(F.size("v") == dim)
    fit = sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(max_fit, MAX_VALUES // dim))).toArrow()
    tree = Tree(_matrix(fit["v"].combine_chunks()), max(1, min(n // LEAF, len(fit) // 8)))
    sent = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles = sent.value.middles()
        for b in batches:
            v = _matrix(b.column("v")) if b.num_rows else np.zeros((0, dim))
            leaf = sent.value.leaf(v)
            away = np.sqrt(((v - middles[leaf]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(leaf, pa.int32()), pa.array(away, pa.float64())], names=["vec_id", "v", "leaf", "away"])

    indexed = materialize(sound.mapInArrow(assign, "vec_id long, v array<double>, leaf int, away double"), "ann-index")
    held, radius = np.zeros(tree.leaves, np.int64), np.zeros(tree.leaves)
    for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).collect():  # at most an eighth as many leaves as vectors were fitted
        held[r["leaf"]], radius[r["leaf"]] = r["n"], r["away"]
    indexed = indexed.drop("away")
    visits = _calibrate(indexed, is_query, tree, held, k, target)

    sent_leaves = spark.sparkContext.broadcast((held, radius))
    group, blocks = _shards(held)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's stops: the leaves that it visits in a shard in a round, each with its best possible inner product."""
        many, far = sent_leaves.value
        middles = sent.value.middles()
        for b in batches:
            q = _matrix(b.column("v")) if b.num_rows else np.zeros((0, dim))
            stops = []
            for x, reach in zip(q, q @ middles.T + np.sqrt((q * q).sum(1))[:, None] * far[None, :], strict=True):
                path, seen, turn = {}, 0, 0
                for i, leaf in enumerate(sent.value.walk(x)):
                    if i >= visits and seen > k:
                        break
                    while seen > FIRST * k * WIDER**turn:
                        turn += 1
                    path.setdefault((turn, int(group[leaf])), []).append(leaf)
                    seen += int(many[leaf])
                reach += 1e-9 * (1 + np.abs(reach))
                stops.append([{"turn": t, "shard": s, "blocks": int(blocks[at].max()), "most": float(reach[at].max()), "leaves": at, "reach": reach[at].tolist()} for (t, s), at in path.items()])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(stops, stop)], names=["query_id", "q", "stops"])

    stop = pa.list_(pa.struct({"turn": pa.int32(), "shard": pa.int32(), "blocks": pa.int32(), "most": pa.float64(), "leaves": pa.list_(pa.int32()), "reach": pa.list_(pa.float64())}))
    of_stops = "array<struct<turn:int, shard:int, blocks:int, most:double, leaves:array<int>, reach:array<double>>>"
    routed = materialize(indexed.filter(is_query).select("vec_id", "v").mapInArrow(route, f"query_id long, q array<double>, stops {of_stops}"), "ann-routes")
    about = routed.agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max("stops.turn")).alias("last")).first()
    parts = max(1, -(-about["n"] // QUERIES))

    def of(numbers: np.ndarray, leaf: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(x)) for x in numbers]), leaf + 1).cast("int")

    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0)
    stored = indexed.withColumn("shard", of(group, F.col("leaf"))).withColumn("block", F.pmod(F.xxhash64("vec_id"), of(blocks, F.col("leaf"))).cast("int"))
    stored = stored.withColumn("part", part).groupBy("shard", "block", "part")

    def look(asked: DataFrame) -> DataFrame:
        """asked: (query_id, q, least, stop). A query goes once to every block of a shard, with the leaves it visits there; the k best of those come back."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            if left.num_rows and right.num_rows:
                v, q = _matrix(left["v"].combine_chunks()), _matrix(right["q"].combine_chunks())
                ids, qid, lie, least = left["vec_id"].to_numpy(), right["query_id"].to_numpy(), left["leaf"].to_numpy(), right["least"].to_numpy()
                leaves = right["leaves"].combine_chunks()
                where, asker = leaves.flatten().to_numpy(), np.repeat(np.arange(len(qid)), leaves.value_lengths().to_numpy())
                can = right["reach"].combine_chunks().flatten().to_numpy() >= least[asker]
                where, asker = where[can], asker[can]
                for leaf in np.unique(where):
                    mine, to = lie == leaf, asker[where == leaf]
                    if mine.any():
                        found.append(_best(qid[to], q[to], ids[mine], v[mine], k, least[to]))
            query, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((vec, -score, query))
            query, vec, score = query[order], vec[order], score[order]
            top = np.arange(len(query)) - np.searchsorted(query, query) < k
            return pa.table(_found((query[top], vec[top], score[top])))

        by = asked.select("query_id", "q", "least", "stop.shard", "stop.leaves", "stop.reach", F.explode(F.sequence(F.lit(0), F.col("stop.blocks") - 1)).alias("block"))
        by = by.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
        return stored.cogroup(by.groupBy("shard", "block", "part")).applyInArrow(run, _FOUND)

    # The k-th best of all leaves so far bounds the next, WIDER times as many; so a round finds about WIDER * k that reach it, however many leaves there are.
    found = None
    for turn in range(about["last"] + 1 if about["n"] else 0):
        to = routed
        if found is None:
            to = to.withColumn("least", F.lit(float("-inf")))
        else:
            bounds = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).select("query_id", F.when(F.col("n") >= k, F.col("low")).alias("low"))
            to = to.join(bounds, "query_id", "left").withColumn("least", F.coalesce("low", F.lit(float("-inf"))))
        now = F.expr(f"filter(stops, s -> s.turn = {turn} AND s.most >= least)")
        new = look(to.select("query_id", "q", "least", F.explode(now).alias("stop")))
        new = new if found is None else found.select("query_id", "vec_id", "score").unionByName(new)
        found = materialize(_top(new, k), f"ann-found{turn}")
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found.select("query_id", "rank", "vec_id", "score")


def _shards(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By leaf: its shard, which are leaves side by side in the tree of BLOCK vectors together, and the shard's blocks: 1, or more for a leaf beyond BLOCK vectors, which is a shard of its own."""
    group, total, shard = np.zeros(len(held), np.int64), 0, 0
    for leaf, n in enumerate(held.tolist()):
        if total and total + n > BLOCK:
            shard, total = shard + 1, 0
        group[leaf], total = shard, total + n
    return group, np.maximum(-(-held // BLOCK), 1)


def _calibrate(indexed: DataFrame, is_query, tree: Tree, held: np.ndarray, k: int, target: float) -> int:
    """Leaves to visit so that the calibration queries reach the target recall."""
    asked = indexed.filter(is_query).orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").limit(CALIBRATION).select("vec_id", "v").toArrow()
    if not asked.num_rows or tree.leaves == 1:
        return 1
    qid, q = asked["vec_id"].to_numpy(), _matrix(asked["v"].combine_chunks())
    truth = exact(indexed, qid, q, k).select("query_id", "vec_id").join(indexed.select("vec_id", "leaf"), "vec_id").toArrow()
    order = {}
    for i, x in zip(qid, q, strict=True):
        at = np.zeros(tree.leaves, np.int64)
        at[list(tree.walk(x))] = np.arange(tree.leaves)
        order[int(i)] = at
    position = np.sort([order[a][b] for a, b in zip(truth["query_id"].to_pylist(), truth["leaf"].to_pylist(), strict=True)])
    return int(position[min(len(position) - 1, int(np.ceil(target * len(position))) - 1)]) + 1 if len(position) else 1

"""Exact top-k inner products with one KD-tree per shard.

Vectors are floored to integers and dealt into shards. A shard builds a KD-tree: median
splits on the widest dimension, a tight bounding box at every node. A block of queries
walks the tree best first: a node's bound for a query is the largest inner product any point of its box could
have; nodes are opened in order of their best bound, a leaf is scored only for the
queries whose bound still beats their kth score, and the walk ends when none does.

The kth score travels: every query first searches the one shard whose box promises most,
and its kth score there is the bar for all other shards, where whole trees
are often refused at the root. Queries travel in blocks, not alone; results are merged per query.

Ties go to the smaller id, so a node is opened while its bound is at least the kth score.
Edge cases: null vectors and vectors with null, NaN or infinite components take no part, neither
do null ids or vectors of another length than the shard's; equal vectors and repeated rows are
candidates of their own, but a query skips every row with its own id; fewer candidates
give fewer ranks; no rows give no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.session import materialize

LEAF = 128
SHARD_ROWS = 16384
BLOCK = 512
SCALE = 64


class KDTree:
    """Median-split tree over integer vectors (float64 holds the sums exactly below 2**53)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        by = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by], x[by].astype(np.float64)
        order = np.arange(len(ids))
        self.lo, self.hi, self.kids, self.rows = [], [], [], []
        self._grow(order, leaf)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        me = len(self.lo)
        pts = self.x[rows]
        lo, hi = pts.min(0), pts.max(0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.kids.append(None)
        self.rows.append(rows)
        if len(rows) > leaf and (hi > lo).any():
            d = int(np.argmax(hi - lo))
            by = np.argsort(pts[:, d], kind="stable")
            half = len(rows) // 2
            left = self._grow(rows[by[:half]], leaf)
            right = self._grow(rows[by[half:]], leaf)
            self.kids[me] = (left, right)
            self.rows[me] = None
        return me

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product for every query and node box."""
        return np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T

    def search(self, qid: np.ndarray, q: np.ndarray, k: int, bar: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query: (ids, scores) of at most k best points with a score of at least ``bar``."""
        bound = self.bounds(q)
        kth = bar.copy()
        best_s = [np.zeros(0)] * len(q)
        best_i = [np.zeros(0, np.int64)] * len(q)
        heap = [(-float(bound[:, 0].max(initial=-np.inf)), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            active = np.flatnonzero(bound[:, node] >= kth)
            if not len(active):
                continue
            if self.kids[node] is not None:
                for kid in self.kids[node]:
                    open_ = bound[active, kid] >= kth[active]
                    if open_.any():
                        heapq.heappush(heap, (-float(bound[active[open_], kid].max()), kid))
                continue
            rows = self.rows[node]
            ids = self.ids[rows]
            score = q[active] @ self.x[rows].T
            good = (score >= kth[active][:, None]) & (ids[None, :] != qid[active][:, None])
            for j in np.flatnonzero(good.any(1)):
                a = active[j]
                s = np.concatenate([best_s[a], score[j][good[j]]])
                i = np.concatenate([best_i[a], ids[good[j]]])
                if len(s) > k:
                    top = np.lexsort((i, -s))[:k]
                    s, i = s[top], i[top]
                best_s[a], best_i[a] = s, i
                if len(s) == k:
                    kth[a] = max(kth[a], s.min())
        return list(zip(best_i, best_s))


def _packed(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Vectors as blocks: (key, ids, body, dim), at most ``rows`` vectors each."""

    def scan(batches):
        held: dict[int, list] = {}

        def out(keys):
            got = [(k, *(np.concatenate(x) for x in zip(*held.pop(k)))) for k in keys]
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1].tobytes() for g in got], pa.binary()),
                 pa.array([_body(g[2]) for g in got], pa.binary()), pa.array([g[2].shape[1] for g in got], pa.int32())],
                ["key", "ids", "body", "dim"])

        for b in batches:
            keys, ids, vecs = A.int64(b.column("key")), A.int64(b.column("vec_id")), b.column("v")
            off = vecs.offsets.to_numpy()
            flat = vecs.values.to_numpy(zero_copy_only=False)
            for i in range(len(keys)):
                held.setdefault(int(keys[i]), []).append((ids[i:i + 1], flat[off[i]:off[i + 1]][None]))
        sizes: dict[tuple[int, int], list] = {}
        for k in list(held):                       # vectors of one length only meet each other
            for x in held.pop(k):
                sizes.setdefault((k, x[1].shape[1]), []).append(x)
        for (k, _), xs in sizes.items():
            for a in range(0, len(xs), rows):
                held[k] = xs[a:a + rows]
                yield out([k])

    return df.mapInArrow(scan, "key long, ids binary, body binary, dim int")


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.transform(vec_col, lambda x: x.cast("double"))
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("x")).filter("vec_id is not null and x is not null and size(x) > 0")
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(finite).select("vec_id", F.transform("x", lambda x: F.floor(x * SCALE)).alias("v"))


def _body(x: np.ndarray) -> bytes:
    """Integers in the smallest width that holds them, which the first byte tells."""
    top = int(np.abs(x).max(initial=0))
    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def _read(ids: bytes, body: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(body, f"<i{body[0]}", offset=1).reshape(-1, dim)


def top_k(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries (ids divisible by ``every``) against all rows."""
    vecs = _vectors(df, id_col, vec_col)
    total = vecs.count()
    shards = max(1, -(-total // SHARD_ROWS))
    blocks = max(1, -(-total // (BLOCK * every)))
    placed = vecs.withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    shard = materialize(_packed(placed.repartition(shards, "key"), "key", 2 * SHARD_ROWS).withColumn("piece", F.monotonically_increasing_id()))
    asks = vecs.filter(F.col("vec_id") % every == 0).withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    asks = materialize(_packed(asks.repartition(blocks, "key"), "key", 2 * BLOCK).withColumn("block", F.monotonically_increasing_id()))

    # the shard that promises most, per query: from the root boxes (one small row per shard)
    def boxes(batches):
        for b in batches:
            for piece, ids, body, dim in zip(*(b.column(c).to_pylist() for c in ("piece", "ids", "body", "dim"))):
                x = _read(ids, body, dim)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([piece]), pa.array([dim], pa.int32()), pa.array([x.min(0).astype("<i8").tobytes()], pa.binary()),
                     pa.array([x.max(0).astype("<i8").tobytes()], pa.binary())], ["piece", "dim", "lo", "hi"])

    box = materialize(shard.mapInArrow(boxes, "piece long, dim int, lo binary, hi binary"))
    side = asks.select("block", "ids", "body", F.col("dim").alias("_dim"))
    pairs = side.join(box, F.col("dim") == F.col("_dim"))

    def promise(batches):
        for b in batches:
            for block, ids, body, piece, dim, lo, hi in zip(*(b.column(c).to_pylist() for c in ("block", "ids", "body", "piece", "dim", "lo", "hi"))):
                i, q = _read(ids, body, dim)
                q = q.astype(np.float64)
                lo, hi = np.frombuffer(lo, "<i8").astype(np.float64), np.frombuffer(hi, "<i8").astype(np.float64)
                up = np.maximum(q, 0) @ hi + np.minimum(q, 0) @ lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), block)), pa.array(np.arange(len(i))), pa.array(np.full(len(i), piece)), pa.array(up)],
                    ["block", "at", "piece", "up"])

    up = pairs.mapInArrow(promise, "block long, at long, piece long, up double")
    first = (up.groupBy("block", "at").agg(F.max(F.struct("up", "piece")).alias("m"))
             .groupBy("block", F.col("m.piece").alias("piece")).agg(F.sort_array(F.collect_list("at")).alias("ats")))
    found_schema = "block long, at long, query_id long, vec_id long, score long"

    def search(batches):
        """A shard's row comes first, then the query blocks that search it."""
        piece, tree = None, None
        for b in batches:
            for r in b.to_pylist():
                if r["block"] is None:
                    piece, tree = r["piece"], KDTree(*_read(r["ids"], r["body"], r["dim"]))
                    continue
                assert piece == r["piece"]
                ids, q = _read(r["ids"], r["body"], r["dim"])
                at = np.arange(len(ids)) if r["ats"] is None else np.array(r["ats"])
                bars = np.full(len(ids), -np.inf)
                for i, x in zip(r["bar_at"] or [], r["bar"] or []):
                    bars[i] = x
                got = tree.search(ids[at], q[at].astype(np.float64), k, bars[at])
                n = [len(x[0]) for x in got]
                if sum(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(sum(n), r["block"])), pa.array(np.repeat(at, n)), pa.array(np.repeat(ids[at], n)),
                         pa.array(np.concatenate([x[0] for x in got])), pa.array(np.concatenate([x[1] for x in got]).astype(np.int64))],
                        ["block", "at", "query_id", "vec_id", "score"])

    extra = {"block": "long", "ats": "array<bigint>", "bar_at": "array<bigint>", "bar": "array<double>"}
    trees = shard.select("piece", "ids", "body", "dim", *[F.lit(None).cast(t).alias(c) for c, t in extra.items()])

    def searched(asked: DataFrame) -> DataFrame:
        """Each shard is sent once, the query blocks stream past it."""
        rows = trees.unionByName(asked.select(*trees.columns)).repartition(shards, "piece")
        return rows.sortWithinPartitions("piece", F.col("block").asc_nulls_first()).mapInArrow(search, found_schema)

    blocks_of = asks.select("block", "ids", "body", "dim")
    empty = {c: F.lit(None).cast(extra[c]) for c in ("bar_at", "bar")}
    pilot = materialize(searched(first.join(blocks_of, "block").withColumns(empty)))
    bars = (pilot.groupBy("block", "at").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("bar")).filter(F.col("n") >= k)
            .groupBy("block").agg(F.collect_list(F.struct("at", "bar")).alias("b"))
            .select("block", F.col("b.at").alias("bar_at"), F.col("b.bar").alias("bar")))
    used = first.select("block", "piece", F.col("ats").alias("done"))
    rest = (pairs.select("block", "piece").join(used, ["block", "piece"], "left")
            .join(blocks_of, "block").join(bars, "block", "left"))
    whole = F.sequence(F.lit(0).cast("long"), (F.octet_length("ids") / 8 - 1).cast("long"))
    rest = rest.withColumn("ats", F.when(F.col("done").isNotNull(), F.array_except(whole, "done")))
    others = searched(rest.filter("ats is null or size(ats) > 0"))
    best = Window.partitionBy("query_id", "at", "block").orderBy(F.desc("score"), "vec_id")
    return (pilot.unionByName(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

"""Hard negatives by threshold joins over an inverted index with suffix norms.

Vectors are scaled and floored to integers; a score is an exact integer inner product. For an
anchor and each of its best rows of the same label (the positives) the best rows of other labels
inside a window below the positive's score are wanted.

Rows are dealt evenly into shards, anchors into blocks; a block visits every shard. In a
shard a block runs threshold joins:

* Dimensions are put in order of weight and cut into panels. A row's leading panels are
  left out of the index while their norm is too small to reach the lowest threshold of the
  block (threshold over anchor norm): what they could add is bounded instead.
* The block goes through the panels in order; each adds partial scores to the rows that
  have it in their index. After a panel a pair stays only while its partial score plus the
  remaining norms (those left out and those to come) can reach the anchor's threshold.
* What survives is scored exactly.

Thresholds start high and are lowered for the anchors whose windows are not full yet, down to the
window's end. An anchor first searches its own shard; what it finds there bounds what
the other shards must return, so each returns few rows. Scores below zero never matter: a
window below a negative score is empty.

Edge cases: rows with a null id, a null label, a null vector, an empty one, or a null or
non-finite component take no part; vectors of different lengths do not meet; a row never meets
rows with its own id; repeated rows are rows of their own; fewer rows give shorter results; sums past
2**53 are taken in whole numbers and kept within 64 bits; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskladder.llm.arrays import int64, tidy
from riskladder.session import materialize

SHARD_ROWS = 16384
BLOCK = 128                    # anchors of a block
PANEL = 8                      # dimensions of a panel
ROUNDS = (0.9, 0.75, 0.5, 0.25, 0.0)   # where thresholds go between the best possible and the lowest score
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as int64 (saturated beyond)."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < _EXACT:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])(q) @ np.vectorize(int, otypes=[object])(x).T
    return np.array([[max(-_LONG, min(_LONG, v)) for v in row] for row in whole], np.int64)


class Index:
    """Rows of a shard (one vector length) with the norms that the joins need."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.raw = ids, labels, x
        self.weight = np.argsort(-np.abs(x).sum(0), kind="stable")
        self.x = x[:, self.weight].astype(np.float64)
        self.cuts = [*range(0, x.shape[1], PANEL), x.shape[1]]
        part = np.stack([(self.x[:, a:b] ** 2).sum(1) for a, b in zip(self.cuts, self.cuts[1:])], 1)
        self.lead = np.sqrt(np.concatenate([np.zeros((len(x), 1)), np.cumsum(part, 1)], 1))     # norm before a panel
        rest = np.cumsum(part[:, ::-1], 1)[:, ::-1]
        self.rest = np.sqrt(np.concatenate([rest, np.zeros((len(x), 1))], 1))                    # norm from a panel on

    def join(self, q: np.ndarray, least: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs of anchors ``q`` and ``rows`` with a score of at least ``least``."""
        none = np.zeros(0, np.int64)
        if not len(q) or not len(rows):
            return none, none, none
        big = float(np.abs(q).max(initial=0)) * float(np.abs(self.raw).max(initial=0)) * q.shape[1] >= _EXACT
        if big:
            s = scores(q, self.raw[rows])
            a, r = np.nonzero(s >= least[:, None])
            return a, rows[r], s[a, r]
        y = q[:, self.weight].astype(np.float64)
        part = np.stack([(y[:, a:b] ** 2).sum(1) for a, b in zip(self.cuts, self.cuts[1:])], 1)
        lead = np.sqrt(np.concatenate([np.zeros((len(y), 1)), np.cumsum(part, 1)], 1))
        rest = np.sqrt(np.concatenate([np.cumsum(part[:, ::-1], 1)[:, ::-1], np.zeros((len(y), 1))], 1))
        need = least - 0.5                         # scores are whole numbers; this absorbs rounding
        norm = rest[:, 0]
        ratio = max(0.0, float((need / np.maximum(norm, 1e-300)).min()))
        # a row enters the index at the first panel after which its norm reaches the ratio
        enough = self.lead[rows, 1:] >= ratio
        entry = np.where(enough.any(1), enough.argmax(1), len(self.cuts))
        rows, entry = rows[entry < len(self.cuts)], entry[entry < len(self.cuts)]
        by = np.argsort(entry, kind="stable")
        rows, entry = rows[by], entry[by]
        if not len(rows):
            return none, none, none
        skipped = self.lead[rows, entry]           # norm of what is left out, and the anchors' share of it
        partial = np.zeros((len(q), len(rows)))
        live = np.ones(len(rows), bool)
        for k, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            n = int(np.searchsorted(entry, k, "right"))
            at = np.flatnonzero(live[:n])
            if not len(at):
                continue
            partial[:, at] += y[:, a:b] @ self.x[rows[at], a:b].T
            if k + 1 < len(self.cuts) - 1:         # remaining norms, of what is left out and of what comes
                bound = partial[:, at] + lead[:, entry[at]] * skipped[at] + rest[:, k + 1][:, None] * self.rest[rows[at], k + 1]
                live[at[~(bound >= need[:, None]).any(0)]] = False
        at = np.flatnonzero(live)
        bound = partial[:, at] + lead[:, entry[at]] * skipped[at]
        a, r = np.nonzero(bound >= need[:, None])
        r = rows[at[r]]
        s = np.empty(len(a), np.int64)
        for k in range(0, len(a), 1 << 16):        # the dimensions left out are added: the exact score
            w = slice(k, k + (1 << 16))
            s[w] = np.rint(np.einsum("ij,ij->i", y[a[w]], self.x[r[w]])).astype(np.int64)
        ok = s >= least[a]
        return a[ok], r[ok], s[ok]


def _best(s: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -s))[:k]


def _threshold(f: float, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.maximum(low, np.ceil(low + f * np.maximum(0.0, high - low)))


def find_positives(index: Index, ids, labels, q, k: int, bars: np.ndarray):
    """Per anchor the ``k`` best rows of its label that reach its bar: (anchor, 0, row, score)."""
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    for label in np.unique(labels):
        rows = np.flatnonzero(index.labels == label)
        if not len(rows):
            continue
        todo = np.flatnonzero(labels == label)
        longest = index.rest[rows, 0].max()
        for f in ROUNDS:
            least = _threshold(f, norms[todo] * longest, bars[todo])
            a, r, s = index.join(q[todo], least, rows)
            other = index.ids[r] != ids[todo[a]]
            a, r, s = a[other], r[other], s[other]
            done = (np.bincount(a, minlength=len(todo)) >= k) | (least <= bars[todo])
            cut = np.searchsorted(a, np.arange(len(todo) + 1))
            for j in np.flatnonzero(done):
                x = slice(cut[j], cut[j + 1])
                by = _best(s[x], index.ids[r[x]], k)
                yield np.full(len(by), todo[j]), np.zeros(len(by), np.int64), r[x][by], s[x][by]
            todo = todo[~done]
            if not len(todo):
                break


def find_negatives(index: Index, ids, labels, q, k: int, tops: np.ndarray, bars: np.ndarray):
    """Per anchor and window the ``k`` best rows of other labels with a score of at most ``tops`` and at least
    ``bars``; a negative top is no window: (anchor, window, row, score)."""
    used = tops >= 0
    todo = np.flatnonzero(used.any(1))
    high, low = np.where(used, tops, -1.0).max(1, initial=-1), np.where(used, bars, np.inf).min(1, initial=np.inf)
    rows = np.arange(len(index.ids))
    for f in ROUNDS:
        if not len(todo):
            break
        least = _threshold(f, high[todo], low[todo])
        a, r, s = index.join(q[todo], least, rows)
        good = (index.ids[r] != ids[todo[a]]) & (index.labels[r] != labels[todo[a]]) & (s <= high[todo[a]])
        a, r, s = a[good], r[good], s[good]
        cut = np.searchsorted(a, np.arange(len(todo) + 1))
        left = []
        for j, i in enumerate(todo):
            x = slice(cut[j], cut[j + 1])
            by = _best(s[x], index.ids[r[x]], len(s))
            sj, rj = s[x][by], r[x][by]
            found = {w: np.flatnonzero((sj <= tops[i, w]) & (sj >= bars[i, w]))[:k] for w in np.flatnonzero(used[i])}
            if all(len(x) >= k or least[j] <= bars[i, w] for w, x in found.items()):
                for w, x in found.items():
                    yield np.full(len(x), i), np.full(len(x), w), rj[x], sj[x]
            else:
                left.append(i)
        todo = np.array(left, np.int64)


def _vectors(df: DataFrame, id_col: str, vec_col: str, label: str, scale: int) -> DataFrame:
    x = F.transform(vec_col, lambda v: v.cast("double"))
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    df = df.filter("vec_id is not null and label is not null and x is not null and size(x) > 0")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.filter(finite).select("vec_id", "label", F.transform("x", lambda v: F.greatest(F.floor(v * scale), F.lit(-_LONG))).alias("v"))


def _small(x: np.ndarray) -> bytes:
    """Integers in the smallest width that holds them, which the first byte tells."""
    top = int(max(x.max(initial=0), -x.min(initial=0)))
    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def _packed(df: DataFrame, most: int) -> DataFrame:
    """Rows as blocks of vectors of one length: (ids, labels, body, dim), at most about ``most`` vectors each."""

    def out(held: list) -> pa.RecordBatch:
        ids, labels, x = (np.concatenate(c) for c in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()),
                                           pa.array([_small(x)], pa.binary()), pa.array([x.shape[1]], pa.int32())], ["ids", "labels", "body", "dim"])

    def scan(batches):
        held: dict[int, list] = {}
        for b in batches:
            ids, labels, v = int64(b.column("vec_id")), int64(b.column("label")), b.column("v")
            off, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
            for dim in np.unique(size := np.diff(off)):
                at = np.flatnonzero(size == dim)
                for k in range(0, len(at), most):
                    w = at[k:k + most]
                    held.setdefault(int(dim), []).append((ids[w], labels[w], flat[off[w][:, None] + np.arange(dim)]))
                if sum(len(x[0]) for x in held[int(dim)]) >= most:
                    yield out(held.pop(int(dim)))
        for x in held.values():
            yield out(x)

    return df.mapInArrow(tidy(scan), "ids binary, labels binary, body binary, dim int")


def _read(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    body = r["body"]
    return (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64),
            np.frombuffer(body, f"<i{body[0]}", offset=1).reshape(-1, r["dim"]).astype(np.int64))


def mine(df: DataFrame, k: int = 5, positives: int = 5, every: int = 100, scale: int = 256, low: int = 80, high: int = 100,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for anchors (ids divisible
    by ``every``) and their best ``positives`` rows of the same label the best ``k`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    vecs = _vectors(df, id_col, vec_col, label_col, scale)
    total = vecs.count()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-total // (BLOCK * every)))
    shard = materialize(_packed(vecs.repartition(shards), shard_rows).withColumn("shard", F.spark_partition_id()))
    asks = _packed(vecs.filter(F.col("vec_id") % every == 0).repartition(blocks), BLOCK)
    asks = materialize(asks.withColumn("block", F.monotonically_increasing_id()))
    schema = "block long, at long, slot long, anchor_id long, vec_id long, score long"
    extra = {"block": "long", "tops": "array<struct<at:bigint,slot:bigint,v:bigint>>", "bars": "array<struct<at:bigint,slot:bigint,v:bigint>>"}
    indexed = shard.select("shard", "ids", "labels", "body", "dim", *[F.lit(None).cast(t).alias(c) for c, t in extra.items()])

    def table(marks, n: int, slots: int, fill: float) -> np.ndarray:
        out = np.full((n, slots), fill)
        for m in marks or ():
            out[m["at"], m["slot"]] = m["v"]
        return out

    def search(negatives: bool):
        def scan(batches):
            """A shard's rows come first, then the blocks that visit it."""
            name, index = None, {}
            for b in batches:
                for r in b.to_pylist():
                    if r["shard"] != name:
                        name, index = r["shard"], {}
                    if r["block"] is None:
                        index[r["dim"]] = [*index.get(r["dim"], []), Index(*_read(r))]
                        continue
                    ids, labels, q = _read(r)
                    bars = table(r["bars"], len(ids), positives if negatives else 1, 0.0)
                    for one in index.get(r["dim"], []):
                        got = (find_negatives(one, ids, labels, q, k, table(r["tops"], len(ids), positives, -1.0), bars)
                               if negatives else find_positives(one, ids, labels, q, positives, bars[:, 0]))
                        got = list(got)
                        if got:
                            at, slot, row, s = (np.concatenate(c) for c in zip(*got))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(at), r["block"])), pa.array(at), pa.array(slot), pa.array(ids[at]), pa.array(one.ids[row]), pa.array(s)],
                                ["block", "at", "slot", "anchor_id", "vec_id", "score"])

        return tidy(scan)

    def visits(own: bool, tops: DataFrame | None, bars: DataFrame | None, negatives: bool) -> DataFrame:
        """Every block searches its first shard (``own``) or all others."""
        asked = asks
        for name, marks in (("tops", tops), ("bars", bars)):
            if marks is None:
                asked = asked.withColumn(name, F.lit(None).cast(extra[name]))
            else:
                listed = marks.groupBy(F.col("block").alias("_b")).agg(F.collect_list(F.struct("at", "slot", F.col("v").cast("long").alias("v"))).alias(name))
                asked = asked.join(listed, F.col("block") == F.col("_b"), "left").drop("_b")
        first = F.pmod("block", F.lit(shards)).cast("int")
        there = F.array(first) if own else F.array_except(F.sequence(F.lit(0), F.lit(shards - 1)), F.array(first))
        asked = asked.withColumn("shard", F.explode(there)).select(*indexed.columns)
        rows = indexed.unionByName(asked).repartition(shards, "shard")
        return rows.sortWithinPartitions("shard", F.col("block").asc_nulls_first()).mapInArrow(search(negatives), schema)

    def best(found: DataFrame, n: int) -> DataFrame:
        order = Window.partitionBy("block", "at", "slot").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

    def reached(found: DataFrame, n: int) -> DataFrame:
        """The n-th best score so far, where there are so many."""
        return (best(found, n).groupBy("block", "at", "slot").agg(F.count("*").alias("c"), F.min("score").alias("v"))
                .filter(F.col("c") >= n).drop("c"))

    near = materialize(visits(True, None, None, False))
    near = best(near.unionByName(visits(False, None, reached(near, positives), False)), positives)
    near = materialize(near.withColumn("slot", (F.col("rank") - 1).cast("long")))
    wide = F.col("score").cast("decimal(20,0)")
    tops = near.select("block", "at", "slot", F.floor(wide * high / 100).cast("long").alias("v"))
    ends = near.select("block", "at", "slot", F.ceil(wide * low / 100).cast("long").alias("v"))
    hard = materialize(visits(True, tops, ends, True))
    bars = ends.join(reached(hard, k).withColumnRenamed("v", "_v"), ["block", "at", "slot"], "left")
    bars = bars.select("block", "at", "slot", F.coalesce("_v", "v").alias("v"))
    hard = best(hard.unionByName(visits(False, tops, bars, True)), k)
    of = near.select("block", "at", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (hard.join(of, ["block", "at", "slot"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))

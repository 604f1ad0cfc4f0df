"""N-gram Jaccard join by vertical partitioning.

A document is its set of distinct word n-grams. All n-grams have one global order, rare
ones first; the order is cut into fragments, every document is cut into the matching
segments, and fragments count overlaps on their own; a pair's partial counts are summed.

1. One scan hashes the n-grams. Documents with equal sets form one class (its members
   are never paired with each other); a fixed-size sketch counts the n-grams over the whole
   corpus. The global order is (count of the n-gram's sketch cell, hash), a total order that
   does not have to be exact to be right: it only decides which fragments are crowded.
2. Two sets at similarity s or more share an n-gram among the first n - ceil(s*n) + 1 of
   each (their prefixes). The prefixes go to the fragments; n-grams seen in one class only
   stop there.
3. Leader links: in each n-gram's list (and size band) the class in which the n-gram stands
   earliest, which is the one with the fewest rare n-grams, is the leader. Members are compared with
   their leaders first, which is linear in the lists. Groups of near copies become
   components here, without their pairs.
4. What is left: pairs of one list that are in different components and may still reach the
   similarity (sizes, positions). Their prefix overlaps are summed over fragments, bounded,
   and the survivors are compared.
5. Comparing: only the compared classes' segments are made again (a bitmap of fixed size
   lets the scan skip the others); overlaps are counted segment by segment and summed.

A pair is left out in step 4 only if it is in one component already, so the components are
exact. Positions and sizes bound the overlap; no list, group or candidate set is capped.

Edge cases: a null or empty text, or one of white space, has no n-grams, links with nothing
and is its own component; a text with fewer words than n has one n-gram, its whole word
sequence; repeated rows and equal sets are in one class; rows with a null id take part and
keep a null id, but never name a component (a class of only such rows has a null component). No rows
give no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.llm.components import connected_components
from riskladder.session import materialize

SKETCH_BITS = 22
PIECE = 1 << 20              # bytes of text at a time, where the rows made do not depend on it
SEGMENTS = 6                 # fragments of the order used when whole sets are compared


class _Sets:
    """The distinct n-grams of a chunk's documents: ``grams[cut[i]:cut[i+1]]`` sorted by hash."""

    def __init__(self, t: A.Text, n: int):
        w = A.Words(t, lower=True)
        h, _, doc = A.window_hashes(w, n)
        ends = np.searchsorted(doc, np.arange(len(t) + 1))
        out, cut = [], [0]
        for i in range(len(t)):
            if ends[i + 1] > ends[i]:
                g = np.unique(h[ends[i]:ends[i + 1]])
            elif w.counts[i]:
                g = w.counts[i:i + 1].astype(np.uint64)        # the whole sequence, salted by its length
                for k in range(w.first[i], w.first[i + 1]):
                    g = A.mix(g * np.uint64(0x9FB21C651E98DF25) + w.hashes[k:k + 1])
            else:
                g = np.zeros(0, np.uint64)
            out.append(g)
            cut.append(cut[-1] + len(g))
        self.grams = np.concatenate(out) if out else np.zeros(0, np.uint64)
        self.cut = np.array(cut)
        self.sizes = np.diff(self.cut)

    def signatures(self) -> np.ndarray:
        """A 64-bit name of each set: sums of two mixes of its members, mixed again."""
        out = np.zeros(len(self.sizes), np.uint64)
        for salt in (0x1B873593, 0x85EBCA6B):
            s = np.concatenate([[np.uint64(0)], np.cumsum(A.mix(self.grams ^ np.uint64(salt * 0x100000001)))])
            out = A.mix(out * np.uint64(31) + (s[self.cut[1:]] - s[self.cut[:-1]]) + self.sizes.astype(np.uint64))
        return out


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _counted(n: int):
    """Adds the n-grams of a task's documents to its sketch."""

    def add(cells, batches):
        for t in A.text_chunks(batches, "text", "doc_id", PIECE):
            np.add.at(cells, _cell(_Sets(t, n).grams), cells.dtype.type(1))

    return add


class _Order:
    """The global order of the cells (by count, then by hash) and its fragments, from the sketch. Broadcast: the counts
    and, for each number of fragments, the keys at which fragments begin; a task makes nothing else of the sketch's size."""

    def __init__(self, counts: np.ndarray, *sizes: int):
        self.counts = counts
        by = np.argsort(counts, kind="stable")
        mass = counts[by].astype(np.float64)
        mass += 1e-9
        np.cumsum(mass, out=mass)
        mass /= mass[-1]
        self.begin = {n: self._key(by[np.searchsorted(mass * n, np.arange(1, n))]) for n in sizes}

    def _key(self, cells: np.ndarray) -> np.ndarray:
        return self.counts[cells].astype(np.uint64) << np.uint64(SKETCH_BITS) | cells.astype(np.uint64)

    def in_order(self, grams: np.ndarray) -> np.ndarray:
        """Hash-sorted n-grams in the global order."""
        return grams[np.argsort(self.counts[_cell(grams)], kind="stable")]

    def fragments(self, grams: np.ndarray, n: int) -> np.ndarray:
        """Fragment of each n-gram: ``n`` runs of the order with about equally many n-grams."""
        return np.searchsorted(self.begin[n], self._key(_cell(grams)), "right")


def shingle_sets(docs: DataFrame, n: int = 5, text_col: str = "text", id_col: str = "doc_id", text_key: bool = False) -> DataFrame:
    """(id, size, signature) of every document's n-gram set, and text_md5 if asked for."""
    more = ["text_md5"] if text_key else []

    def scan(batches):
        for t in A.text_chunks(batches, "text", "doc_id", PIECE):
            s = _Sets(t, n)
            yield pa.RecordBatch.from_arrays(
                [t.rows.column("doc_id"), pa.array(s.sizes), pa.array(s.signatures().view(np.int64)), *[t.rows.column(c) for c in more]],
                ["doc_id", "n_shingles", "sig", *more])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if text_key:
        src = src.withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    return src.mapInArrow(A.tidy(scan), "doc_id long, n_shingles long, sig long" + ", text_md5 binary" * text_key)


def _needed(na: np.ndarray, nb: np.ndarray, pct: int) -> np.ndarray:
    """Smallest overlap of sets of these sizes at pct % similarity or more."""
    return -(-(pct * (na + nb)) // (100 + pct))


def _prefixes(src: DataFrame, order, n: int, pct: int, tasks: int) -> DataFrame:
    """The prefix segments, as one row per chunk and reduce task: n-grams, positions, classes."""

    def scan(batches):
        o = order.value
        seen: set[int] = set()
        for t in A.text_chunks(batches, "text", "doc_id"):
            s = _Sets(t, n)
            sigs = s.signatures()
            grams, pos, which = [], [], []
            for i in range(len(t)):
                size, sig = int(s.sizes[i]), int(sigs[i])
                if not size or sig in seen:        # copies within a task add nothing
                    continue
                seen.add(sig)
                g = o.in_order(s.grams[s.cut[i]:s.cut[i + 1]])[:size - -(-pct * size // 100) + 1]
                grams.append(g)
                pos.append(np.arange(len(g), dtype=np.uint32))
                which.append(np.full(len(g), i, np.uint32))
            if not grams:
                continue
            g, p, d = np.concatenate(grams), np.concatenate(pos), np.concatenate(which)
            to = (o.fragments(g, 4 * tasks) % tasks).astype(np.uint16 if tasks < 1 << 16 else np.uint32)   # crowded fragments go to all tasks
            by = np.argsort(to, kind="stable")
            g, p, d, to = g[by], p[by], d[by], to[by]
            lo, hi = A.segments(to)
            rows: list[list] = [[], [], [], [], [], []]
            for a, b in zip(lo, hi):
                docs, of = np.unique(d[a:b], return_inverse=True)
                for out, x in zip(rows, (int(to[a]), g[a:b].tobytes(), A.small(p[a:b]),
                                         A.small(np.bincount(of)), sigs[docs].tobytes(), A.small(s.sizes[docs]))):
                    out.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32())] + [pa.array(x, pa.binary()) for x in rows[1:]],
                ["part", "grams", "pos", "per_class", "sigs", "sizes"])

    return src.mapInArrow(A.tidy(scan), "part int, grams binary, pos binary, per_class binary, sigs binary, sizes binary")


_LISTS = "gram long, sig long, n int, pos int, leader long, leader_n int, leader_pos int"


def _lists(batches):
    """One reduce task of fragments: the lists with two classes or more, and their leaders."""
    g, p, s, n = [], [], [], []
    for b in batches:
        for grams, pos, per, sigs, sizes in zip(*(b.column(c).to_pylist() for c in
                                                  ("grams", "pos", "per_class", "sigs", "sizes"))):
            per = A.unsmall(per)
            g.append(np.frombuffer(grams, np.uint64))
            p.append(A.unsmall(pos).astype(np.int32))
            s.append(np.repeat(np.frombuffer(sigs, np.uint64), per))
            n.append(np.repeat(A.unsmall(sizes).astype(np.int32), per))
    if not g:
        return
    g, p, s, n = (np.concatenate(x) for x in (g, p, s, n))
    ordered = np.sort(g)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    at = np.searchsorted(twice, g)
    keep = twice[np.minimum(at, len(twice) - 1)] == g
    g, p, s, n = g[keep], p[keep], s[keep], n[keep]
    by = np.lexsort((s, g))                        # one row per n-gram and class
    g, p, s, n = g[by], p[by], s[by], n[by]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    g, p, s, n = g[fresh], p[fresh], s[fresh], n[fresh]
    band = np.floor(np.log(n) / np.log(4 / 3)).astype(np.int32)
    by = np.lexsort((s, p / n, band, g))
    g, p, s, n, band = g[by], p[by], s[by], n[by], band[by]
    lo, hi = A.segments(g)
    long = np.repeat(hi - lo > 1, hi - lo)
    g, p, s, n, band = g[long], p[long], s[long], n[long], band[long]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (band[1:] != band[:-1])
    leader = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
    for a in range(0, len(g), 1 << 17):
        x = slice(a, a + (1 << 17))
        q = leader[x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (g[x].view(np.int64), s[x].view(np.int64), n[x], p[x],
                                   s[q].view(np.int64), n[q], p[q])],
            ["gram", "sig", "n", "pos", "leader", "leader_n", "leader_pos"])


def _summed(pairs: DataFrame, pct: int) -> DataFrame:
    """Prefix overlaps summed per pair; pairs whose bound stays below the needed overlap go."""
    s = pairs.groupBy("a", "b").agg(F.sum("k").alias("k"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
                                    F.first("na").alias("na"), F.first("nb").alias("nb"))
    bound = F.col("k") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    return s.filter((100 + pct) * bound >= pct * (F.col("na") + F.col("nb")))


def _leader_bound(pairs: DataFrame, pct: int) -> DataFrame:
    """Leader pairs that look like links: all shared n-grams up to the end of the prefix that ends
    first are in both prefixes, so a link needs many of them. At least a quarter must be in lists that
    this leader leads; a link missed here is found among the pairs of different components."""
    prefix = lambda n: n - F.ceil(pct * n / 100) + 1
    na, nb = F.col("na"), F.col("nb")
    bound = 4 * F.col("k") + F.greatest(F.least(na - prefix(na), nb - F.col("pb") - 1), F.least(na - F.col("pa") - 1, nb - prefix(nb)))
    return pairs.filter((100 + pct) * bound >= pct * (na + nb)).select("a", "b", "na", "nb")


def _cross_pairs(pct: int):
    """Pairs of one list that are in different components and may reach the similarity."""

    def scan(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        g, s, c, n, p = (t.column(x).to_numpy() for x in ("gram", "sig", "component", "n", "pos"))
        n, p = n.astype(np.int64), p.astype(np.int64)
        by = np.lexsort((s, g))
        g, s, c, n, p = g[by], s[by], c[by], n[by], p[by]
        lo, hi = A.segments(g)
        held: list[list[np.ndarray]] = []
        count = 0

        def flush():
            a, b, na, nb, qa, qb = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((b, a))
            a, b, na, nb, qa, qb = (x[order] for x in (a, b, na, nb, qa, qb))
            cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            k = np.diff(np.concatenate([cut, [len(a)]]))
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (a[cut], b[cut], na[cut], nb[cut],
                                       np.maximum.reduceat(qa, cut), np.maximum.reduceat(qb, cut), k)],
                ["a", "b", "na", "nb", "pa", "pb", "k"])

        for x, y in zip(lo, hi):
            if (c[x:y] == c[x]).all():
                continue
            for i in range(x, y - 1):              # one row against the rest of its list
                j = slice(i + 1, y)
                need = _needed(n[i], n[j], pct)
                ok = (c[j] != c[i]) & (np.minimum(n[i] - p[i], n[j] - p[j]) >= need) & (np.minimum(n[i], n[j]) >= need)
                if ok.any():
                    m = int(ok.sum())
                    held.append([np.full(m, s[i]), s[j][ok], np.full(m, n[i]), n[j][ok], np.full(m, p[i]), p[j][ok]])
                    count += m
                    if count > 1 << 20:
                        yield flush()
                        held, count = [], 0
        if held:
            yield flush()

    return scan


def _links(src: DataFrame, pairs: DataFrame, order, n: int, pct: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose whole sets reach the similarity, by summed partial overlaps."""
    spark = src.sparkSession
    wanted = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig")))
    bits = spark.sparkContext.broadcast(A.bloom_of(wanted, "sig"))

    def scan(batches):
        o = order.value
        seen: set[int] = set()
        for t in A.text_chunks(batches, "text", "doc_id", PIECE):
            s = _Sets(t, n)
            sigs = s.signatures()
            names, segs = [], []
            for i in np.flatnonzero(A.bloom_has(bits.value, sigs) & (s.sizes > 0)):
                sig = int(sigs[i])
                if sig in seen:
                    continue
                seen.add(sig)
                g = s.grams[s.cut[i]:s.cut[i + 1]]
                f = o.fragments(g, SEGMENTS)
                names.append(sig - (1 << 64) if sig >> 63 else sig)
                segs.append([g[f == k].tobytes() for k in range(SEGMENTS)])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(segs, pa.list_(pa.binary()))], ["sig", "segs"])

    # one row per class, so both joins below use the same deal of the segments
    segs = src.mapInArrow(A.tidy(scan), "sig long, segs array<binary>").dropDuplicates(["sig"])
    of_a = pairs.select("a", "b").join(segs, F.col("a") == F.col("sig")).select("a", "b", F.col("segs").alias("ga"))
    of_b = segs.select(F.col("sig").alias("b"), F.col("segs").alias("gb"))
    both = of_a.join(of_b, "b").select("a", "b", "ga", "gb")

    def overlap(batches):
        def common(x, y):
            return len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))

        for b in batches:
            k = [sum(map(common, x, y)) for x, y in zip(b.column("ga").to_pylist(), b.column("gb").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(k, pa.int64())], ["a", "b", "k"])

    part = both.mapInArrow(A.tidy(overlap), "a long, b long, k long")
    return (pairs.join(part, ["a", "b"])
            .filter(100 * F.col("k") >= pct * (F.col("na") + F.col("nb") - F.col("k"))).select("a", "b"))


def ngram_jaccard_components(docs: DataFrame, n: int = 5, min_percent: int = 75, text_col: str = "text",
                             id_col: str = "doc_id", text_key: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)
    and class_id (smallest id with the same set). With ``text_key`` also component (a name that rows of one component
    share, whatever their ids; null for documents without words) and text_md5, for decisions per row."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    tasks = A.reduce_tasks(docs)
    order = spark.sparkContext.broadcast(_Order(A.fold_array(src, _counted(n), 1 << SKETCH_BITS), 4 * tasks, SEGMENTS))
    lists = _prefixes(src, order, n, min_percent, tasks).repartitionById(tasks, F.col("part")).mapInArrow(A.tidy(_lists), _LISTS)
    lists = materialize(lists)

    # leaders first
    led = (lists.filter("sig <> leader")
           .filter(100 * F.least("n", "leader_n") >= min_percent * F.greatest("n", "leader_n"))
           .groupBy("leader", "sig").agg(F.count("*").alias("k"), F.max("leader_pos").alias("pa"), F.max("pos").alias("pb"),
                                         F.first("leader_n").alias("na"), F.first("n").alias("nb"))
           .select(F.col("leader").alias("a"), F.col("sig").alias("b"), "na", "nb", "pa", "pb", "k"))
    first = materialize(_leader_bound(_summed(led, min_percent), min_percent))
    links = materialize(_links(src, first, order, n, min_percent))
    comps = connected_components(links, "a", "b")

    # pairs of different components that share a prefix n-gram
    named = (lists.select("gram", "sig", "n", "pos").join(comps.withColumnRenamed("node", "sig"), "sig", "left")
             .withColumn("component", F.coalesce("component", "sig")))
    of_gram = Window.partitionBy("gram")
    rest = (named.withColumns({"_lo": F.min("component").over(of_gram), "_hi": F.max("component").over(of_gram)})
            .filter("_lo <> _hi").drop("_lo", "_hi"))       # the rows of an n-gram stay in one task
    cross = rest.mapInArrow(A.tidy(_cross_pairs(min_percent)), "a long, b long, na long, nb long, pa long, pb long, k long")
    cross = _summed(cross, min_percent).select("a", "b", "na", "nb")
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = materialize(cross.join(done, ["a", "b"], "left_anti"))
    more = _links(src, cross, order, n, min_percent)
    comps = connected_components(links.unionByName(more), "a", "b")

    sets = materialize(shingle_sets(docs, n, text_col, id_col, text_key))
    classes = sets.filter("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("class_id"))
    classes = classes.join(comps.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "component", F.coalesce("component", "sig"))
    roots = classes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    classes = classes.join(roots, "component").select("sig", "class_id", "component_id", "component")
    out = sets.join(classes, "sig", "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "n_shingles",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      *([F.when(~alone, F.col("component")).alias("component"), "text_md5"] if text_key else []))

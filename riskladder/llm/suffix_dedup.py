"""Exact repeats of L bytes by a hash-compared suffix sort.

Sorting every suffix of the corpus is not needed: only suffixes whose next L bytes occur
again matter. Each L-byte string names an anchor inside itself, the place of its smallest
K-byte hash (leftmost on ties), so equal strings name the same place; about one place in
L/2 is an anchor.

1. One scan emits anchors (hash, text, place). The hash covers the anchor and the (L - K) / 2 bytes
   before it, or after it, whichever side is longer in the string, so a common line in different
   surroundings does not form a group. A hash that occurs once in the corpus ends the matter for all
   strings that name it.
2. The bytes around the remaining anchors are dealt to tasks by anchor hash. A task holds
   suffixes in groups (anchor hash, distance from the anchor to the suffix) and sorts every
   group by mergesort, all groups at once: two suffixes are compared by
   finding their common extension with a binary search over prefix polynomial hashes.
   Neighbours in suffix order with a common extension of L bytes are repeats.
   An anchor hash with more than ``hot`` places is thinned and split before its bytes move. Places whose strings
   cover the same bytes (named by 128-bit hashes, counted with partial sums) are repeats of each other and
   settled there; one place of each content goes on. Its strings are cut into ranges of
   distance to the anchor, and each range is keyed with the bytes that all its strings cover, so places
   with different surroundings part. What occurs once drops out, and what is still hot is cut into narrower ranges,
   at last single strings keyed with all their L bytes.
   Places of a task with equal bytes are settled before they are dealt (a text of one repeated word has
   thousands), so a task gets each content once per sender.
3. Neighbours found equal by hash are compared byte by byte (once per pair of anchors);
   on a collision the group is redone with the bytes themselves.

Exact copies are one text here: every byte of a text of L bytes or more that occurs in two
rows is removed, which needs no sort, and a large group of copies adds one set of anchors.

Edge cases: null and empty texts have no bytes; texts shorter than L lose nothing; a repeat
inside one document counts; repeated rows are copies of each other; null ids are kept; no
rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.session import materialize

GRAM = 32
HOT = 4096                       # places of one anchor hash that are dealt as they are
_RANGE, _LEVEL = np.int64(1 << 28), np.int64(4)      # a name holds place and side, level of the split, range


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: sums[j] - sums[i], times B**-i, names the bytes i..j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(A._BYTE[data] * A.powers(len(data) + 1)[0][:len(data)], out=out[1:])
    return out


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` elements (two block-wise scans)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(x)] = x
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


class _Anchors:
    """Anchors of a chunk: ``place`` (byte in the chunk), document, the range [lo, hi] of string starts
    that name it, and ``hash`` of the anchor with the bytes on its longer side in those strings; an
    anchor counts twice when strings of both kinds name it (``name`` tells them apart)."""

    def __init__(self, t: A.Text, length: int):
        self.t, self.length = t, length
        n = len(t.data)
        grams = n - GRAM + 1
        empty = np.zeros(0, np.int64)
        self.place = self.doc = self.lo = self.hi = self.name = empty
        self.hash = empty.astype(np.uint64)
        if n < length:
            return
        s = _sums(t.data)
        h = A.mix((s[GRAM:] - s[:-GRAM]) * A.powers(n + 1)[1][:grams])
        bits = np.uint64(max(1, int(n).bit_length()))
        key = ((h >> bits) << bits) | np.arange(grams, dtype=np.uint64)
        at = (_sliding_min(key, length - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        doc = np.repeat(np.arange(len(t)), np.diff(t.off))[:len(at)]
        starts = np.flatnonzero(np.arange(len(at)) + length <= t.off[1:][doc])
        at, doc = at[starts], doc[starts]
        if not len(at):
            return
        cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
        place, doc, lo = at[cut], doc[cut], starts[cut]
        hi = starts[np.concatenate([cut[1:] - 1, [len(at) - 1]])]
        # the strings with at least ``half`` bytes before the anchor are keyed with those, the others with those after it
        half = (length - GRAM) // 2
        inv = A.powers(n + 1)[1]
        left, right = np.flatnonzero(lo <= place - half), np.flatnonzero(hi > place - half)
        x, y = place[left], place[right]
        keys = np.concatenate([A.mix((s[x + GRAM] - s[x - half]) * inv[x - half] + np.uint64(1)),
                               A.mix((s[y + GRAM + half] - s[y]) * inv[y] + np.uint64(2))])
        los = np.concatenate([lo[left], np.maximum(lo[right], y - half + 1)])
        his = np.concatenate([np.minimum(hi[left], x - half), hi[right]])
        side = np.repeat([0, 1], [len(left), len(right)])
        of = np.concatenate([left, right])
        by = np.argsort(doc[of], kind="stable")
        self.hash, self.lo, self.hi, self.place, self.doc = keys[by], los[by], his[by], place[of][by], doc[of][by]
        self.name = ((self.place - t.off[self.doc]) * 2 + side[by]) * (_LEVEL * _RANGE)
        self.sums = s

    def wanted(self, names: list) -> np.ndarray:
        """Indexes of the anchors, repeated for their ranges, and the ranges' names, for a list of names per document."""
        at, out = [], []
        lo = np.searchsorted(self.doc, np.arange(len(self.t) + 1))
        for i, mine in enumerate(names):
            x = np.sort(np.asarray(mine, np.int64))
            whole = x // (_LEVEL * _RANGE) * (_LEVEL * _RANGE)
            here = self.name[lo[i]:lo[i + 1]]
            by = np.argsort(here)
            found = np.isin(whole, here)
            at.append(by[np.searchsorted(here[by], whole[found])] + lo[i])
            out.append(x[found])
        return np.concatenate(at or [np.zeros(0, np.int64)]), np.concatenate(out or [np.zeros(0, np.int64)])

    def ranges(self, k: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lo, hi, hash) of the named ranges of anchors ``k``: strings with a distance to the anchor in [r * w, r * w + w),
        keyed with the bytes that all strings of such distances cover."""
        level, r = name // _RANGE % _LEVEL, name % _RANGE
        w = np.array([self.length, *widths(self.length)])[level]
        place, lo, hi, h = self.place[k], self.lo[k], self.hi[k], self.hash[k]
        cut = level > 0
        lo = np.where(cut, np.maximum(lo, place - r * w - w + 1), lo)
        hi = np.where(cut, np.minimum(hi, place - r * w), hi)
        if cut.any():
            a = (place - r * w)[cut]
            b = (place - r * w - w + 1)[cut] + self.length
            body = (self.sums[b] - self.sums[a]) * A.powers(len(self.sums))[1][a]
            h = h.copy()
            h[cut] = A.mix(A.mix(h[cut] + name[cut].astype(np.uint64) % np.uint64(_LEVEL * _RANGE) * np.uint64(0x9E3779B97F4A7C15)) + body)
        return lo, hi, h

    def split(self, k: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of the next level that make up the named ranges of anchors ``k``: anchors and names."""
        lo, hi, _ = self.ranges(k, name)
        level = name // _RANGE % _LEVEL + 1
        w = np.array([self.length, *widths(self.length)])[level]
        first, last = (self.place[k] - hi) // w, (self.place[k] - lo) // w
        n = last - first + 1
        of = np.repeat(np.arange(len(k)), n)
        r = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        return k[of], self.name[k][of] + level[of] * _RANGE + r


def widths(length: int) -> tuple[int, ...]:
    """Distances in a range, per level of the split: powers of two, at last one."""
    w = 1 << max(0, min(64, (length - GRAM) // 4).bit_length() - 1)
    return w, max(1, w // 8), 1


def _contents(texts: DataFrame, length: int) -> DataFrame:
    """What the strings of each named anchor (column places) cover: (h, back, md5, th, place, lo, hi), a row per content and task;
    rows without md5 are runs of bytes that are settled, as a task met their content before."""

    def scan(batches):
        first: dict[tuple[int, int, bytes], list] = {}
        for t in A.text_chunks(batches, "text", "th"):
            a = _Anchors(t, length)
            k, name = a.wanted(t.rows.column("places").to_pylist())
            los, his, hashes = a.ranges(k, name)
            data, d = t.data.tobytes(), a.doc[k]
            rows: list[tuple] = []
            runs: dict[int, list] = {}
            for h, th, back, place, start, i, j in zip(hashes.view(np.int64).tolist(), t.ids[d].tolist(), (a.place[k] - los).tolist(),
                                                       name.tolist(), (los - t.off[d]).tolist(), los.tolist(), (his + length).tolist()):
                key = (h, back, hashlib.md5(data[i:j]).digest())
                old = first.get(key)
                if old is None:
                    first[key] = [th, start, start + j - i]
                    rows.append((h, back, key[2], th, place, start, start + j - i))
                    continue
                runs.setdefault(th, []).append((start, start + j - i))
                if old:
                    runs.setdefault(old[0], []).append((old[1], old[2]))
                    old.clear()
            for th, x in runs.items():
                lo, hi = A.merged(*np.array(x).T)
                rows += [(None, None, None, th, None, p, q) for p, q in zip(lo.tolist(), hi.tolist())]
            for x in range(0, len(rows), 1 << 14):
                cols = list(zip(*rows[x:x + (1 << 14)]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == 2 else pa.int64()) for n, c in enumerate(cols)],
                                                 ["h", "back", "md5", "th", "place", "lo", "hi"])

    return texts.mapInArrow(scan, "h long, back long, md5 binary, th long, place long, lo long, hi long")


def _split_rows(texts: DataFrame, length: int) -> DataFrame:
    """As ``_anchor_rows`` for the next ranges of the texts' hot ones (column places)."""

    def scan(batches):
        for t in A.text_chunks(batches, "text", "th"):
            a = _Anchors(t, length)
            k, name = a.split(*a.wanted(t.rows.column("places").to_pylist()))
            h = a.ranges(k, name)[2]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(t.ids[a.doc[k]]), pa.array(name)], ["h", "th", "place"])

    return texts.mapInArrow(scan, "h long, th long, place long")


def _anchor_rows(src: DataFrame, length: int) -> DataFrame:
    def scan(batches):
        seen: set[int] = set()
        for t in A.text_chunks(batches, "text", "th"):
            a = _Anchors(t, length)
            use = np.zeros(len(t), bool)
            for i, x in enumerate(t.ids.tolist()):
                if x not in seen:
                    seen.add(x)
                    use[i] = True
            k = use[a.doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.hash[k].view(np.int64)), pa.array(t.ids[a.doc[k]]), pa.array(a.name[k])],
                ["h", "th", "place"])

    return src.mapInArrow(scan, "h long, th long, place long")


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """The bytes that the strings of each wanted anchor cover, distinct within the task; a row without
    bytes is a settled repeat [start, back) of text th."""

    def scan(batches):
        # places with equal bytes are repeats of each other: one of them goes on, the others are settled here
        first: dict[tuple[int, int, bytes], list] = {}
        for t in A.text_chunks(batches, "text", "th"):
            a = _Anchors(t, length)
            k, name = a.wanted(t.rows.column("places").to_pylist())
            los, his, hashes = a.ranges(k, name)
            out: list[tuple] = []
            data = t.data.tobytes()
            d = a.doc[k]
            for h, th, start, back, i, j in zip(hashes.view(np.int64).tolist(), t.ids[d].tolist(), (los - t.off[d]).tolist(),
                                                (a.place[k] - los).tolist(), los.tolist(), (his + length).tolist()):
                body = data[i:j]
                key = (h, back, hashlib.md5(body).digest())
                old = first.get(key)
                if old is None:
                    first[key] = [th, start]
                    out.append((h, th, start, back, body))
                    continue
                if old:
                    out.append((old[0], old[0], old[1], old[1] + j - i, None))
                    old.clear()
                out.append((th, th, start, start + j - i, None))
            for x in range(0, len(out), 2048):
                cols = list(zip(*out[x:x + 2048]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.binary())],
                                                 ["h", "th", "start", "back", "body"])

    return rows.mapInArrow(scan, "h long, th long, start long, back long, body binary")


class _Suffixes:
    """Suffixes of length L inside ``data``; compared through prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.sums = _sums(data)
        self.inv = A.powers(len(data) + 1)[1]

    def same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        s, q = self.sums, self.inv
        return (s[x + n] - s[x]) * q[x] == (s[y + n] - s[y]) * q[y]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, at most L: a binary search."""
        out = np.full(len(x), self.length, np.int64)
        open_ = np.flatnonzero(~self.same(x, y, self.length))
        if not len(open_):
            return out
        a, b = x[open_], y[open_]
        lo, hi = np.zeros(len(a), np.int64), np.full(len(a), self.length - 1, np.int64)
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            ok = self.same(a, b, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        out[open_] = lo
        return out

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        at = np.minimum(n, self.length - 1)
        return (n < self.length) & (self.data[x + at] < self.data[y + at])

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Mergesort of the suffixes ``at`` inside each group (``group`` ascending): sorted runs
        double each round; every element finds its rank in the neighbouring run by binary search."""
        lo, hi = A.segments(group)
        first, end = np.repeat(lo, hi - lo), np.repeat(hi, hi - lo)
        index = np.arange(len(at))
        run = 1
        while len(lo) and run < (hi - lo).max():
            pair = first + (index - first) // (2 * run) * (2 * run)     # start of the pair of runs
            middle, stop = np.minimum(pair + run, end), np.minimum(pair + 2 * run, end)
            moving = np.flatnonzero(stop > middle)
            here, p, m, e = index[moving], pair[moving], middle[moving], stop[moving]
            left = here < m
            a, b = np.where(left, m, p), np.where(left, e, m)           # the other run
            base = a.copy()
            mine = at[here]
            while True:
                busy = np.flatnonzero(a < b)
                if not len(busy):
                    break
                mid = (a[busy] + b[busy]) >> 1
                other = at[mid]
                before = np.empty(len(busy), bool)                      # other goes before mine
                l = left[busy]
                before[l] = self.less(other[l], mine[busy][l])
                before[~l] = ~self.less(mine[busy][~l], other[~l])
                a[busy] = np.where(before, mid + 1, a[busy])
                b[busy] = np.where(before, b[busy], mid)
            to = np.where(left, here, here - m + p) + (a - base)
            new = at.copy()
            new[to] = mine
            at = new
            run *= 2
        return at


def _repeats(length: int, budget: int = 1 << 19):
    """Sort one task's suffixes and give, per text, the byte runs covered by repeats."""

    def mark_repeats(s: _Suffixes, at: np.ndarray, group: np.ndarray, base: np.ndarray, mark: np.ndarray) -> None:
        at = s.sort(at, group)
        x, y = at[:-1], at[1:]
        hit = np.flatnonzero((group[1:] == group[:-1]) & s.same(x, y, length))
        x, y = x[hit], y[hit]
        if not len(x):
            return
        # byte check: once per pair of members over its stretch of suffixes
        a, b = (np.searchsorted(base, v, "right") - 1 for v in (x, y))
        by = np.lexsort((x, b, a))
        cut = np.flatnonzero(np.concatenate([[True], (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])]))
        stop = np.concatenate([cut[1:], [len(by)]])
        for i, j in zip(cut, stop):
            mine = by[i:j]
            p, q, shift = x[mine[0]], x[mine[-1]], y[mine[0]] - x[mine[0]]
            if (s.data[p:q + length] != s.data[p + shift:q + shift + length]).any() and not all(
                    (s.data[u:u + length] == s.data[v:v + length]).all() for u, v in zip(x[mine], y[mine])):
                names: dict[tuple[int, bytes], list[int]] = {}     # a hash collision: use the bytes
                for g, u in zip(group.tolist(), at.tolist()):
                    names.setdefault((g, s.data[u:u + length].tobytes()), []).append(u)
                mark[[u for us in names.values() if len(us) > 1 for u in us]] = True
                return
        mark[x] = True
        mark[y] = True

    def one(rows: list[tuple]) -> pa.RecordBatch | None:
        """rows: (h, th, start, back, body) of whole anchor groups."""
        data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        size = np.array([len(r[4]) for r in rows])
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        count = size - length + 1
        member = np.repeat(np.arange(len(rows)), count)
        step = np.arange(len(member)) - np.repeat(np.cumsum(count) - count, count)
        at = base[member] + step
        h = np.array([r[0] for r in rows])
        gid = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
        distance = np.array([r[3] for r in rows])[member] - step        # from suffix to anchor
        group = gid[member] * (length + 1) + distance
        by = np.argsort(group, kind="stable")
        at, group = at[by], group[by]
        s = _Suffixes(data, length)
        mark = np.zeros(len(data), bool)
        lo, hi = A.segments(group)
        lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
        a = 0
        while a < len(lo):                         # groups are independent: a bounded number of suffixes at a time
            b = a + max(1, int(np.searchsorted(np.cumsum((hi - lo)[a:]), budget // 4, "right")))
            take = np.concatenate([np.arange(i, j) for i, j in zip(lo[a:b], hi[a:b])])
            mark_repeats(s, at[take], group[take], base, mark)
            a = b
        found = np.flatnonzero(mark)
        if not len(found):
            return None
        who = np.searchsorted(base, found, "right") - 1
        new = np.concatenate([[True], (who[1:] != who[:-1]) | (found[1:] > found[:-1] + length)])
        cut = np.flatnonzero(new)
        last = np.concatenate([cut[1:] - 1, [len(found) - 1]])
        w = who[cut]
        start = np.array([r[2] for r in rows])[w] - base[w]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array([r[1] for r in rows])[w]), pa.array(found[cut] + start), pa.array(found[last] + start + length)],
            ["th", "lo", "hi"])

    def scan(batches):
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("h", "th", "start", "back", "body")))]
        settled = [r for r in rows if r[4] is None]
        for x in range(0, len(settled), 1 << 15):
            cols = list(zip(*settled[x:x + (1 << 15)]))
            yield pa.RecordBatch.from_arrays([pa.array(cols[k], pa.int64()) for k in (1, 2, 3)], ["th", "lo", "hi"])
        rows = [r for r in rows if r[4] is not None]
        rows.sort(key=lambda r: r[0])
        a = 0
        while a < len(rows):
            b, used = a, 0
            while b < len(rows) and (used < budget or rows[b][0] == rows[b - 1][0]):
                used += len(rows[b][4])
                b += 1
            got = one(rows[a:b])
            if got is not None:
                yield got
            a = b

    return scan


def _cut(carry: bool):
    def scan(batches):
        for b in (x.slice(a, 512) for x in batches for a in range(0, x.num_rows, 512)):
            out: list[list] = [[], [], [], [], []]
            for body, los, his, whole in zip(b.column("body").to_pylist(), b.column("los").to_pylist(),
                                             b.column("his").to_pylist(), b.column("whole").to_pylist()):
                body = body or b""
                lo = hi = np.zeros(0, np.int64)
                if whole:
                    lo, hi = np.array([0]), np.array([len(body)])
                elif los:
                    lo, hi = A.merged(np.array(los), np.array(his))
                kept = b"".join(body[i:j] for i, j in zip([0, *hi.tolist()], [*lo.tolist(), len(body)]))
                for col, v in zip(out, (len(body), int((hi - lo).sum()), lo.tolist(), hi.tolist(), kept)):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            cols = [b.column("doc_id"), *(pa.array(v, k) for v, k in zip(out, kinds))]
            names = ["doc_id", "n_bytes", "n_removed", "removed_from", "removed_to", "kept"]
            if carry:
                cols.append(b.column("rest"))
                names.append("rest")
            yield pa.RecordBatch.from_arrays(cols, names)

    return scan


def _shared(plain: DataFrame, length: int, hot: int) -> tuple[DataFrame, list[DataFrame]]:
    """Texts (th, text) with the names of their ranges whose hash occurs again (places), and frames of
    runs (th, lo, hi) that are settled already."""
    runs: list[DataFrame] = []

    def named(rows):
        places = materialize(rows.groupBy("th").agg(F.collect_set("place").alias("places")))
        bits = plain.sparkSession.sparkContext.broadcast(A.bloom_of(places, "th"))
        return A.with_bits(plain, "th", bits).dropDuplicates(["th"]).join(places, "th")

    rows, done = materialize(_anchor_rows(plain, length)), []
    for level in range(len(widths(length)) + 1):
        again = (rows.groupBy("h").agg(F.min("th").alias("a"), F.max("th").alias("b"), F.min("place").alias("c"), F.max("place").alias("d"),
                                       F.count("*").alias("n"))
                 .filter("a <> b or c <> d").select("h", (F.col("n") > hot).alias("hot")))
        met = materialize(rows.join(again, "h").select("th", "place", "hot"))
        if level == len(widths(length)):
            done.append(met)
            break
        done.append(met.filter("not hot"))
        more = met.filter("hot")
        if more.isEmpty():
            break
        if level == 0:
            found = materialize(_contents(named(more), length))
            runs.append(found.filter("md5 is null").select("th", "lo", "hi"))
            found = found.filter("md5 is not null")
            each = found.groupBy("h", "back", "md5").agg(F.count("*").alias("n"), F.min(F.struct("th", "place")).alias("one"))
            runs.append(found.join(each.filter("n > 1").select("h", "back", "md5"), ["h", "back", "md5"]).select("th", "lo", "hi"))
            more = each.select("one.th", "one.place")
        rows = materialize(_split_rows(named(more), length))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return named(out), runs


def remove_repeated_bytes(docs: DataFrame, length: int = 400, text_col: str = "text", id_col: str = "doc_id",
                          carry: list[str] | None = None, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, removed_from / removed_to (maximal byte
    runs) and kept (the remaining bytes; a cut may fall inside a character)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *([F.struct(*carry).alias("rest")] if carry else []))
    src = src.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    plain = src.select("th", "text").filter(F.octet_length("text") >= length)

    texts, settled = _shared(plain, length, hot)
    runs = _contexts(texts, length).repartition(A.reduce_tasks(docs), "h").mapInArrow(_repeats(length), "th long, lo long, hi long")
    for x in settled:
        runs = runs.unionByName(x)
    copies = plain.groupBy("th").count().filter("count > 1").select(
        "th", F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.lit(True).alias("whole"))
    marks = materialize(runs.withColumn("whole", F.lit(False)).unionByName(copies).groupBy("th").agg(
        F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"), F.max("whole").alias("whole")))
    bits = spark.sparkContext.broadcast(A.bloom_of(marks, "th"))
    body = src.withColumn("body", F.col("text").cast("binary")).drop("text")
    none = F.lit(None).cast("array<bigint>")
    untouched = A.with_bits(body, "th", bits, has=False).withColumns({"los": none, "his": none, "whole": F.lit(False)})
    touched = A.with_bits(body, "th", bits).join(marks, "th", "left")
    schema = "doc_id long, n_bytes long, n_removed long, removed_from array<long>, removed_to array<long>, kept binary"
    if carry:
        schema += f", rest {src.schema['rest'].dataType.simpleString()}"
    return untouched.unionByName(touched).drop("th").mapInArrow(_cut(bool(carry)), schema)

"""Substring dedup by fixed-block anchors.

A window of W words that repeats always contains one whole block of a = (W + 1) // 2
words that starts at a multiple of a in the earlier document. So it is enough to

1. index every document's non-overlapping a-word blocks and probe them with every rolling
   a-word window (both dealt to reduce tasks by hash; 32 bits travel, a chance hit is
   harmless because step 2 looks at the words again);
2. extend the hits: around a hit block every W-word window of the two documents is compared
   by its 64-bit hash, and the windows also found in a smaller id are kept;
   overlapping windows merge to maximal exact repeats.

Exact copies need no windows at all: a copy of a text with a smaller id is a repeat from
end to end. So only a text's first document matters, each task deals a text once, and a
large group of copies costs one scan. A block in a third of all documents gives one
entry each, never pairs: a probe asks for the smallest id that has its block.

Edge cases: null, empty and blank texts have no words; texts shorter than W words lose
nothing; a null id is larger than every id (and no smaller than another null); rows with equal
id do not remove each other's words; repeated rows get equal results; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.session import materialize


def _first_of_text(src: DataFrame) -> DataFrame:
    """doc_id, rk (row key: id and text) and whether a smaller id has the same text."""
    keyed = src.select("oid", "rk", F.md5(F.col("text").cast("binary")).alias("m"))
    first = keyed.groupBy("m").agg(F.min("oid").alias("first"))
    return keyed.join(first, "m").groupBy("rk").agg(F.max(F.col("oid") > F.col("first")).alias("copy"))


def _probes(src: DataFrame, block: int, tasks: int) -> DataFrame:
    def scan(batches):
        seen: dict[bytes, int] = {}
        for t in A.text_chunks(batches, "text", "oid"):
            w = A.Words(t, lower=False)
            h, at, doc = A.window_hashes(w, block)
            use = np.ones(len(t), bool)
            for i in np.flatnonzero(w.counts > block):
                name = hashlib.md5(t.bytes_of(i)).digest()
                if seen.get(name, A.NO_ID + 1) <= t.ids[i]:
                    use[i] = False
                else:
                    seen[name] = int(t.ids[i])
            keep = use[doc]
            h, at, doc = h[keep], at[keep], doc[keep]
            if len(h):
                yield A.deal(A.by_bits(h, tasks), doc,
                             {"h32": (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), "pos": at - w.first[doc]}, {"oid": t.ids})

    return src.mapInArrow(A.tidy(scan), "part int, per_doc binary, h32 binary, pos binary, oid binary")


def _deal_by_document(name: str, ids: np.ndarray, values: np.ndarray, tasks: int) -> pa.RecordBatch:
    """``values`` of documents as one row per reduce task (see ``_by_document``)."""
    by = np.argsort(ids, kind="stable")
    ids, values = ids[by], values[by]
    lo, hi = A.segments(ids)
    names, doc = ids[lo], np.repeat(np.arange(len(lo)), hi - lo)
    return A.deal(A.by_bits(A.mix(names.view(np.uint64)), tasks)[doc], doc, {"pos": values.astype(np.int64)}, {name: names})


def _by_document(dealt: DataFrame, name: str, values: str, tasks: int) -> DataFrame:
    """All dealt values (32 bits each) of each document in one row."""

    def scan(batches):
        x = A.dealt(batches, {"pos": "small"}, {name: "<i8"})
        if x is None:
            return
        ids = x[2][name][x[1]]
        by = np.argsort(ids, kind="stable")
        ids, pos = ids[by], x[0]["pos"][by].astype(np.uint32)
        lo, hi = A.segments(ids)
        for a in range(0, len(lo), 4096):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo[a:a + 4096]]),
                 pa.array([pos[i:j].tobytes() for i, j in zip(lo[a:a + 4096], hi[a:a + 4096])], pa.binary())], [name, values])

    return dealt.repartitionById(tasks, F.col("part")).mapInArrow(A.tidy(scan), f"{name} long, {values} binary")


def _hits(block: int, tasks: int):
    """Probes that meet an indexed block of a smaller id, and the indexed blocks that were met, dealt by
    document: one row per reduce task."""

    def scan(batches):
        x = A.dealt(batches, {"h32": "<u4", "pos": "small"}, {"oid": "<i8"})
        if x is None:
            return
        h, pos, doc, ids = x[0]["h32"], x[0]["pos"], x[1], x[2]["oid"]
        ref = np.flatnonzero(pos % block == 0)
        by = np.lexsort((ids[doc[ref]], h[ref]))
        ref = ref[by]
        rh, ro = h[ref], ids[doc[ref]]
        lo, hi = A.segments(rh)
        known, least = rh[lo], ro[lo]
        if not len(known):
            return
        table = np.zeros(1 << 24, bool)
        table[known >> np.uint32(8)] = True
        cand = np.flatnonzero(table[h >> np.uint32(8)])
        del table
        at = np.minimum(np.searchsorted(known, h[cand]), len(known) - 1)
        ok = (known[at] == h[cand]) & (least[at] < ids[doc[cand]])
        hit, at = cand[ok], at[ok]
        last = np.full(len(known), np.iinfo(np.int64).min)
        np.maximum.at(last, at, ids[doc[hit]])
        met = ref[np.repeat(last, hi - lo) > ro]
        who = ids[doc[np.concatenate([hit, met])]]
        what = np.concatenate([pos[hit].astype(np.int64) * 4 + 1, pos[met].astype(np.int64) * 4 + 2])
        if len(who):
            yield _deal_by_document("oid", who, what, tasks)

    return scan


def _windows(rows: DataFrame, window: int, block: int, tasks: int) -> DataFrame:
    """W-word windows around hits: bit 0 asks for a smaller id, bit 1 answers."""

    def scan(batches):
        for t in A.text_chunks(batches, "text", "oid"):
            w = A.Words(t, lower=False)
            marks = np.zeros((2, len(w.hashes) + 1), np.int64)
            for i, hits in enumerate(t.rows.column("hits").to_pylist()):
                v = np.frombuffer(hits, np.uint32)
                pos = (v >> 2).astype(np.int64)
                inside = pos < w.counts[i]
                for bit in (0, 1):
                    marks[bit, w.first[i] + pos[inside & ((v >> bit) & 1 == 1)] + 1] = 1
            h, at, doc = A.window_hashes(w, window)
            c = np.cumsum(marks, axis=1)
            span = window - block + 1
            flags = sum(((c[bit, at + span] > c[bit, at]) << bit for bit in (0, 1)), np.zeros(len(at), np.int64))
            keep = flags > 0
            h, at, doc, flags = h[keep], at[keep], doc[keep], flags[keep]
            if len(h):
                yield A.deal(A.by_bits(h, tasks), doc, {"h": h, "pos": (at - w.first[doc]) * 4 + flags},
                             {"oid": t.ids, "rk": A.int64(t.rows.column("rk"))})

    return rows.mapInArrow(A.tidy(scan), "part int, per_doc binary, h binary, pos binary, oid binary, rk binary")


def _repeats(tasks: int):
    """Starts of the windows that also start in a smaller id, dealt by document: one row per reduce task."""

    def scan(batches):
        x = A.dealt(batches, {"h": "<u8", "pos": "small"}, {"oid": "<i8", "rk": "<i8"})
        if x is None:
            return
        h, pos, flags, oid, rk = x[0]["h"], x[0]["pos"] >> 2, x[0]["pos"] & 3, x[2]["oid"][x[1]], x[2]["rk"][x[1]]
        ref = np.flatnonzero(flags & 2)
        by = np.lexsort((oid[ref], h[ref]))
        rh, ro = h[ref][by], oid[ref][by]
        lo, _ = A.segments(rh)
        if not len(lo):
            return
        known, least = rh[lo], ro[lo]
        ask = np.flatnonzero(flags & 1)
        at = np.minimum(np.searchsorted(known, h[ask]), len(known) - 1)
        hit = ask[(known[at] == h[ask]) & (least[at] < oid[ask])]
        if len(hit):
            yield _deal_by_document("rk", rk[hit], pos[hit], tasks)

    return scan


_WORD = re.compile(rb"[^ \t-\r]+")


def _without(body: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    """The text without words lo..hi and the space after them; the rest stays as it is."""
    at = [m.start() for m in _WORD.finditer(body)] + [len(body)]
    out, done = [], 0
    for i, j in zip(lo, hi):
        out.append(body[done:at[i]])
        done = at[j]
    return b"".join([*out, body[done:]])


def _cut(window: int, layout: bool, carry: bool):
    """Kept words, removed runs and counts of each row (columns starts, copy, text)."""

    def scan(batches):
        for b in (x.slice(a, 512) for x in batches for a in range(0, x.num_rows, 512)):
            out: list[list] = [[], [], [], [], []]
            for text, starts, copy in zip(b.column("text").to_pylist(), b.column("starts").to_pylist(), b.column("copy").to_pylist()):
                body = (text or "").encode("utf-8", "surrogatepass")
                words = body.split()
                lo = hi = np.zeros(0, np.int64)
                if copy and len(words) >= window:
                    lo, hi = np.array([0]), np.array([len(words)])
                elif starts:
                    s = np.frombuffer(starts, np.uint32).astype(np.int64)
                    lo, hi = A.merged(s, s + window)
                if layout:
                    left = _without(body, lo, hi) if len(lo) else body
                else:
                    kept, at = [], 0
                    for i, j in zip(lo, hi):
                        kept += words[at:i]
                        at = j
                    left = b" ".join(kept + words[at:])
                for col, v in zip(out, (len(words), int((hi - lo).sum()), left.decode("utf-8", "replace"),
                                        lo.tolist(), hi.tolist())):
                    col.append(v)
            cols = [b.column("oid"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                    pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.list_(pa.int64()))]
            names = ["oid", "n_words", "n_removed", "kept_text", "removed_from", "removed_to"]
            if carry:
                cols.append(b.column("rest"))
                names.append("rest")
            yield pa.RecordBatch.from_arrays(cols, names)

    return scan


def remove_repeats(docs: DataFrame, window: int = 13, text_col: str = "text", id_col: str = "doc_id",
                   layout: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (kept words joined by one
    space; with ``layout`` in the text's own white space), removed_from / removed_to (word ranges); ``carry`` columns come along as struct
    ``rest``. Removed is every word of a ``window``-word run that also starts in a smaller id."""
    spark = docs.sparkSession
    block, tasks = (window + 1) // 2, A.reduce_tasks(docs)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(A.NO_ID)).alias("oid"),
                      F.col(text_col).cast("string").alias("text"),
                      *([F.struct(*carry).alias("rest")] if carry else []))
    src = src.withColumn("rk", F.xxhash64("oid", "text"))
    plain = src.select("oid", "rk", "text")

    met = (_probes(plain, block, tasks).repartitionById(tasks, F.col("part"))
           .mapInArrow(A.tidy(_hits(block, tasks)), "part int, per_doc binary, pos binary, oid binary"))
    hits = materialize(_by_document(met, "oid", "hits", tasks))
    hit_docs = spark.sparkContext.broadcast(A.bloom_of(hits, "oid"))
    rows = A.with_bits(plain, "oid", hit_docs).join(hits, "oid")
    again = (_windows(rows, window, block, tasks).repartitionById(tasks, F.col("part"))
             .mapInArrow(A.tidy(_repeats(tasks)), "part int, per_doc binary, pos binary, rk binary"))
    starts = _by_document(again, "rk", "starts", tasks)
    copies = _first_of_text(plain).filter("copy").select("rk", F.lit(None).cast("binary").alias("starts"), "copy")
    marks = materialize(starts.withColumn("copy", F.lit(False)).unionByName(copies))    # a row may be in both
    bits = spark.sparkContext.broadcast(A.bloom_of(marks, "rk"))
    untouched = A.with_bits(src, "rk", bits, has=False).withColumn("starts", F.lit(None).cast("binary")).withColumn("copy", F.lit(False))
    touched = (A.with_bits(src, "rk", bits).join(marks.filter("not copy").select("rk", "starts"), "rk", "left")
               .join(marks.filter("copy").select("rk", "copy"), "rk", "left"))
    schema = "oid long, n_words long, n_removed long, kept_text string, removed_from array<long>, removed_to array<long>"
    if carry:
        schema += f", rest {src.schema['rest'].dataType.simpleString()}"
    out = untouched.unionByName(touched).drop("rk").mapInArrow(A.tidy(_cut(window, layout, bool(carry))), schema)
    return out.withColumn("doc_id", F.when(F.col("oid") != A.NO_ID, F.col("oid"))).drop("oid")

"""Spelling variants: words that differ by one code point, found in frequency-vector tries.

A word is described by how often it uses each letter group. One inserted or deleted code point
changes one count by one, a replaced one raises one count and lowers one (or stays within a
group), so two near words differ by a surplus of at most one and a deficit of at most one.

* Occurrences are counted by Spark (a grouped count, combined before the shuffle).
* Coarse groups route: all words with the same four coarse counts live in one trie, named by
  those counts. A word asks its own trie and the tries one surplus and one deficit away, each
  pair of tries in one direction only. A trie with more than ``hot`` words is dealt into
  several by word, and asked in each of them.
* Fine groups are the levels of a trie: its words are sorted by successive group counts, a node is a
  run of words with equal counts so far. A depth-first search carries all words that ask, each
  with its surplus and deficit spent so far; words of small nodes and leaves
  that share the first or the last three letters (one edit leaves one of the two) are compared letter by letter.

The form of a word is its near word of most occurrences, if those are at least ten times its own;
forms grow tenfold at each step, so following them to the last takes the logarithm of that
in rounds of pointer doubling.

Edge cases: null and empty texts have no words; a null id reads as an empty string in the
checksum; words of any length are compared whole; ties of forms go to the smaller word in code-point
order; repeated rows count again; other columns are ignored; no words give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm.arrays import reduce_tasks, segments, tidy
from riskladder.session import materialize

LEAST_CHARS, LEAST_COUNT, STRONGER = 7, 2, 10
LEAF = 24                      # words of a node that are checked without going deeper
HOT = 50_000                   # words of one trie; more are dealt into several
WIDTH = 64                     # longer words are compared one by one
_PAIRS = 1 << 20               # pairs looked at at a time
# fixed values: letter groups of about equal use; other code points go by their number
GROUPS = ("e", "tj", "aq", "ox", "iz", "nk", "sv", "hb", "rp", "dgy", "lfw", "cum")
COARSE = 4                     # coarse group of a fine one: its number modulo this
_TOP = 32767                   # counts above are kept at this; differences never grow by that

_FINE = np.arange(256, dtype=np.int64) % len(GROUPS)
for _k, _letters in enumerate(GROUPS):
    _FINE[[ord(c) for c in _letters]] = _k


def _latin(column) -> tuple[np.ndarray, np.ndarray]:
    """Code points (all below 256) of words, one byte each, and where each word begins."""
    words = column.to_pylist()
    off = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=off[1:])
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), off


def _vectors(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of every fine group, a row per word."""
    who = np.repeat(np.arange(len(off) - 1), np.diff(off))
    flat = np.bincount(who * len(GROUPS) + _FINE[data], minlength=(len(off) - 1) * len(GROUPS))
    return np.minimum(flat.reshape(-1, len(GROUPS)), _TOP).astype(np.int16)


def _coarse(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.int64)
    return np.minimum(np.stack([wide[:, k::COARSE].sum(1) for k in range(COARSE)], 1), _TOP)


def _key(coarse: np.ndarray) -> np.ndarray:
    return (coarse << (16 * np.arange(COARSE))).sum(1)


def _steps() -> np.ndarray:
    """Coarse differences of one surplus and one deficit at most."""
    one = np.eye(COARSE, dtype=np.int64)
    out = [np.zeros(COARSE, np.int64), *one, *-one] + [a - b for i, a in enumerate(one) for j, b in enumerate(one) if i != j]
    return np.array(out)


class Words:
    """The words of one trie and of those that ask it, with what their comparison needs."""

    def __init__(self, column):
        self.data, self.off = _latin(column)
        self.size = np.diff(self.off)
        self.vectors = _vectors(self.data, self.off)
        width = int(self.size[self.size <= WIDTH].max(initial=0)) + 1
        short = np.repeat(self.size <= WIDTH, self.size)
        who = np.repeat(np.arange(len(self.size)), self.size)[short]
        at = (np.arange(len(self.data)) - np.repeat(self.off[:-1], self.size))[short]
        self.letters = np.zeros((len(self.size), width), np.uint8)
        self.letters[who, at] = self.data[short]
        # a word has at least seven letters: one edit leaves its first three or its last three as they are
        ends = [self.data[self.off[:-1] + k].astype(np.int32) << (8 * k) for k in range(3)]
        self.head = ends[0] | ends[1] | ends[2]
        ends = [self.data[self.off[1:] - 1 - k].astype(np.int32) << (8 * k) for k in range(3)]
        self.tail = ends[0] | ends[1] | ends[2]

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of words (a[i], b[i]) differ by exactly one code point."""
        out = np.zeros(len(a), bool)
        short = (self.size[a] <= WIDTH) & (self.size[b] <= WIDTH)
        for i in np.flatnonzero(~short):
            x, y = (self.data[self.off[w]:self.off[w + 1]] for w in sorted((int(a[i]), int(b[i])), key=lambda w: self.size[w]))
            n = len(x)
            if len(y) == n:
                out[i] = np.count_nonzero(x != y) == 1
            elif len(y) == n + 1:
                at = int(np.argmax(np.append(x != y[:n], True)))
                out[i] = np.array_equal(x[at:], y[at + 1:])
        i = np.flatnonzero(short)
        if not len(i):
            return out
        swap = self.size[a[i]] > self.size[b[i]]
        lo, hi = np.where(swap, b[i], a[i]), np.where(swap, a[i], b[i])
        x, y = self.letters[lo], self.letters[hi]
        gap = self.size[hi] - self.size[lo]
        differ = x != y
        rest = (x[:, :-1] != y[:, 1:]) & (np.arange(x.shape[1] - 1)[None, :] >= differ.argmax(1)[:, None])
        out[i] = np.where(gap == 0, np.count_nonzero(differ, axis=1) == 1, (gap == 1) & ~rest.any(1))
        return out

    def pairs(self, held: np.ndarray, asked: np.ndarray, leaf: int = LEAF):
        """(word that asks, word of the trie) for all near pairs; ``held`` in the order of the vectors."""
        head, tail = self.head[held], self.tail[held]
        for who, lo, hi in search(self.vectors[held], self.vectors[asked], leaf):
            step = max(1, _PAIRS // (hi - lo))
            for k in range(0, len(who), step):
                w = asked[who[k:k + step]]
                i, j = np.nonzero((self.head[w][:, None] == head[lo:hi]) | (self.tail[w][:, None] == tail[lo:hi]))
                if len(i):
                    a, b = w[i], held[lo + j]
                    ok = self.near(a, b)
                    yield a[ok], b[ok]


def search(trie: np.ndarray, asked: np.ndarray, leaf: int = LEAF):
    """Depth-first walk of a trie of count vectors (sorted rows), all asking vectors at once: (rows of
    ``asked``, first and last row of a node) for every leaf or small node that they reach
    with a surplus and a deficit of at most one."""
    none = np.zeros(len(asked), np.int8)
    stack = [(0, len(trie), 0, np.arange(len(asked)), none, none)]
    while stack:
        lo, hi, level, who, plus, minus = stack.pop()
        if hi - lo <= leaf or level == trie.shape[1]:
            yield who, lo, hi
            continue
        starts, ends = segments(trie[lo:hi, level])
        for s, e in zip(starts, ends):
            d = asked[who, level] - trie[lo + s, level]
            ok = np.flatnonzero((d == 0) | ((d == 1) & (plus == 0)) | ((d == -1) & (minus == 0)))
            if len(ok):
                stack.append((lo + s, lo + e, level + 1, who[ok], plus[ok] + (d[ok] == 1), minus[ok] + (d[ok] == -1)))


def words_of(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", typo_every: int = 31) -> DataFrame:
    """(word, n): distinct words after the seeded deletions, with their occurrences."""
    text, doc = F.col(text_col).cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # a run of at least LEAST_CHARS is matched whole; shorter runs cannot give a word
    runs = F.regexp_extract_all(text, F.lit(f"[A-Za-zÀ-ÿ]{{{LEAST_CHARS},}}"), F.lit(0))
    one = docs.select(doc.alias("_doc"), F.explode(runs).alias("_run"))
    low = F.translate("_run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    one = one.select("_doc", low.alias("_run")).withColumn("_h", F.crc32(F.concat_ws(":", "_doc", "_run")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    one = one.select(F.when(F.col("_h") % typo_every == 0, cut).otherwise(F.col("_run")).alias("word"))
    return (one.filter(F.length("word") >= LEAST_CHARS).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, near, near_n): every ordered pair of words that differ by one code point. ``words``: word, n."""

    def named(batches):
        for b in batches:
            if b.num_rows:
                key = _key(_coarse(_vectors(*_latin(b.column("word")))))
                yield pa.RecordBatch.from_arrays([b.column("word"), b.column("n"), pa.array(key)], ["word", "n", "key"])

    keyed = materialize(words.select("word", "n").mapInArrow(tidy(named), "word string, n long, key long"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > hot)
    steps = _steps()

    def asking(batches):
        for b in batches:
            if not b.num_rows:
                continue
            coarse = _coarse(_vectors(*_latin(b.column("word"))))
            own = _key(coarse)
            for d in steps:
                there = np.minimum(coarse + d, _TOP)
                key = _key(there)
                ok = np.flatnonzero((there >= 0).all(1) & ((key > own) if d.any() else True))
                rows = pa.array(ok)
                yield pa.RecordBatch.from_arrays([b.column("word").take(rows), b.column("n").take(rows), pa.array(key[ok]),
                                                  pa.array((key == own)[ok])], ["word", "n", "key", "own"])

    asks = keyed.select("word", "n").mapInArrow(tidy(asking), "word string, n long, key long, own boolean")
    tries = keyed
    if crowded.isEmpty():
        asks, tries = (x.withColumn("salt", F.lit(0)) for x in (asks, tries))
    else:
        salts = materialize(crowded.select(F.col("key").alias("_key"), F.ceil(F.col("c") / hot).cast("int").alias("salts")))
        on = F.col("key") == F.col("_key")
        several = F.coalesce("salts", F.lit(1))
        asks = asks.join(salts, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), several - 1)))
        tries = tries.join(salts, on, "left").withColumn("salt", F.pmod(F.xxhash64("word"), several).cast("int"))
    cols = ["key", "salt", "asks", "own", "word", "n"]
    rows = (tries.withColumns({"asks": F.lit(False), "own": F.lit(False)}).select(*cols)
            .unionByName(asks.withColumn("asks", F.lit(True)).select(*cols)))

    def paired(table: pa.Table):
        """The pairs of one trie: its words, and the words that ask it."""
        w = Words(table.column("word"))
        asks_, own = table.column("asks").to_numpy(), table.column("own").to_numpy()
        held, asked = np.flatnonzero(~asks_), np.flatnonzero(asks_)
        if not len(held) or not len(asked):
            return
        held = held[np.lexsort(w.vectors[held].T[::-1])]
        words_, n = table.column("word"), table.column("n").to_numpy()
        for a, b in w.pairs(held, asked):
            # a word asks its own trie too: there each pair is met from both sides already
            back = ~own[a]
            a, b = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
            if len(a):
                yield pa.RecordBatch.from_arrays([words_.take(pa.array(a)).combine_chunks(), words_.take(pa.array(b)).combine_chunks(), pa.array(n[b])],
                                                 ["word", "near", "near_n"])

    def scan(batches):
        """Rows come sorted by trie; one trie is held at a time."""
        held: list = []
        name = None
        for b in batches:
            keys = b.column("key").to_numpy(zero_copy_only=False)
            salts_ = b.column("salt").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((keys[1:] != keys[:-1]) | (salts_[1:] != salts_[:-1])) + 1
            for lo, hi in zip([0, *cut], [*cut, len(keys)]):
                if hi == lo:
                    continue
                now = (int(keys[lo]), int(salts_[lo]))
                if held and now != name:
                    yield from paired(pa.Table.from_batches(held))
                    held = []
                name = now
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from paired(pa.Table.from_batches(held))

    dealt = rows.repartition(reduce_tasks(words), "key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(tidy(scan), "word string, near string, near_n long")


def _roots(found: DataFrame) -> DataFrame:
    """(word, root): words that have a form, with the last one on the way."""
    step = found.filter("form is not null").select("word", F.col("form").alias("root"))
    most = found.agg(F.max("n")).first()[0] or 1
    rounds = math.ceil(math.log2(max(1, math.ceil(math.log10(max(most, 10))))))
    for _ in range(rounds):
        step = materialize(step)
        ahead = step.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = step.join(ahead, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"))
    return step


def spelling_variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", typo_every: int = 31, hot: int = HOT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(words_of(docs, text_col, id_col, typo_every))
    near = near_pairs(words, hot)
    best = near.groupBy(F.col("word").alias("_w")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    strong = F.col("best").isNotNull() & (-F.col("best.less") >= STRONGER * F.col("n"))
    found = materialize(words.join(best, F.col("word") == F.col("_w"), "left").select(
        "word", F.when(strong, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, -F.col("best.less")).alias("form_n")))
    roots = _roots(found).withColumnRenamed("word", "_w")
    return (found.join(roots, F.col("word") == F.col("_w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

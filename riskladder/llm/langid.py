"""Language identification with interpolated Kneser-Ney character models.

Training counts character 4-grams per language over all training texts (letters in
lower case, everything else is one space); partial counts are summed by Spark. All lower
orders follow from the 4-grams: their continuation counts are numbers of distinct left
extensions. A language's model is a set of sorted arrays of n-gram hashes with their probabilities
and, per context, the weight of the lower order.

Prediction is the language of the lowest cross-entropy per character. ``score`` is the winner's share of
the languages' likelihoods at a fixed temperature. Rejection is calibrated on the
training texts: a text is ``rejected`` when its cross-entropy is more than ``sigmas`` standard deviations
above the mean that training texts of the predicted language have under their own model.

Every 4-gram of the training texts counts, whatever their number. Up to ``capacity`` rows of (language, 4-gram), as
counted, the models are gathered and broadcast; above, the same models are grouped
DataFrames (``grouped_models``), the texts are cut into chunks that name their distinct 4-grams, and the
4-grams' costs are joined to the chunks. Both ways use the same arithmetic and sum costs as whole
numbers of 2^-20 bits, so the results are equal.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is everything when
there is nothing to learn from; a null id belongs to the held-out part; rows
without lang are not learned from; repeated rows get equal results; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.session import materialize

CAPACITY = 1 << 21               # rows of (language, 4-gram) that are broadcast; more are joined
ORDER = 4
UNIT = 1 << 20                   # costs are whole numbers of 1 / UNIT bits
CHUNK_CHARS = 1 << 18
TEMPERATURE = 12.0
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _grams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram of every predicted character, end of each text's run): four 16-bit symbols each.
    Every text starts from three spaces."""
    joined = "\0\0\0".join((t or "").replace("\0", " ") for t in texts)
    c = np.frombuffer(("\0\0\0" + joined).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    gap = c == 0
    sym = np.where(_letters()[c], (c ^ (c >> 16) * np.uint32(0x9E37)) & np.uint32(0xFFFF), np.uint32(32))
    space = sym == 32
    keep = np.ones(len(c), bool)
    keep[1:] = gap[1:] | ~(space[1:] & space[:-1])
    sym, gap = sym[keep].astype(np.uint64), gap[keep]
    at = np.flatnonzero(~gap)
    g = sym[at] | sym[at - 1] << np.uint64(16) | sym[at - 2] << np.uint64(32) | sym[at - 3] << np.uint64(48)
    # the text of a position: every third gap opens one
    ends = np.searchsorted(np.cumsum(gap)[at], 3 * np.arange(1, len(texts) + 1), "right")
    return g, ends


class _Order:
    """One order of a model: hashes of its n-grams (sorted) with probability, and of its contexts with
    the lower order's weight."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, lower, discount: float):
        ctx = grams >> np.uint64(16)
        self.by_ctx, inv = np.unique(ctx, return_inverse=True)
        total = np.bincount(inv, weights=counts)
        kinds = np.bincount(inv)
        weight = discount * kinds / total
        p = np.maximum(counts - discount, 0) / total[inv] + weight[inv] * lower
        h = A.mix(grams)
        by = np.argsort(h)
        self.hash, self.p = h[by], p[by].astype(np.float32)
        hc = A.mix(self.by_ctx)
        by = np.argsort(hc)
        self.ctx, self.weight = hc[by], weight[by].astype(np.float32)
        del self.by_ctx

    def look(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        def at(table, key):
            i = np.minimum(np.searchsorted(table, key), len(table) - 1)
            return i, table[i] == key

        i, seen = at(self.hash, A.mix(grams))
        j, ctx = at(self.ctx, A.mix(grams >> np.uint64(16)))
        return np.where(seen, self.p[i], np.where(ctx, self.weight[j], 1.0) * lower)


class KneserNey:
    """Interpolated Kneser-Ney model of one language from its 4-gram counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, symbols: int = 1 << 16):
        levels = [(grams, counts.astype(np.float64))]
        for k in range(ORDER - 1, 0, -1):           # continuation counts: distinct left extensions
            g, n = np.unique(levels[0][0] & np.uint64((1 << 16 * k) - 1), return_counts=True)
            levels.insert(0, (g, n.astype(np.float64)))
        self.floor = 1.0 / symbols
        self.orders: list[_Order] = []
        for g, n in levels:
            ones, twos = int((n == 1).sum()), int((n == 2).sum())
            d = ones / (ones + 2 * twos) if ones else 0.5
            lower = np.full(len(g), self.floor)
            for o, k in zip(self.orders, range(1, ORDER)):
                lower = o.look(g & np.uint64((1 << 16 * k) - 1), lower)
            self.orders.append(_Order(g, n, lower, min(max(d, 0.1), 0.95)))

    def prob(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), self.floor)
        for k, o in enumerate(self.orders, 1):
            p = o.look(grams & np.uint64((1 << 16 * k) - 1), p)
        return p


def _held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _pieces(batch: pa.RecordBatch, max_chars: int = 1 << 20):
    texts = batch.column("text").to_pylist()
    a = used = 0
    for i, t in enumerate(texts):
        used += len(t or "")
        if used >= max_chars or i == len(texts) - 1:
            yield a, i + 1, texts[a:i + 1]
            a, used = i + 1, 0


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (lang, text)."""

    def scan(batches):
        held: dict[str, list] = {}

        def add(lang, g, n):
            old = held.setdefault(lang, [])
            old.append((g, n))
            if len(old) > 8:
                held[lang] = [_sum(old)]

        for b in batches:
            langs = b.column("lang").to_pylist()
            for lo, hi, texts in _pieces(b):
                by: dict[str, list] = {}
                for lang, t in zip(langs[lo:hi], texts):
                    by.setdefault(lang, []).append(t)
                for lang, ts in by.items():
                    add(lang, *np.unique(_grams(ts)[0], return_counts=True))
        for lang, parts in held.items():
            g, n = _sum(parts)
            for a in range(0, len(g), 1 << 16):
                x = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g[x])), pa.array(g[x].view(np.int64)), pa.array(n[x].astype(np.int64))],
                                                 ["lang", "gram", "n"])

    part = train.select("lang", "text").mapInArrow(scan, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _sum(parts: list) -> tuple[np.ndarray, np.ndarray]:
    g, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return g, np.bincount(inv, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def fit(counts: DataFrame) -> dict[str, KneserNey]:
    """Models of all languages in ``counts`` (lang, gram, n), gathered on the driver."""
    t = counts.toArrow()                           # at most ``capacity`` rows, see ``identify``
    langs = np.array(t.column("lang").to_pylist(), object)
    grams, n = t.column("gram").to_numpy().view(np.uint64), t.column("n").to_numpy()
    out = {}
    for lang in sorted(set(langs.tolist())):
        m = langs == lang
        g, k = grams[m], n[m]
        by = np.argsort(g)
        out[lang] = KneserNey(g[by], k[by])
    return out


def _low(k: int):
    """The last ``k`` symbols of column gram."""
    return F.col("gram") if k == ORDER else F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1))


def grouped_models(counts: DataFrame, symbols: int = 1 << 16) -> list[tuple[DataFrame, DataFrame]]:
    """The models of ``fit`` as DataFrames: per order (lang, gram, p) and (lang, ctx, weight). An n-gram has at
    most 2^16 extensions on either side, so no key of the joins and sums is hot."""
    levels = [counts.select("lang", "gram", "n")]
    for k in range(ORDER - 1, 0, -1):              # continuation counts: distinct left extensions
        levels.insert(0, materialize(levels[0].groupBy("lang", _low(k).alias("gram")).agg(F.count("*").alias("n"))))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, level in enumerate(levels, 1):
        ones, twos = (F.count(F.when(F.col("n") == c, 1)) for c in (1, 2))
        d = level.groupBy("lang").agg(ones.alias("ones"), twos.alias("twos")).select("lang", F.least(F.greatest(
            F.when(F.col("ones") > 0, F.col("ones") / (F.col("ones") + 2 * F.col("twos"))).otherwise(0.5), F.lit(0.1)), F.lit(0.95)).alias("d"))
        level = level.withColumn("ctx", F.shiftrightunsigned("gram", 16))
        ctx = (level.groupBy("lang", "ctx").agg(F.sum("n").cast("double").alias("total"), F.count("*").cast("double").alias("kinds"))
               .join(F.broadcast(d), "lang").withColumn("weight", F.col("d") * F.col("kinds") / F.col("total")))   # a row per language
        x = level.join(ctx, ["lang", "ctx"])
        if k == 1:
            x = x.withColumn("lower", F.lit(1.0 / symbols))
        else:
            below = out[-1][0].select("lang", F.col("gram").alias("low"), F.col("p").cast("double").alias("lower"))
            x = x.withColumn("low", _low(k - 1)).join(below, ["lang", "low"])
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        out.append((materialize(x.select("lang", "gram", p.cast("float").alias("p"))),
                    materialize(ctx.select("lang", "ctx", F.col("weight").cast("float").alias("weight")))))
    return out


def _gram_costs(grams: DataFrame, models: list[tuple[DataFrame, DataFrame]], names: list[str]) -> DataFrame:
    """(gram, cost: per language, in order of ``names``) for distinct 4-grams."""
    index = F.broadcast(grams.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "lang string, i int"))   # a row per language

    def wide(df, key, value, new):
        return (df.join(index, "lang").groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("i", F.col(value).cast("double").alias("v")))).alias(new)))

    asked = [grams]
    for k in range(ORDER - 1, 0, -1):
        asked.insert(0, materialize(asked[0].select(_low(k).alias("gram")).distinct()))
    t = None
    for k, (seen, contexts) in enumerate(models, 1):
        x = asked[k - 1].withColumn("ctx", F.shiftrightunsigned("gram", 16))
        if t is None:
            x = x.withColumn("lower", F.array_repeat(F.lit(1.0 / (1 << 16)), len(names)))
        else:
            x = x.withColumn("low", _low(k - 1)).join(t.select(F.col("gram").alias("low"), F.col("p").alias("lower")), "low")
        x = x.join(wide(seen, "gram", "p", "ps"), "gram", "left").join(wide(contexts, "ctx", "weight", "ws"), "ctx", "left")
        t = materialize(x.select("gram", F.transform("lower", lambda low, i: F.coalesce(
            F.try_element_at("ps", i), F.coalesce(F.try_element_at("ws", i), F.lit(1.0)) * low)).alias("p")))

    def scan(batches):
        for b in batches:
            p = b.column("p")
            yield pa.RecordBatch.from_arrays([b.column("gram"), pa.ListArray.from_arrays(
                np.arange(b.num_rows + 1, dtype=np.int32) * len(names), pa.array(_cost(p.flatten().to_numpy())))], ["gram", "cost"])

    return t.mapInArrow(scan, "gram long, cost array<int>")


def _cost(p: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(p) * UNIT).astype(np.int32)


class _Scorer:
    """Costs of texts under all models; probabilities are looked up once per distinct 4-gram."""

    def __init__(self, models: dict[str, KneserNey]):
        self.models = list(models.values())

    def costs(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        g, ends = _grams(texts)
        starts = np.concatenate([[0], ends[:-1]])
        n = ends - starts
        out = np.zeros((len(texts), len(self.models)), np.int64)
        if not len(g):
            return out, n
        kinds = np.unique(g)
        slot_bits = np.uint64(64 - max(10, min(22, int(16 * len(kinds)).bit_length())))
        table = np.zeros(1 << int(64 - int(slot_bits)), np.int32)
        table[A.mix(kinds) >> slot_bits] = np.arange(len(kinds), dtype=np.int32)
        at = table[A.mix(g) >> slot_bits]
        miss = np.flatnonzero(kinds[at] != g)      # two kinds in one slot
        at[miss] = np.searchsorted(kinds, g[miss])
        filled = np.flatnonzero(n > 0)
        for k, m in enumerate(self.models):
            cost = _cost(m.prob(kinds))
            out[filled, k] = np.add.reduceat(cost[at], starts[filled], dtype=np.int64)
        return out, n


def _has_letter(texts: list) -> np.ndarray:
    letters = _letters()
    return np.array([bool(t) and any(letters[ord(c)] for c in t[:64]) or bool(t) and any(c.isalpha() for c in t) for t in texts], bool)


SCORED = "doc_id long, held_out boolean, lang string, lang_pred string, score double, entropy double, own double"


def _verdicts(names: list[str], sums: np.ndarray, n: np.ndarray, some: np.ndarray, cols: list[pa.Array]) -> pa.RecordBatch:
    """Rows of ``SCORED`` from the documents' summed costs, lengths and columns doc_id, held_out, lang."""
    some = some & bool(names)
    ce = sums / UNIT / np.maximum(n, 1)[:, None] if names else np.zeros((len(n), 1))
    best = ce.argmin(1)
    low = ce[np.arange(len(n)), best]
    share = 1 / np.exp(-TEMPERATURE * np.minimum(ce - low[:, None], 50)).sum(1)
    pred = [names[k] if s else "und" for k, s in zip(best, some)]
    at = {x: i for i, x in enumerate(names)}
    own = [float(c[at[x]]) if x in at and s else None for c, x, s in zip(ce, cols[2].to_pylist(), some)]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array(pred, pa.string()), pa.array(np.where(some, share, 0.0)), pa.array(low, mask=~some), pa.array(own, pa.float64())],
        ["doc_id", "held_out", "lang", "lang_pred", "score", "entropy", "own"])


def _score_broadcast(src: DataFrame, models: dict[str, KneserNey]) -> DataFrame:
    names = list(models)
    shared = src.sparkSession.sparkContext.broadcast(models)

    def scan(batches):
        scorer = _Scorer(shared.value)
        for b in batches:
            for lo, hi, texts in _pieces(b):
                sums, n = scorer.costs(texts)
                yield _verdicts(names, sums, n, _has_letter(texts), [b.column(c).slice(lo, hi - lo) for c in ("doc_id", "held_out", "lang")])

    return src.mapInArrow(scan, SCORED)


def _chunks(src: DataFrame) -> DataFrame:
    """Pieces of documents: their columns, the piece's distinct 4-grams (ascending), and per document its distinct
    4-grams as indexes of these with their numbers."""

    def scan(batches):
        for b in batches:
            for lo, hi, texts in _pieces(b, CHUNK_CHARS):
                g, ends = _grams(texts)
                n = np.diff(ends, prepend=0)
                kinds, at = np.unique(g.view(np.int64), return_inverse=True)     # signed, as Spark orders them
                pair, count = np.unique(np.repeat(np.arange(len(texts)), n) * len(kinds) + at, return_counts=True)
                doc = pair // max(1, len(kinds))
                lists = [*(b.column(c).slice(lo, hi - lo) for c in ("doc_id", "held_out", "lang")), pa.array(_has_letter(texts)),
                         pa.array(n.astype(np.int64)), pa.array(kinds)]
                blobs = [np.bincount(doc, minlength=len(texts)), pair - doc * len(kinds), count]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.concat_arrays([x])) for x in lists),
                     *(pa.array([A.small(x)], pa.binary()) for x in blobs)],
                    ["doc_id", "held_out", "lang", "letter", "n", "kinds", "per_doc", "at", "count"])

    out = src.mapInArrow(scan, "doc_id array<long>, held_out array<boolean>, lang array<string>, letter array<boolean>, n array<long>, "
                               "kinds array<long>, per_doc binary, at binary, count binary")
    return materialize(out.withColumn("chunk", F.monotonically_increasing_id()))


def _score_joined(src: DataFrame, counts: DataFrame) -> DataFrame:
    """As ``_score_broadcast`` with models of any size: a task holds a chunk's 4-grams only."""
    models = grouped_models(counts)
    names = sorted(r["lang"] for r in models[0][1].select("lang").distinct().collect())   # a row per language
    chunks = _chunks(src)
    asked = chunks.select("chunk", F.explode("kinds").alias("gram"))
    costs = _gram_costs(materialize(asked.select("gram").distinct()), models, names)
    met = (asked.join(costs.hint("merge"), "gram").groupBy("chunk")
           .agg(F.sort_array(F.collect_list(F.struct("gram", "cost"))).alias("met")).select("chunk", F.col("met.cost").alias("cost")))

    def scan(batches):
        for b in batches:
            for r in range(b.num_rows):
                one = lambda c: b.column(c).slice(r, 1).flatten()  # noqa: B023,E731
                n, cost = one("n").to_numpy(), one("cost").flatten().to_numpy().reshape(-1, len(names))
                per, at, count = (A.unsmall(b.column(c)[r].as_py()).astype(np.int64) for c in ("per_doc", "at", "count"))
                sums = np.zeros((len(n), len(names)), np.int64)
                filled = np.flatnonzero(per > 0)
                starts = (np.cumsum(per) - per)[filled]
                for k in range(len(names) if len(filled) else 0):
                    sums[filled, k] = np.add.reduceat(cost[at, k] * count, starts)
                yield _verdicts(names, sums, n, one("letter").to_numpy(zero_copy_only=False), [one(c) for c in ("doc_id", "held_out", "lang")])

    return chunks.drop("kinds").join(met, "chunk", "left").drop("chunk").mapInArrow(scan, SCORED)


def identify(docs: DataFrame, sigmas: float = 4.0, capacity: int = CAPACITY, text_col: str = "text", lang_col: str = "lang",
             id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, entropy (bits per character), rejected."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(lang_col).cast("string").alias("lang"), _held_out(id_col).alias("held_out"))
    counts = materialize(gram_counts(src.filter("not held_out and lang is not null and text is not null")))
    scored = materialize(_score_broadcast(src, fit(counts)) if counts.count() <= capacity else _score_joined(src, counts))
    bars = (scored.filter("not held_out and own is not null").groupBy(F.col("lang").alias("_lang"))
            .agg((F.avg("own") + sigmas * F.coalesce(F.stddev_pop("own"), F.lit(0.0))).alias("bar")))
    out = scored.join(bars, F.col("lang_pred") == F.col("_lang"), "left")
    return out.select("doc_id", "held_out", "lang_pred", "score", "entropy",
                      F.coalesce(F.col("entropy") > F.col("bar"), F.lit(True)).alias("rejected"))

"""Hard negatives, token counts and spelling variants against brute force and the library."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskladder.llm import hard_negatives, spelling, token_count
from riskladder.llm.queries import ship

from tests_llm_brute import pairs_of

P = pytest.importorskip("public_tokenizers")
PIECES = P.path("piece_bpe_32k.model")


# --- hard negatives ----------------------------------------------------------
def brute_negatives(rows, k=5, positives=5, every=100, scale=256):
    good = [(i, label, np.floor(scale * np.array(v, float))) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, label, v in good:
        if i % every:
            continue
        found = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), j, m) for j, m, w in good if j != i and len(w) == len(v))
        for s, p, m in [x for x in found if x[2] == label][:positives]:
            window = [x for x in found if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(window)]
    return sorted(out)


def vectors(n=900, dim=20, seed=4):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.3, (6, dim))
    rows = [(int(i), (centres[i % 6] + r.normal(0, 0.1, dim)).tolist(), int(i * 7 % 4)) for i in range(n)]
    rows += [(100, rows[100][1], rows[100][2]), (2000, [0.0] * dim, 1), (2100, None, 1), (None, rows[3][1], 1), (2200, rows[5][1], None),
             (2300, [float("nan")] * dim, 1), (2400, [None] + [1.0] * (dim - 1), 1), (2500, [], 0), (2600, [float("inf")] * dim, 1),
             (2700, [0.5, 0.5], 1), (2701, [0.5, 0.5], 1), (2702, [0.5, 0.5], 2), (2800, [-0.5] * dim, 99), (2801, [0.5] * dim, 99)]
    return rows + [(3000 + i, rows[200][1], i % 2) for i in range(300)]     # a third of the rows are equal


def frame(spark, rows):
    return spark.createDataFrame([(i, v, m, 1, 2.0) for i, v, m in rows],
                                 "vec_id long, embedding array<double>, label long, rank int, score double").repartition(3)


@pytest.mark.parametrize("shard_rows", [hard_negatives.SHARD_ROWS, 100])
def test_hard_negatives(spark, shard_rows):
    ship(spark)
    rows = vectors()
    got = hard_negatives.mine(frame(spark, rows), shard_rows=shard_rows).collect()
    want = brute_negatives(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 50 and any(r[0] == 2700 for r in want)


def test_hard_negatives_of_few_or_no_rows(spark):
    ship(spark)
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.8, 0.0], 2), (100, [-1.0, 0.0], 1)]
    got = hard_negatives.mine(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows) == [(0, 1, 1, 2, 58880, 52224)]
    assert hard_negatives.mine(frame(spark, rows).limit(0)).count() == 0


def test_threshold_join_is_exact_and_leaves_rows_out():
    r = np.random.default_rng(8)
    x = r.integers(-90, 90, (500, 24))
    x[:200, :8] = 0                                # little weight in front
    q = r.integers(-90, 90, (30, 24))
    index = hard_negatives.Index(np.arange(500), np.zeros(500, np.int64), x)
    s = q @ x.T
    for least in (-(10**6), 0, 20_000, 60_000, 10**7):
        a, row, score = index.join(q, np.full(30, float(least)), np.arange(500))
        assert sorted(zip(a.tolist(), row.tolist(), score.tolist())) == [(i, j, s[i, j]) for i, j in zip(*np.nonzero(s >= least))]


def test_scores_past_double_precision():
    q, x = np.array([[1 << 40, 3]]), np.array([[1 << 40, 5], [(1 << 20) + 1, 7], [0, 0]])
    assert hard_negatives.scores(q, x).tolist() == [[(1 << 63) - 1, (1 << 60) + (1 << 40) + 21, 0]]
    index = hard_negatives.Index(np.arange(3), np.zeros(3, np.int64), x)
    assert index.join(q, np.array([1.0]), np.arange(3))[2].tolist() == [(1 << 63) - 1, (1 << 60) + (1 << 40) + 21]


# --- token counts --------------------------------------------------------------
def library(texts):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)
    return [len(x) for x in sp.encode(texts, num_threads=1)]


def test_token_counts(documents, none):
    rows = pairs_of(documents)
    want = [(d, len((t or "").encode()), n, n > 50) for (d, t), n in zip(rows, library([t or "" for _, t in rows]))]
    for cache in (token_count.CACHE_BYTES, 2000):
        got = token_count.count_tokens(documents, PIECES, limit=50, cache_bytes=cache, group_chars=5000).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_count.count_tokens(none, PIECES).count() == 0


def test_pretokens_add_up_to_the_library():
    r = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\r", "\t", "▁", "\0", "é", "龍", "<s>", "<0x0A>", "▁▁", "  \n ", " the", "{\r", "\U0001F600", "x" * 90, "　", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(1, 30))) for _ in range(3000)] + ["y" * 20_000, " " * 999, "\n" * 99]
    counter = token_count.Counter(PIECES, token_count.prove_whole(PIECES))
    got = []
    for t in texts:
        cut = token_count.pretokens_of(t)
        counter.fill(set(cut))
        got.append(sum(counter.known[p] for p in cut))
        counter.forget_long(set(cut))
    assert got == library(texts)
    assert max(map(len, set(counter.known) - set(counter.whole))) <= token_count.LONGEST_KEPT
    assert counter.used == sum(len(p) + token_count._ENTRY for p in counter.known if p not in counter.whole)


def test_whole_strings_are_proven():
    whole = token_count.prove_whole(PIECES)
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)
    spaced = [w[1:] for w in whole if w[0] == " " and len(w) > 1]
    assert len(spaced) > 10_000 and all(len(x) == 1 for x in sp.encode(spaced))
    with pytest.raises(ValueError, match="word border"):
        token_count.check_borders(["▁a", "a▁b"])
    with pytest.raises(ValueError, match="line border"):
        token_count.check_borders(["a\n"])


# --- spelling variants ---------------------------------------------------------
def edit_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows, every=31):
    n = collections.Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % every == 0 else w] += 1
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and edit_one(v, w)] for w in n}
    form = {}
    for w, v in near.items():
        if v and max(n[x] for x in v) >= 10 * n[w]:
            form[w] = min(v, key=lambda x: (-n[x], x))
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def spelled():
    r = random.Random(6)
    base = ["".join(r.choice("abcdeéÀßno") for _ in range(r.randint(7, 12))) for _ in range(25)] + ["longer" * 30, "z" * 400]
    change = lambda w: (lambda i: r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abxÿ") + w[i:], w[:i] + r.choice("abx") + w[i + 1:]]))(r.randrange(len(w)))
    words = [w for w in base for _ in range(r.choice([2, 30, 400]))]
    words += [v for w in base for v in [change(w) for _ in range(12)] for _ in range(r.choice([1, 2, 3, 25]))]
    words += ["chainaa"] * 2 + ["chainab"] * 20 + ["chaincb"] * 200 + ["CHAINCD"] * 2000
    r.shuffle(words)
    return [(k, " ".join(words[k::40]).replace(" a", "\ta") + (" x1y the" if k % 2 else "-")) for k in range(40)] + [(None, "chainaa chainaa"), (7, None), (8, "")]


@pytest.mark.parametrize("hot", [spelling.HOT, 8])
def test_spelling_variants(spark, hot):
    ship(spark)
    rows = spelled()
    df = spark.createDataFrame([(d, t, "w", 1, 2) for d, t in rows], "doc_id long, text string, word string, n int, key int").repartition(3)
    got = spelling.spelling_variants(df, hot=hot).collect()
    want = brute_variants(rows)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    chains = {r[0]: r[2] for r in want}
    assert chains["chainaa"] == "chaincd"
    assert any(len(r[0]) > spelling.WIDTH and r[4] for r in want)


def test_equal_forms_go_to_the_smaller_word(spark):
    ship(spark)
    df = spark.createDataFrame([(1, "tieword Tieword " + "tieworda " * 20 + "atieword " * 20)], "doc_id long, text string")
    got = {r.word: (r.form, r.form_n, r.n_near) for r in spelling.spelling_variants(df, typo_every=1 << 40).collect()}
    assert got == {"tieword": ("atieword", 20, 2), "tieworda": (None, None, 1), "atieword": (None, None, 1)}


def test_spelling_variants_of_the_fixture(documents, none):
    got = spelling.spelling_variants(documents).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_variants(pairs_of(documents)), key=repr)
    assert spelling.spelling_variants(none).count() == 0


def test_trie_search_meets_every_near_pair():
    r = random.Random(9)
    words = sorted({"".join(r.choice("etajoxnk") for _ in range(r.randint(7, 9))) for _ in range(400)} | {"etajoxnk", "etajoxn", "etajoxnn"})
    w = spelling.Words(pa.array(words))
    held = np.lexsort(w.vectors.T[::-1])
    for leaf in (1, spelling.LEAF, 10**6):
        got = {(int(a), int(b)) for x, y in w.pairs(held, np.arange(len(words)), leaf) for a, b in zip(x, y)}
        assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if edit_one(a, b)}

"""Operators on documents against brute force on a small, awkward fixture, and on no rows."""

import array
import base64
import collections
import hashlib
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskladder.llm import arrays, block_dedup, bpe, langid, line_quality, mixing, ngram_join, suffix_dedup, wavelet
from riskladder.llm.queries import ORACLE_SQL

from tests_llm_brute import brute_blocks, brute_components, brute_quality, pairs_of, words

P = pytest.importorskip("public_tokenizers")
sha = lambda b: hashlib.sha256(b).hexdigest()


def test_ngram_components(documents, none):
    got = ngram_join.ngram_jaccard_components(documents).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_components(pairs_of(documents)), key=repr)
    assert ngram_join.ngram_jaccard_components(none).count() == 0


def test_ngram_tasks_make_nothing_else_of_the_sketchs_size():
    """A task holds the counts of the cells; their places and fragments took some 200 MB beside them."""
    r, tasks = random.Random(5), 12
    texts = [" ".join(str(r.randrange(300)) for _ in range(200)) for _ in range(20)]
    batch = pa.record_batch({"doc_id": list(range(20)), "text": texts})
    cells = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint32)

    def peak(job):
        tracemalloc.start()
        out = job()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    _, most = peak(lambda: ngram_join._counted(5)(cells, iter([batch])))
    assert cells.sum() == sum(len(set(zip(*(t.split()[i:] for i in range(5))))) for t in texts)
    assert most < 4 << 20
    order = SimpleNamespace(value=ngram_join._Order(cells, 4 * tasks, ngram_join.SEGMENTS))
    src = SimpleNamespace(mapInArrow=lambda scan, schema: scan)
    parts, most = peak(lambda: list(ngram_join._prefixes(src, order, 5, 75, tasks)(iter([batch]))))
    assert most < 4 << 20
    # the order and its fragments, made plainly
    by = np.argsort(cells, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    share = np.cumsum(cells[by] + 1e-9)
    t = arrays.Text(np.arange(20), *arrays.utf8(batch.column("text")), batch)
    grams = ngram_join._Sets(t, 5).grams
    grams.sort()
    cell = (grams >> np.uint64(64 - ngram_join.SKETCH_BITS)).astype(np.int64)
    assert (order.value.in_order(grams) == grams[np.argsort(place[cell], kind="stable")]).all()
    for n in (4 * tasks, ngram_join.SEGMENTS):
        plain = np.minimum((share / share[-1] * n).astype(np.int64), n - 1)
        assert (order.value.fragments(grams, n) == plain[place[cell]]).all()
    assert {p for b in parts for p in b.column("part").to_pylist()} <= set(range(tasks))


def test_block_dedup(documents, none):
    got = block_dedup.remove_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_blocks(pairs_of(documents)), key=repr)
    assert sum(r.n_removed for r in got) > 0
    assert block_dedup.remove_repeats(none).count() == 0


def test_block_dedup_keeps_the_layout(documents):
    got = block_dedup.remove_repeats(documents, layout=True, carry=["size", "rk"]).collect()
    plain = {(r.doc_id, r.kept_text) for r in block_dedup.remove_repeats(documents).collect()}
    assert {(r.doc_id, b" ".join(words(r.kept_text)).decode()) for r in got} == plain
    same = {(r.doc_id, r.text or "") for r in documents.collect()}
    assert all((r.doc_id, r.kept_text) in same for r in got if r.n_removed == 0)


def brute_bytes(rows, n):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k:k + n] for k in range(len(b) - n + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone[k:k + n] = True
        spans = int((np.diff(np.concatenate([[0], gone[:-1].astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


@pytest.mark.parametrize("length", [400, 90])
def test_suffix_dedup(documents, length):
    got = suffix_dedup.remove_repeated_bytes(documents, length).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed_from"), F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_bytes(pairs_of(documents), length), key=repr)


def test_suffix_dedup_parts_a_hot_anchor(spark):
    r = random.Random(3)
    noise = lambda n: "".join(r.choice("abcdefghij klmnopqrst") for _ in range(n))
    licence, longer, some = noise(300), noise(396), noise(450)
    texts = [noise(r.randint(300, 500)) + licence + noise(450) for _ in range(60)]
    texts += [noise(r.randint(300, 500)) + longer + noise(420) for _ in range(60)]
    texts += [noise(r.randint(10, 50)) + some + noise(40) for _ in range(30)] + [texts[0][100:], "é" + texts[70][50:900], texts[1]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = [(i, t) for i, t in enumerate(texts)]
    for hot in (10, suffix_dedup.HOT):
        got = suffix_dedup.remove_repeated_bytes(df, hot=hot).select("doc_id", "n_bytes", "n_removed", F.size("removed_from"), F.sha2("kept", 256)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute_bytes(rows, 400), key=repr)
    plain = df.selectExpr("xxhash64(text) as th", "text")
    most = [max(x["count"] for x in suffix_dedup._contexts(suffix_dedup._shared(plain, 400, h)[0].coalesce(1), 400)
                .filter("body is not null").groupBy("h").count().collect()) for h in (10, suffix_dedup.HOT)]
    assert most[0] <= 10 and most[1] > 50


def test_suffix_dedup_on_no_rows(none):
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0


def test_suffix_sort_is_the_lexicographic_one():
    data = np.frombuffer(b"abracadabra" * 30 + b"banana" * 40, np.uint8)
    s = suffix_dedup._Suffixes(data, 50)
    at = np.random.default_rng(1).permutation(len(data) - 50)
    group = np.sort(np.arange(len(at)) % 3)
    got = s.sort(at, group)
    for g in range(3):
        mine = [data[i:i + 50].tobytes() for i in got[group == g]]
        assert mine == sorted(data[i:i + 50].tobytes() for i in at[group == g])


def test_bpe_equals_tiktoken(documents, none):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expect = []
    for d, t in pairs_of(documents):
        ids = enc.encode_ordinary(t or "")
        expect.append((d, len(ids), ids, (t or "").encode(), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = [(r.doc_id, r.n_tokens, list(r.ids), bytes(r.decoded), r.ids_sha256, r.decoded_sha256)
           for r in bpe.encode_decode(documents, path, P.PATTERN).collect()]
    assert sorted(got, key=repr) == sorted(expect, key=repr)
    assert bpe.encode_decode(none, path, P.PATTERN).count() == 0


def _odd_texts(n=400):
    r = random.Random(4)
    parts = ["a", "don't", " ", "  ", "\n", "\n\n", "\t", "\r\n", " 12", "é", "龍", "<|endoftext|>", "<|endof", "\x1c", "\x85", "\u2028", "\u3000", "\0", "!!", "'s", "x" * 80]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(n)]


def test_chunks_encode_like_whole_texts():
    tiktoken = pytest.importorskip("tiktoken")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = _odd_texts() + ["q" * 100_000, "ab" * 700 + " tail"]
    own = bpe._Cached(bpe.Bpe.load(path, P.PATTERN))
    own.bound = 4000                               # the cache is emptied again and again
    lib, mine = Tokenizer.from_file(P.path("byte_bpe_50k.json")), wavelet._Encoder(P.path("byte_bpe_50k.json"))
    mine.bound = 4000
    for k in range(0, len(texts), 20):
        some = texts[k:k + 20]
        cut = [bpe.chunks_of(t) for t in some]
        own.fill(set().union(*cut))
        assert [",".join(own.known[c] for c in x) for x in cut] == [",".join(map(str, enc.encode_ordinary(t))) for t in some]
        own.settle(set().union(*cut))
        cut = [mine.chunks(t) for t in some]
        mine.fill(set().union(*cut))
        assert [np.frombuffer(b"".join(mine.known[c] for c in x), np.uint16).tolist() for x in cut] == [lib.encode(t, add_special_tokens=False).ids for t in some]
        mine.settle(set().union(*cut))
        for cache in (own, mine):
            assert cache.used == cache._bytes(cache.known) <= 2 * cache.bound and all(len(c) <= bpe.LONGEST_KEPT for c in cache.known)


def test_wavelet_matrix():
    ids = np.random.default_rng(3).integers(0, 40, 1000).astype(np.uint16)
    _, _, m = wavelet.open_shard(wavelet.pack_shard(np.array([5]), np.array([1000]), ids, 16))
    assert (m.tokens() == ids).all() and (m.access(np.arange(1000)) == ids).all()
    for token in (0, 7, 39, 41):
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where) and m.rank(token, 500) == (where < 500).sum()
        assert [m.select(token, k) for k in range(len(where))] == where.tolist()
    with pytest.raises(IndexError):
        m.select(41, 0)
    empty = wavelet.WaveletMatrix.build(np.zeros(0, np.uint16), 16)
    assert empty.count(3) == 0 and len(empty.tokens()) == 0


def test_wavelet_shards(spark, documents, none, tmp_dir):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)                # the plain call: special strings in texts are special tokens
    rows = {(d, t): tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in pairs_of(documents)}
    wavelet.write_shards(documents, f"{tmp_dir}/shards", path)
    got = wavelet.read_documents(spark, f"{tmp_dir}/shards").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert any(d == r.doc_id and list(r.ids) == ids for (d, _), ids in rows.items())
        assert r.ids_crc32 == zlib.crc32(array.array("I", r.ids).tobytes())
        at += r.n_tokens
    assert len(got) == documents.count()
    wavelet.write_shards(none, f"{tmp_dir}/empty", path)
    assert wavelet.read_documents(spark, f"{tmp_dir}/empty").count() == 0


def test_wavelet_encoder_gives_the_library_each_word_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    lib, enc, given = Tokenizer.from_file(path), wavelet._Encoder(path), []
    plain = enc._one_by_one
    monkeypatch.setattr(enc, "_one_by_one", lambda texts: (given.extend(texts), plain(texts))[1])
    r = random.Random(4)
    words_ = ["".join(r.choice("aeioußéklmn龍") for _ in range(r.randint(3, 9))) for _ in range(600)]
    texts = [" ".join(r.choice(words_) + r.choice(["", ".", ",", "!?", "###", '")']) for _ in range(300)) for _ in range(40)]
    odd = [None, "", " ", "\n", " a", "a ", "\na.", "a.\nb", "a  b.", "a\0b c", "a.\n\nb", "x<|endoftext|>y. z", "it's. 42. a'. b", "tab\there", "é\u3000b c.",
           "a\x85b c", "\U0001F600. b", " .", ". .", "a. . 4.", "z" * 3000 + ". " + "z" * 3000, "a\n b", "ab.c. d<|e", "x <|endoftext|>"]
    for some in (texts, odd, texts + odd, []):
        want = [lib.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [np.frombuffer(x, np.uint16).tolist() for x in enc.encode_texts(pa.array(some, pa.string()))] == want
        if some is texts:                          # a word with and without its first space, whatever follows it
            assert sum(map(len, given)) < 2.5 * sum(len(w) + 1 for w in set(words_))
        assert enc.used == enc._bytes(enc.known) and all(len(c) <= bpe.LONGEST_KEPT for c in enc.known)
    enc.bound = 2000                               # entries go and are made again
    for k in range(0, 40, 8):
        some = texts[k:k + 8] + odd
        assert [np.frombuffer(x, np.uint16).tolist() for x in enc.encode_texts(pa.array(some))] == [lib.encode(t or "", add_special_tokens=False).ids for t in some]
        assert enc.used == enc._bytes(enc.known) <= 2 * enc.bound


def test_wavelet_shards_spread_rows_of_one_id(spark, tmp_dir):
    df = spark.createDataFrame([(None, f"text {k % 50} of no id") for k in range(4000)] + [(k, "some") for k in range(800)], "doc_id long, text string").repartition(4)
    wavelet.write_shards(df, f"{tmp_dir}/s", P.path("byte_bpe_50k.json"))
    sizes = [r["n"] for r in spark.read.parquet(f"{tmp_dir}/s").groupBy("part").agg(F.sum("n_docs").alias("n")).collect()]
    got = wavelet.read_documents(spark, f"{tmp_dir}/s", with_ids=False).orderBy("start").collect()
    assert len(sizes) >= 4 and max(sizes) < 0.4 * 4800 and len(got) == 4800
    assert [r.doc_id for r in got] == [None] * 4000 + list(range(800))
    assert [r.start for r in got][1:] == np.cumsum([r.n_tokens for r in got])[:-1].tolist()


def test_language_id(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    long = [r for r in held if r.n_chars > 200]
    assert sum(r.lang_pred == r.lang for r in long) >= 0.97 * len(long)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) < 0.1 * len(got)
    assert langid.identify(none).count() == 0


def test_language_id_of_awkward_texts(spark, documents):
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(documents).collect()}
    letterless = {r.doc_id for r in documents.collect() if not any(c.isalpha() for c in r.text or "")}
    assert {d for d, p in got if p == "und"} == letterless
    unlabelled = langid.identify(documents.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


def test_language_id_learns_from_every_gram(spark, documents):
    rows = [(r.doc_id, r.text, r.lang) for r in documents.select("doc_id", "text", "lang").collect()]
    rows += [(1000 + i, "qwx zvj 龍鬼語 kjq " * (1 + i % 3), "rare") for i in range(10)]    # counts far below the others'
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    small, joined = (sorted(map(tuple, langid.identify(df, capacity=c).collect()), key=repr) for c in (1 << 21, 50))
    assert small == joined
    assert {r[2] for r in joined if (r[0] or 0) >= 1000} == {"rare"}


def test_kneser_ney_against_brute_force():
    texts = ["abracadabra abba cab " * 3, "the cat sat on the mat, the rat ran", "Zwölf Boxkämpfer jagen Viktor"]
    rows = []
    for t in texts:                                # letters in lower case, runs of other characters as one space
        line = "   "
        for c in t.lower():
            if c.isalpha() or line[-1] != " ":
                line += c if c.isalpha() else " "
        rows += [line[k - 3:k + 1] for k in range(3, len(line))]
    counts = [None, *[collections.Counter() for _ in range(4)]]
    counts[4].update(rows)
    for k in (3, 2, 1):                            # continuation counts
        counts[k].update({g for g in counts[k + 1]} and [g[1:] for g in counts[k + 1]])
    discount = {}
    for k in range(1, 5):
        ones, twos = (sum(v == x for v in counts[k].values()) for x in (1, 2))
        discount[k] = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.95)

    def prob(g):
        if not g:
            return 1 / (1 << 16)
        same = {x: v for x, v in counts[len(g)].items() if x[:-1] == g[:-1]}
        if not same:
            return prob(g[1:])
        d, total = discount[len(g)], sum(same.values())
        return max(same.get(g, 0) - d, 0) / total + d * len(same) / total * prob(g[1:])

    grams, _ = langid._grams(texts)
    k, n = np.unique(grams, return_counts=True)
    m = langid.KneserNey(k, n)
    pack = lambda g: sum(ord(c) << 16 * (3 - i) for i, c in enumerate(g))
    assert collections.Counter(map(int, grams)) == collections.Counter(pack(g) for g in rows)
    asked = [*counts[4], "abcd", "zzzz", "thex", " the", "e ca", "wölf", "   q", "bra "]
    got = m.prob(np.array([pack(g) for g in asked], np.uint64))
    assert got.tolist() == pytest.approx([prob(g) for g in asked], rel=1e-5)


def test_kneser_ney_sums_to_one():
    text = "abracadabra abba cab " * 20
    g, _ = langid._grams([text])
    k, n = np.unique(g, return_counts=True)
    m = langid.KneserNey(k, n)
    symbols = np.arange(1 << 16, dtype=np.uint64)
    for ctx in (k[0] >> np.uint64(16), np.uint64(0x7A007A007A)):
        assert m.prob((ctx << np.uint64(16)) | symbols).sum() == pytest.approx(1, abs=2e-3)


def test_line_quality(documents, none):
    rows = [(r.doc_id, r.text, r.source) for r in documents.select("doc_id", "text", "source").collect()]
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept"]
    got = line_quality.line_verdicts(documents, min_docs=3).select(*cols).collect()
    want = brute_quality(rows, 3)
    assert sorted(map(tuple, got), key=repr) == sorted((r[:9] for r in want), key=repr)
    got = line_quality.line_quality(documents, min_docs=3, carry=["rk"]).select(*cols, "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r[7] for r in want) > 0 and line_quality.line_verdicts(none).count() == 0


def test_line_limit_follows_the_hosts_texts(spark):
    duckdb = pytest.importorskip("duckdb")
    # (host, texts of it, texts that hold its line): the limits are 30 and 20 texts
    cases = [("big", 300, 31), ("large", 300, 30), ("wide", 300, 25), ("small", 40, 21), ("tiny", 40, 20), ("few", 10, 6), (None, 40, 21)]
    rows = []
    for s, n, k in cases:
        rows += [(f"{s} {i} " + " ".join(f"w{i}x{j}" for j in range(10)) + f"\nThe  line of {s}" * (i < k), s) for i in range(n)]
        rows += [rows[-1]] * 30 + [rows[-n]] * 30      # copies count once
    rows = [(d, t, s) for d, (t, s) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "depleted", "kept"]
    got = sorted(map(tuple, line_quality.line_verdicts(docs).select(*cols).collect()))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(con.sql(ORACLE_SQL["op9_line_quality"]).select(*cols).fetchall())
    assert {rows[r[0]][2] for r in got if r[7]} == {"big", "small", None}
    assert [r[7] for r in got] == [r[7] for r in brute_quality(rows, 20)]


def test_mixing(documents, none):
    got = mixing.systematic_copies(documents).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    sizes = {s: sum(r.size for r in x) for s, x in by.items()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = dict.fromkeys(sizes, 0.0), set()
    while True:                                    # share, cap, share the excess again
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for s in order:
        target[s] = 2.0 * sizes[s] if s in full else level * weight[s]
    for s, x in by.items():
        assert x[0].source_size == sizes[s] and x[0].target == pytest.approx(target[s])
        taken = sum(r.copies * r.size for r in x)
        assert abs(taken - target[s]) <= 2 * max(r.size for r in x) and all(0 <= r.copies <= 2 for r in x)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.systematic_copies(documents.repartition(3)).collect()), key=repr)
    copies = collections.Counter()
    for r in got:
        copies[(r.doc_id, r.source, r.size)] += r.copies
    mixed = collections.Counter((r.doc_id, r.source, len(words(r.text))) for r in mixing.mix(documents).collect())
    assert mixed == +copies
    assert mixing.systematic_copies(none).count() == 0 and mixing.mix(none).columns == none.columns


def test_mixing_spreads_the_copies_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "one two three", "a")] * 6000 + [(k, "four five", "b") for k in range(2, 3002)], "doc_id long, text string, source string").repartition(3)
    sizes = mixing.mix(df).filter("doc_id = 1").groupBy(F.spark_partition_id()).count().collect()
    drawn = mixing.systematic_copies(df).filter("doc_id = 1").agg(F.sum("copies")).first()[0]
    assert sum(r["count"] for r in sizes) == drawn > 5000 and max(r["count"] for r in sizes) < 0.5 * drawn


def test_mixing_keeps_rows_that_differ_in_other_columns(spark):
    df = spark.createDataFrame([(1, "one two three", "a", f"l{i}") for i in range(12)], "doc_id long, text string, source string, lang string")
    out = [r.lang for r in mixing.mix(df).collect()]
    assert len(set(out)) == 12 and max(collections.Counter(out).values()) <= 2

"""The corpus pipeline against a brute-force version, and the DuckDB twins of the queries."""

import base64
import collections
import hashlib
import os
import re

import pytest

import corpus_pipeline
from riskladder.llm.queries import ORACLE_SQL, QUERIES
from tests_llm_brute import brute_blocks, brute_components, brute_quality, words

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def _after_substrings(rows):
    """(id, text, source) after the first three stages, in plain Python."""
    good = brute_quality(rows, 20)
    rows = [(d, q[9], s) for (d, _, s), q in zip(rows, good) if q[8]]
    keep = {d for d, _, c in brute_components([(d, t) for d, t, _ in rows]) if d == c}
    rows = [r for r in rows if r[0] in keep]
    left = {d: k for d, n, m, k in brute_blocks([(d, t) for d, t, _ in rows]) if m == 0 or m < n}
    return [(d, left[d], s) for d, _, s in rows if d in left]


def test_pipeline(spark):
    tiktoken = pytest.importorskip("tiktoken")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
    want = _after_substrings(rows)
    assert sorted((r.doc_id, b" ".join(words(r.text)).decode()) for r in docs.collect()) == sorted((d, b" ".join(words(t)).decode()) for d, t, _ in want)
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    drawn = collections.Counter(r.doc_id for r in out)
    assert set(drawn) <= set(texts) and max(drawn.values()) <= 2
    for r in out:
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    total = sum(len(words(t)) for t in texts.values())
    taken = sum(n * len(words(texts[d])) for d, n in drawn.items())
    longest = max(len(words(t)) for t in texts.values())
    assert abs(taken - 1.5 * total) <= 2 * longest * len({s for _, _, s in want})


def test_near_copies_are_decided_per_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = a.replace("a20", "zz")
    rows = [(0, a, "x"), (1, a, "x"), (1, b, "x"), (2, near, "x"), (None, c, "y"), (None, c, "y"), (None, c, "z"), (None, a, "y"), (3, "", "x"),
            (3, "", "x"), (4, None, "x"), (4, None, "x"), (5, "", "x"), (None, None, "x"), (6, b.replace("b20", "zz"), "q")]
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(0, a), (1, b), (None, c), (3, ""), (4, None), (5, ""), (None, None)], key=repr)
    assert corpus_pipeline.near_copies(spark, docs.limit(0), SF).count() == 0


def test_every_query_is_held_against_sql_or_brute_force():
    tested = {"op3_wavelet_shards": "test_wavelet_shards", "op4_language_id": "test_kneser_ney_against_brute_force",
              "op6_suffix_dedup": "test_suffix_dedup", "op7_byte_bpe": "test_bpe_equals_tiktoken", "op12_token_counts": "test_token_counts"}
    assert set(QUERIES) - set(ORACLE_SQL) == set(tested)
    folder = os.path.dirname(os.path.abspath(__file__))
    code = "".join(open(os.path.join(folder, f), encoding="utf-8").read() for f in os.listdir(folder) if f.endswith(".py"))
    assert all(f"def {t}(" in code for t in tested.values())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in set(re.findall(r"\b(documents|embeddings|conversations)\b", ORACLE_SQL[name])):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want.select(*cols).fetchall(), key=repr)

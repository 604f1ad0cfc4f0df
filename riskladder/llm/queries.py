"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import os
import tempfile
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.llm import (block_dedup, bpe, chat, hard_negatives, kdtree, langid, line_quality, mixing, ngram_join, spelling,
                            suffix_dedup, token_count, wavelet)

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), for sessions that were not started
    with it on their Python path, and make Arrow batches of texts small (rows of a batch are held several
    times between the JVM and Python). The operators themselves leave the session alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="riskladder-py-"), "riskladder.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("riskladder", os.path.relpath(full, top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (ngram_join.ngram_jaccard_components(_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.systematic_copies(_table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = wavelet.shard_path(spark)
    wavelet.write_shards(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_documents(spark, path, with_ids=False)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = block_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed_from").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                             public_tokenizers.PATTERN, digests_only=True)


def op8_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(_table(spark, sf_dir, "conversations"))
    ranges = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return out.select("conv_id", "perspective", "part", "n_turns", "rendered", F.array_join(ranges, ",").alias("mask"))


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_verdicts(_table(spark, sf_dir, "documents")).drop("rk", "bad")


def op10_kdtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(_table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_mixing, op3_wavelet_shards, op4_language_id, op5_block_dedup, op6_suffix_dedup, op7_byte_bpe,
    op8_chat_perspectives, op9_line_quality, op10_kdtree_top_k, op11_hard_negatives, op12_token_counts, op13_spelling_variants)}

_WORD = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op1_ngram_jaccard": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY 1),
k AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM k JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
r(node, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, e.y FROM r JOIN e ON r.reach = e.x)
SELECT n.doc_id, n.n AS n_shingles, min(r.reach) AS component_id FROM n JOIN r ON r.node = n.doc_id GROUP BY 1, 2""",
    "op2_mixing": f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
c AS (SELECT *, [3, 1, 2][rk % 3 + 1] AS w, 2 * source_size AS cap FROM o),
p AS (SELECT *, coalesce(sum(cap) OVER q, 0) AS caps, coalesce(sum(w) OVER q, 0) AS ws FROM c
      WINDOW q AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((1.5::DOUBLE * (SELECT sum(source_size) FROM s) - caps) / ((SELECT sum(w) FROM c) - ws)) AS level FROM p),
t AS (SELECT source, source_size, least(cap::DOUBLE, level * w) AS target FROM p, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS pos,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
        ('0x' || substr(md5('0|' || coalesce(d.source, chr(0))), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(pos * rate + u) - floor((pos - 1) * rate + u)) * size)::BIGINT AS taken FROM r""",
    "op5_block_dedup": f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM g),
f AS (SELECT g, min(doc_id) AS first FROM h GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM h JOIN f USING (g) WHERE first < doc_id),
l AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(coalesce(gone, []::BIGINT[]), i)), lambda i: ws[i]), ' ')) AS kept_sha256
FROM w LEFT JOIN l ON w.doc_id = l.doc_id""",
    "op8_chat_perspectives": r"""
WITH t AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1) // 256 AS part FROM (
    SELECT conv_id, turn, role AS named, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations)),
s AS (SELECT DISTINCT conv_id, named AS perspective FROM t WHERE named IS NOT NULL AND named <> 'system'),
e AS (
  SELECT t.*, s.perspective, role = perspective AS own,
    CASE WHEN role = perspective THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
      ELSE '<|user|>' || chr(10) || role || ': ' END AS who, text || chr(10) || '<|end|>' || chr(10) AS body
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, sum(length(who) + length(body)) OVER (PARTITION BY conv_id, part, perspective ORDER BY turn NULLS FIRST, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM e)
SELECT conv_id, perspective, part, count(*) AS n_turns,
  string_agg(who || body, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
  coalesce(string_agg((stop - length(body))::VARCHAR || '-' || stop::VARCHAR, ',' ORDER BY turn NULLS FIRST, role, text) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, perspective, part""",
    "op9_line_quality": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, {_WORD}) AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS solid FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
b AS (SELECT r, g FROM g GROUP BY r, g HAVING count(*) > 1),
v AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS pos FROM g JOIN b USING (r, g)) GROUP BY r),
l AS (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT r, source, text, regexp_extract_all(lower(line), {_WORD}) AS ws FROM l),
k AS (SELECT r, source, text, array_to_string(ws, ' ') AS h, len(ws) AS n FROM m WHERE len(ws) > 0),
t AS (SELECT source, count(DISTINCT text) AS n FROM d GROUP BY source),
f AS (SELECT source, h FROM k GROUP BY source, h HAVING count(DISTINCT text) >
        (SELECT greatest(20.0, 0.10 * t.n) FROM t WHERE t.source IS NOT DISTINCT FROM k.source)),
x AS (SELECT k.r, sum(k.n)::BIGINT AS lost FROM k JOIN f ON k.h = f.h AND k.source IS NOT DISTINCT FROM f.source GROUP BY k.r),
a AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(solid) - len(list_distinct(solid)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN v USING (r) LEFT JOIN x USING (r)),
z AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 100 * n_removed_words > 50 * n_words AS depleted FROM a)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM z""",
    "op10_kdtree_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op13_spelling_variants": f"""
WITH RECURSIVE b AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
o AS (SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY 1, 2),
x AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM o),
h AS (
  SELECT run, n, xor(list_reduce(range(0, len(bytes), 2), lambda c, i: xor(c >> 8, t[1 + (xor(c, ('0x' || bytes[i + 1:i + 2])::BIGINT) & 255)]), 4294967295), 4294967295) AS h
  FROM x, b),
w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
d AS (SELECT word, unnest(range(length(word))) AS i FROM w),
g AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS cut FROM d),
e AS (
  SELECT a.word, z.word AS near FROM g a JOIN g z ON a.i = z.i AND a.cut = z.cut AND a.word <> z.word
  UNION SELECT word, cut FROM g JOIN w z USING (word) WHERE cut IN (SELECT word FROM w)
  UNION SELECT cut, word FROM g WHERE cut IN (SELECT word FROM w)),
m AS (SELECT e.word, count(*) AS n_near, min(ROW(-z.n, near)) AS best FROM e JOIN w z ON z.word = e.near GROUP BY 1),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 10 * w.n THEN best[2] END AS form,
    CASE WHEN -best[1] >= 10 * w.n THEN -best[1] END AS form_n FROM w LEFT JOIN m ON m.word = w.word),
c(word, last, form) AS (SELECT word, word, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.form)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word AND c.form IS NULL""",
}

"""A training-data pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared
checkpoint folder and read again as the next stage's docs. All but the last return the
columns of documents. Decisions: quality rules drop rejected documents and cut boilerplate
lines; of each group of near copies the row with the smallest id stays; repeated word
windows are cut, and a document that loses every word goes; mixing repeats or drops documents to reach its
source's target; the last stage gives token ids.

Edge cases are those of the operators; a stage on no rows gives no rows. Of rows with one id and one text one
stays after the near-copy stage, also of rows with a null id (which come after all others of their group).
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.llm import arrays, block_dedup, bpe, line_quality, mixing, ngram_join
from riskladder.llm.queries import ship
from riskladder.session import ensure_checkpoint_dir, materialize


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def _documents(out: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with a new text; n_chars follows it."""
    new = F.length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out.select(*[F.col(text).alias("text") if c == "text" else F.col("doc_id") if c == "doc_id"
                        else new.alias(c) if c == "n_chars" else F.col("rest")[c].alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = line_quality.line_quality(docs, carry=_others(docs))
    return _documents(out.filter("kept"), docs, "kept_text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decided per row, named by id and text: of each component the smallest row by (id, nulls last, text hash) stays,
    and of rows that agree in both one. A row of another text under the id of a copy is kept."""
    ship(spark)
    found = materialize(ngram_join.ngram_jaccard_components(docs, text_key=True).select("doc_id", "text_md5", "component"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_md5").alias("md5")))
    groups = (found.filter("component is not null").groupBy(F.col("component").alias("_c")).agg(first.alias("_first"), F.count("*").alias("_n"))
              .filter("_n > 1").drop("_n"))
    stays = F.col("doc_id").eqNullSafe(F.col("_first.id")) & F.col("text_md5").eqNullSafe(F.col("_first.md5"))
    gone = found.join(groups, F.col("component") == F.col("_c")).filter(~stays).select("doc_id", "text_md5").distinct().withColumn("_gone", F.lit(True))
    again = found.groupBy("doc_id", "text_md5").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id", "text_md5", F.lit(False).alias("_gone"))
    marks = materialize(gone.unionByName(again).groupBy(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5")).agg(F.max("_gone").alias("_gone"))
                        .withColumn("_key", F.xxhash64("_id", "_md5")))
    bits = spark.sparkContext.broadcast(arrays.bloom_of(marks, "_key"))
    marks = marks.withColumnRenamed("_key", "_mark")
    keyed = docs.withColumn("_text_md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    keyed = keyed.withColumn("_row_key", F.xxhash64("doc_id", "_text_md5"))
    rest = arrays.with_bits(keyed, "_row_key", bits, has=False).select(*docs.columns)
    met = arrays.with_bits(keyed, "_row_key", bits).join(
        marks, (F.col("_row_key") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text_md5").eqNullSafe(F.col("_md5")), "left")
    met = met.filter("_gone is null or not _gone").dropDuplicates(["doc_id", "_text_md5"])
    return rest.unionByName(met.select(*docs.columns))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    out = block_dedup.remove_repeats(docs, layout=True, carry=_others(docs))
    return _documents(out.filter("n_removed = 0 or n_removed < n_words"), docs, "kept_text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return (bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=False, cache_bytes=24 << 20)
            .select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("substring dedup", substrings),
          ("mixing sources", mixed), ("byte-level BPE", tokens)]

# Tokenizing is not SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``sf_dir``'s documents."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

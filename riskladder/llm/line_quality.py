"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules are computed inside the row. Then lines are normalised (lower case, words joined by
one space) and hashed, the distinct texts that hold a line are counted per host (the
source column), lines in more than ``max_share`` of the host's distinct texts and in more than
``min_docs`` of them are removed, and a document that loses more than ``max_loss_percent`` of its words is
rejected as depleted. Exact copies count once, so a copied document does not turn into
boilerplate.

Lines are cut and hashed once per row, into a checkpoint without the texts. A line is dealt with its host
and hash and counted with partial sums, as are the host's texts; the lines above the limits are few, so they join back
without moving the texts.

Edge cases: null and empty texts have no words (base rule fails); the null host is a host;
repeated rows get equal results; a line of white space is never counted; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _line(text: Column) -> Column:
    """Hash and word count of a line, normalised."""
    words = words_of(F.lower(text))
    return F.struct(F.xxhash64(F.array_join(words, " ")).alias("h"), F.size(words).alias("w"))


def _source(docs: DataFrame, text_col: str, id_col: str, host_col: str, carry: list[str] | None) -> DataFrame:
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("raw"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      *([F.struct(*carry).alias("rest")] if carry else []))
    return src.withColumn("rk", F.xxhash64("doc_id", "host", "raw"))


def line_verdicts(docs: DataFrame, max_share: float = 0.10, min_docs: int = 20, max_loss_percent: int = 50,
                  min_words: int = 10, max_repeat_percent: int = 20, text_col: str = "text", id_col: str = "doc_id",
                  host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, rk (row key), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_removed_words, depleted, kept, bad (hashes of the document's removed lines, or null)."""
    src = _source(docs, text_col, id_col, host_col, None)
    lines = F.transform(F.split("text", "\n"), _line)

    # base rules, staged so that every array is made once
    keep = ["doc_id", "rk", "host", "text_md5"]
    src = src.withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary"))))
    base = src.select(*keep, "text", lines.alias("lines"), words_of(F.col("text")).alias("words"))
    base = base.select(*keep, "text", "lines", F.size("words").cast("long").alias("n_words"),
                       F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                       F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                       F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("solid"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    rolled = F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0))),
                         lambda x, i: F.xxhash64(x, *[F.get("hashes", i + k) for k in range(1, WINDOW)]))
    counts = ["n_words", "word_chars", "n_symbols"]
    base = base.select(*keep, "lines", *counts, (F.size("solid") - F.size(F.array_distinct("solid"))).cast("long").alias("n_dup_lines"),
                       rolled.alias("windows"))
    counts.append("n_dup_lines")
    base = base.select(*keep, "lines", *counts, F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("sorted"))
    again = F.filter("sorted", lambda x, i: F.coalesce(x["h"] == F.get("sorted", i - 1)["h"], F.lit(False))
                     | F.coalesce(x["h"] == F.get("sorted", i + 1)["h"], F.lit(False)))
    base = base.select(*keep, "lines", *counts, F.sort_array(F.transform(again, lambda x: x["i"])).alias("at"))
    covered = F.aggregate(F.transform("at", lambda x, i: F.least(F.lit(WINDOW), x - F.coalesce(F.get("at", i - 1), x - WINDOW))),
                          F.lit(0), lambda a, x: a + x)
    base = base.select(*keep, "lines", *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    counts.append("n_repeat_words")

    # the checkpoint keeps later filters from being pushed, expanded, into the expressions above
    base = materialize(base)

    # lines: in how many distinct texts of the host, of how many
    held = base.select("rk", "host", "text_md5", F.explode(F.array_distinct(F.filter("lines", lambda x: x["w"] > 0)["h"])).alias("h"))
    texts = base.select("host", "text_md5").distinct().groupBy("host").agg(F.count("*").alias("n"))
    limits = texts.select(F.col("host").alias("_host"), F.greatest(F.lit(float(min_docs)), F.lit(float(max_share)) * F.col("n")).alias("_limit"))
    often = (held.select("host", "h", "text_md5").distinct().groupBy("host", "h").agg(F.count("*").alias("df"))
             .filter(F.col("df") > min_docs))
    often = often.join(limits, F.col("host").eqNullSafe(F.col("_host"))).filter("df > _limit")
    often = often.select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    marks = (held.join(often, F.col("host").eqNullSafe(F.col("_host")) & (F.col("h") == F.col("_h")))
             .groupBy("rk").agg(F.collect_set("h").alias("bad")))
    out = base.join(marks, "rk", "left")
    lost = F.aggregate(F.filter("lines", lambda x: (x["w"] > 0) & F.array_contains("bad", x["h"])), F.lit(0), lambda a, x: a + x["w"])
    out = out.withColumn("n_removed_words", F.coalesce(F.when(F.col("bad").isNotNull(), lost), F.lit(0)).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    depleted = 100 * F.col("n_removed_words") > max_loss_percent * F.col("n_words")
    return out.select("doc_id", "rk", *counts, failed.alias("base_failed"), "n_removed_words", depleted.alias("depleted"),
                      (~failed & ~depleted).alias("kept"), "bad")


def line_quality(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", host_col: str = "source",
                 carry: list[str] | None = None, **limits) -> DataFrame:
    """The documents with their verdicts: the columns of ``line_verdicts`` and kept_text (the text
    without the removed lines); ``carry`` columns come along as struct ``rest``."""
    names = {"text_col": text_col, "id_col": id_col, "host_col": host_col}
    verdicts = line_verdicts(docs, **limits, **names).drop("doc_id").dropDuplicates(["rk"])
    out = _source(docs, **names, carry=carry).join(verdicts, "rk")
    pieces = F.filter(F.split("text", "\n"), lambda s: ~F.array_contains("bad", _line(s)["h"]) | (_line(s)["w"] == 0))
    text = F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(pieces, "\n"))
    return out.withColumn("kept_text", text).drop("rk", "host", "raw", "text", "bad")

"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words: all sources share ``total`` times the
corpus by weight, a target stops at ``most`` times the source's size, and what is over goes to
the other sources by weight (one water level for all, found from running sums over
the sources in order of saturation). A document's expected copies are target / size of
its source; the expected copies are prefix-summed within the source, one random offset is
added, and a copy is emitted for each integer boundary crossed. Documents are in
order of size, so the taken words stay within about one long document of the target.

A hot source is spread over ranges of that order. The offset is a hash of seed and source:
reruns agree. Edge cases: null and empty texts have size 0 (they may be taken, with no
words); the null source is a source; a source without words has target 0; repeated rows
are documents of their own; null ids sort first among equal sizes; no rows give no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.llm.running import running_sums
from riskladder.session import materialize

SLICE = 256                      # copies of one row that are made in one place
WEIGHTS = (3, 1, 2)              # fixed values: weights of the sources in code point order, repeating


def _sizes(src: DataFrame) -> DataFrame:
    def scan(batches):
        for t in A.text_chunks(batches, "text", None):
            yield pa.RecordBatch.from_arrays(
                [t.rows.column(c) for c in ("doc_id", "source", "rk")] + [pa.array(A.Words(t, lower=False).counts)],
                ["doc_id", "source", "rk", "size"])

    return src.mapInArrow(scan, "doc_id long, source string, rk long, size long")


def source_targets(sizes: DataFrame, total: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) for rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source").asc_nulls_last()]
    per = running_sums(per.withColumn("_one", F.lit(1)), order, {"_rank": "_one"})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = per.withColumns({"_w": weight.cast("long"), "_cap": most * F.col("source_size")})
    per = running_sums(per, [F.col("_cap") / F.col("_w"), F.col("_rank")], {"_caps": "_cap", "_ws": "_w"})
    per = materialize(per)
    all_ = per.agg(F.sum("source_size").alias("_all"), F.sum("_w").alias("_all_w"))
    # the level that the sources from here on would share; the highest is the common one
    level = (per.crossJoin(all_)              # one row
             .agg(F.max((total * F.col("_all") - F.col("_caps")) / (F.col("_all_w") - F.col("_ws"))).alias("_level")))
    return per.crossJoin(level).select("source", "source_size", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w")).alias("target"))


def _row_key(docs: DataFrame) -> Column:
    """Hash of all columns and of which are null (the hash skips nulls)."""
    return F.xxhash64(*[docs[c] for c in docs.columns], *[docs[c].isNull() for c in docs.columns])


def systematic_copies(docs: DataFrame, total: float = 1.5, most: int = 2, seed: int = 0, weights: tuple[int, ...] = WEIGHTS,
                      text_col: str = "text", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, rk (row key), size, source_size, target, copies."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      _row_key(docs).alias("rk"), F.col(text_col).cast("string").alias("text"))
    sizes = materialize(_sizes(src))
    targets = source_targets(sizes, total, most, weights).withColumnRenamed("source", "_s")
    ranked = running_sums(sizes.withColumn("_one", F.lit(1)),
                          [F.col("source"), F.col("size"), F.col("doc_id"), F.col("rk")], {"_before": "_one"}, "source")
    each = ranked.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_one")
    name = F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("\x00")))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor((F.col("_before") + 1) * rate + offset) - F.floor(F.col("_before") * rate + offset)
    return each.withColumn("copies", copies.cast("long")).drop("_before")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs``, all its columns, as often as it was drawn. Copies of rows that agree in
    every column are drawn together; many of them are made in slices of ``SLICE``, dealt to all tasks."""
    drawn = materialize(systematic_copies(docs, **options).groupBy("rk").agg(F.sum("copies").alias("_n"))
                        .filter("_n > 0").withColumnRenamed("rk", "_rk"))
    rows = docs.withColumn("_rk", _row_key(docs)).dropDuplicates(["_rk"])
    copy = F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))
    few = rows.join(drawn.filter(F.col("_n") <= SLICE), "_rk").withColumn("_copy", copy).select(*docs.columns)
    often = drawn.filter(F.col("_n") > SLICE)
    if often.isEmpty():
        return few
    many = rows.join(often, "_rk")
    many = many.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / SLICE))))
    many = many.withColumn("_n", F.least(F.lit(SLICE).cast("long"), F.col("_n") - F.col("_slice") * SLICE))
    many = many.repartition(A.reduce_tasks(docs), "_rk", "_slice").drop("_slice")
    return few.unionByName(many.withColumn("_copy", copy).select(*docs.columns))

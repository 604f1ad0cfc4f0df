"""Flattening of the fund type tree: three levels by joins, any depth by a recursive query.

The tree is a dimension (hundreds of nodes): levels are read once and joined
leaf -> parent -> root. The joins are left joins; a leaf whose parent is missing
or not executed keeps null upper levels. Size-based broadcast is left to the
planner (and AQE at run time), so a larger tree falls back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_levels(nodes: DataFrame, code: str = "FundTypeCode", name: str = "FundTypeName",
                parent: str = "FNodeCode", level: str = "Level", active: str = "IfExecuted") -> tuple[DataFrame, ...]:
    """The executed nodes of levels 3, 2 and 1: FundTypeCodeK, FundTypeNameK, _parentK."""
    live = nodes.filter(F.col(active) == 1).select(code, name, parent, level)
    return tuple(live.filter(F.col(level) == k)
                 .select(F.col(code).alias(f"FundTypeCode{k}"), F.col(name).alias(f"FundTypeName{k}"),
                         F.col(parent).alias(f"_parent{k}")) for k in (3, 2, 1))


def attach_type_path(df: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add names and codes of all levels to rows with FundTypeCode3, level after level: each
    level has a known small size, while the size of the flattened tree would be over-estimated
    and the rows shuffled by their few type codes."""
    l3, l2, l1 = type_levels(nodes)
    return (df.join(l3, "FundTypeCode3", "left")
              .join(l2, F.col("_parent3") == F.col("FundTypeCode2"), "left")
              .join(l1, F.col("_parent2") == F.col("FundTypeCode1"), "left")
              .drop("_parent3", "_parent2", "_parent1"))


def flatten_tree(nodes: DataFrame, code: str = "FundTypeCode", name: str = "FundTypeName",
                 parent: str = "FNodeCode", level: str = "Level", active: str = "IfExecuted") -> DataFrame:
    """-> FundTypeCode1, FundTypeName1, FundTypeCode2, FundTypeName2, FundTypeCode3, FundTypeName3."""
    l3, l2, l1 = type_levels(nodes, code, name, parent, level, active)
    return (l3.join(l2, l2["FundTypeCode2"] == l3["_parent3"], "left")
              .join(l1, l1["FundTypeCode1"] == l2["_parent2"], "left")
              .select("FundTypeCode1", "FundTypeName1", "FundTypeCode2", "FundTypeName2",
                      "FundTypeCode3", "FundTypeName3"))


def type_paths(nodes: DataFrame, code: str = "FundTypeCode", name: str = "FundTypeName",
               parent: str = "FNodeCode", active: str = "IfExecuted", leaf: Column | None = None) -> DataFrame:
    """-> code, path, complete for every executed node (or those that ``leaf`` picks): ``path`` is an array of
    (code, name) from the node up to its last executed ancestor, whatever the depth.

    A recursive query: each round joins the walks to the parents of their last nodes. A node that is
    on the walk already ends it (a cycle), as do a missing and a not executed parent. ``complete``: the walk ended at a
    root, whose parent is null or 0. Codes must be unique among executed nodes, else each of them is walked
    and the longest path is kept. Spark bounds depth and rows of a recursion (``spark.sql.cteRecursionLevelLimit``,
    ``spark.sql.cteRecursionRowLimit``); past them the query fails, it is never cut."""
    live = nodes.filter(F.col(active) == 1).select(F.col(code).alias("code"), F.col(name).alias("name"), F.col(parent).alias("parent"),
                                                   (F.lit(True) if leaf is None else leaf).alias("is_leaf"))
    walks = nodes.sparkSession.sql("""
        WITH RECURSIVE walk(node, depth, parent, path) AS (
          SELECT code, 1, parent, array(struct(code, name)) FROM {live} WHERE is_leaf
          UNION ALL
          SELECT w.node, w.depth + 1, n.parent, concat(w.path, array(struct(n.code, n.name)))
          FROM walk w JOIN {live} n ON w.parent = n.code
          WHERE NOT exists(w.path, p -> p.code = n.code))
        SELECT node AS code, max(struct(depth, path, parent)) AS last FROM walk GROUP BY node""", live=live)
    top = F.col("last.parent")
    return walks.select("code", F.col("last.path").alias("path"), (top.isNull() | (top == 0)).alias("complete"))


def flatten_paths(nodes: DataFrame, levels: int = 3, code: str = "FundTypeCode", name: str = "FundTypeName",
                  parent: str = "FNodeCode", level: str = "Level", active: str = "IfExecuted") -> DataFrame:
    """``flatten_tree`` for any number of levels, from ``type_paths`` of the nodes at the lowest one: columns
    FundTypeCode1, FundTypeName1 ... down to level ``levels``; missing upper levels are null."""
    paths = type_paths(nodes, code, name, parent, active, F.col(level) == levels)
    at = lambda k, f: F.try_element_at("path", F.lit(levels - k + 1))[f]
    return paths.select(*[at(k, f).alias(f"FundType{n}{k}") for k in range(1, levels + 1) for f, n in (("code", "Code"), ("name", "Name"))])

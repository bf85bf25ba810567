"""Connected components of an edge table, by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.shared import discard, stored


def _with_least(pairs: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """u, v and the least of u and its neighbours; and the table of the least, to be discarded.

    The least come from a partial aggregate and are stored, so that rows meet them by a join of two plain tables: the
    rows of a hub, which may be a large part of all, can be split by adaptive execution.
    """
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)
    return pairs.join(least, "u"), least


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """edges: u, v (of one sortable type). Returns node, root: the least node that edges lead to; only for nodes of edges.

    Each round keeps what it found in the shared folder and deletes what the one before left. Rounds end when the edges
    are stars around the least nodes.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        met, first = _with_least(both, label)
        large = stored(met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), label)
        met, second = _with_least(large, label)
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = stored(small, label)
        done = after.join(now, ["u", "v"], "left_anti").isEmpty() and now.join(after, ["u", "v"], "left_anti").isEmpty()
        for table in (now, first, large, second):
            discard(table)
        if done:
            break
        now = after
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())

"""Connected components of a distributed edge table (union-find by alternating stars).

Each round replaces every node's larger neighbours by links to its smallest neighbour (large star), then links a
node's smaller neighbours and itself to the smallest of them (small star), until nothing changes; the number of
rounds grows with the logarithm of the largest component.  Edges stay distributed; each round is checkpointed in
the shared folder, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_tables, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), both directions for the large star; from larger to smaller ends for the small one."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = edges.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of *edges* (two columns of one orderable type): root is the smallest node it reaches.

    Loops and edges with a null end are ignored; repeated edges count once; without edges the result is empty.
    """
    a, b = edges.columns
    now = write_table(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 2**31)).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v"), F.col("v")).distinct())
        before = mark
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        after = _star(both, True).distinct()
        after = after.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        last, now = now, write_table(_star(after, False).distinct(), "edges")
        drop_tables(last)

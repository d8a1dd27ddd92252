"""Connected components of a table of links, by alternating stars.

Each round joins every node to the smallest node near it: first larger
neighbours (large star), then smaller ones (small star).  Rounds go on until
the links are stars and stop changing, about twice the logarithm of the longest
chain.  Nothing is gathered on the driver but one count and checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import dropped, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over rows (u, v) with v < u."""
    near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("at", "m").alias("m"))
    joined = near.join(least, near["u"] == least["at"])
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) of one integer type;
    root is the component's smallest node.  Nulls and loops are ignored."""
    kind = dict(links.dtypes)["a"]
    now = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = written(now, "links"), None
    while True:
        count = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).head()
        if (count.n, count.x) == mark or not count.n:
            break
        mark = (count.n, count.x)
        before, now = now, written(_star(_star(now, True), False), "links")
        dropped(before)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).withColumn("root", F.col("root").cast(kind))

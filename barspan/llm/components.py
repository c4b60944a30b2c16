"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def min_labels(nodes: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """(doc_id, label) with the smallest id reachable over ``links`` (a, b), for every node (doc_id).

    Each round hangs nodes nearer to the smallest neighbour; the number of links never grows, and rounds grow with the
    logarithm of the longest path. Rounds are written to ``folder``, which all executors share, so lineage stays short.
    """
    spark = nodes.sparkSession
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    last, step = None, 0
    while True:
        now.write.mode("overwrite").parquet(f"{folder}/{step}")
        now = spark.read.parquet(f"{folder}/{step}")
        # Order-free sums of the links: equal sums twice running mean a fixed point.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last, step = state, step + 1
        # Large star: all larger neighbours of u go to the smallest of u and its neighbours.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours go to the smallest of them.
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = small.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        now = now.select("x.*").where("u <> v").distinct()
    tree = now.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "doc_id")
    return nodes.join(tree, "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("label"))

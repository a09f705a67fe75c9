"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtable.session import new_folder


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node is connected with.

    Rounds of two steps, each a grouped minimum and a join: every node hands the least
    of its neighbourhood to its larger neighbours, then every node hands the least of
    its smaller neighbours to these and keeps that link alone. Links so turn into
    stars around the smallest nodes; their number never grows. Each round is written
    to the shared folder, which cuts the lineage.
    """
    spark = links.sparkSession
    folder = new_folder(spark, "components")
    pair = lambda x, y: (F.greatest(x, y).alias("node"), F.least(x, y).alias("other"))
    links.where(F.col(a) != F.col(b)).select(*pair(a, b)).distinct().write.parquet(f"{folder}/0")
    turn, before = 0, None
    while True:
        now = spark.read.parquet(f"{folder}/{turn}")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other")), F.sum(F.xxhash64("other", "node") % 1_000_003)).first()
        if mark == before:
            return now.select("node", F.col("other").alias("component")).union(
                now.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
            )
        before = mark
        both = now.union(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        least = large.groupBy("node").agg(F.min("other").alias("least"))
        small = large.join(least, "node")
        small = small.select(F.explode(F.array(F.struct("node", F.col("least").alias("other")), F.struct(F.col("other").alias("node"), F.col("least").alias("other")))).alias("l"))
        turn += 1
        small.select("l.*").where("node <> other").distinct().write.parquet(f"{folder}/{turn}")

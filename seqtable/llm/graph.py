"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtable import session


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node that each node of an edge is connected with.

    In each round a node takes the least label among its neighbours and itself,
    then the label of the node so named. Minima combine before the shuffle, so a
    node with a large share of all edges needs no task of its own. Every round is
    written to the shared folder, which cuts the lineage; the number of rounds
    follows the logarithm of the longest path in the usual case.
    """
    spark = edges.sparkSession
    folder = session.new_folder(spark, "components")
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    both.union(both.select("other", "node")).write.parquet(f"{folder}/edges")
    both = spark.read.parquet(f"{folder}/edges")
    labels = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label"))
    labels.write.parquet(f"{folder}/0")
    turn = 0
    while True:
        labels = spark.read.parquet(f"{folder}/{turn}").select("node", "label")
        named = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        least = both.join(named, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        taken = labels.join(least, "node").select("node", F.col("label").alias("before"), F.least("label", "theirs").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        taken = taken.join(jump, "label", "left")
        turn += 1
        taken.select(
            "node", F.least("label", "further").alias("label"), (F.col("before") > F.least("label", "further")).alias("changed")
        ).write.parquet(f"{folder}/{turn}")
        written = spark.read.parquet(f"{folder}/{turn}")
        if not written.filter("changed").limit(1).count():
            return written.select("node", "label")

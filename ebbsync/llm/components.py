"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbsync.session import work_dir, written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """The least node that each linked node reaches, as ``id`` and ``label``.

    Every round a node takes the least label among itself and its neighbors, and
    then the label of the node it points to, which halves the way to the least
    one. Rounds are tables in the shared folder. A node with many links is summed
    up before the exchange. An empty table of links gives an empty result.
    """
    spark = links.sparkSession
    both = links.select(F.col(a).alias("id"), F.col(b).alias("to"))
    both = both.unionByName(both.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct()
    both = written(both, work_dir(spark, "edges"))
    least = both.groupBy("id").agg(F.min("to").alias("label"))
    labels = written(least.select("id", F.least("id", "label").alias("label")), work_dir(spark, "labels"))
    while True:
        near = both.join(labels.withColumnRenamed("id", "to"), "to").select("id", "label")
        lower = labels.unionByName(near).groupBy("id").agg(F.min("label").alias("label"))
        lower = written(lower, work_dir(spark, "labels"))
        to = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = lower.join(to, "label", "left").select("id", F.coalesce("next", "label").alias("label"))
        jumped = written(jumped, work_dir(spark, "labels"))
        before = labels.withColumnRenamed("label", "was")
        settled = jumped.join(before, "id").filter("label != was").isEmpty()
        labels = jumped
        if settled:
            return labels

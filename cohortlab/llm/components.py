"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (u long, v long).

    Each round a node takes the least label among its neighbours' and then that
    label's own label, so long chains halve.  Rounds are written to the shared
    scratch folder; only the number of changed labels reaches the driver.
    """
    both = edges.where("u != v").select("u", "v")
    both = keep(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = keep(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        best = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = keep(best.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        if step.where("old != label").limit(1).count() == 0:
            return step.select("node", F.col("label").alias("component"))
        labels = step.select("node", "label")

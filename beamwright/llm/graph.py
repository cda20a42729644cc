"""Connected components by least labels and pointer jumping, one written table a round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beamwright.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (id, root): the least id reachable, for every id that has an edge.

    Each round takes the least label among the neighbours, then the label of the label, so long chains halve. A hub's
    edges join as plain rows, which adaptive execution may split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        nearer = labels.join(near, "id").select("id", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        nearer = written(nearer, "labels")
        jump = nearer.select(F.col("id").alias("root"), F.col("root").alias("next"))
        after = written(nearer.join(jump, "root").select("id", F.least("root", "next").alias("root"), (F.least("root", "next") != F.col("old")).alias("moved")), "labels")
        if after.filter("moved").isEmpty():
            return after.select("id", "root")
        labels = after.select("id", "root")

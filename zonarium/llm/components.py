"""Connected components of a graph that is too large for one task."""

from pyspark.sql import functions as F

from zonarium.llm.common import stored


def connected_components(edges, one="a", two="b"):
    """(key, label): the least key of the component of every key that has an edge.

    A key takes the least label among itself and its neighbours, then the label of
    that label, until nothing changes; the number of rounds grows with the logarithm
    of a component's width.  Each join is between two written tables, so that Spark
    can split the rows of one label or hub, which may be a third of all.

    Defined results: repeated edges and edges of a key to itself change nothing; an
    edge with a null key is no edge; no edges give no rows.
    """
    pairs = edges.select(F.col(one).alias("key"), F.col(two).alias("near"))
    pairs = pairs.unionByName(edges.select(F.col(two).alias("key"), F.col(one).alias("near")))
    both = stored(pairs.filter("key <> near").distinct(), "edges")
    labels = stored(both.groupBy("key").agg(F.min("near").alias("near")).select("key", F.least("key", "near").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("key").alias("near"), F.col("label").alias("far"))
        spread = stored(both.join(seen, "near").groupBy("key").agg(F.min("far").alias("far")), "spread")
        stepped = stored(
            labels.join(spread, "key").select("key", F.least("label", "far").alias("step"), F.col("label").alias("was")),
            "stepped",
        )
        jump = stepped.select(F.col("key").alias("step"), F.col("step").alias("label"))
        after = stored(stepped.join(jump, "step").select("key", "label", (F.col("label") < F.col("was")).alias("moved")), "labels")
        labels = after.select("key", "label")
        if not after.filter("moved").take(1):
            return labels

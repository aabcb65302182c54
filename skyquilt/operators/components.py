"""Connected components of an undirected graph, by hooking to the smallest neighbour and contracting.

Each round every node takes the smallest node among itself and its neighbours, the pointers are doubled
once, and edges are rewritten on the new labels; edges inside a label vanish. Rounds grow with the
logarithm of the longest shortest path to a local minimum. Nothing but one emptiness flag reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyquilt.plans.scratch import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node in ``edges``; component is its smallest reachable node.

    Null ends and self loops are ignored, repeated edges count once, no edges give no rows.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)
    pairs = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    pairs = pairs.where(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("lo") < F.col("hi"))).select("lo", "hi").distinct()
    live, labels = scratch.save(pairs), None
    kind = edges.schema[a].dataType
    while not live.isEmpty():
        both = live.union(live.select("hi", "lo"))
        near = both.groupBy(F.col("lo").alias("node")).agg(F.min("hi").alias("m"))
        near = scratch.save(near.select("node", F.least("node", "m").alias("up")))
        above = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jump = scratch.save(near.join(above, "up").select("node", F.col("top").alias("up")))
        if labels is None:
            fresh = jump.select("node", F.col("up").alias("component"))
        else:
            step = jump.select(F.col("node").alias("component"), "up")
            fresh = labels.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        fresh = scratch.save(fresh)
        lo = jump.select(F.col("node").alias("lo"), F.col("up").alias("x"))
        hi = jump.select(F.col("node").alias("hi"), F.col("up").alias("y"))
        moved = live.join(lo, "lo").join(hi, "hi").where("x <> y")
        moved = scratch.save(moved.select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
        scratch.drop(labels, near, jump, live)
        live, labels = moved, fresh
    if labels is None:
        return spark.createDataFrame([], "node int, component int").select(F.col("node").cast(kind), F.col("component").cast(kind))
    return labels

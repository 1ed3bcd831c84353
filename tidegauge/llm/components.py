"""Connected components of a link table, by rounds of contraction.

In each round every node points to the neighbour (or itself) that comes first in a fresh hash order; links are then drawn
between the pointed-to nodes, and links inside one node vanish. A constant share of the nodes goes in each round on average,
also on chains, so rounds grow with the logarithm of the number of nodes. Links are reduced to distinct pairs as they shrink;
a node with a third of all links is only ever the key of a pre-aggregated minimum or of a join that may be split. Each
round is written to the shared folder; the driver sees row counts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import stage, stage_counted


def components(links: DataFrame, tag: str = "links") -> DataFrame:
    """`node`, `root` for every node of the links (a, b): equal roots, same component. Null ends are left out."""
    open_links, left = stage_counted(
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        tag,
    )
    kind = open_links.schema["a"].dataType
    spark = links.sparkSession
    assigned, turn = spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}"), 0
    while left:
        both = open_links.select("a", "b").union(open_links.select("b", "a")).toDF("node", "other")
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), c.alias("node"))  # noqa: B023, E731
        first = both.groupBy("node").agg(F.min(order(F.col("other"))).alias("o"))
        points = stage(
            first.select("node", F.least(order(F.col("node")), F.col("o"))["node"].alias("to")), f"{tag}-points"
        )
        # nodes met for the first time, and those whose root has moved on
        moved = assigned.join(points.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
        fresh = points.join(assigned.select("node"), "node", "left_anti").select("node", F.col("to").alias("root"))
        assigned = stage(moved.unionByName(fresh) if turn else fresh, f"{tag}-roots")
        ends = open_links.join(points.toDF("a", "ra"), "a").join(points.toDF("b", "rb"), "b")
        open_links, left = stage_counted(
            ends.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            tag,
        )
        turn += 1
    return assigned

"""Connected components of links between numbered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import drop_tables, materialize


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every end of ``links`` (a, b); root is the least number reachable.

    Each round points every vertex to its least neighbour, follows the pointers to their ends, and
    goes on with the links between those ends; all state stays in written tables, each deleted when the next
    one is there.
    """
    edges = materialize(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "cc-edges")
    label: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "cc-point")
        while True:
            up = point.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            new = materialize(point.join(up, "p").select("a", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-point")
            drop_tables(point)
            point = new
            if new.where("moved").isEmpty():
                break
        if label is None:
            label = materialize(point.select(F.col("a").alias("v"), F.col("p").alias("root")), "cc-label")
        else:
            old, nxt = label, point.select(F.col("a").alias("root"), F.col("p").alias("r"))
            label = materialize(label.join(nxt, "root", "left").select("v", F.coalesce("r", "root").alias("root")), "cc-label")
            drop_tables(old)
        at = point.select(F.col("a").alias("x"), F.col("p").alias("r"))
        left = (edges.join(at, edges["a"] == at["x"]).select(F.col("r").alias("a"), "b")
                .join(at, F.col("b") == F.col("x")).select("a", F.col("r").alias("b")))
        left = materialize(left.where(F.col("a") != F.col("b")).distinct(), "cc-edges")
        drop_tables(edges, point)
        edges = left
    drop_tables(edges)
    return links.sparkSession.createDataFrame([], "v long, root long") if label is None else label

"""Distributed union-find over an edge table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace


def connected_components(edges: DataFrame, a: str, b: str, ws: Workspace, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node of its component.

    Each round hooks every node to its smallest neighbour (pointers only go down, so there are no cycles), halves the
    pointer paths until they are flat, and contracts the edges to the roots. It ends when no edge joins two roots, so it
    is exact for any diameter. Edges with a null end and self-loops are ignored. Only aggregates that combine before the
    shuffle and equi-joins that adaptive execution can split are used; the driver sees one number a round.
    """
    e = ws.save(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a < b").distinct(),
        f"{name}-edges",
    )
    spark, labels, round_ = ws.spark, None, 0
    kept = e
    while not kept.isEmpty():
        both = kept.unionByName(kept.select(F.col("b").alias("a"), F.col("a").alias("b")))
        p = ws.save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("parent")), f"{name}-p{round_}-0")
        hop = 0
        while True:
            up = p.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            nxt = ws.save(p.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")), f"{name}-p{round_}-{hop + 1}")
            ws.drop(f"{name}-p{round_}-{hop}")
            moved, p, hop = not nxt.where("moved").isEmpty(), nxt.select("node", "parent"), hop + 1
            if not moved:
                break
        ra, rb = p.select(F.col("node").alias("a"), F.col("parent").alias("ra")), p.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        kept = ws.save(kept.join(ra, "a").join(rb, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), f"{name}-e{round_}")
        if labels is None:
            labels = p.withColumnRenamed("parent", "component")
        else:
            step = p.select(F.col("node").alias("component"), F.col("parent").alias("lower"))
            labels = ws.save(labels.join(step, "component", "left").select("node", F.coalesce("lower", "component").alias("component")), f"{name}-l{round_}")
        round_ += 1
    if labels is None:
        kind = e.schema["a"].dataType
        labels = spark.createDataFrame([], "node string, component string").select(F.col("node").cast(kind), F.col("component").cast(kind))
    return labels

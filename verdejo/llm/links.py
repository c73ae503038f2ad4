"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import Scratch


def components(edges: DataFrame, ws: Scratch, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node reachable.

    Each round hangs larger neighbours on the smallest one (large star), then smaller ones
    (small star); the table shrinks to one edge per node. Hubs are reduced by partial minima,
    and joins on a hub are split by adaptive execution. Loops, repeated and null ends are allowed.
    """
    now = ws.keep(f"{name}-0", edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state, turn = None, 0
    while (new := _state(now)) != state:
        state, turn = new, turn + 1
        if not state[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        rest = hung.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = ws.keep(f"{name}-{turn}", rest.union(least.select("u", F.col("m").alias("v"))).distinct())
        ws.drop(f"{name}-{turn - 1}")
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], int(row[1] or 0)

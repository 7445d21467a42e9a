"""Connected components of an edge table, by rounds of small and large stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starq.llm.common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs neighbours on the least of them; the node itself too in a small star."""
    if large:
        around = edges.union(edges.select("v", "u")).toDF("node", "other")
    else:
        around = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("other"))
    least = around.groupBy("node").agg(F.min("other").alias("least"))
    if large:
        least = least.select("node", F.least("node", "least").alias("least"))
        hung = around.where("other > node").join(least, "node").select(F.col("other").alias("u"), F.col("least").alias("v"))
    else:
        others = around.join(least, "node").select(F.col("other").alias("u"), F.col("least").alias("v"))
        hung = others.union(least.select("node", "least"))
    # The small star that follows sees repeated edges as one.
    return hung.where("u <> v") if large else hung.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, files: int | None = None) -> DataFrame:
    """doc, comp (the least node it reaches) of every node that is not its own least.

    edges(u, v) of longs. Every round is a table in the shared folder; only a count
    and a checksum come to the driver. files: of every table, at most.
    """
    known, turn = None, 0
    now = scratch.write(edges.select("u", "v").where("u <> v").distinct(), f"{name}-0", files)
    while True:
        turn += 1
        after = scratch.write(_star(_star(now, large=True), large=False), f"{name}-{turn}", files)
        scratch.drop(f"{name}-{turn - 1}")
        now = after
        # Exact decimal sums of hashes: equal edge sets, whatever their order.
        print_of = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if known == tuple(print_of):
            return now.select(F.col("u").alias("doc"), F.col("v").alias("comp"))
        known = tuple(print_of)

"""As-of join within a group.

Each fact row gets the latest context row of its group at or before its time;
when nothing precedes it, the first context row of the group. Rows without time
or group, and groups without context, stay unmatched.

All context tables and the facts are stacked and one running window fills the
context forward, so a fact table joined to several contexts is shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from starq.operators.slicing import LIMIT, Slices, plan_slices, with_slice

# Rows that cannot match are dealt over this many window groups of their own.
_UNMATCHED_SPREAD = 1 << 20


@dataclass(frozen=True)
class Context:
    """A time-stamped context table; `columns` maps its columns to output names."""

    frame: DataFrame
    time: str
    columns: Mapping[str, str]
    # Decides between rows of the same group and time: the largest is the latest. Rows
    # without it come before all others; rows that still tie are ordered by their columns.
    tie: str | None = None


def _prepared(context: Context, keys: Sequence[str], one_per_time: bool) -> DataFrame:
    payload = F.struct(*[F.col(c).alias(out) for c, out in context.columns.items()])
    parts = [F.col(context.tie).isNotNull().alias("known"), F.col(context.tie).alias("value")] if context.tie else []
    tie = F.struct(*parts, payload.alias("row"))
    rows = context.frame.select(*keys, F.col(context.time).alias("_t"), payload.alias("_row"), tie.alias("_tie"))
    rows = rows.dropna(subset=[*keys, "_t"])
    if not one_per_time:
        return rows.withColumn("_first", F.col("_row"))
    # Combined before the shuffle, so even a time stamp shared by a large part
    # of a hot group becomes a single row.
    return rows.groupBy(*keys, "_t").agg(
        F.max_by("_row", "_tie").alias("_row"),
        F.min_by("_row", "_tie").alias("_first"),
        F.max("_tie").alias("_tie"),
    )


def _seeds(rows: DataFrame, keys: Sequence[str], slices: Slices) -> DataFrame:
    """What a fact sees before any context row of its own slice.

    Slice 0 starts from the group's first context row (the fallback), every
    later slice from the last context row of the slices before it.
    """
    heads = rows.groupBy(*keys).agg(F.min_by("_first", F.struct("_t", "_tie")).alias("_head"))
    if slices.hot is None:
        return heads.select(*keys, F.lit(0).alias("_slice"), F.col("_head").alias("_row"))
    grid = slices.one_row_per_slice().drop("_rows")
    tails = (
        with_slice(rows.join(F.broadcast(slices.hot.select(*keys)), list(keys), "left_semi"), slices, "_t")
        .groupBy(*keys, "_slice")
        .agg(F.max_by("_row", "_t").alias("_tail"))
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    hot = (
        grid.join(tails, [*keys, "_slice"], "left")
        .withColumn("_carry", F.last("_tail", ignorenulls=True).over(before))
        .join(heads, list(keys))
        .select(*keys, "_slice", F.coalesce("_carry", "_head").alias("_row"))
    )
    cold = heads.join(F.broadcast(slices.hot.select(*keys)), list(keys), "left_anti")
    return hot.unionByName(cold.select(*keys, F.lit(0).alias("_slice"), F.col("_head").alias("_row")))


def asof_join(
    facts: DataFrame,
    keys: Sequence[str],
    time: str,
    contexts: Sequence[Context],
    limit: int = LIMIT,
) -> DataFrame:
    keys = list(keys)
    load = facts.select(*keys, F.col(time).cast("double").alias("_v"))
    for c in contexts:
        load = load.unionByName(c.frame.select(*keys, F.col(c.time).cast("double").alias("_v")))
    slices = plan_slices(load, keys, "_v", limit)

    row_hash = F.xxhash64(*facts.columns)
    matchable = F.col("_t").isNotNull()
    for k in keys:
        matchable &= F.col(k).isNotNull()
    stacked = (
        with_slice(facts.withColumn("_t", F.col(time)), slices, "_t", spread=row_hash)
        .withColumn("_slice", F.when(matchable, F.col("_slice")).otherwise(-1 - F.pmod(row_hash, F.lit(_UNMATCHED_SPREAD))))
        .withColumn("_slice", F.col("_slice").cast("int"))
        .withColumn("_side", F.lit(1))
    )
    order = [F.col("_t").asc_nulls_first(), F.col("_side")]
    for i, c in enumerate(contexts):
        rows = _prepared(c, keys, one_per_time=slices.hot is not None)
        placed = with_slice(rows, slices, "_t").select(
            *keys, "_t", "_slice", F.lit(0).alias("_side"), F.col("_row").alias(f"_row{i}"), F.col("_tie").alias(f"_tie{i}")
        )
        seeds = _seeds(rows, keys, slices).select(
            *keys, "_slice", F.lit(0).alias("_side"), F.col("_row").alias(f"_row{i}")
        )
        stacked = stacked.unionByName(placed, allowMissingColumns=True).unionByName(seeds, allowMissingColumns=True)
        order.append(F.col(f"_tie{i}"))

    running = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = stacked
    filled = filled.select(
        *facts.columns,
        "_side",
        *[F.last(f"_row{i}", ignorenulls=True).over(running).alias(f"_hit{i}") for i in range(len(contexts))],
    ).where(F.col("_side") == 1)
    hits = [F.col(f"_hit{i}.{out}") for i, c in enumerate(contexts) for out in c.columns.values()]
    return filled.select(*facts.columns, *hits)

"""Cutting hot groups into ordered slices.

A window over a group runs in one task, so a group of more than LIMIT rows has to
be cut first. `plan_slices` finds such groups and their cut points, `with_slice`
adds a `_slice` number that grows with the ordering value: slice 0 holds the
smallest values of the group, the last slice the largest.

The plan is made once, up front, and kept as plain numbers. Every later use (and
every retried task) therefore cuts at the same points. LIMIT is a number of rows,
not a share, so a slice fits one task at any size of the data; the plan holds one
number per LIMIT rows, a few megabytes for a million million rows. Cut points come
from quantile sketches of fixed size, which tasks make of their own rows and Spark
merges: no rows are gathered or sorted for them. Results never depend on where the
cuts fall.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Rows that a group, or a slice of one, may bring to a task.
LIMIT = 1_000_000
# Cut points a sketch is asked for, and its accuracy: ranks are off by a tenth of a slice at most.
FANOUT, ACCURACY = 1024, 10_000


@dataclass(frozen=True)
class Slices:
    keys: tuple[str, ...]
    # One row per hot group: keys, _rows, _cuts (number of cut points), _chunk
    # (cut points per chunk), _chunks (the cut points), _ends (last one of each
    # chunk). None when no group is hot.
    hot: DataFrame | None

    def one_row_per_slice(self) -> DataFrame:
        """keys, _rows and every _slice of each hot group (bounded, see above)."""
        return self.hot.select(
            *self.keys, "_rows", F.explode(F.sequence(F.lit(0), F.col("_cuts"))).alias("_slice")
        )


def hot_groups(df: DataFrame, keys: Sequence[str], value: str, limit: int = LIMIT) -> DataFrame | None:
    """keys and _rows of the groups with more than `limit` values; None when there are none."""
    slim = df.select(*keys, F.col(value).cast("double").alias("_v")).dropna()
    # At most one row per `limit` rows of data comes back.
    large = slim.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit).collect()
    if not large:
        return None
    return df.sparkSession.createDataFrame(large, T.StructType([*[slim.schema[k] for k in keys], T.StructField("_rows", T.LongType())]))


def plan_slices(df: DataFrame, keys: Sequence[str], value: str, limit: int = LIMIT) -> Slices:
    keys = tuple(keys)
    groups = hot_groups(df, keys, value, limit)
    if groups is None:
        return Slices(keys, None)

    spark = df.sparkSession
    slim = df.select(*keys, F.col(value).cast("double").alias("_v")).dropna()
    key_fields = [slim.schema[k] for k in keys]
    hot = slim.join(F.broadcast(groups), list(keys))
    # Slices beyond FANOUT: first into FANOUT parts, then every part by itself.
    huge = math.ceil(groups.agg(F.max("_rows")).first()[0] / limit) > FANOUT
    first = _sketched(hot, [*keys, "_rows"], F.ceil(F.col("_rows") / F.lit(limit)))
    if huge:
        coarse = F.broadcast(first.where(F.col("_rows") / limit > FANOUT).select(*keys, F.col("_q").alias("_part_cuts")))
        part = F.size(F.filter("_part_cuts", lambda x: x < F.col("_v")))
        parts = hot.join(coarse, list(keys)).withColumn("_part", part)
        inner = _sketched(parts, [*keys, "_rows", "_part"], F.ceil(F.col("_rows") / F.lit(limit * FANOUT)))
        inner = inner.groupBy(*keys, "_rows").agg(F.flatten(F.collect_list("_q")).alias("_q"))
        ends = first.where(F.col("_rows") / limit > FANOUT).select(*keys, "_rows", "_q")
        first = first.where(F.col("_rows") / limit <= FANOUT).unionByName(
            ends.unionByName(inner).groupBy(*keys, "_rows").agg(F.flatten(F.collect_list("_q")).alias("_q"))
        )
    cuts = first.select(*keys, "_rows", F.array_sort("_q").alias("_q")).where(F.size("_q") > 0).collect()
    rows = []
    for r in cuts:
        q = r["_q"]
        chunk = max(1, math.isqrt(len(q)))
        chunks = [q[i : i + chunk] for i in range(0, len(q), chunk)]
        rows.append((*[r[k] for k in keys], r["_rows"], len(q), chunk, chunks, [c[-1] for c in chunks]))
    if not rows:
        return Slices(keys, None)
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("_rows", T.LongType()),
            T.StructField("_cuts", T.IntegerType()),
            T.StructField("_chunk", T.IntegerType()),
            T.StructField("_chunks", T.ArrayType(T.ArrayType(T.DoubleType()))),
            T.StructField("_ends", T.ArrayType(T.DoubleType())),
        ]
    )
    return Slices(keys, spark.createDataFrame(rows, schema))


def _sketched(rows: DataFrame, keys: Sequence[str], slices: Column) -> DataFrame:
    """keys and `_q`: cut points that part each group's _v into so many slices, FANOUT at most."""
    shares = F.array(*[F.lit(i / FANOUT) for i in range(1, FANOUT)])
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", shares, ACCURACY).alias("_all"))
    wanted = F.least(slices, F.lit(FANOUT)).cast("int")
    step = F.transform(
        F.when(wanted > 1, F.sequence(F.lit(1), wanted - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.get("_all", F.round(i * FANOUT / wanted).cast("int") - 1),
    )
    return sketch.select(*keys, step.alias("_q"))


def _cuts_passed(v: Column, or_equal: bool) -> Column:
    """How many cut points lie below v, looking first at chunks, then inside one."""

    def passed(x: Column) -> Column:
        return x <= v if or_equal else x < v

    full = F.size(F.filter("_ends", passed))
    inside = F.size(F.filter(F.get("_chunks", full), passed))
    return F.least(full * F.col("_chunk"), F.col("_cuts")) + F.when(full < F.size("_ends"), inside).otherwise(0)


def with_slice(df: DataFrame, slices: Slices, value: str, spread: Column | None = None) -> DataFrame:
    """Add `_slice`. Rows of other groups, and rows without a value, get slice 0.

    Equal values share a slice. With `spread` (a hash of the row), rows whose
    value is so frequent that several cut points fall on it are dealt out over
    all the slices between those cut points.
    """
    if slices.hot is None:
        return df.withColumn("_slice", F.lit(0))
    v = F.col(value).cast("double")
    first = _cuts_passed(v, or_equal=False)
    number = first
    if spread is not None:
        number = first + F.pmod(spread, _cuts_passed(v, or_equal=True) - first + 1).cast("int")
    plan = F.broadcast(slices.hot.drop("_rows"))
    return (
        df.join(plan, list(slices.keys), "left")
        .withColumn("_slice", F.when(F.col("_cuts").isNotNull() & v.isNotNull(), number).otherwise(0))
        .drop("_cuts", "_chunk", "_chunks", "_ends")
    )


def join_group_rows(df: DataFrame, per_group: DataFrame, slices: Slices, value: str) -> DataFrame:
    """Left join one row per group onto its members.

    The rows of hot groups are broadcast, one per LIMIT rows at most, so their members
    stay where they are.
    """
    keys = list(slices.keys)
    if slices.hot is None:
        return df.join(per_group, keys, "left")
    hot_keys = F.broadcast(slices.hot.select(*keys))
    few = F.broadcast(slices.hot.select(*keys).join(per_group, keys, "left"))
    return df.join(few, keys).unionByName(df.join(hot_keys, keys, "left_anti").join(per_group, keys, "left"))

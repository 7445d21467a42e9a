"""Exact quantiles per group, linear between neighbours, also for hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starq.operators.slicing import ACCURACY, Slices

# How far, as a share of the rows, a bracket reaches to either side of a wanted rank:
# twice what a sketch may be off.
_SLACK = 2 / ACCURACY


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float], slices: Slices
) -> DataFrame:
    """One row per group: keys, _n (values) and a column per probability.

    Groups below the slicing limit (a number of rows) go through the built-in exact
    `percentile`; its value map is bounded by that limit. Hot groups are cut at brackets
    around the wanted ranks instead (see `hot_quantiles`).
    """
    keys = list(keys)
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if slices.hot is None:
        return _builtin(data, keys, probabilities)
    hot_keys = F.broadcast(slices.hot.select(*keys))
    exact = hot_quantiles(data.join(hot_keys, keys, "left_semi"), keys, probabilities, slices)
    return exact.unionByName(_builtin(data.join(hot_keys, keys, "left_anti"), keys, probabilities))


def _builtin(rows: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    array = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probabilities.values()]))
    agg = rows.groupBy(*keys).agg(F.count("*").alias("_n"), array.alias("_q"))
    return agg.select(*keys, "_n", *[F.col("_q")[i].alias(n) for i, n in enumerate(probabilities)])


def hot_quantiles(hot: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float], slices: Slices) -> DataFrame:
    """Exact quantiles of the values `_v` of hot groups, one row per group, as plain numbers.

    A sketch gives two values around each wanted rank. One pass cuts the groups there: it
    counts what lies outside these brackets, and inside them every value, a few rows in
    ten thousand. So the cost of a row does not grow with its group, and no value is
    shuffled that no bracket holds. A group whose rank falls outside its bracket, which
    the sketch's error bound rules out, would go through the built-in `percentile`.
    """
    keys, spark = list(keys), hot.sparkSession
    names, probs = list(probabilities), [float(p) for p in probabilities.values()]
    fewest = slices.hot.agg(F.min("_rows")).first()[0]
    reach = _SLACK + 3 / fewest
    ends = [e for p in probs for e in (max(p - reach, 0.0), min(p + reach, 1.0))]
    sketch = hot.groupBy(*keys).agg(F.percentile_approx("_v", F.array(*[F.lit(e) for e in ends]), ACCURACY).alias("_ends"))
    # Kept as plain numbers, like the slice plan: every task cuts at the same points.
    found = [r for r in sketch.collect() if r["_ends"] is not None]
    brackets = F.broadcast(spark.createDataFrame(found, sketch.schema))

    v, passed, inside = F.col("_v"), F.lit(0), F.lit(False)
    for i, p in enumerate(probs):
        above = v >= F.col("_ends")[2 * i] if p - reach > 0 else F.lit(True)
        beyond = v > F.col("_ends")[2 * i + 1] if p + reach < 1 else F.lit(False)
        passed, inside = passed + above.cast("int") + beyond.cast("int"), inside | (above & ~beyond)
    cut = hot.join(brackets, keys).select(*keys, passed.alias("_passed"), F.when(inside, v).alias("_v"))
    counted = cut.groupBy(*keys, "_passed", "_v").agg(F.count("*").alias("_c"))
    group = Window.partitionBy(*keys)
    running = group.orderBy("_passed", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(*keys, "_v", "_c", (F.sum("_c").over(running) - F.col("_c")).alias("_first"), F.sum("_c").over(group).alias("_n"))

    def low_rank(p: float):
        return F.floor(F.lit(p) * (F.col("_n") - 1))

    picks = []
    for name, p in zip(names, probs):
        for side, step in (("lo", 0), ("hi", 1)):
            rank = F.least(low_rank(p) + step, F.col("_n") - 1)
            held = (F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_c"))
            picks.append(F.max(F.when(held, F.col("_v"))).alias(f"{name}_{side}"))
    picked = ranked.groupBy(*keys, "_n").agg(*picks)

    def between(name: str, p: float):
        part = F.lit(p) * (F.col("_n") - 1) - low_rank(p)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (low * (1 - part) + high * part).alias(name)

    # One row per hot group.
    exact = picked.select(*keys, "_n", *[between(n, p) for n, p in zip(names, probs)])
    rows = exact.collect()
    sure = [r for r in rows if all(r[n] is not None for n in names)]
    out = spark.createDataFrame(sure, exact.schema)
    if len(sure) < len(rows):
        missed = spark.createDataFrame([r for r in rows if r not in sure], exact.schema).select(*keys)
        out = out.unionByName(_builtin(hot.join(F.broadcast(missed), keys, "left_semi"), keys, probabilities))
    return out


def group_spread(df: DataFrame, keys: Sequence[str], value: str, slices: Slices) -> DataFrame:
    """One row per group: keys, _n, q1, median, q3 and mad (the median distance from the median), all exact.

    Groups below the slicing limit are one sorted array each, from which all four are
    read: one shuffle of the values. Hot groups are cut at brackets, first their values,
    then the distances.
    """
    keys = list(keys)
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())

    def at(array: str, p: float):
        place = F.lit(p) * (F.col("_n") - 1)
        low = F.floor(place).cast("int")
        here, after = F.get(array, low), F.get(array, F.least(low + 1, (F.col("_n") - 1).cast("int")))
        return here * (1 - (place - low)) + after * (place - low)

    def from_arrays(rows: DataFrame) -> DataFrame:
        sorted_ = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.sort_array(F.collect_list("_v")).alias("_all"))
        quartiles = sorted_.select(*keys, "_n", "_all", at("_all", 0.25).alias("q1"), at("_all", 0.5).alias("median"), at("_all", 0.75).alias("q3"))
        apart = quartiles.withColumn("_apart", F.sort_array(F.transform("_all", lambda x: F.abs(x - F.col("median")))))
        return apart.select(*keys, "_n", "q1", "median", "q3", at("_apart", 0.5).alias("mad"))

    if slices.hot is None:
        return from_arrays(data)
    hot_keys = F.broadcast(slices.hot.select(*keys))
    spread = hot_spread(data.join(hot_keys, keys, "left_semi"), keys, slices)
    return spread.unionByName(from_arrays(data.join(hot_keys, keys, "left_anti")))


def hot_spread(hot: DataFrame, keys: Sequence[str], slices: Slices) -> DataFrame:
    """The same of the values `_v` of hot groups alone."""
    stats = hot_quantiles(hot, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75}, slices)
    apart = hot.join(F.broadcast(stats), keys).select(*keys, F.abs(F.col("_v") - F.col("median")).alias("_v"))
    mads = hot_quantiles(apart, keys, {"mad": 0.5}, slices).drop("_n")
    return stats.join(F.broadcast(mads), keys)

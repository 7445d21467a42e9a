"""Skew: one group holds a large part of the rows. Results must equal brute force, and no slice may hold it all."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starq.operators.asof import Context, asof_join
from starq.operators.keys import first_per_key, number_rows, require_unique
from starq.operators.quantiles import group_quantiles
from starq.operators.slicing import join_group_rows, plan_slices, with_slice
from starq.plans.outliers import score_groups

SMALL = {"limit": 100}


def skewed(rng, n, ties):
    """A third of the rows in group 0; `ties` of them share one time stamp."""
    group = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    time = rng.integers(0, 5000, n)
    hot = np.flatnonzero(group == 0)
    time[hot[:ties]] = 2500
    return pd.DataFrame({"id": np.arange(n), "g": group, "t": time})


def expected_asof(facts, context):
    out = {}
    by_group = {g: d.sort_values(["t", "cid"]) for g, d in context.dropna(subset=["t"]).groupby("g")}
    for f in facts.itertuples():
        rows = by_group.get(f.g)
        if rows is None or pd.isna(f.t):
            out[f.id] = None
            continue
        at = np.searchsorted(rows["t"].to_numpy(), f.t, side="right")
        out[f.id] = int(rows["cid"].iloc[max(at - 1, 0)])
    return out


@pytest.mark.parametrize("ties", [0, 900])
@pytest.mark.parametrize("options", [{}, SMALL, {"limit": 20}])
def test_asof_equals_brute_force(spark, ties, options):
    rng = np.random.default_rng(ties)
    facts = skewed(rng, 3000, ties).astype({"t": "float64"})
    facts.loc[rng.random(len(facts)) < 0.05, "t"] = np.nan
    context = skewed(rng, 800, ties // 10).rename(columns={"id": "cid"})
    context = context[~context["g"].isin([7, 8])].astype({"t": "float64"})
    context.loc[context["cid"] % 50 == 3, "t"] = np.nan
    left = spark.createDataFrame(facts).selectExpr("id", "g", "nullif(t, double('nan')) as t")
    right = spark.createDataFrame(context).selectExpr("cid", "g", "nullif(t, double('nan')) as ct")
    joined = asof_join(left, ["g"], "t", [Context(right, "ct", {"cid": "cid"}, tie="cid")], **options)
    got = {r["id"]: r["cid"] for r in joined.collect()}
    assert got == expected_asof(facts, context)


@pytest.mark.parametrize("tie", [None, "cid"])
def test_asof_ties_do_not_depend_on_slicing(spark, tie):
    """Rows without a tie value, rows that tie on it, and contexts without one: the same answer, cut or not."""
    rng = np.random.default_rng(8)
    facts = spark.createDataFrame(skewed(rng, 400, 200))
    context = skewed(rng, 300, 150).rename(columns={"id": "payload", "t": "ct"}).assign(cid=lambda d: d["payload"] % 7)
    right = spark.createDataFrame(context).withColumn("cid", F.when(F.col("payload") % 3 > 0, F.col("cid")))

    def rows(**options):
        joined = asof_join(facts, ["g"], "t", [Context(right.repartition(9), "ct", {"payload": "payload"}, tie=tie)], **options)
        return {r["id"]: r["payload"] for r in joined.collect()}

    assert rows() == rows(limit=20) == rows(limit=90)
    null_ties = spark.createDataFrame([(1, "a", None, 5), (2, "a", None, 5)], "payload long, g string, cid long, ct long")
    fact = spark.createDataFrame([(1, "a", 9)] * 30, "id long, g string, t long")
    for options in ({}, {"limit": 10}):
        joined = asof_join(fact, ["g"], "t", [Context(null_ties, "ct", {"payload": "payload"}, tie="cid")], **options)
        assert {r["payload"] for r in joined.collect()} == {2}


def test_asof_joins_several_contexts_and_keeps_rows(spark):
    rng = np.random.default_rng(5)
    facts = skewed(rng, 1000, 0)
    one, two = (skewed(rng, 300, 0).rename(columns={"id": "cid"}) for _ in range(2))
    contexts = [Context(spark.createDataFrame(c).withColumnRenamed("t", "ct"), "ct", {"cid": n}, tie="cid") for c, n in ((one, "a"), (two, "b"))]
    joined = asof_join(spark.createDataFrame(facts), ["g"], "t", contexts, **SMALL)
    rows = joined.collect()
    assert {r["id"]: r["a"] for r in rows} == expected_asof(facts, one)
    assert {r["id"]: r["b"] for r in rows} == expected_asof(facts, two)
    assert len(rows) == len(facts)


def test_asof_with_null_group_matches_nothing(spark):
    facts = spark.createDataFrame([(1, None, 5), (2, "a", 5)], "id long, g string, t long")
    context = spark.createDataFrame([(1, None, 1), (2, "a", 9)], "cid long, g string, ct long")
    rows = asof_join(facts, ["g"], "t", [Context(context, "ct", {"cid": "cid"})]).collect()
    assert {r["id"]: r["cid"] for r in rows} == {1: None, 2: 2}


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    data = skewed(rng, 4000, 700).assign(v=lambda d: np.round(rng.normal(size=len(d)), 2))
    df = spark.createDataFrame(data)
    probabilities = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "p9": 0.9, "lo": 0.0, "hi": 1.0}
    for column in ("v", "t"):
        slices = plan_slices(df, ["g"], column, **SMALL)
        assert slices.hot is not None
        for r in group_quantiles(df, ["g"], column, probabilities, slices).collect():
            values = data.loc[data["g"] == r["g"], column]
            assert r["_n"] == len(values)
            for name, p in probabilities.items():
                assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_hot_group_is_cut_into_bounded_slices(spark):
    df = spark.createDataFrame(skewed(np.random.default_rng(2), 6000, 0))
    slices = plan_slices(df, ["g"], "t", limit=200)
    sizes = with_slice(df, slices, "t").groupBy("g", "_slice").count().collect()
    assert sum(r["count"] for r in sizes) == 6000
    assert max(r["count"] for r in sizes) <= 500
    spread = with_slice(df.withColumn("t", F.lit(7)), plan_slices(df.withColumn("t", F.lit(7)), ["g"], "t", limit=200), "t", F.xxhash64("id"))
    assert max(r["count"] for r in spread.groupBy("g", "_slice").count().collect()) <= 700


def test_cold_data_is_not_cut(spark):
    df = spark.createDataFrame(skewed(np.random.default_rng(3), 500, 0))
    assert plan_slices(df, ["g"], "t").hot is None


def test_group_rows_reach_every_member(spark):
    data = skewed(np.random.default_rng(4), 2000, 100)
    df = spark.createDataFrame(data)
    per_group = df.groupBy("g").agg(F.count("*").alias("n"))
    joined = join_group_rows(df, per_group, plan_slices(df, ["g"], "t", **SMALL), "t").collect()
    counts = data.groupby("g").size()
    assert len(joined) == 2000 and all(r["n"] == counts[r["g"]] for r in joined)


def test_outlier_scores_do_not_depend_on_slicing(spark):
    rng = np.random.default_rng(6)
    data = skewed(rng, 3000, 0).assign(value=lambda d: np.round(rng.standard_t(2, len(d)), 3))
    df = spark.createDataFrame(data)
    names = ["id", "tested", "iqr_flag", "modified_z_flag", "consensus_score", "iqr_lower_bound", "modified_z_score"]

    def rows(**options):
        out = {r["id"]: tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in score_groups(df, ["g"], **options).select(names).collect()}
        assert len(out) == 3000
        return out

    assert rows() == rows(**SMALL)


def test_scores_of_hot_groups_read_their_input_twice(spark):
    """Once to find the hot groups, once for all that follows, however many slices a group would have."""
    n, seen = 3000, spark.sparkContext.accumulator(0)

    def observed(x):
        seen.add(1)
        return x

    data = skewed(np.random.default_rng(11), n, 0).assign(value=lambda d: d["t"] / 7)
    df = spark.createDataFrame(data).withColumn("value", F.udf(observed, "double").asNondeterministic()("value"))
    assert score_groups(df, ["g"], limit=2).count() == n
    assert n <= seen.value <= 2 * n


def test_quantiles_beside_lumps_and_of_missing_ranks(spark):
    """Most rows on two values, wanted ranks beside them, on them and at the ends; groups without keys."""
    values = [1.0] * 400 + [2.0] * 401 + [float(x) for x in range(3, 103)] + [-5.0, 1e300]
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in values] + [("b", None)] * 300, "g string, v double")
    probabilities = {f"p{i}": i / 20 for i in range(21)}
    slices = plan_slices(df, ["g"], "v", **SMALL)
    got = {r["g"]: r for r in group_quantiles(df, ["g"], "v", probabilities, slices).collect()}
    assert set(got) == {"a", None}
    for row in got.values():
        assert row["_n"] == len(values)
        assert [row[n] for n in probabilities] == pytest.approx([np.quantile(values, p) for p in probabilities.values()])


@pytest.mark.parametrize("limit", [10, 500, 10_000])
def test_numbers_are_consecutive_in_order(spark, limit):
    ids = np.random.default_rng(7).permutation(3000) * 7
    df = spark.createDataFrame(pd.DataFrame({"k": ids}))
    rows = number_rows(df, "k", "n", start=5, limit=limit).collect()
    assert [r["n"] for r in sorted(rows, key=lambda r: r["k"])] == list(range(5, 3005))


def test_first_per_key_and_unique_guard(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 9, "c"), (None, 1, "d")], "k int, o int, v string")
    assert {(r["k"], r["v"]) for r in first_per_key(df, ["k"], ["o"]).collect()} == {(1, "a"), (2, "c"), (None, "d")}
    assert require_unique(df.where("o > 1"), ["k"], "x").count() == 2
    with pytest.raises(Exception, match="occurs 2 times"):
        require_unique(df, ["k"], "x").collect()

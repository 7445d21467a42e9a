"""Junk keys as ranks in a bitmap, against sorting the distinct rows."""

import random

import pytest

from starq.operators.domains import junk_keys
from starq.operators.keys import number_set
from starq.plans import warehouse

ATTRIBUTES = ("kind", "level", "wet", "old")


def rows(seed, n, kinds):
    rng = random.Random(seed)
    return [
        (f"K{rng.randrange(kinds)}ß", rng.choice(["Low", "High", "Unknown", "", "漢"]), rng.random() < 0.5, rng.random() < 0.1)
        for _ in range(n)
    ]


@pytest.mark.parametrize("n,kinds", [(1, 1), (40, 3), (700, 23), (3000, 64)])
def test_equals_the_sorted_set(spark, n, kinds):
    data = rows(n, n, kinds)
    df = spark.createDataFrame(data, "kind string, level string, wet boolean, old boolean").repartition(3)
    junk = junk_keys(df, {"d": ("key", ATTRIBUTES)})["d"]
    want = {row: i for i, row in enumerate(sorted(set(data)), 1)}
    assert {tuple(r)[1:]: r.key for r in junk.dimension(spark).collect()} == want
    assert {tuple(r) for r in junk.dimension(spark).collect()} == {
        tuple(r) for r in number_set(df.distinct(), ATTRIBUTES, "key").collect()
    }
    got = df.select(junk.key().alias("key"), *ATTRIBUTES).collect()
    assert len(got) == n and all(r.key == want[tuple(r)[1:]] for r in got)


def test_full_words_and_their_borders(spark):
    """All 256 places occur: every bit of four words, the sign bits too."""
    data = [(f"{a:02}", f"{b:02}") for a in range(16) for b in range(16)]
    df = spark.createDataFrame(data, "a string, b string")
    junk = junk_keys(df, {"d": ("key", ("a", "b"))})["d"]
    assert junk.words == (-1,) * 4
    assert sorted(tuple(r) for r in df.select(junk.key(), "a", "b").collect()) == [(i, *row) for i, row in enumerate(data, 1)]


def test_values_that_did_not_occur_have_no_key(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "a string, b string")
    junk = junk_keys(df, {"d": ("key", ("a", "b"))})["d"]
    others = spark.createDataFrame([("a", "y"), ("c", "x"), (None, "x"), ("b", "y")], "a string, b string")
    assert [r[0] for r in others.select(junk.key()).collect()] == [None, None, None, 2]


def test_large_domains_are_left_to_the_set(spark):
    df = spark.createDataFrame([(f"v{i}", "x", i) for i in range(70)], "wide string, narrow string, number int")
    dimensions = {"open": ("k", ("wide", "narrow")), "small": ("k", ("narrow",)), "typed": ("k", ("number",)), "absent": ("k", ("other",))}
    assert set(junk_keys(df, dimensions)) == {"small"}
    assert set(junk_keys(df, dimensions, most_values=70)) == {"small", "open"}
    assert set(junk_keys(df, dimensions, most_values=70, most_places=69)) == {"small"}
    assert junk_keys(df.limit(0), dimensions) == {}


def test_fact_has_the_same_keys_with_and_without_joins(spark):
    names = warehouse.CONTEXT_DIMENSIONS["dim_tyre_context"][1]
    flags = warehouse.LAP_FLAGS
    rng = random.Random(3)
    data = [
        (i, *[rng.choice(["A", "B", "Unknown"]) for _ in names], rng.random() < 0.5, *[rng.choice(["Low", "High"]) for _ in range(3)],
         *[rng.random() < 0.3 for _ in flags]) for i in range(400)
    ]
    weather = ("rain_flag", "air_temp_class", "track_temp_class", "wind_speed_class")
    types = ["lap_performance_key long", *[f"{n} string" for n in names], "rain_flag boolean", *[f"{n} string" for n in weather[1:]], *[f"{n} boolean" for n in flags]]
    work = spark.createDataFrame(data, ", ".join(types))
    keys = warehouse.context_keys(work, warehouse.LAP_CONTEXT)
    assert set(keys) == set(warehouse.LAP_CONTEXT)
    joined, dimensions = warehouse.lap_fact(work, warehouse.context_dimensions(work, warehouse.LAP_CONTEXT)), warehouse.context_dimensions(work, warehouse.LAP_CONTEXT, keys)
    direct = warehouse.lap_fact(work, dimensions, keys)
    assert sorted(joined.collect()) == sorted(direct.collect())
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in direct._jdf.queryExecution().optimizedPlan().toString()


def test_costly_attributes_are_evaluated_once(spark):
    """Nothing repeats what stands behind an attribute, however many words the bitmap has."""
    df = spark.createDataFrame(rows(5, 500, 40), "kind string, level string, wet boolean, old boolean")
    junk = junk_keys(df, {"d": ("key", ATTRIBUTES)})["d"]
    assert len(junk.words) > 4
    for expression in (str(junk.domain.place()), str(junk.key())):
        assert [expression.count(a) for a in ATTRIBUTES] == [1] * len(ATTRIBUTES)

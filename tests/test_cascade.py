"""The referential cascade against a plain loop to the fixpoint."""

import random

import pytest
from pyspark.sql import functions as F

from starq.plans import cleaning

ORDER = ("a", "b", "c")
GRAPHS = {
    "self": {"a": (("x", "a", "id"),)},
    "cycle": {"a": (("x", "b", "id"),), "b": (("x", "c", "id"), ("y", "b", "id")), "c": (("x", "a", "id"),)},
    "backward": {"a": (("x", "c", "id"), ("y", "a", "id")), "b": (("x", "a", "id"),)},
}


def plain(tables, dropped, references):
    dropped = {t: set(d) for t, d in dropped.items()}
    changed = True
    while changed:
        changed = False
        for table, edges in references.items():
            for column, parent, _ in edges:
                there = {r["id"] for i, r in enumerate(tables[parent]) if i not in dropped[parent]}
                broken = {i for i, r in enumerate(tables[table]) if r[column] is not None and r[column] not in there}
                changed |= bool(broken - dropped[table])
                dropped[table] |= broken
    return dropped


def resolved(spark, tables, dropped):
    out = {}
    for t, rows in tables.items():
        data = [(i, r["id"], r["x"], r["y"], t, 0 if i in dropped[t] else None) for i, r in enumerate(rows)]
        out[t] = cleaning.Resolved(spark.createDataFrame(data, "row int, id long, x long, y long, _rid string, _drop int"), ({"reason": "planted"},))
    return out


def lost(cascaded):
    return {t: {r["row"] for r in out.frame.where("_drop is not null").select("row").collect()} for t, out in cascaded.items()}


def test_the_case_of_a_chain_in_one_table(spark):
    """4 refers to 9, which is not there, and 5 to 4: both go; 7 and 8 hold one another."""
    rows = [{"id": i, "x": x, "y": None} for i, x in ((1, None), (4, 9), (5, 4), (6, 1), (7, 8), (8, 7))]
    got = cleaning.cascade(resolved(spark, {"a": rows}, {"a": set()}), GRAPHS["self"], ("a",))
    assert lost(got) == {"a": {1, 2}}
    reasons = {n["check_id"] for n in got["a"].notes if "check_id" in n}
    assert reasons == {"post_cleaning_fk_a_x_to_a_id"}


@pytest.mark.parametrize("graph", list(GRAPHS))
@pytest.mark.parametrize("seed", range(2))
def test_fixpoint_equals_a_plain_loop(spark, graph, seed):
    rng = random.Random(seed)
    references = GRAPHS[graph]
    # Repeated keys: one is lost with its last row only. Null keys and references.
    tables = {
        t: [
            {"id": rng.choice([i, i, i, i // 2, None]), "x": rng.choice([None, rng.randrange(30), rng.randrange(30)]), "y": rng.choice([None, None, rng.randrange(32)])}
            for i in range(30)
        ]
        for t in ORDER
    }
    dropped = {t: {i for i in range(30) if rng.random() < 0.05} for t in ORDER}
    got = cleaning.cascade(resolved(spark, tables, dropped), references, ORDER)
    assert lost(got) == plain(tables, dropped, {t: references.get(t, ()) for t in ORDER})
    # Planted drops keep their reason.
    for t in ORDER:
        kept = {r["row"] for r in got[t].frame.where(F.col("_drop") == 0).select("row").collect()}
        assert kept == dropped[t]


def test_long_chains_and_empty_tables(spark):
    rows = [{"id": i, "x": i - 1 if i else 99, "y": None} for i in range(12)]
    assert lost(cleaning.cascade(resolved(spark, {"a": rows}, {"a": set()}), GRAPHS["self"], ("a",))) == {"a": set(range(12))}
    empty = resolved(spark, {"a": [], "b": [], "c": []}, {"a": (), "b": (), "c": ()})
    assert lost(cleaning.cascade(empty, GRAPHS["cycle"], ORDER)) == {"a": set(), "b": set(), "c": set()}

"""Quality ranking, rule anomalies and their counts."""

import collections
import os
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starq.llm import anomaly, quality, queries, stats
from starq.llm.common import plain_documents

from .conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")
has_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def base(text):
    found = WORD.findall(text or "")
    windows = list(zip(found, found[1:], found[2:]))
    often = collections.Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(found), sum(map(len, found)), symbols, dup, len(again)


def test_base_counts(odd):
    got = odd.select("doc_id", "text").join(stats.document_counts(plain_documents(odd.where("doc_id IS NOT NULL"))).distinct(), "doc_id").collect()
    assert len(got) == 17
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text), r.doc_id


def test_anomalies_on_odd_rows(odd, none, labels):
    rows = anomaly.verdicts(odd, labels).collect()
    assert len(rows) == odd.count()
    failed = {r.doc_id for r in rows if r.base_failed}
    assert {4, 5, 6, 7, 11, 12, 16} <= failed and 1 not in failed
    assert not any(r.kept for r in rows if r.base_failed)
    assert anomaly.verdicts(none, labels).count() == 0
    plain = anomaly.verdicts(odd, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed and r.path is None for r in plain)


def test_forest_isolates_the_odd_one():
    rng = np.random.default_rng(1)
    usual = rng.normal(0.5, 0.05, (2000, 12))
    strange = np.full((1, 12), 0.9)
    forest = anomaly.grow(usual)
    assert forest.mean_path(strange)[0] < np.quantile(forest.mean_path(usual), 0.001)


def test_ranking_on_odd_rows(odd, none, labels):
    rows = quality.score(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert quality.score(none, labels).count() == 0
    assert {r.score for r in quality.score(odd, labels.limit(0)).collect()} == {quality.CUT}


def test_held_out_labels_change_nothing(session, odd, labels):
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda x: sorted((r.doc_id or -1, r.score) for r in quality.score(odd, x).collect())
    assert score(labels) == score(flipped)


def test_repeated_and_null_ids(session, odd, labels):
    """Every row has its score, whatever its doc_id; a label of a repeated doc_id weighs as often as it has rows."""
    more = odd.where("doc_id IN (1, 9)")
    rows = quality.score(odd.union(more), labels).collect()
    assert len(rows) == odd.count() + more.count()
    assert all(r.held_out is False for r in rows if r.doc_id is None) and all(r.score is not None for r in rows)
    counts = stats.document_counts(plain_documents(odd.union(odd)))
    sizes = []
    watched = quality.best_cut
    quality.best_cut = lambda strengths: sizes.append(strengths.count()) or watched(strengths)
    try:
        quality.fit(counts, labels)
    finally:
        quality.best_cut = watched
    labelled = {r.doc_id for r in labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert sizes == [2 * sum(r.doc_id in labelled for r in odd.collect())]


def test_weights_are_the_minimum_of_the_loss():
    """The gradient of the logistic loss, summed pair by pair in a loop, vanishes at the fitted weights."""
    rng = np.random.default_rng(8)
    x, label = rng.random((90, 4)), np.arange(90) % 3 == 0
    x[:, 2] += 0.3 * label
    fitted = quality.fit_pairs(x, label.astype(int), seed=17)
    z = (x - fitted.center) / fitted.scale
    drawn, n = np.random.default_rng(17), quality.PARTNERS * 60
    good, poor = (drawn.permutation(np.resize(np.flatnonzero(label == v), n)) for v in (1, 0))
    gradient = [quality.RIDGE * w for w in fitted.weights]
    for g, p in zip(good, poor):
        ahead = sum(w * (a - b) for w, a, b in zip(fitted.weights, z[g], z[p]))
        for k in range(4):
            gradient[k] -= (z[g][k] - z[p][k]) / (1 + np.exp(ahead)) / n
    assert max(map(abs, gradient)) < 1e-6


def test_cut_is_the_best_of_all(session):
    rng = np.random.default_rng(3)
    for shift in (0.2, 1.5):
        label = (rng.random(80) < 0.4).astype(int)
        strength = rng.normal(0, 1, 80) + shift * label
        cut = quality.best_cut(session.createDataFrame(pd.DataFrame({"strength": strength, "quality": label})))
        gain = lambda c: (strength[label == 0] < c).mean() - (strength[label == 1] < c).mean()
        assert gain(cut) == pytest.approx(max(gain(c) for c in strength))


def test_paths_equal_a_walk_by_hand():
    rng = np.random.default_rng(11)
    x = rng.random((400, 5))
    forest = anomaly.grow(x, trees=7)

    def walk(tree, node, row):
        k = int(forest.feature[tree, node])
        if k < 0:
            return forest.path[tree, node]
        return walk(tree, 2 * node + 1 + (row[k] >= forest.split[tree, node]), row)

    rows = np.concatenate([x[:50], rng.random((50, 5)) * 3 - 1])
    want = [sum(walk(t, 0, row) for t in range(7)) / 7 for row in rows]
    assert forest.mean_path(rows) == pytest.approx(want, abs=1e-12)


def test_threshold_is_the_best_allowed(session):
    rng = np.random.default_rng(12)
    label = (rng.random(3000) < 0.8).astype(int)
    path = np.clip(rng.normal(5 + 2 * label, 0.8), 0.1, 9.9)
    found = anomaly.calibrate(session.createDataFrame(pd.DataFrame({"path": path, "quality": label})), 10.0)
    lost = lambda c, v: (path[label == v] < c).mean()
    allowed = [c for c in np.arange(1, anomaly.BINS + 1) * 10.0 / anomaly.BINS if lost(c, 1) <= anomaly.MAX_GOOD_LOSS]
    assert lost(found, 1) <= anomaly.MAX_GOOD_LOSS
    assert lost(found, 0) - lost(found, 1) == pytest.approx(max(lost(c, 0) - lost(c, 1) for c in allowed))


def test_pairs_rank_what_they_prefer():
    rng = np.random.default_rng(2)
    x, label = rng.random((600, 3)), np.arange(600) % 2
    x[:, 1] += label
    weights = quality.fit_pairs(x, label).weights
    assert weights[1] > 5 * abs(weights[0]) and quality.fit_pairs(x, np.ones(600)) is None


@pytest.mark.parametrize("poor", [0.002, 0.2, 0.5, 0.7, 0.9, 0.998])
def test_cut_for_any_share_of_poor_rows(session, poor):
    """Well separated labels: the cut parts them, whichever is the rarer."""
    rng = np.random.default_rng(6)
    quality_ = (rng.random(20_000) >= poor).astype(int)
    strength = rng.normal(0, 1, 20_000) + 8 * quality_
    rows = session.createDataFrame(pd.DataFrame({"strength": strength, "quality": quality_}))
    kept = strength >= quality.best_cut(rows)
    assert kept[quality_ == 0].mean() < 0.01 and kept[quality_ == 1].mean() > 0.99


@has_tables
def test_held_out_accuracy(session):
    sf_dir = os.path.join(os.path.dirname(SF_DIR), "sf0.01")
    truth = session.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.op1(session, sf_dir).join(truth, "doc_id").where("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.97
    kept = queries.op4(session, sf_dir).where("NOT base_failed").join(truth, "doc_id").toPandas()
    assert kept[kept.quality == 1].kept.mean() > 0.97 and kept[kept.quality == 0].kept.mean() < 0.2

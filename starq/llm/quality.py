"""Quality classifier: Bradley-Terry ranking of documents.

A document's strength is linear in its RATIOS; a labelled-good document is
preferred to a labelled-poor one with the probability sigmoid(strength difference).
The weights minimise the logistic loss on feature differences of preference
pairs. The cut is a quantile of the strengths of all training rows of either label,
over their whole range, so it does not matter how many rows are poor.

Defined results: null, empty or blank texts have zero counts and are scored like
any other; equal texts score the same; a table without both labels among its
training rows gives every document the neutral score CUT and keeps it; a null doc_id
is scored, is not held out and has no label; every row of a repeated doc_id is scored
and, where labelled, is one row of the fit and the cut; an empty table gives no rows;
columns other than doc_id and text never reach the model. One text is held whole in a
task, at some 46 bytes of memory a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starq.llm import stats
from starq.llm.common import Scratch, bounded_sample, forget, plain_documents

#: Scores from here on predict label 1.
CUT = 0.7
#: Bound of the rows the weights are fitted on (chosen by a hash of doc_id, about as many).
FIT_ROWS = 20_000
#: Preference pairs drawn for each row of the larger label.
PARTNERS = 4
RIDGE = 1e-3
#: Quantiles of each label's training strengths that are tried as the cut, from the least strength on.
QUANTILES = tuple(q / 400 for q in range(400))
SCHEMA = "doc_id long, strength double"


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    cut: float = 0.0

    def strength(self, counts: dict[str, np.ndarray]) -> np.ndarray:
        return ((stats.ratios(counts) - self.center) / self.scale) @ self.weights


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit_pairs(x: np.ndarray, label: np.ndarray, seed: int = 17) -> Ranking | None:
    """Newton steps on the logistic loss of feature differences over drawn pairs."""
    good, poor = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(poor):
        return None
    center, scale = x.mean(0), np.maximum(x.std(0), 0.02)
    z = (x - center) / scale
    rng = np.random.default_rng(seed)
    n = PARTNERS * max(len(good), len(poor))
    each = lambda side: rng.permutation(np.resize(side, n))
    difference = z[each(good)] - z[each(poor)]
    weights = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(difference @ weights, -30, 30)))
        gradient = difference.T @ (p - 1) / n + RIDGE * weights
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / n + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights -= step * min(1.0, 2.0 / np.abs(step).max()) if np.abs(step).max() > 0 else 0
        if np.abs(step).max() < 1e-7:
            break
    return Ranking(weights, center, scale)


def _scorer(ranking: Ranking, keep: str):
    """Batches of one column of the input and the strength."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            counts = {c: batch.column(c).to_numpy() for c in stats.COUNTS}
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(ranking.strength(counts))], [keep, "strength"])

    return run


def best_cut(strengths: DataFrame) -> float | None:
    """The quantile of either label's training strengths with the best balanced accuracy.

    strengths(strength, quality). Sketch quantiles, then one count per quantile:
    what returns to the driver is bounded by QUANTILES.
    """
    found = strengths.groupBy("quality").agg(F.percentile_approx("strength", list(QUANTILES), 100_000).alias("cuts")).collect()
    if not found:
        return None
    cuts = sorted({c for r in found for c in r["cuts"]})
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("strength")))
    tally = np.zeros((2, len(cuts) + 1))
    for place, quality, n in strengths.groupBy(below.alias("place"), "quality").count().collect():
        tally[quality, place] = n
    # Column i: the share of rows below cut i.
    poor, good = (np.cumsum(t)[:-1] / max(t.sum(), 1) for t in tally)
    cut = cuts[int(np.argmax(poor - good))]
    under = strengths.where(F.col("strength") < cut).agg(F.max("strength")).first()[0]
    return cut if under is None else (cut + under) / 2


def fit(counts: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ranking | None:
    """Learns from labelled rows that are not held out. counts: document_counts, staged."""
    train = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).join(counts, "doc_id")
    )
    sample = bounded_sample(train, "doc_id", fit_rows)
    ranking = fit_pairs(stats.ratios({c: sample[c].to_numpy() for c in stats.COUNTS}), sample["quality"].to_numpy()) if len(sample) else None
    if ranking is None:
        return None
    strengths = train.select("quality", *stats.COUNTS).mapInArrow(_scorer(ranking, "quality"), "quality int, strength double")
    cut = best_cut(strengths)
    return Ranking(ranking.weights, ranking.center, ranking.scale, cut)


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score in [0, 1], predicted (1: score >= CUT) for every document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    counts = scratch.write(stats.document_counts(plain_documents(docs)), "counts")
    ranking = fit(counts, labels.select("doc_id", "quality"), fit_rows)
    if ranking is None:
        scored = counts.select("doc_id", F.lit(CUT).alias("score"))
    else:
        # The cut maps to CUT; the strengths' order is the scores' order.
        odds = F.col("strength") - F.lit(ranking.cut) + F.lit(float(np.log(CUT / (1 - CUT))) + 1e-9)
        scored = counts.mapInArrow(_scorer(ranking, "doc_id"), SCHEMA).select("doc_id", (1 / (1 + F.exp(-odds))).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

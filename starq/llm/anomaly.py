"""Quality rules with an isolation forest on rule statistics.

Documents that break a base rule go. Of the others, those that random splits of
the RATIOS isolate early (short mean path) are anomalous; how short is too short is
calibrated from labelled rows.

Defined results: null, empty or blank texts have zero counts and break the rule on
short texts; equal texts get the same verdict; without labelled rows, or with one
label only, no threshold can be calibrated and the base rules decide alone; a null
doc_id gets a verdict and has no label; every row of a repeated doc_id gets its own;
an empty table gives no rows; columns other than doc_id and text never matter. One
text is held whole in a task, at some 46 bytes of memory a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starq.llm import stats
from starq.llm.common import Scratch, bounded_sample, plain_documents

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TREES = 200
#: Rows a tree is grown from, and the depth that follows from it.
TREE_ROWS = 256
DEPTH = 8
#: Bound of the labelled-good rows that the trees draw from (chosen by a hash of doc_id, about as many).
FIT_ROWS = 10_000
#: Labelled-good rows that the calibrated threshold may give up, at most.
MAX_GOOD_LOSS = 0.002
BINS = 4000


@dataclass(frozen=True)
class Forest:
    """Trees as heaps: the children of node i are 2i + 1 and 2i + 2; path is set at leaves."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray

    def mean_path(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = feature[node] >= 0
                right = x[rows, np.maximum(feature[node], 0)] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return total / len(self.path)


def _tail(n: int) -> float:
    """Mean path of an unsuccessful search among n rows: what an unsplit leaf still holds."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, seed: int = 5) -> Forest:
    rng = np.random.default_rng(seed)
    nodes = 2 ** (DEPTH + 1) - 1
    feature, split, path = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        rows = x[rng.choice(len(x), min(TREE_ROWS, len(x)), replace=False)]
        open_nodes = [(0, 0, rows)]
        while open_nodes:
            node, depth, held = open_nodes.pop()
            low, high = held.min(0), held.max(0)
            # A random split may fall outside the rows seen, so that values beyond them come off early too.
            margin = 0.1 * (high - low) + 0.02
            if depth == DEPTH or len(held) < 2:
                path[t, node] = depth + _tail(len(held))
                continue
            k = rng.integers(x.shape[1])
            cut = rng.uniform(low[k] - margin[k], high[k] + margin[k])
            feature[t, node], split[t, node] = k, cut
            right = held[:, k] >= cut
            for child, part in ((2 * node + 1, held[~right]), (2 * node + 2, held[right])):
                if len(part):
                    open_nodes.append((child, depth + 1, part))
                else:
                    path[t, child] = depth + 1
    return Forest(feature, split, path)


def _paths(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = stats.ratios({c: batch.column(c).to_numpy() for c in stats.COUNTS})
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.mean_path(x))], [*names, "path"])

    return run


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def calibrate(paths: DataFrame, longest: float) -> float | None:
    """The path below which rows are anomalous: separates the labels best, at most MAX_GOOD_LOSS of good rows lost.

    paths(path, quality) is counted in BINS equal bins, which bounds what the driver gets.
    """
    place = F.least(F.floor(F.col("path") / longest * BINS), F.lit(BINS - 1)).cast("int")
    tally = np.zeros((2, BINS))
    for b, quality, n in paths.groupBy(place.alias("place"), "quality").count().collect():
        tally[quality, b] = n
    if not tally.sum(1).all():
        return None
    poor, good = (np.cumsum(t) / t.sum() for t in tally)
    gain = np.where(good <= MAX_GOOD_LOSS, poor - good, -1)
    best = np.flatnonzero(gain == gain.max())
    # Of equally good bins, the middle of the gap; no gain at all: no row is anomalous.
    return float((best[len(best) // 2] + 1) * longest / BINS) if gain.max() > 0 else 0.0


def verdicts(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The base counts, base_failed, path (mean over trees) and kept of every document."""
    scratch = Scratch(docs.sparkSession, "anomaly")
    counts = scratch.write(stats.document_counts(plain_documents(docs)).withColumn("base_failed", base_failed()), "counts")
    labelled = (
        labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .join(counts.where(~F.col("base_failed")), "doc_id")
    )
    good = bounded_sample(labelled.where(F.col("quality") == 1), "doc_id", fit_rows)
    if not len(good):
        return counts.select("*", F.lit(None).cast("double").alias("path"), (~F.col("base_failed")).alias("kept"))
    forest = grow(stats.ratios({c: good[c].to_numpy() for c in stats.COUNTS}))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in stats.COUNTS) + ", {}path double"
    known = labelled.select("doc_id", *stats.COUNTS, "quality").mapInArrow(_paths(forest), schema.format("quality int, "))
    threshold = calibrate(known, float(forest.path.max()) + 1e-9)
    scored = counts.mapInArrow(_paths(forest), schema.format("base_failed boolean, "))
    normal = F.lit(True) if threshold is None else F.col("path") >= threshold
    return scored.withColumn("kept", ~F.col("base_failed") & normal)

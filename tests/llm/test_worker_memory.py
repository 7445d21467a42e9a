"""A worker that Spark hands to another operator holds nothing of the one before."""

import weakref

import numpy as np
import pyarrow as pa
import public_tokenizers as tokenizers
import pytest

from starq.llm import bpe, common, decontaminate, jaccard, quality, stats

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["one two three four five six seven", "a text of seven words and more"]


def batch(**columns):
    return iter([pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64())} | columns)])


def texts():
    return batch(text=TEXTS)


def counted():
    return next(stats._count_batches(texts()))


def no_rarity():
    return jaccard.Rarity(np.zeros(1 << jaccard.SKETCH_BITS, np.uint8), np.zeros(1 << jaccard.WORD_BITS, np.int16), 14)


TASKS = {
    "counts": lambda: stats._count_batches(texts()),
    "scores": lambda: quality._scorer(quality.Ranking(np.ones(len(stats.RATIOS)), 0.0, 1.0), "doc_id")(iter([counted()])),
    "sets": lambda: jaccard._sets(texts()),
    "postings": lambda: jaccard._postings(no_rarity())(texts()),
    "sketches": lambda: jaccard._add_blocks(iter([])),
    "ranks": lambda: jaccard._ranked(0.0, 0)(iter([])),
    "pairs": lambda: jaccard._verify(batch(a=[1, 2], b=[3, 4], text_a=TEXTS, text_b=TEXTS)),
    "quotations": lambda: decontaminate._search(decontaminate.Pieces([(1, TEXTS[0])]))(texts()),
}


def encoded():
    return list(bpe._encode(RANKS, tokenizers.PATTERN, False)(texts()))


@pytest.mark.parametrize("task", TASKS)
def test_other_tasks_free_the_encoder(task):
    first = encoded()
    held = weakref.ref(bpe.encoder(RANKS, tokenizers.PATTERN))
    assert encoded() == first and held() is bpe.encoder(RANKS, tokenizers.PATTERN)  # kept from task to task
    list(TASKS[task]())
    assert held() is None
    assert encoded() == first


def test_one_vocabulary_at_a_time():
    held = weakref.ref(bpe.encoder(RANKS, tokenizers.PATTERN))
    other = bpe.encoder(RANKS, r"\s+|\S+")
    assert held() is None and other is bpe.encoder(RANKS, r"\s+|\S+")


def test_tables_of_numbers_have_few_files(spark, monkeypatch):
    """Each file costs an executor's process on local stores, so their number follows the documents, not the partitions."""
    files = {}

    def write(self, df, name, *most, plain=common.Scratch.write):
        table = plain(self, df, name, *most)
        files[name] = len(table.inputFiles())
        return table

    monkeypatch.setattr(common.Scratch, "write", write)
    monkeypatch.setattr(jaccard, "FILES_PER_CORE", 1)
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 97 : i % 97 + 60])) for i in range(600)], "doc_id long, text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        prepare = common.prepare(spark)
        monkeypatch.setattr(common, "prepare", lambda spark: spark)
        prepare.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        prepare.conf.set("spark.sql.shuffle.partitions", "40")
        found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(found.values()) == {0}
    most = spark.sparkContext.defaultParallelism
    tables = [n for n in files if n.startswith(("classes", "postings", "lists", "counts", "long", "mains", "pairs", "wanted", "comp"))]
    assert "comp-last-1" in tables and "postings" in tables
    assert all(files[n] <= most for n in tables), files

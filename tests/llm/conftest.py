import os
import random

import pytest

from starq.llm.common import prepare

SF_DIR = os.environ.get("STARQ_TEST_DIR", "/root/testdata/sf0.001")
#: Every column of it clashes with a name some operator uses inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, n long, doc long, token long, row long, found string, path string"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Nulls, empty and long texts, ties, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(7)
    base, passage = words(rng, 120), words(rng, 60)
    near = base.copy()
    near[50] = "changed"
    texts = {
        1: " ".join(base), 2: " ".join(near), 3: " ".join(base).upper(), 4: None, 5: "", 6: " \n\t ", 7: "one two three",
        8: "one two three", 9: " ".join(words(rng, 80) + passage + words(rng, 30)), 10: " ".join(passage + words(rng, 200)),
        11: " ".join(["again"] * 90), 12: " ".join(["ab", "cd", "ef", "gh", "ij"] * 8), 13: " ".join(words(rng, 60_000, 50_000)),
        14: "x" * 300_000, 15: "Zeile\nZeile\nüber ß 漢字 😀 \x1c\x85 don't <|endoftext|> \\ <|im_end|>", 16: "\n".join([" ".join(words(rng, 9))] * 12),
    }
    rows = [(i, t, "en", "a" if i % 3 else "b", None if t is None else len(t), 1, 2, 3, 4, "f", "p") for i, t in texts.items()]
    rows += [rows[8], (None, " ".join(base), None, None, 1, 1, 2, 3, 4, "f", "p"), (None, None, None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd(session):
    return session.createDataFrame(odd_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def none(session):
    return session.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(session):
    return session.createDataFrame([(1, 1, 0), (11, 0, 0), (9, 1, 0), (16, 0, 0), (10, 1, 1), (12, 0, 0), (None, 1, 0), (13, None, 0)], "doc_id long, quality int, toxic int")

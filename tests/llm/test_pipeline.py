"""The pipeline's stages: what goes, what stays, and in which shape."""

import os

import pytest

import corpus_pipeline
from starq.llm import queries
from starq.llm.common import read

from .conftest import SF_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages(session):
    docs = read(session, SF_DIR, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(session, docs, SF_DIR)
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "tokens":
            assert kept[name] == kept["pii"] and out.columns[0] == "doc_id"
        else:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
    every = kept["pii"]
    assert len(every) == docs.count()
    assert kept["quality"] == {r.doc_id for r in queries.op1(session, SF_DIR).collect() if r.predicted == 1}
    assert kept["near_duplicates"] == {r.doc_id for r in queries.op10(session, SF_DIR).collect() if r.component_id == r.doc_id}
    assert kept["decontamination"] == every - {r.doc_id for r in queries.op3(session, SF_DIR).collect()}
    assert corpus_pipeline.run(session, SF_DIR).count() <= min(map(len, kept.values()))


def test_odd_rows(session, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(session, docs, SF_DIR).count() <= docs.count(), name

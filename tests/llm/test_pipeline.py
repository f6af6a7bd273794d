import os

import pytest

import corpus_pipeline
from tessera.llm import parity_join
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents").cache()
    ids = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        ids.append(docs.count())
    assert ids[0] > ids[1] > ids[2] > 0.5 * ids[0]
    found = {r["doc_id"]: r["component_id"] for r in parity_join.components(docs, parity_join.Measure(5, 80)).collect()}
    one = corpus_pipeline.STAGES[2][1](spark, docs, SF)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(d for d, c in found.items() if d == c)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and all(r["n_pieces"] == len(r["piece_ids"]) for r in rows)

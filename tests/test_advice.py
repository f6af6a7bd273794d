"""Whole jobs against brute force: what the first review found cut short."""

import os
import re

import pytest

from pyspark.sql import functions as F

from tessera.operators import documents
from tessera.plans import relational

SF = "/root/testdata/sf0.001"


def ranked(scores):
    """The eight best of {doc_id: score}."""
    best = sorted((-s, d) for d, s in scores.items() if s)[:8]
    return [(d, -s, i + 1) for i, (s, d) in enumerate(best)]


def test_score_looks_at_file_names_first(spark):
    docs = [(1, "MPD-TMC.md", "about salt"), (2, "mpd.md", "tmc and salt"), (3, "other.md", "mpd salt"), (4, "s.md", "")]
    asked = spark.createDataFrame([(1, ["MPD", "tmc"]), (2, ["mpd tmc"]), (3, ["salt", "mpd"]), (4, ["about", "salt"]), (5, ["none"]), (6, ["MPD", "tmc"])], "row int, keywords array<string>")
    table = spark.createDataFrame(docs, "doc_id int, name string, text string")
    got = {}
    for r in documents.score(asked, "row", "keywords", documents.words(table, "doc_id", "text"), names=table.select("doc_id", "name")).collect():
        got.setdefault(r["row"], []).append((r["rank"], r["doc_id"], r["score"]))
    twice = [(1, 1, 210), (2, 2, 105)]
    assert {k: sorted(v) for k, v in got.items()} == {1: twice, 2: [(1, 1, 45)], 3: [(1, 1, 105), (2, 2, 105)], 4: [(1, 1, 24), (2, 2, 12), (3, 3, 12)], 6: twice}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_top_docs_of_every_entity(spark):
    words = {r["doc_id"]: set(re.findall("[a-z0-9]+", (r["text"] or "").lower())) for r in relational.read(spark, SF, "documents").collect()}
    want = set()
    for (entity,) in relational.entities(spark, SF).select("entity").collect():
        asked = relational.ASKED_WORDS[entity % 5]
        want |= {(entity, *x) for x in ranked({d: 12 * len(w & set(asked)) for d, w in words.items()})}
    assert {(r["row"], r["doc_id"], r["score"], r["rank"]) for r in relational.w_top_docs(spark, SF).collect()} == want


def test_candidates_keep_every_document_of_a_key(spark):
    start = "a study of thin films on porous supports made by slow interfacial reaction work"
    docs = [(1, f"# {start} one\n"), (2, f"# {start} two\n"), (3, f"# {start} one\n"), (4, f"# {start} {'and more ' * 30}\n"), (5, "DOI 10.1234/abc.d\n"), (6, "10.1234/ABC.d\n")]
    table = spark.createDataFrame(docs, "doc_id int, text string")
    known = documents.catalog(table, "doc_id", F.concat(F.lit("p"), F.col("doc_id")), "text")
    rows = spark.createDataFrame([(1, "", f"{start} one", ""), (2, "", "", "https://doi.org/10.1234/abc.d")], "row int, file string, title string, doi string")
    got = {tuple(r) for r in documents.candidates(rows, "row", "file", "title", "doi", known).collect()}
    assert got == {*((1, d, "title_partial") for d in (1, 2, 3)), (2, 5, "doi"), (2, 6, "doi")}

"""The backtrace of names through documents: containment against brute force, outcomes of hand-written cases, rounds that resume."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import gates
from tessera.operators import backtrace, documents, steps

TEXTS = {
    1: "In brief, sodium dodecyl sulfate (SDS) was added to the bath.",
    2: "TMC (trimesoyl chloride) reacts at once.",
    3: "Nothing to see. ZIF-8 is a commercial framework of that series.",
    4: "Here MPD stands for m-phenylenediamine in all cases.",
    5: "Then we saw PEI twice.",
    6: "The tonic SDS stayed. No more was said of it.",
}
KNOWN = {"SODIUM DODECYL SULFATE": "sodium lauryl sulfate"}


@pytest.mark.parametrize(("least", "ratio"), [(1, 0.0), (2, 0.5), (3, 0.6), (8, 0.0), (8, 0.3)])
def test_contained_equals_every_pair(spark, least, ratio):
    rng = random.Random(least)
    word = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    wholes = [word(rng.randrange(0, 40)) for _ in range(60)] + ["aaaa" * 10, ""]
    parts = [w[i : i + rng.randrange(1, 16)] for w in wholes if w for i in [rng.randrange(len(w))]] + [word(rng.randrange(0, 14)) for _ in range(40)] + wholes[:3]
    frame = lambda some: spark.createDataFrame([(x,) for x in [*some, some[0]]], "key string")
    fits = lambda a, b: least <= len(a) and len(a) >= ratio * len(b) and a in b
    got = sorted(map(tuple, documents.contained(frame(parts), frame(wholes), least, ratio).collect()))
    assert got == sorted({(a, b) for a in parts for b in wholes if fits(a, b)}) and got
    both = sorted(map(tuple, documents.either_way(frame(parts), frame(wholes), least, ratio).collect()))
    assert both == sorted({(a, b) for a in parts for b in wholes if fits(a, b) or fits(b, a)})


@pytest.fixture(scope="module")
def library(spark):
    docs = spark.createDataFrame([(i, f"paper-{i:09d}.md", t) for i, t in TEXTS.items()], "doc_id long, name string, text string")
    return docs, documents.catalog(docs, "doc_id", F.col("name"), "text").cache()


def rows(spark, some):
    return spark.createDataFrame(some, "row long, name string, query string, record long, file string, title string, doi string")


def test_outcomes_of_one_source(spark, library, tmp_path):
    docs, catalog = library
    registry = spark.createDataFrame([("sodium lauryl sulfate", "1", "A"), ("trimesoyl chloride", "2", "B")], "name_key string, cid string, formula string")
    file = lambda i: f"paper-{i:09d}.md"
    asked = rows(spark, [
        (1, "SDS", "", 1, file(1), "", ""), (2, "TMC", None, 2, file(2), None, None), (3, "ZIF-8", "", 3, file(3), "", ""), (4, "MPD", "", 4, file(4), "", ""), (5, "PEI", "", 5, file(5), "", ""),
        (6, "MPD", "", 1, file(1), "", ""), (7, "SDS", "", None, None, None, None), (8, "SDS", "", 9, "", "", ""), (9, None, None, 1, file(1), "", ""), (10, "SDS", "", 1, file(1), "", ""),
    ])
    cited = asked.filter("record is not null").select("record", "file", "title", "doi").distinct()
    candidates = backtrace.record_candidates(cited, catalog, str(tmp_path / "one"))
    found = {r["row"]: r for r in backtrace.trace_source(asked, docs, candidates, registry, KNOWN, str(tmp_path / "one")).collect()}
    told = {k: (r["status"], r["doc_id"], r["method"], r["resolved"], r["cid"]) for k, r in found.items()}
    assert told[1] == told[10] == ("BACKTRACE_HIT", 1, "filename", "sodium dodecyl sulfate", "1")
    assert told[2] == ("BACKTRACE_HIT", 2, "filename", "trimesoyl chloride", "2")
    assert told[3][:3] == ("BACKTRACE_CLASSIFIED", 3, "filename") and told[3][4] is None
    assert told[5][0] == "CONTEXT_FOUND_BUT_NO_EXPANSION" and found[5]["evidence"].startswith("Then we saw PEI")
    assert told[6][0] == "TOKEN_NOT_IN_MD" and told[6][1] is None and found[6]["tried"] >= 1
    assert told[7][0] == "RAW_ROW_NOT_FOUND" and told[8][0] == "MD_NOT_FOUND" and told[9][0] == "TOKEN_NOT_IN_MD"
    assert len(found) == 10


def test_rounds_keep_the_best_and_resume(spark, library, tmp_path, monkeypatch):
    docs, catalog = library
    registry = spark.createDataFrame([("sodium lauryl sulfate", "1", "A")], "name_key string, cid string, formula string")
    records = spark.createDataFrame([(i, f"paper-{i:09d}.md", "", "") for i in TEXTS], "record long, file string, title string, doi string")
    entities = spark.createDataFrame([(1, "SDS", "", [6, 1, 2]), (2, "SDS", "", [2, 6, 99]), (3, "SDS", "", []), (4, "SDS", "", None), (5, "SDS", "", [99]), (6, "PEI", "", [1, 2, 3, 5])], "entity long, name string, query string, sources array<long>")
    folder = str(tmp_path / "rounds")
    calls = []
    once = backtrace.trace_source

    def stops(*args):
        calls.append(args[-1])
        if len(calls) == 2:
            raise RuntimeError("lost")
        return once(*args)

    monkeypatch.setattr(backtrace, "trace_source", stops)
    with pytest.raises(RuntimeError):
        backtrace.backtrace(entities, records, docs, catalog, registry, KNOWN, folder)
    assert steps.is_whole(spark, f"{folder}/round-1/outcome") and not steps.is_whole(spark, f"{folder}/round-2/outcome")
    found = {r["entity"]: r for r in backtrace.backtrace(entities, records, docs, catalog, registry, KNOWN, folder).collect()}
    assert [c.rsplit("/", 1)[1] for c in calls] == ["round-1", "round-2", "round-2", "round-3"]  # the first round is not done again
    assert (found[1]["status"], found[1]["source"], found[1]["trail"]) == ("BACKTRACE_HIT", 1, "6:CONTEXT_FOUND_BUT_NO_EXPANSION|1:BACKTRACE_HIT")  # no third round after a hit
    assert (found[2]["status"], found[2]["source"]) == ("CONTEXT_FOUND_BUT_NO_EXPANSION", 6)
    assert found[3]["status"] == found[4]["status"] == "MISSING_SOURCE_RECORDINDEX" and found[3]["trail"] == ""
    assert found[5]["status"] == "RAW_ROW_NOT_FOUND" and found[6]["trail"].count("|") == 2  # three sources at most


def test_search_tokens(spark):
    df = spark.createDataFrame([("HNT-COOH", ""), ("2,4-dinitro_phenol", "x (y) z"), (None, None), ("MCM-41", "MCM-41")], "name string, query string")
    got = [r["t"] for r in df.select(gates.search_tokens(F.col("name"), F.col("query")).alias("t")).collect()]
    assert got[0][:6] == ["HNT-COOH", "HNTCOOH", "HNT COOH", "HNT", "COOH", "COOH-HNT"] and "carboxylated HNT" in got[0] and "halloysite nanotube-COOH" in got[0]
    assert got[1][0] == "2,4-dinitro_phenol" and {"dinitro_phenol", "phenol", "x y z"} <= set(got[1])
    assert got[2] == [] and got[3][:2] == ["MCM-41", "MCM41"] and len({t.lower() for t in got[3]}) == len(got[3]) <= 24


def test_first_occurrences_are_apart(spark):
    text = "x" * 30 + " TMC " + "y " * 15 + "TMC" + " z" * 80 + " tmc. " + "w " * 90 + "TMC" + " v" * 200 + " TMC"
    df = spark.createDataFrame([(text, "TMC"), (text, "T"), (None, "TMC"), ("TMC", "TMC"), ("", "TMC")], "text string, token string")
    got = [r["w"] for r in df.select(gates.first_occurrences(F.col("text"), F.col("token"), radius=40).alias("w")).collect()]
    assert len(got[0]) == 3 and [w.lower().count("tmc") for w in got[0]] == [2, 1, 1]  # the second mention is within 100 of the first
    assert got[1:] == [[], [], [], []]

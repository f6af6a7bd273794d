"""The registered queries: columns, rows and a check of each one's values; stages on odd tables."""

import os
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import common, queries, repetition, url_filter
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")

COLUMNS = {
    "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op2_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op6_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op8_token_binary": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_name_join": ["vendor_id", "distance", "n_clients", "first_client_id", "clients_crc"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
}


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    out = queries.queries()[name](spark, SF)
    assert out.columns[: len(COLUMNS[name])] == COLUMNS[name]


def test_classifier_query(spark):
    rows = queries.queries()["op1_quality_classifier"](spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    pairs = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x == 1 and y == 0]
    assert not pairs or sum(pairs) / len(pairs) > 0.8


def test_all_links_of_a_page_join(spark):
    two = '<link rel="canonical" href="http://a.example.net/x"><link rel="canonical" href="https://www.example.org/es/1">'
    rows = [(1, "http://b.net/p", two), (2, "http://a.example.net/x", ""), (3, None, two), (4, "nothing", two), (5, "http://www.example.org/es/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.filter_pages(pages).collect()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block"}


def test_sample_is_bounded_by_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (None, 1)], "doc_id long, quality int")
    found = common.labelled_sample(docs, labels, "quality", 10)
    assert found == ([(1, "a", 1)] if zlib.crc32(b"1") % 5 else [])


CLASHING = ["kept", "n_words", "quality_ok", "quality_score", "n_tokens", "p_good", "nth", "__nth", "rate", "component", "node"]


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:4])
def test_stages_leave_other_columns_alone(spark, name, stage):
    base = table(spark, SF, "documents").select("doc_id", "text").limit(40)
    odd = spark.createDataFrame([(None, "a b"), (10**9, None), (10**9 + 1, ""), (10**9 + 2, "x"), (10**9 + 2, "x")], "doc_id long, text string")
    docs = base.unionAll(odd).select("doc_id", "text", *[F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))).alias(c) for c in CLASHING]).cache()
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns
    for r in out.collect():
        assert all(r[c] == f"{c}{r['doc_id'] or 0}" for c in CLASHING), name
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_last_stage_on_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (2, "a b"), (2, "a b")], "doc_id long, text string")
    out = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    assert len(out) == 4 and all(r["n_pieces"] == len(r["piece_ids"]) for r in out)


def test_base_counts_equal_plain_ones(spark):
    texts = ["a b c # $\n\n a b c # $\nx", "é é " * 30, "w " * 200, " ".join(f"t{i}" for i in range(30)), "", None]
    rows = repetition.rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        words = [w.decode() for w in text.encode().split()]
        seen: dict = {}
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i : i + 8]), []).append(i)
        inside = {p + j for at in seen.values() if len(at) > 1 for p in at for j in range(8)}
        lines = [x for x in text.split("\n") if x.split()]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(inside))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))

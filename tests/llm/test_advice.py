"""Whole jobs against brute force: what the first review found cut short."""

import math
import os
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import lm_score, mixing
from tessera.llm.common import materialise, table
from tessera.llm.queries import PIECE_MODEL, domains

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ 5
def losses_by_hand(texts):
    """Function (context, word) -> loss, and the vocabulary is that of `texts` on the second list's side."""
    pairs, words, after, kinds = Counter(), Counter(), Counter(), defaultdict(set)
    for t in texts:
        w = t.split()
        words.update(w)
        for a, b in zip([None, *w], w, strict=False):
            pairs[a, b] += 1
            after[a] += 1
            kinds[a].add(b)
    return pairs, words, after, kinds


def test_lm_counts_every_word(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_TOKENS", 700)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = [" ".join(rng.choice(vocabulary) if rng.random() < 0.7 else rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    rows = [*enumerate(texts), (0, texts[0]), (300, ""), (301, None), (None, "a b w1"), (302, "a b a b"), (303, "日本 é a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labelled = [(i, int(i % 3 == 0), int(i % 9 == 0)) for i in range(300)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    target = {i for i, q, x in labelled if q and not x and crc32(str(i).encode()) % 5}
    background = losses_by_hand([t or "" for _, t in rows])
    wanted = losses_by_hand([t or "" for i, t in rows if i in target])
    size = len(background[1])
    assert size > lm_score.VOCABULARY

    def loss(model, a, b):
        pairs, words, after, kinds = model
        lower = (words[b] + 1) / (sum(words.values()) + size)
        rest = 0.75 * len(kinds[a]) / after[a] if after[a] else 1.0
        return -math.log(max(pairs[a, b] - 0.75, 0) / max(after[a], 1) + rest * lower)

    def by_hand(text):
        w = (text or "").split()
        t, b = (sum(loss(m, x, y) for x, y in zip([None, *w], w, strict=False)) / max(len(w), 1) for m in (wanted, background))
        return len(w), round(t, 9), round(b, 9), round(b - t, 9)

    got = lm_score.score_corpus(docs, labels).collect()
    want = sorted(((i, *by_hand(t)) for i, t in rows), key=repr)
    found = sorted(((r[0], r[1], *(round(x, 9) for x in r[2:])) for r in got), key=repr)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert all(a == pytest.approx(b, abs=1e-8) for x, y in zip(found, want, strict=True) for a, b in zip(x[2:], y[2:], strict=True))
    assert lm_score.score_corpus(docs.limit(0), labels).count() == 0


# ------------------------------------------------------------------ pipeline
def test_mixing_keeps_each_anchor_document_once(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, "x " * rng.randrange(5, 50), p) for i, p in enumerate([0.6, 0.9, 1.0] * 100 + [0.1, 0.0] * 200)], "doc_id long, text string, p double")
    asked = {"good": 0.9, "bad": 0.1}

    class Known:
        domains = ("bad", "good")

    def given(df, classifier):
        return df.withColumns({"n_tokens": F.size(F.split(F.trim("text"), " ")), "p_good": F.col("p"), "p_bad": 1 - F.col("p")})

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(mixing, "posteriors", given)
        for soft in (docs, docs.filter("p <> 0.6")):
            rows = given(mixing.mixed(soft, Known, asked, "good"), Known).collect()
            kept = Counter(r["doc_id"] for r in rows)
            whole = {r["doc_id"] for r in soft.filter("p > 0.5").collect()}
            assert set(kept.values()) == {1} and whole <= set(kept)
            share = sum(r["n_tokens"] * r["p_bad"] for r in rows) / sum(r["n_tokens"] for r in rows)
            assert share == pytest.approx(0.1, abs=0.02) or len(kept) == len(whole)


@pytest.mark.parametrize(("alpha", "targets"), [([2, 0.3, 0.3], {"good": 0.97, "low": 0.01, "toxic": 0.02}), ([0.1, 0.1, 0.1], {"good": 0.6, "low": 0.1, "toxic": 0.3})])
def test_mixing_fits_a_rate_for_each_document(spark, alpha, targets):
    """rows had the rate of their most probable domain, found on the driver, instead of one of their own by projected gradient."""
    names = ("good", "low", "toxic")
    rng = np.random.default_rng(4)
    p, n = rng.dirichlet(alpha, 1000), rng.integers(0, 500, 1000).astype(float)
    df = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)], "n_tokens long, p_good double, p_low double, p_toxic double")
    steps, off = mixing.bounded_steps(df, names, targets, "good")
    got = np.array([r[0] for r in df.select(mixing.bounded_rate(names, targets, "good", steps)).collect()])
    v = p[:, 1:] - np.outer(p[:, 0], [targets[d] / targets["good"] for d in names[1:]])
    fixed = p.argmax(axis=1) == 0
    weight, want = np.linalg.inv((v[~fixed] * n[~fixed, None]).T @ v[~fixed]), np.ones(1000)
    for _ in range(3000):  # small steps of the same problem, in one process
        want = np.where(fixed, 1, np.clip(want - 0.9 * v @ (weight @ (v.T @ (n * want))), 0, 1))
    far = lambda x: (v.T @ (n * x)) @ weight @ (v.T @ (n * x))
    assert (got[fixed] == 1).all() and 0 <= got.min() <= got.max() <= 1
    assert off <= mixing.CLOSE or far(got) <= far(want) * 1.001
    assert off == pytest.approx(np.abs(v.T @ (n * got)).max() / (n * got).sum(), rel=1e-6)
    if alpha[0] == 0.1:
        assert off <= mixing.CLOSE and len(set(np.round(got[p.argmax(axis=1) == 1], 6))) > 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_run_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = materialise(stage(spark, docs, SF))
    classifier = mixing.train(table(spark, SF, "documents"), domains(table(spark, SF, "labels")), tuple(sorted(corpus_pipeline.TARGETS)))
    into = docs.collect()
    _, p = classifier.posteriors([r["text"] or "" for r in into])
    best = p.argmax(axis=1)
    anchored = {r["doc_id"] for r, b in zip(into, best, strict=True) if classifier.domains[b] == "good"}
    known = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    pieces = {r["doc_id"]: known.encode(r["text"] or "") for r in into}
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r["doc_id"] for r in out]
    assert len(ids) == len(set(ids)) and anchored <= set(ids) <= set(pieces)
    assert all(list(r["piece_ids"]) == pieces[r["doc_id"]] and r["n_pieces"] == len(pieces[r["doc_id"]]) for r in out)

"""The ten operators against brute force, exact round trips or held-out accuracy, with nulls, empties, ties and repeats."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, components, dac, edit_counts, lm_score, mixing, parity_join, quality_cnn, repetition, shingles, tokens, url_filter, wfst

ODD = ["", " ", "\n", "a", "A b", "x " * 30, "é́ ñ 日本 😀", "the\tthe\x0bthe", "word " * 3000, "<|endoftext|> <|", "▁ x", "\x1c y", None]
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts, extra=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.withColumn("score", F.lit("clash")).withColumn("kept", F.lit(1)) if extra else df


# ------------------------------------------------------------------ 1
def junk(rng, bad):
    words = [rng.choice(["the", "of", "reed", "thand", "ouring"]) for _ in range(rng.randrange(5, 60))]
    return " ".join(w + rng.choice(["###", "$$$"]) if bad else w for w in words)


def test_cnn_learns_and_pools_over_pieces():
    rng = random.Random(1)
    rows = [(junk(rng, i % 3 == 0), int(i % 3 != 0)) for i in range(240)]
    model = quality_cnn.fit(rows[:200], epochs=12)
    got = model.scores([t.encode() for t, _ in rows[200:]])
    assert np.mean((got >= 0.5) == np.array([y for _, y in rows[200:]])) > 0.95
    long = ("x y " * 200_000 + "###$$$ " * 3).encode()  # over one piece
    whole = model.responses(quality_cnn.padded(long)).max(axis=0)
    assert np.allclose(model.pooled([long, b""])[0], whole, atol=1e-4)


def test_cnn_pieces_of_any_length(monkeypatch):
    monkeypatch.setattr(quality_cnn, "PIECE", 64)
    rng = np.random.default_rng(3)
    model = quality_cnn.fit([("ab cd", 1), ("## $$", 0)] * 4, epochs=1)
    for n in [*range(60, 90), *range(120, 150)]:
        data = rng.integers(1, 256, n).astype(np.uint8).tobytes()
        assert np.allclose(model.pooled([data])[0], model.responses(quality_cnn.padded(data)).max(axis=0), atol=1e-5), n


def test_cnn_edges(spark):
    model = quality_cnn.fit([("a", 1), ("b", 1)])
    got = quality_cnn.score(frame(spark, ODD, True), model).collect()
    assert len(got) == len(ODD) and all(r["quality_score"] == 1.0 for r in got)
    assert quality_cnn.fit([]).scores([b""])[0] == 0.5
    assert quality_cnn.score(frame(spark, ["a"]).limit(0), model).count() == 0


# ------------------------------------------------------------------ 2
def test_url_components_and_precedence(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "http://a.net/x", link("https://z.example.org/es/q")), (2, "HTTPS://z.Example.ORG/es/q/?utm_source=1#k", None), (3, "http://q.net/", '<META http-equiv=refresh content="0; url=/y">'),
        (4, "https://q.net/y", link("http://a.net/x/")), (5, None, None), (6, "nope", ""), (7, "http://x.org/p", link("http://q.net/y")), (8, "http://k.net/", ""), (1, "http://a.net/x", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_pages(pages).collect()}
    assert got[1] == ("a.net", "/x", None, "block") and got[2] == ("z.example.org", "/es/q/", "example.org/es/", "block")
    assert got[3][3] == got[4][3] == "block" and got[7] == ("x.org", "/p", "org/", "allow")
    assert got[5] == got[6] == ("", "", None, "allow") and got[8][3] == "allow"
    assert url_filter.filter_pages(pages.limit(0)).count() == 0


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(17)] + [(None, 5), (7, 7)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {n: n for e in edges for n in e if n is not None}
    for _ in range(60):
        for u, v in edges:
            if u is not None:
                root[u] = root[v] = min(root[u], root[v])
    linked = {n for u, v in edges if u is not None and u != v for n in (u, v)}
    assert got == {n: root[n] for n in linked}


# ------------------------------------------------------------------ 3
def brute_repeats(words, least):
    n = len(words)
    best = [max((next((k for k in range(n) if i + k >= n or j + k >= n or words[i + k] != words[j + k]), 0) for j in range(n) if j != i), default=0) for i in range(n)]
    cover = lambda ok, size: len({p for i in range(n) if ok(best[i]) for p in range(i, i + size(best[i]))})
    return cover(lambda b: b >= 8, lambda b: 8), cover(lambda b: b >= least, lambda b: b), max(best, default=0)


def test_repeats_match_brute_force():
    rng = random.Random(1)
    docs = [[rng.randrange(k) for _ in range(rng.randrange(0, 60))] for k in [1, 2, 3, 5, 9, 40] * 5]
    docs += [d + d for d in docs[-6:]]
    got = repetition.repeats([np.array(d, np.int64) for d in docs], repetition.Limits(min_repeat=4), True)
    for i, d in enumerate(docs):
        assert brute_repeats(d, 4) == (got.in_windows[i], got.covered[i], got.longest[i])
        assert sum(b - a for a, b in got.spans[i]) == got.covered[i]


def test_rules_edges(spark):
    got = {r["doc_id"]: r for r in repetition.rules(frame(spark, [*ODD, "a #\nb\na #\n \n"])).collect()}
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (0, 1, 2, 3, len(ODD) - 1)) and got[8]["base_failed"]
    last = got[len(ODD)]
    assert (last["n_words"], last["word_chars"], last["n_symbols"], last["n_dup_lines"]) == (5, 5, 2, 1)
    assert repetition.judge(frame(spark, ["a"], True)).columns.count("kept") == 1
    assert repetition.rules(frame(spark, ["a"]).limit(0)).count() == 0


# ------------------------------------------------------------------ 4
def test_neighbours_reach_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1600, 16)).astype(np.float32)
    x[5:60] = x[5]  # one common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0]), (None, [1.0] * 16), (20, x[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got: dict = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, 20, ann.Settings(parts=4, least_part=256, cell=300, query_cell=40)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(np.float64)
    hits = 0
    for q in range(0, 1600, 20):
        s = (y * y[q]).sum(axis=1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(1600), -s))[:20]
        found = [v for _, v, _ in sorted(got[q])]
        hits += len(set(want.tolist()) & set(found))
        assert all(abs(sc - s[v]) < 1e-12 for _, v, sc in got[q])
    assert set(got) == set(range(0, 1600, 20)) and hits / (80 * 20) >= 0.9
    few = ann.search(df.filter("vec_id < 5"), F.col("vec_id") == 0, 20).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]
    assert ann.search(df.limit(0), F.col("vec_id") == 0).count() == 0


# ------------------------------------------------------------------ 5
def test_lm_matches_brute_force(spark):
    docs = frame(spark, ["a b a b", "b a c", "zz 9 A!x", "", None, "a b"])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    models = lm_score.train(docs, labels, 8)
    numbers = {w: i + 5 for i, w in enumerate(models.words)}
    pairs = Counter()
    for t in ["a b a b", "b a c", "zz 9 A!x", "a b"]:
        ids = [numbers.get(w.encode(), lm_score.Vocabulary()[w.encode()]) for w in t.split()]
        pairs.update(zip([0, *ids], ids, strict=False))
    counts = np.zeros((len(models.words) + 5,) * 2, np.int64)
    for (a, b), n in pairs.items():
        counts[a, b] = n
    loss = lm_score.losses(counts)
    assert np.allclose(loss, models.background, atol=1e-5) and np.allclose(np.exp(-loss).sum(axis=1), 1)
    got = {r["doc_id"]: r for r in lm_score.score(docs, models).collect()}
    ids = [numbers[b"a"], numbers[b"b"]]
    assert got[5]["background_loss"] == pytest.approx((loss[0, ids[0]] + loss[ids[0], ids[1]]) / 2, abs=1e-5)
    assert got[3]["score"] == got[4]["score"] == 0.0
    assert lm_score.score(docs.limit(0), models).count() == 0


# ------------------------------------------------------------------ 6
def families(rng):
    words = [f"w{i}" for i in range(2000)]
    docs = []
    for size in (12, 40, 120):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(40):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                w[rng.randrange(len(w))] = rng.choice(words)
            docs.append(" ".join(w))
    return docs + ["", "a", "a", "A  B", "a b", "x y z", " "] + [" ".join(rng.choice(words) for _ in range(30)) for _ in range(20)]


def crowds(rng):
    """Documents around common passages, some mostly passage, and a crowd of near copies of which many are not linked."""
    words = [f"v{i}" for i in range(3000)]
    passages = [[rng.choice(words) for _ in range(30)] for _ in range(2)]
    docs = []
    for _ in range(90):
        own = [rng.choice(words) for _ in range(rng.choice([6, 8, 20, 40, 90]))]
        docs.append(" ".join(rng.choice(passages) + own))
    base = [rng.choice(words) for _ in range(80)]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(len(w))] = rng.choice(words)
        docs.append(" ".join(w))
    return docs + [docs[0]] * 30 + ["", None] * 5


@pytest.mark.parametrize(("k", "percent", "chunk", "frequent"), [(4, 85, 9, 16), (5, 80, 768, 16), (4, 85, 16, 3), (5, 80, 20, 2)])
def test_join_matches_brute_force(spark, monkeypatch, k, percent, chunk, frequent):
    monkeypatch.setattr(parity_join, "FREQUENT", frequent)
    monkeypatch.setattr(parity_join, "HELD_KEYS", 3000)
    monkeypatch.setattr(parity_join, "CHUNK", chunk)
    docs = families(random.Random(7)) if frequent > 9 else crowds(random.Random(8))
    measure = parity_join.Measure(k, percent)
    df = spark.createDataFrame([*enumerate(docs), *enumerate(docs[:3]), (None, "a b"), (9999, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in parity_join.components(df, measure).collect()}
    sets = list(shingles.shingle_sets([d or "" for d in docs], k))
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(docs)):
        for j in range(i):
            if measure.linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert {i: (len(sets[i]), find(i)) for i in range(len(docs))} == {i: got[i] for i in range(len(docs))}
    assert got[None][1] is None and got[9999] == (0, 9999)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(2))
        a, b = np.unique(shingles.mix(a)), np.unique(shingles.mix(b))
        apart = len(np.setxor1d(a, b))
        assert parity_join.hamming(parity_join.filter_sketch(a), parity_join.filter_sketch(b)) <= apart


# ------------------------------------------------------------------ 7
def test_edits_match_full_counts(spark):
    counts = edit_counts.piece_counts(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(5)
    alphabet = "ab  \n  's'tre'llx1é.,!日"
    for t in range(600):
        now = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 900 if t % 10 == 0 else 60)))
        tree = edit_counts.TokenTree(now, counts)
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(0, len(now) + 1)
            b = min(len(now), a + rng.randrange(0, rng.choice([1, 3, 80])))
            new = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, rng.choice([2, 8, 120]))))
            tree.edit(a, b, new)
            now = now[:a] + new + now[b:]
            assert tree.text() == now and tree.n_tokens == len(counts.encoding.encode_ordinary(now))
    got = edit_counts.count(frame(spark, [*ODD, "mail a.b@c.de\nx\nx\n"]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert got[-1]["n_edits"] == 2
    for r, t in zip(got, [*ODD, None], strict=True):
        if r["n_edits"] == 0:
            assert r["tokens_after"] == r["tokens_before"] == len(counts.encoding.encode_ordinary(t or ""))


def test_edit_table(spark):
    edits = spark.createDataFrame([(0, 2, 0, 1, "zz"), (0, 1, 1, 9, None), (7, 1, 0, 1, "x")], "doc_id long, seq int, start int, stop int, replacement string")
    got = edit_counts.edited(frame(spark, ["abc def"]), edits, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(0, "zz")]


# ------------------------------------------------------------------ 8
def test_codes_random_access():
    rng = np.random.default_rng(0)
    for n, high in ((0, 9), (1, 2**8), (511, 2**16), (512, 2**16), (513, 2**32), (3000, 2**20)):
        ids = rng.integers(0, high, n).astype(np.uint32)
        file = dac.Reader(dac.encode(ids, np.array([5]), np.array([n])))
        assert (file.all() == ids).all() and [file[i] for i in range(n)] == ids.tolist()


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "FILE_TOKENS", 50)
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(WORD_BPE)
    dac.write(frame(spark, ODD).repartition(3), str(tmp_path / "codes"), WORD_BPE)
    got = dac.digest(spark, str(tmp_path / "codes")).orderBy("doc_id").collect()
    at = 0
    for r, text in zip(got, ODD, strict=True):
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    dac.write(frame(spark, ["a"]).limit(0), str(tmp_path / "none"), WORD_BPE)
    assert dac.digest(spark, str(tmp_path / "none")).count() == 0


def test_run_encoder_equals_the_library():
    from tokenizers import Tokenizer

    reference, mine = Tokenizer.from_file(WORD_BPE), tokens.RunEncoder(WORD_BPE)
    rng = random.Random(2)
    parts = ["the", "don't", "THE", "!!", ",", "é", "É", "é", "́", "İ", "ß", "ﬁ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "12", "日本", " ", "\n", "　", "\x1c", "'S", "word."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for text, packed in zip(texts, mine.packed([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ 9
def test_rates_reach_targets(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    rows = [(i, int(rng.integers(0, 500)), *map(float, p[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_a double, p_b double, p_c double")
    targets = {"a": 0.8, "b": 0.15, "c": 0.05}
    out = mixing.fit_rates(df, ("a", "b", "c"), targets).toPandas()
    total = out.n_tokens.sum()
    assert out.rate.min() >= 0
    for d, share in targets.items():
        assert (out.n_tokens * out.rate * out[f"p_{d}"]).sum() == pytest.approx(share * total, abs=2e-4 * total)
    assert mixing.fit_rates(df.limit(0), ("a", "b", "c"), targets).count() == 0


def test_mixing_edges(spark):
    rng = random.Random(1)
    docs = frame(spark, [junk(rng, i % 2 == 0) for i in range(120)] + ODD)
    labelled = spark.createDataFrame([(i, "bad" if i % 2 == 0 else "good") for i in range(120)] + [(5, None), (None, "bad")], "doc_id long, domain string")
    got = mixing.rates(docs, labelled, {"good": 0.9, "bad": 0.1}).collect()
    assert len(got) == 120 + len(ODD) and all(r["rate"] >= 0 and abs(r["p_bad"] + r["p_good"] - 1) < 1e-9 for r in got)
    assert np.mean([(r["p_bad"] > 0.5) == (r["doc_id"] % 2 == 0) for r in got if r["doc_id"] < 120]) > 0.9
    mixed = mixing.mixed(docs, mixing.train(docs, labelled, ("bad", "good")), {"good": 0.97, "bad": 0.03}, "good")
    kept = Counter(r["doc_id"] % 2 for r in mixed.collect() if r["doc_id"] < 120)
    assert kept[1] >= 55 and kept[0] <= 12 and mixed.columns == docs.columns


# ------------------------------------------------------------------ 10
def test_transducer_equals_sentencepiece(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    mine, reference = wfst.Transducer(model), sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("ab \n▁théx1😀日") for _ in range(rng.randrange(40))) for _ in range(2000)] + ["the quick brown fox, jumps!\nOver  the lazy dog " * 20]
    for t in texts:
        assert mine.encode(t) == reference.encode(t) and mine.decode(mine.encode(t)) == reference.decode(reference.encode(t))
    table = wfst.decode(wfst.encode(frame(spark, ODD, True), model), model).collect()
    assert all(r["decoded"] == (t or "").replace("▁", " ") for r, t in zip(table, ODD, strict=True))
    assert wfst.encode(frame(spark, ["a"]).limit(0), model).count() == 0

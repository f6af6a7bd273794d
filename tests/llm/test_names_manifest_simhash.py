"""Operators 11 to 13: the queries against their SQL, the operators against brute force, with odd rows."""

import glob
import hashlib
import os
import random
import zlib
from itertools import groupby

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import anagram_join, merkle, queries, simhash_join

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ the registered queries
@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", ["op11_name_join", "op12_merkle_manifest"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.queries()[name](spark, SF)
    result = con.execute(queries.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in df.columns]
    want = sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want and want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_simhash_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_simhash([(r["doc_id"], r["text"]) for r in rows])
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in queries.queries()["op13_simhash_near_dedup"](spark, SF).collect()}
    assert got == want


# ------------------------------------------------------------------ 11
def alignment(a, b):
    """Optimal string alignment by the table of its definition."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def some_names(rng, n, sizes):
    return ["".join(rng.choice("abcé😀") for _ in range(rng.choice(sizes))) for _ in range(n)]


def edited(rng, name, edits):
    s = list(name)
    for _ in range(edits):
        k = rng.randrange(len(s) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            s.insert(k, "z")
        elif k < len(s) and kind == 1:
            s.pop(k)
        elif k < len(s) and kind == 2:
            s[k] = "y"
        elif 0 < k < len(s):
            s[k - 1], s[k] = s[k], s[k - 1]
    return "".join(s)


def test_bit_parallel_distance():
    rng = random.Random(1)
    a = some_names(rng, 400, [0, 1, 2, 3, 5, 20, 63, 64, 65, 90])
    b = [edited(rng, x, rng.randrange(5)) if i % 2 else y for i, (x, y) in enumerate(zip(a, some_names(rng, 400, [0, 1, 4, 64, 66]), strict=True))]
    want = [alignment(x, y) for x, y in zip(a, b, strict=True)]
    assert anagram_join.distances(a, b).tolist() == want and [anagram_join.distance(x, y) for x, y in zip(a, b, strict=True)] == want
    assert anagram_join.distance("ca", "abc") == 3  # no substring is edited twice


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_a_close_pair_meets_under_one_key(most):
    def keys(name):
        out = []
        for _, found, gone in anagram_join.deletion_keys([name], most):
            out += [(k, {g >> 21 * i & 2**21 - 1 for i in range(3)} - {0}) for k, g in zip(found.tolist(), gone.tolist(), strict=True)]
        return out

    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8)))
        b = edited(rng, a, rng.randrange(most + 1)) or "a"
        met = sum(k == k2 and not g & g2 for k, g in keys(a) for k2, g2 in keys(b))
        assert met <= 1 and (met == 1 or alignment(a, b) > most)


def test_keys_of_many_letters(monkeypatch):
    whole = sorted(k for _, found, _ in anagram_join.deletion_keys([("".join(map(chr, range(200, 290))))], 2) for k in found.tolist())
    monkeypatch.setattr(anagram_join, "PICKS_AT_ONCE", 7)
    monkeypatch.setattr(anagram_join, "KEYS_AT_ONCE", 11)
    again = sorted(k for _, found, _ in anagram_join.deletion_keys([("".join(map(chr, range(200, 290))))], 2) for k in found.tolist())
    assert whole == again and len(whole) == 1 + 90 + 90 * 89 // 2


def test_join_equals_every_pair(spark):
    rng = random.Random(3)
    base = some_names(rng, 12, [1, 2, 3, 6, 9]) + ["Anna Berg", "x" * 80, "日本語名"]
    clients = [(i, edited(rng, rng.choice(base), rng.randrange(4))) for i in range(150)] + [(900 + i, "Anna Berg") for i in range(60)]
    clients += [(None, "Anna Berg"), (1000, None), (1001, ""), (5, "Anna Berg"), (5, "Anna Berg")]
    vendors = [(i, x) for i, x in enumerate(base)] + [(50, "Anna Berg"), (50, "Anna Bergg"), (51, None), (52, ""), (None, "Anna Berg"), (53, "q")]
    stored = {}
    for v, name in vendors:
        if v is not None and name:
            h, s = zlib.crc32(str(v).encode()), list(name)
            if h % 2 == 0 and len(s) >= 2:
                k = h % (len(s) - 1)
                s[k], s[k + 1] = s[k + 1], s[k]
            stored.setdefault(v, []).append("".join(s))
    want: dict = {}
    for v, names in stored.items():
        for name in names:
            for c, other in clients:
                if c is not None and other and (d := alignment(name, other)) <= 2:
                    n, first, crc = want.get((v, d), (0, c, 0))
                    want[v, d] = (n + 1, min(first, c), crc + zlib.crc32(str(c).encode()))
    left = spark.createDataFrame(clients, "client_id long, name string").withColumn("node", F.lit("clash")).withColumn("key", F.lit(1))
    right = spark.createDataFrame(vendors, "vendor_id long, name string").withColumn("distance", F.lit("clash"))
    got = {(r["vendor_id"], r["distance"]): (r["n_clients"], r["first_client_id"], r["clients_crc"]) for r in anagram_join.vendor_clients(left, right).collect()}
    assert got == want and want
    assert anagram_join.vendor_clients(left.limit(0), right).count() == anagram_join.vendor_clients(left, right.limit(0)).count() == 0


# ------------------------------------------------------------------ 12
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])])


def plain_tree(leaves):
    """(top, siblings of each leaf level by level, indexes of each leaf's digest in its runs)."""
    proofs, slots, now, where = [[] for _ in leaves], [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(now) > 1:
        runs = [now[i : i + 8] for i in range(0, len(now), 8)]
        for i, at in enumerate(where):
            run = runs[at // 8]
            proofs[i].append(run[: at % 8] + run[at % 8 + 1 :])
            slots[i].append(at % 8)
            where[i] = at // 8
        now = [h(*run) for run in runs]
    return now[0], proofs, slots


def brute_manifest(rows):
    rows = sorted(rows, key=lambda r: (r["lang"] is not None, (r["lang"] or "").encode(), r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    trees = [list(g) for _, g in groupby(rows, key=lambda r: r["lang"])]
    below = [plain_tree([plain_leaf(r) for r in t]) for t in trees]
    root, high, high_slots = plain_tree([b[0] for b in below])
    out = []
    for k, (tree, (subroot, proofs, slots)) in enumerate(zip(trees, below, strict=True)):
        for i, row in enumerate(tree):
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
            text = row["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            now = plain_leaf(row | {"text": text}) if hit else plain_leaf(row)
            beside = proofs[i] + high[k]
            for some, at in zip(beside, slots[i] + high_slots[k], strict=True):
                now = h(*some[:at], now, *some[at:])
            out.append((row["doc_id"], plain_leaf(row), subroot, root, h(*[d for some in beside for d in some]), now, now == root))
    return out


def doc_rows(rng, n, langs):
    rows = [(i, rng.choice(["A text", "lower", "É Ä", "", None]) and f"{rng.choice(['Up', 'low'])} {i}", rng.choice(langs), rng.choice(["web", None]), rng.choice([i, None])) for i in range(n)]
    return rows + [(3, "twice", langs[0], "web", 1), (3, "twice", langs[0], "web", 1), (3, "Other", langs[0], None, None), (None, "X", langs[0], None, 2), (None, None, None, None, None)]


@pytest.mark.parametrize(("n", "langs"), [(700, ["en", "de", None, "Zz", "a"]), (70, [str(i) for i in range(30)]), (9, ["en"]), (1, ["fr"])])
def test_manifest_equals_brute_force(spark, n, langs):
    docs = spark.createDataFrame(doc_rows(random.Random(n), n, langs), "doc_id long, text string, lang string, source string, n_chars long").withColumn("path", F.lit("clash")).withColumn("pos", F.lit(1))
    got = merkle.verify(docs.repartition(7), merkle.every_third())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_manifest([r.asDict() for r in docs.drop("path", "pos").collect()]), key=repr)


def test_single_leaf_and_empty_table(spark):
    one = spark.createDataFrame([(7, "Text", "en", "web", 4)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.verify(one, F.lit(False)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h() and row["verified"]
    assert merkle.verify(one.limit(0), F.lit(True)).count() == 0


def test_written_manifest_folds(spark, tmp_path):
    docs = spark.createDataFrame(doc_rows(random.Random(5), 100, ["en", "de"]), "doc_id long, text string, lang string, source string, n_chars long")
    built = merkle.build(docs.select("doc_id", "lang", merkle.leaf(*map(F.col, merkle.FIELDS)).alias("digest")), F.col("lang"), ["doc_id"])
    built.write(str(tmp_path / "manifest"))
    again = merkle.read(spark, str(tmp_path / "manifest"))
    root = again.root().first()["root"]
    assert root == built.root().first()["root"]
    folded = again.paths().select(merkle.fold(F.col("path"), F.col("digest")).alias("r")).distinct().collect()
    assert [r["r"] for r in folded] == [root]
    assert again.paths().select(merkle.fold(F.col("path"), F.lit("0" * 64)).alias("r")).filter(F.col("r") == root).count() == 0


# ------------------------------------------------------------------ 13
def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    some = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def brute_simhash(rows):
    prints = {d: plain_fingerprint(t) for d, t in rows}
    least = dict.fromkeys(prints)
    for d in prints:
        least[d] = d
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if least[b] < least[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a], changed = least[b], True
    return {d: (prints[d], least[d]) for d in prints}


def test_links_are_all_pairs_within_the_limit(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, int(n), replace=False)) for x in base for n in range(1, 7)]
    crowd = [int(base[0]) ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12)]
    every = sorted({simhash_join._signed(int(x)) for x in [*base, *near, *crowd, 0, 7, 2**64 - 1, 2**63, 2**64 - 2]})
    df = spark.createDataFrame([(x,) for x in every], "fingerprint long")
    got = {(r["u"], r["v"]) for r in simhash_join.links(df).collect()}
    assert got == {(a, b) for a in every for b in every if a < b and ((a ^ b) & 2**64 - 1).bit_count() <= 3} and len(got) > 500


def test_pivot_table_never_discards_a_link(spark):
    s = simhash_join.Settings()
    rng = np.random.default_rng(5)
    rows = [(int(x), int(x) ^ sum(1 << int(b) for b in rng.choice(63, int(n), replace=False)), int(n)) for x in rng.integers(0, 2**63, 300, dtype=np.int64) for n in range(12)]
    df = spark.createDataFrame(rows, "a long, b long, n int")
    tables = zip(simhash_join.pivot_table(F.col("a"), s), simhash_join.pivot_table(F.col("b"), s), strict=True)
    kept = [simhash_join.within(x, y, s.limit).alias(f"k{i}") for i, (x, y) in enumerate(tables)]
    refs = [int(x) for x in s.references()]
    for r in df.select("a", "b", "n", *kept).collect():
        apart = [abs((r["a"] ^ p).bit_count() - (r["b"] ^ p).bit_count()) for p in refs]
        assert [r[f"k{i}"] for i in range(4)] == [max(apart[i * 7 : i * 7 + 7]) <= 3 for i in range(4)]
        assert r["n"] > 3 or all(r[f"k{i}"] for i in range(4))


def test_simhash_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(simhash_join, "PIECE", 5)
    long = " ".join(f"Word{i % 97}" for i in range(400))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a"), (5, "A\x0bB"), (6, "a b"), (7, long), (8, long.upper()), (9, long + " tail"), (10, "é ñ \x1c x"), (12, long), (11, long)]
    df = spark.createDataFrame([*rows, (12, long), (None, long)], "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).withColumn("key", F.lit(1))
    found = simhash_join.components(df).collect()
    want = brute_simhash(rows)
    assert len(found) == len(rows) + 2
    for r in found:
        if r["doc_id"] is None:
            assert int(r["fingerprint"], 16) == want[7][0] and r["component_id"] is None
        else:
            assert (int(r["fingerprint"], 16), r["component_id"]) == want[r["doc_id"]] and len(r["fingerprint"]) == 16
    assert simhash_join.components(df.limit(0)).count() == 0

from pyspark.sql import functions as F

from tessera.operators import delivery, dictionary, lookup, resolve
from tessera.sources import readers, sinks
from tessera.streaming import micro_batch


def test_first_success_takes_the_earliest_hit(spark):
    rows = spark.createDataFrame([(1, ["x", "b", "a"]), (2, ["q"]), (3, [])], "id int, tries array<string>")
    table = spark.createDataFrame([("a", 10), ("b", 20)], "k string, cid int")
    got = {r["id"]: (r["query"], r["cid"]) for r in lookup.first_success(rows, "id", F.col("tries"), table, "k", ["cid"]).collect()}
    assert got == {1: ("b", 20), 2: (None, None), 3: (None, None)}


def test_identity_guard_rejects_unlike_names(spark):
    table = spark.createDataFrame([(0, "Graphene oxide", "methane", "", "CH4", "1", "16.04"), (1, "sodium chloride", "", "", "NaCl", "2", "58.44")], "row int, original string, standard string, iupac string, formula string, cid string, mw string")
    known = lookup.build_identity(table)
    names = spark.createDataFrame([("Graphene oxide",), ("sodium  chloride",), ("",), ("XYZ",), ("unknown thing",)], "name string")
    got = {r["name"]: (r["identity_source"], r["mw"]) for r in lookup.resolve_identity(names, "name", known).collect()}
    assert got["Graphene oxide"] == ("IDENTITY_TABLE_REJECTED_SIMILARITY", None)
    assert got["sodium  chloride"] == ("IDENTITY_TABLE_EXACT", 58.44)
    assert got[""] == ("EMPTY_SOLUTE", None)
    assert got["XYZ"][0] == "UNRESOLVED_ABBREVIATION" and got["unknown thing"][0] == "UNRESOLVED"


def test_slot_to_weight_percent(spark):
    slots = spark.createDataFrame([(1, "aqueous_monomer", "MPD; PIP", "2; 0.5", "wt%"), (1, "test_nacl", "", "2000", "ppm"), (2, "test_nacl", "", "", "")], "row_id int, slot string, solutes string, values string, units string")
    rows = delivery.items(slots).withColumns({"standard": F.col("solute"), "mw": F.lit(None).cast("double")})
    out = {(r["row_id"], r["slot"], r["item_index"]): (r["wt"], r["status"]) for r in delivery.convert(rows).collect()}
    assert out == {
        (1, "aqueous_monomer", 1): (2.0, "RULE_NORMALIZED_CONVERTED"),
        (1, "aqueous_monomer", 2): (0.5, "RULE_NORMALIZED_CONVERTED"),
        (1, "test_nacl", 1): (0.2, "RULE_NORMALIZED_CONVERTED"),
        (2, "test_nacl", 1): (None, "FAILED_PARSE"),
    }


def test_lexicon_and_dictionary(spark):
    names = spark.createDataFrame([(1, "m-phenylenediamine (MPD)"), (2, "m-phenylenediamine (MPD)"), (3, "SDS"), (4, "SDS x"), (5, "y SDS"), (6, "QQX"), (7, "QQX"), (8, "QQX")], "row int, name string")
    assert [tuple(r) for r in dictionary.abbreviation_lexicon(names, "name").collect()] == [("MPD", "m-phenylenediamine", 2)]
    seed = spark.createDataFrame([("SDS", "sodium dodecyl sulfate", "additive")], "alias string, canonical_name string, category string")
    got = {r["alias"]: r["source"] for r in dictionary.alias_dictionary(names, "name", seed).collect()}
    assert got == {"SDS": "seed_manual", "MPD": "auto_mined", "QQX": "high_freq_abbr"}


def test_best_source_prefers_rank_then_position(spark):
    rows = spark.createDataFrame([(1, 1, "MD_NOT_FOUND"), (1, 2, "BACKTRACE_HIT"), (1, 3, "BACKTRACE_HIT"), (2, 4, "BACKTRACE_HIT"), (2, 1, "other")], "e int, position int, status string")
    got = {r["e"]: (r["position"], r["status"]) for r in resolve.best_source(rows, "e", "position", "status").collect()}
    assert got == {1: (2, "BACKTRACE_HIT"), 2: (1, "other")}


def test_checkpoint_resume_and_sanitation(spark, tmp_path):
    path = str(tmp_path / "done")
    df = spark.range(5).withColumn("t", F.lit("a\x01b"))
    assert sinks.pending(df, "id", path).count() == 5
    sinks.append_checkpoint(df.filter("id < 3"), path)
    assert sorted(r["id"] for r in sinks.pending(df, "id", path).collect()) == [3, 4]
    assert sinks.sanitize_table(df).select("t").first()[0] == "ab"
    assert sinks.bad_cells(df, "id").count() == 5


def test_csv_in_another_encoding(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("名称,v\n水,1\n".encode("gbk"))
    assert [tuple(r) for r in readers.read_csv_any(spark, str(path)).collect()] == [("水", "1")]


def test_folder_of_files_in_their_own_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("名称,v\n水,1\n".encode("gbk"))
    (tmp_path / "b.csv").write_bytes("\ufeffv,名称,extra\n2,油,x\n3,\"a,b\",\n".encode())
    (tmp_path / "c.csv").write_bytes("名称\tv\n盐\t4\t9\n".encode("gb18030"))
    (tmp_path / "d.csv").write_bytes("v,other\n".encode())
    (tmp_path / "e.csv").write_bytes(b"")
    got = readers.read_csv_any(spark, str(tmp_path))
    assert got.columns == ["名称", "v", "extra", "other"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("水", "1", None, None), ("油", "2", "x", None), ("a,b", "3", "", None), ("盐", "4", None, None)], key=repr)


def test_archive(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/one.md", "# Title of the paper\nDOI 10.1234/ab.c")
        z.writestr("skip.txt", "no")
    got = readers.read_archive(spark, str(tmp_path / "a.zip")).collect()
    assert [(r["member"], r["text"][:7]) for r in got] == [("x/one.md", "# Title")]


def test_stream_appends_each_key_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "0.5", "g/L"), (1, "0.5", "g/L"), (2, "x", "")], "k int, value string, unit string").write.parquet(source)
    stream = micro_batch.convert_cells(spark.readStream.schema("k int, value string, unit string").parquet(source), "value", "unit")
    micro_batch.append_new(stream, "k", out, str(tmp_path / "cp")).awaitTermination(60)
    got = {r["k"]: (r["parsed"], r["unit_family"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (0.5, "mass_concentration"), 2: (None, "unsupported")}


def test_windows_equal_plain_ones(spark):
    import random
    import re

    from tessera.functions import text as T

    rng = random.Random(3)
    words = ["the", "The", "than", "other", "x", "the-", "a,", "so.", "end!", "\n", "naïve", "the."]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 120))), "the") for i in range(60)] + [(90, "", "the"), (91, None, "the"), (92, "the the the", "a"), (93, "the", None), (94, "the", "the")]
    squeeze = lambda t: re.sub(r"\s+", " ", t).strip()

    def sentences(t):
        parts = [p.strip(" ") for p in re.split(r"(?<=[.!?\n])", t)]
        out, keys = [], set()
        for i, p in enumerate(parts):
            if re.search(r"(?i)(?<![A-Za-z0-9])the(?![A-Za-z0-9])", p):
                w = squeeze(" ".join(x for x in parts[max(i - 1, 0) : i + 2] if x))
                if w and w.lower() not in keys and len(out) < 6:
                    keys.add(w.lower())
                    out.append(w[:1400])
        return out

    def spans(t):
        found = [squeeze(t[max(m.start() - 300, 0) : m.end() + 300]) for m in re.finditer(r"(?i)(?<![A-Za-z0-9])the(?![A-Za-z0-9])", t)]
        return list(dict.fromkeys(found))[:6]

    df = spark.createDataFrame(rows, "id int, text string, token string")
    for r in df.select("id", "text", "token", T.sentence_windows(F.col("text"), F.col("token")).alias("s"), T.span_windows(F.col("text"), F.col("token")).alias("p")).collect():
        told = r["token"] == "the"
        assert r["s"] == (sentences(r["text"] or "") if told else []), r
        assert r["p"] == (spans(r["text"] or "") if told else []), r


def test_conversion_keeps_rows_with_nulls(spark):
    rows = [("a", "aqueous_monomer", "TMC", "TMC", "0.5", "wt%", 1.0), ("b", "aqueous_monomer", "TMC", None, "0.5", "wt%", 1.0), ("c", "additive", "TMC", "TMC", "0.5", None, 1.0), ("d", "additive", None, "TMC", None, "g/L", None)]
    df = spark.createDataFrame(rows, "row_id string, slot string, solute string, standard string, value string, unit string, mw double")
    from tessera.operators import delivery

    out = {r["row_id"]: r for r in delivery.convert(df).collect()}
    assert sorted(out) == ["a", "b", "c", "d"] and out["a"]["wt"] == out["b"]["wt"] == 0.5

"""The findings of round 3, one small test for each that was right."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import gates, numbers, predicates, units
from tessera.functions.text import bound
from tessera.operators import compounds, containment, delivery, documents, lineage, lookup, recovery
from tessera.plans import answers, backtrace, relational
from tessera.plans import recovery as recovered

QUERIES = answers.queries() | backtrace.queries() | relational.queries()


def plan_length(df):
    return len(df._jdf.queryExecution().analyzed().toString())


def test_rules_of_numbers_and_units_read_each_step_once(spark):
    """every rule of the ladder held a copy of all steps before it, so the plan was longer than any text should be."""
    df = spark.createDataFrame([("120", "wt%"), ("60000", "M"), ("5", "ppm")], "value string, unit string")
    told = df.select(bound(units.normalize_unit(F.col("unit")), lambda u: numbers.number_sanity(F.col("value"), u["family"], u["unit"])).alias("sanity"))
    assert [r[0] for r in told.collect()] == ["percent_over_100", "huge_integer_with_molarity_unit_likely_ref_id", "ok"]
    assert plan_length(told) < 40_000
    assert plan_length(df.select(numbers.value_cell(F.col("value"), F.col("unit")))) < 40_000
    assert plan_length(df.select(numbers.format_g(numbers.parse_number(F.col("value"))))) < 20_000


def executed(df):
    """The plan that was run in the end, after its rows are counted."""
    made = df._jdf.queryExecution()
    made.toRdd().count()
    return made.executedPlan().toString().split("== Initial Plan ==")[0]


def test_best_numbers_send_nothing_through_the_driver(spark):
    """F1: rows were joined with the best score of each, which the driver collected and hashed, and so were the properties."""
    asked = spark.createDataFrame([(1, "urea", [1, 2, 3]), (2, "zinc", [3, 2]), (3, None, [1]), (4, "x", [])], "row long, name string, cids array<long>")
    properties = spark.createDataFrame([(1, "urea hydrate", "a"), (2, "ureas", "b"), (3, None, "c")], "cid long, iupac string, formula string")
    found = compounds.best_number(asked, ["row"], "name", "cids", properties)
    assert "Broadcast" not in executed(found)
    got = {r["row"]: (r["cid"], round(r["score"], 6)) for r in found.collect()}
    assert got[1] == (2, round(8 / 9 + 0.08, 6)) and got[2] == (3, 0.15) and set(got) == {1, 2, 3}


def test_words_end_at_letters_of_other_alphabets(spark):
    """beside a letter such as ñ, Java saw no word's end where the SQL does, so a number among references was kept."""
    rows = [(1, ["5 ppm la\u00f1doi"], ["x"]), (2, ["5 mM\u00f1"], ["x"]), (3, ["5 ppm adoi"], ["x"])]
    got = {r["key"]: (r["found"], r["candidates"]) for r in recovery.recovered(spark.createDataFrame(rows, "key long, snippets array<string>, words array<string>"), "key", "snippets", "words").collect()}
    assert got == {1: (False, 0), 2: (True, 1), 3: (True, 1)}


@pytest.fixture
def traced(spark):
    records = spark.createDataFrame([(k, "A; b", "(x;y); a") for k in range(1, 1203)], "record long, m string, n string")
    entities = spark.createDataFrame([(5, "a"), (3, " A "), (9, "b"), (7, "none such"), (8, "n/a"), (4, "(x;y)")], "entity long, name string")
    return lineage.long_table(records, "record", ["m", "n"]), entities


def test_attached_records_are_all_of_them(traced):
    """the cell ended after 1,000 records."""
    long, entities = traced
    got = {r["entity"]: r for r in lineage.attach(entities, "entity", "name", lineage.full_index(long)).collect()}
    every = "|".join(map(str, range(1, 1203)))
    assert {k: (r["same_as"], r["n_items"], r["n_records"], r["records"]) for k, r in got.items()} == {
        3: (3, 2404, 1202, every), 5: (3, 2404, 1202, None), 9: (9, 1202, 1202, every), 4: (4, 1202, 1202, every), 7: (7, 0, 0, ""), 8: (8, 0, 0, "")}


def test_every_match_can_be_told_from_the_classes(traced):
    """F8: only counts were left of the matches."""
    long, entities = traced
    rows = lineage.pairs(entities, "entity", "name", long).collect()
    items = {}
    for r in rows:
        items.setdefault(r["entity"], []).append((r["record"], r["column"], r["item"]))
    whole = {r["entity"]: sorted(items[r["same_as"]], key=repr) for r in rows}
    a = sorted([(k, "m", 1) for k in range(1, 1203)] + [(k, "n", 2) for k in range(1, 1203)], key=repr)
    assert whole[3] == whole[5] == a and whole[9] == sorted([(k, "m", 2) for k in range(1, 1203)], key=repr)
    assert whole[7] == [(None, None, None)] and set(whole) == {3, 4, 5, 7, 9}


def test_index_holds_every_record(traced):
    """the records of a name were left out."""
    got = {r["key"]: r["records"].split("|") for r in lineage.full_index(traced[0]).collect()}
    assert got == {k: [str(i) for i in range(1, 1203)] for k in ("a", "b", "(x;y)")}


def test_identity_verdict_reads_tokens_once(spark):
    """every rule held its own copy of both names' tokens."""
    df = spark.createDataFrame([("graphene oxide", "methane", "", ""), ("urea", "Urea", "", "")], "a string, b string, c string, d string")
    told = df.select(predicates.identity_verdict(*map(F.col, "abcd")).alias("v"))
    assert [r[0] for r in told.collect()] == ["conflict_keyword_pair", "ok_exact_same"]
    text = told._jdf.queryExecution().analyzed().toString()
    assert text.count("array_intersect") == 2


def test_parts_of_one_alphabet_of_digits_meet_only_their_wholes(spark):
    """keys met in other keys on a few digits that they shared, as many pairs as parts times wholes over a hundred."""
    wholes = spark.range(3000).select(F.format_string("library/10.1234/tessera%09d.md", "id").alias("key"))
    parts = spark.range(0, 3000, 3).select(F.format_string("10.1234/tessera%09d", "id").alias("key"))
    found = containment.contained(parts, wholes, 3)
    got = {(r["part"], r["whole"]) for r in found.collect()}
    assert got == {(f"10.1234/tessera{i:09d}", f"library/10.1234/tessera{i:09d}.md") for i in range(0, 3000, 3)}
    heads, full, sizes = containment._filters(parts, 3)
    keys = [r["key"] for r in wholes.collect()]
    assert sizes.tolist() == [24] and len(containment._found(keys, heads, full, sizes, 3, 0.0)) < 1_100
    assert "Explode" not in found._jdf.queryExecution().executedPlan().toString()  # no marks of keys are rows


def test_equal_cells_are_taken_apart_once(spark):
    """each record's cells were taken apart again, however many records had the same ones."""
    records = spark.range(1, 400).select(F.col("id").alias("record"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("A; b"), (F.col("id") % 3).cast("string"))).alias("m"))
    long = lineage.long_table(records, "record", ["m"])
    rows = sorted((r["record"], r["item"], r["name"]) for r in long.collect())
    assert rows == sorted((k, i, n) for k in range(1, 400) if k % 3 for i, n in ((1, "A"), (2, f"b{k % 3}")))
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and plan.index("Join Inner") < plan.index("Aggregate [cell")


@pytest.mark.parametrize("name", ["st_align_gate", "s_tokens_bt", "x_json_loose", "j_density"])
def test_equal_inputs_are_judged_once(spark, name):
    """costly values were computed for each row, however many rows had the same inputs."""
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Aggregate [" in plan.split("Join Inner")[1]


def test_values_of_nulls_come_back(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", None), (4, "a", 1)], "row int, a string, b int")
    told = lookup.once_each(df, ["a", "b"], "v", F.concat_ws("-", "a", F.col("b").cast("string"))).collect()
    assert sorted((r["row"], r["a"], r["b"], r["v"]) for r in told) == [(1, "a", None, "a"), (2, None, None, ""), (3, "a", None, "a"), (4, "a", 1, "a-1")]


def test_captures_of_a_context_are_made_once(spark):
    """the names of all captures were made again for each capture, patterns were tried at every letter of contexts without the token, and all by as many tasks as the file had row groups."""
    rows = [("SDS", "Sodium dodecyl sulfate (SDS) acts. Sodium Dodecyl sulfate ( sds ) too. SDS (lauryl salt). SDS is sodium laurate"), ("TEA", "No brackets around TEA here"), ("x(", "a name (x() stays"), ("", "text"), (None, "a"), ("a", None)]
    df = spark.createDataFrame(rows, "token string, context string").select(gates.context_candidates(F.col("token"), F.col("context")).alias("x"))
    got = [[(x["candidate"], x["rule"]) for x in r["x"]] for r in df.collect()]
    assert got[0] == [("Sodium dodecyl sulfate", "full(abbr)"), ("lauryl salt", "abbr(full)"), ("sodium laurate", "definition")] and got[1] == [] and got[3:] == [[], [], []]
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract_all(") == 13
    plan = QUERIES["x_candidates_ctx"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan.split("Generate")[1]


def test_solvent_of_a_row_reads_each_column_once(spark):
    """a row's text was put together for every test of it, each column's solvent was sought twice, and all by as many tasks as the file had row groups."""
    rows = [("aqueous", None, "x"), ("aqueous", "Ethanol", "x"), ("organic", "h2o", " "), ("organic", None, "n-hexane"), ("", " ", None), (None, None, "toluene"), (None, "deionized  water", None)]
    df = spark.createDataFrame(rows, "phase string, `aqueous solvent` string, `organic solvent` string")
    told = df.select(recovery.row_solvent({n: F.col(f"`{n}`") for n in df.columns[1:]}, F.col("phase")).alias("s"))
    assert [r[0] for r in told.collect()] == ["water", "ethanol", "", "n-hexane", "", "", "water"]
    assert told._jdf.queryExecution().analyzed().toString().count("concat_ws(") == 2
    plan = recovered.queries()["n_solvent_row"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan


def test_title_is_sought_line_by_line(spark):
    """every one of a document's first 40 lines was cleaned, and the whole text cut into lines, for the first title among them."""
    rows = [(1, "# short\n\n ##  The Title of  it\nAnother longer line"), (2, "a\n" * 40 + "The line beyond the others"), (3, None), (4, "a\n" * 39 + "The fortieth line")]
    found = documents.catalog(spark.createDataFrame(rows, "doc_id long, content string"), "doc_id", F.lit("x.md"), "content")
    assert {r["doc_id"]: r["title_key"] for r in found.collect()} == {1: "thetitleofit", 2: "", 3: "", 4: "thefortiethline"}
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "aggregate(slice(split(" in plan and ", 41), 1, 40)" in plan


def test_numbers_are_found_in_one_pass(spark):
    """a text was searched for numbers four times, once for its pieces and once for each group."""
    texts = ["5 wt% MPD, 0.1 mM", "no number", "", "5 ppm", "own \ue000 marks 5 wt% \ue001 and 7 mM", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, content string")
    told = df.select("k", recovery.spans(F.col("content"), recovery.PATTERN, 2).alias("x"))
    got = {r["k"]: r["x"] and [(x["start"], x["stop"], texts[r["k"]][x["start"] : x["stop"]], x["g1"], x["g2"]) for x in r["x"]] for r in told.collect()}
    assert got == {0: [(0, 5, "5 wt%", "5", "wt%"), (11, 17, "0.1 mM", "0.1", "mM")], 1: [], 2: [], 3: [(0, 5, "5 ppm", "5", "ppm")], 4: [(12, 17, "5 wt%", "5", "wt%"), (24, 28, "7 mM", "7", "mM")], 5: None}
    assert "regexp_replace(content" in told._jdf.queryExecution().analyzed().toString()


def test_equal_slots_are_taken_apart_once(spark, monkeypatch):
    """F16: every slot was taken apart, resolved and converted by itself, and that once for each of the joins on names and units."""
    rows = [(k, "aqueous_monomer", "MPD; NaCl", "2; 0.5", "wt%", None if k % 2 else "plain") for k in range(40)]
    rows += [(40, "additive", None, "5", None, ""), (41, "additive", "", "", "", "x"), (0, "test_nacl", "MPD; NaCl", "2; 0.5", "wt%", "plain")]
    slots = spark.createDataFrame(rows, "row_id int, slot string, solutes string, values string, units string, sample string")
    table = [(0, "NaCl", "sodium chloride", "", "NaCl", "2", "58.44")]
    known = lookup.build_identity(spark.createDataFrame(table, "row int, original string, standard string, iupac string, formula string, cid string, mw string"))
    taken, items = [], delivery.items
    monkeypatch.setattr(delivery, "items", lambda df: taken.append(df) or items(df))
    told = delivery.review(slots, known, context="sample")
    assert told.columns[:7] == ["row_id", "slot", "sample", "item_index", "solute", "value", "unit"]
    got = sorted(((r["row_id"], r["slot"], r["item_index"], r["solute"], r["mw"], r["wt"]) for r in told.collect()), key=str)
    expected = [(k, "aqueous_monomer", *x) for k in range(40) for x in [(1, "MPD", None, 2.0), (2, "NaCl", 58.44, 0.5)]]
    expected += [(0, "test_nacl", 1, "NaCl", 58.44, 2.0), (0, "test_nacl", 2, "NaCl", 58.44, 0.5), (40, "additive", 1, "", None, None)]
    assert got == sorted(expected, key=str)
    assert [df.count() for df in taken] == [5]


def test_rows_meet_their_slots_without_a_pivot(spark):
    """each slot was a row of all the columns of the pivot while it was sorted, and the wide rows were sorted again for a join."""
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "row_id long")
    slots = [(1, "additive", "2;3", 3, 2, "PARTIAL"), (1, "test_nacl", "", 1, 0, "FAIL"), (2, "modifier", "1", 1, 1, "OK"), (9, "additive", "1", 1, 1, "OK"), (3, "no such slot", "1", 1, 1, "OK"), (None, "additive", "1", 1, 1, "OK")]
    wide = delivery.delivery_main(rows, spark.createDataFrame(slots, "row_id long, slot string, wt_values string, n_items long, n_ok long, slot_status string"))
    assert wide.columns[:5] == ["row_id", *[f"{delivery.SLOT_NAMES[0]}_{x}" for x in ("wt", "items", "ok", "status")]] and len(wide.columns) == 21
    got = sorted((r["row_id"] or 0, r["additive_wt"], r["additive_items"], r["test_nacl_status"], r["modifier_ok"]) for r in wide.collect())
    assert got == [(0, "", 0, "", 0), (1, "2;3", 3, "FAIL", 0), (2, "", 0, "", 1), (2, "", 0, "", 1), (3, "", 0, "", 0)]
    assert "Join" not in executed(wide)


def test_parts_are_dealt_before_their_slots(spark):
    """a file of parts is read by one task or a few, which then took all its slots apart."""
    assert relational.slots(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

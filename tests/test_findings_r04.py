"""The findings of round 4, one small test for each that was right."""

import pytest

from tessera.operators import delivery
from tessera.plans import answers, backtrace, relational

QUERIES = answers.queries() | backtrace.queries() | relational.queries()


def executed(df):
    """The plan that was run in the end, after its rows are counted."""
    made = df._jdf.queryExecution()
    made.toRdd().count()
    return made.executedPlan().toString()


@pytest.mark.parametrize("name", ["st_review", "st_align_gate", "s_tokens_bt", "x_json_loose", "j_density"])
def test_rows_of_a_small_file_are_not_broadcast(spark, name):
    """five slots of each part looked as small as the file of parts, so all of them went through the driver."""
    assert "Broadcast" not in executed(QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_whole_summary_of_a_slot_is_delivered(spark):
    """the line of a row left out which items failed and what is to be looked at, and values by assumption counted as OK."""
    kinds = [("additive", 2, 1.5, "RULE_NORMALIZED_CONVERTED", False), ("additive", 10, None, "FAILED_PARSE", False), ("additive", 3, None, "FAILED_PARSE", None)]
    kinds += [("modifier", 1, 2.0, "ASSUMED_CONVERTED", False), ("test_nacl", 1, None, "NEED_TRACEBACK", True), ("aqueous_monomer", 1, 3.0, "RULE_NORMALIZED_CONVERTED", None)]
    reviewed = spark.createDataFrame([(1, *k) for k in kinds], "row_id long, slot string, item_index long, wt double, status string, review boolean")
    r = delivery.delivery_main(spark.createDataFrame([(1,)], "row_id long"), delivery.slot_delivery(reviewed)).collect()[0]
    got = {s: tuple(r[f"{s}_{x}"] for x in ("wt", "items", "ok", "status", "failed", "review")) for s in delivery.SLOT_NAMES}
    assert len(r) == 31 and got == {
        "additive": ("1.5", 3, 1, "PARTIAL", "3;10", False), "modifier": ("2", 1, 1, "REVIEW", "", True), "test_nacl": ("", 1, 0, "FAIL", "1", True),
        "aqueous_monomer": ("3", 1, 1, "OK", "", False), "organic_monomer": ("", 0, 0, "", "", False)}

"""The findings of round 4 on the operators for training data, one small test for each that was right."""

from tessera.llm import anagram_join


def test_keys_of_names_are_not_broadcast(spark):
    """a name makes a hundred keys, but the names alone looked small, so the keys of all vendors went through the driver."""
    clients = spark.createDataFrame([(1, "Anna Berg"), (2, "Anan Berg"), (3, "Nils Holm"), (4, None), (5, "Anna Bergs")], "client_id long, name string")
    vendors = spark.createDataFrame([(1, "Anna Berg"), (2, "Nils Hölms"), (3, "")], "vendor_id long, name string")
    found = anagram_join.join(clients, "client_id", "name", vendors, "vendor_id", "name")
    got = sorted((r["right_id"], r["distance"], r["n"], r["first_id"]) for r in found.collect())
    assert got == [(1, 0, 1, 1), (1, 1, 2, 2), (2, 2, 1, 3)]
    made = found._jdf.queryExecution()
    made.toRdd().count()
    assert "Broadcast" not in made.executedPlan().toString()

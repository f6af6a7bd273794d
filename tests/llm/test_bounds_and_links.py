"""Bounds that the n-gram join rests on, and which tags of a page are links."""

import numpy as np
import pytest

from tessera.llm import parity_join, url_filter


@pytest.mark.parametrize("percent", [60, 80, 85, 99])
def test_a_settled_partner_is_in_the_family(percent):
    measure = parity_join.Measure(4, percent)
    for a in range(1, 500):
        sizes = np.arange(-(-a * percent // 100), a * 100 // percent + 1)  # of sets that may link with one of size a
        farthest = 2 * measure.partner_difference(a)
        assert measure.settled(a, farthest)
        assert measure.in_family(sizes, farthest + measure.most_apart(a + sizes)).all()


def brute(sets, percent):
    least = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    return least


def test_chains_across_size_bands(spark):
    """Sets that grow from link to link, from one band of sizes into the next but one."""
    words = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(words[: 60 + 8 * i])) for i in range(40)] + [(100 + i, " ".join(words[300 + 40 * i : 420 + 45 * i])) for i in range(6)]
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    found = {r["doc_id"]: r["component_id"] for r in parity_join.components(spark.createDataFrame(rows, "doc_id long, text string"), parity_join.Measure(4, 85)).collect()}
    assert found == brute(sets, 85)


@pytest.mark.parametrize(("html", "joined"), [
    ('<link rel="canonical" href="http://b.net/x">', True), ("<LINK HREF='http://b.net/x' REL=Canonical>", True), ('<link rel="alternate canonical" href="http://b.net/x">', True),
    ('<link rel="canonical" data-href="http://b.net/x">', False), ('<link data-rel="canonical" href="http://b.net/x">', False), ('<link rel="canonicals" href="http://b.net/x">', False),
    ('<!-- <link rel="canonical" href="http://b.net/x"> -->', False), ('<!-- a --><link rel=canonical href=http://b.net/x>', True), ('<!-- <link rel="canonical" href="http://b.net/x">', False),
    ('<meta http-equiv="refresh" content="0; url=http://b.net/x">', True), ('<meta data-http-equiv="refresh" content="0; url=http://b.net/x">', False), ('<linker rel="canonical" href="http://b.net/x">', False),
])
def test_which_tags_join(spark, html, joined):
    pages = spark.createDataFrame([(1, "http://a.net/", html), (2, "http://b.net/x", "")], "page_id long, url string, html string")
    assert bool(url_filter.page_edges(pages).collect()) == joined

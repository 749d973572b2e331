"""Long walks, links seen in earlier runs and keyword search against plain versions."""

import re

import numpy as np
import pytest

from offerquarry.operators.walk import follow_links
from offerquarry.operators.words import search_index, word_index
from offerquarry.sources import seen_store


def plain_walk(links, start, most=None):
    """First visits in order; a page captured twice counts by its lowest id."""
    known = {}
    for page_id, url, ahead in sorted(links, reverse=True):
        known[url] = (page_id, ahead)
    found, url = [], start
    while url in known and url not in [u for u, _ in found] and (most is None or len(found) < most):
        found.append((url, known[url][0]))
        url = known[url][1]
    return [(n, u, p) for n, (u, p) in enumerate(found, 1)]


@pytest.mark.parametrize("most", [None, 1, 5, 8])
def test_walks_of_any_length(spark, most):
    rng = np.random.default_rng(3)
    rows, starts, expected = [], [], []
    for search in range(12):
        n = int(rng.integers(1, 40))
        order = rng.permutation(n)
        links = [(int(100 * search + i), f"u{a}", f"u{b}") for i, (a, b) in enumerate(zip(order, order[1:]))]
        # The last page ends the walk, leads to a page not captured, to itself, or back.
        ends = ["", None, "nowhere", f"u{order[-1]}", f"u{order[n // 2]}"]
        links.append((100 * search + 99, f"u{order[-1]}", ends[search % 5]))
        links.append((100 * search + 98, links[0][1], "other"))  # captured twice
        rows += [(f"s{search}", *link) for link in links]
        starts.append((f"s{search}", f"u{order[0]}"))
        expected += [(f"s{search}", *v) for v in plain_walk(links, f"u{order[0]}", most)]
    starts += [("none", "u1"), starts[0]]
    found = follow_links(
        spark.createDataFrame(starts, "search_id string, start_url string"),
        spark.createDataFrame(rows, "search_id string, page_id long, url string, next_href string"),
        most,
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_no_walks(spark):
    starts = spark.createDataFrame([], "search_id string, start_url string")
    links = spark.createDataFrame([], "search_id string, page_id long, url string, next_href string")
    assert follow_links(starts, links).collect() == []


def listings(rows, spark):
    return spark.createDataFrame(rows, "search_id string, page_no long, pos long, link string, titel string")


@pytest.mark.parametrize("words", [seen_store.MOST_WORDS, 0])
def test_runs_add_up_to_one(spark, tmp_path, monkeypatch, words):
    monkeypatch.setattr(seen_store, "MOST_WORDS", words)
    rng = np.random.default_rng(5)
    rows = [
        (f"s{rng.integers(3)}", int(page), int(pos), f"l{rng.integers(60)}" if rng.random() < 0.9 else None, f"{page}-{pos}")
        for page in range(9) for pos in range(20)
    ]
    folder = str(tmp_path / "seen")
    found = []
    for first in (0, 3, 6):
        part = [r for r in rows if first <= r[1] < first + 3]
        found += [tuple(r) for r in seen_store.new_links(listings(part, spark), folder).collect()]
    once = {}
    for r in rows:
        once.setdefault((r[0], r[3]), r)
    assert sorted(found, key=str) == sorted(once.values(), key=str)
    assert seen_store.new_links(listings(rows, spark), folder).count() == 0
    assert seen_store.new_links(listings([], spark), folder).count() == 0


def test_the_filter_holds_all_keys_and_few_others(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS link")
    bits = seen_store.BITS_A_KEY * 2000
    words = seen_store.bloom_words(keys, bits)
    assert words.count() <= bits / 64 + 1
    assert seen_store.may_be_in(keys, ["link"], words, bits).count() == 2000
    others = spark.range(2000).selectExpr("concat('x', id) AS link")
    assert seen_store.may_be_in(others, ["link"], words, bits).count() < 100


def test_keywords_are_whole_words(spark):
    titles = ["Hundred red shoes", "RED widget", "red, red RED", "ünï Skischuhe 42", "", None, "widget-red"]
    rows = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    asked = ["red", "widget RED", "shoe", "ÜNÏ 42", "", "red hundred shoes gone", "red red", None]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    found = search_index(word_index(rows, ["id"]), queries, ["id"])
    expected = set()
    for q, text in enumerate(asked):
        words = set(re.findall(r"\w+", (text or "").lower()))
        for i, title in enumerate(titles):
            if words and words <= set(re.findall(r"\w+", (title or "").lower())):
                expected.add((q, i))
    rows_found = [tuple(r) for r in found.collect()]
    assert set(rows_found) == expected and len(rows_found) == len(expected)

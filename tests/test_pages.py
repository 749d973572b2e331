import os
import subprocess
import sys

import pytest
from pyspark.sql import SparkSession

from offerquarry import run_search
from offerquarry.operators.cards import (
    Selectors,
    explode_cards,
    extract_pages,
    raw_listings,
)
from offerquarry.operators.dedupe import seen_links
from offerquarry.operators.walk import page_walk
from offerquarry.plans.search import (
    offers_found,
    page_stats,
    read_search,
    save_search,
    start_urls,
)
from offerquarry.sources.pages import read_html_files

pytestmark = pytest.mark.usefixtures("spark")

# An advertisement first, then one link under two titles, and another link.
DUPLICATES = """
<div class="s-item"><a class="s-item__link" href="https://m.example/itm/7?x=1">
  <h3 class="s-item__title">Sponsored</h3></a></div>
<div class="s-item"><a class="s-item__link" href="https://m.example/itm/7?x=1">
  <h3 class="s-item__title">Stock 120 cm</h3></a><span class="s-item__price">EUR 8</span></div>
<div class="s-item"><a class="s-item__link" href="https://m.example/itm/9">
  <h3 class="s-item__title">Helm</h3></a><span class="s-item__price">CHF 31.50</span></div>
<div class="s-item"><a class="s-item__link" href="https://m.example/itm/7?x=1">
  <h3 class="s-item__title">Stock, rot</h3></a><span class="s-item__price">EUR 9,90</span></div>
"""


def read(html, **selectors):
    """Cards (fields that are empty left out) and next link of one page."""
    spark = SparkSession.active()
    page = extract_pages(spark.createDataFrame([(html,)], "html string"), Selectors(**selectors))
    found = page.first()
    cards = [card.asDict() for card in found.cards]
    for card in cards:
        card |= {r: [card[f"{r}_text"]] for r in ("title", "price") if card[f"{r}_text"]}
    return cards, found.next_href


def titles(html, **selectors):
    return [" ".join(c.get("title", ())) for c in read(html, **selectors)[0]]


@pytest.mark.parametrize(
    "html, href",
    [
        ('<nav><a href="/1">1</a><a class="x pagination__next" href="/s?_pgn=3">></a></nav>', "/s?_pgn=3"),
        ('<!-- <a class="pagination__next" href="/no"> --><p>Ende</p>', None),
        ('<a rel="next" href="/p">x</a><a aria-label="Weiter" href="/q">y</a>', "/p"),
        ('<a rel="next nofollow" href="/p">x</a>', None),
        ('<a class="pagination__next">x</a><a rel="next" href="/p">y</a>', None),
        ("<a class='pagination__next' href=/p?a=1&amp;b=2>x", "/p?a=1&b=2"),
    ],
)
def test_next_link(html, href):
    assert read(html)[1] == href


def test_first_match_is_by_document_order():
    card = (
        '<li class="s-card"><h3 class="s-item__title">second kind</h3>'
        '<div class="s-card__title"><span class="su-styled-text primary default">'
        "first kind</span></div></li>"
    )
    assert titles(card) == ["second kind"]


def test_text_skips_comments_scripts_and_joins_pieces():
    card = (
        '<li class="s-item"><h3 class="s-item__title"> A<!-- c -->B <b>C&amp;D</b>'
        "<script>x</script><style>y</style> &euro;&#233;&#x80; </h3></li>"
    )
    assert titles(card) == ["A B C&D €é€"]


def test_broken_markup_is_read_tolerantly():
    assert titles("<li class=s-item><h3 class='s-item__title'>A < B & C</li>") == ["A < B & C"]
    assert titles('<li class="s-item"><p><b><h3 class="s-item__title">A</li>x') == ["A"]
    assert titles('<li class="s-item"><h3 class="s-item__title">A') == ["A"]


def test_nested_cards_share_inner_tags():
    html = (
        '<div class="s-card"><li class="s-item"><h3 class="s-item__title">A</h3></li></div>'
    )
    assert titles(html) == ["A", "A"]


def test_ancestor_may_lie_above_the_card():
    html = '<div class="s-card__title"><li class="s-item"><i class="su-styled-text">A</i></li></div>'
    assert titles(html) == ["A"]


def test_first_link_without_address_counts():
    html = (
        '<li class="s-item"><a class="s-item__link">x</a>'
        '<a class="s-item__link" href="/itm/1">y</a></li>'
    )
    assert read(html)[0][0]["href"] is None


def test_custom_selectors_read_other_layouts():
    html = (
        '<li class="brw__item-card card--list"><h3 class="brw__title">Gitarre</h3>'
        '<span class="bsig__price">CHF 159,61 bis CHF 191,78</span></li>'
    )
    assert read(html)[0] == []
    found = read(html, card="li.brw__item-card", title=".brw__title", price=".bsig__price")
    assert found[0][0]["price"] == ["CHF 159,61 bis CHF 191,78"]


def pages_of(spark, *rows):
    return spark.createDataFrame(
        list(rows), "search_id string, page_id long, url string, html string"
    )


def test_listings_of_a_page(spark):
    html = """<div class="s-card"><a href="https://m.example/itm/1?_skw=x&amp;y=2">
      <img class="s-card__image" src="" data-src="a.jpg 1x, b.jpg 2x"></a>
      <div class="s-card__title"><span class="su-styled-text primary default">Ski &ndash;
      wird in neuem Fenster oder Tab geöffnet</span></div>
      <div class="s-card__attribute-row"><span class="s-card__price">CHF 5</span></div>
      <div class="s-card__attribute-row">
        <span class="su-styled-text secondary large">+CHF 3.47 Versand</span></div>
      <div class="s-card__attribute-row">
        <span class="su-styled-text secondary large">aus Deutschland</span></div></div>
      <li class="s-item"><h3 class="s-item__title">Anzeige</h3><a href="/itm/2">x</a></li>
      <li class="s-item"><h3 class="s-item__title">no item</h3><a href="/help">x</a></li>
      <li class="s-item"><h3 class="s-item__title">no link</h3></li>
      <li class="s-item"><a href="/itm/3">no title</a></li>"""
    cards = explode_cards(extract_pages(pages_of(spark, ("s", 1, "u", html))))
    (row,) = raw_listings(cards).drop("search_id", "page_id", "url").collect()
    assert tuple(row) == (
        0, "Ski –", "", "CHF 5",
        "aus Deutschland", "+CHF 3.47 Versand", "https://m.example/itm/1?_skw=x&y=2", "a.jpg",
    )


def test_seen_links_keep_the_first(spark):
    from pyspark.sql import functions as F

    pages = pages_of(
        spark, ("a", 1, "u", DUPLICATES), ("a", 2, "v", DUPLICATES), ("b", 3, "u", DUPLICATES),
        ("b", 4, "w", "<p>nothing</p>"),
    )
    extracted = extract_pages(pages)
    cards = explode_cards(extracted).withColumn("page_no", F.col("page_id"))
    listings = seen_links(raw_listings(cards))
    rows = listings.orderBy("page_id", "pos").collect()
    assert [(r.search_id, r.page_id, r.titel) for r in rows] == [
        ("a", 1, "Stock 120 cm"), ("a", 1, "Helm"), ("b", 3, "Stock 120 cm"), ("b", 3, "Helm"),
    ]
    stats = page_stats(extracted, listings).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in stats] == [(1, 4, 2), (2, 4, 0), (3, 4, 2), (4, 0, 0)]
    searches = spark.createDataFrame([("a",), ("b",), ("c",)], "search_id string")
    counts = offers_found(searches, listings).orderBy("search_id").collect()
    assert [tuple(r) for r in counts] == [("a", 2), ("b", 2), ("c", 0)]


def links_of(spark, *rows):
    return spark.createDataFrame(
        list(rows), "search_id string, url string, page_id long, next_href string"
    )


def test_page_walk(spark):
    starts = spark.createDataFrame(
        [("long", "1"), ("loop", "1"), ("gone", "1"), ("none", "x")],
        "search_id string, start_url string",
    )
    chain = [("long", str(n), n, str(n + 1)) for n in range(1, 8)]
    loop = [("loop", "1", 11, "2"), ("loop", "2", 12, "1")]
    gone = [("gone", "1", 21, "2"), ("gone", "2", 22, "missing"), ("gone", "1", 23, "3")]
    links = links_of(spark, *chain, *loop, *gone, ("none", "1", 31, ""))
    found = [tuple(r) for r in page_walk(starts, links).collect()]
    assert sorted(found) == [
        ("gone", 1, "1", 21),
        ("gone", 2, "2", 22),
        ("long", 1, "1", 1),
        ("long", 2, "2", 2),
        ("long", 3, "3", 3),
        ("long", 4, "4", 4),
        ("loop", 1, "1", 11),
        ("loop", 2, "2", 12),
        ("loop", 3, "1", 11),
        ("loop", 4, "2", 12),
    ]
    assert page_walk(starts, links, max_pages=6).where("search_id = 'long'").count() == 6


def offer(n, link):
    return (
        f'<li class="s-item"><a class="s-item__link" href="https://m/itm/{link}?_skw=ski">'
        f'<h3 class="s-item__title">Ski {n}</h3></a>'
        f'<span class="s-item__price">EUR {n},50</span></li>'
    )


def test_search_from_request_to_clean_table(spark, tmp_path):
    requests = spark.createDataFrame(
        [("s", "ski schuhe", "99"), ("t", "nichts", "")],
        "search_id string, query string, max_price string",
    )
    (start, _) = [r.start_url for r in start_urls(requests).orderBy("search_id").collect()]
    after = '<a class="pagination__next" href="http://p/2">Weiter</a>'
    pages = pages_of(
        spark,
        ("s", 1, start, offer(1, 1) + offer(2, 2) + after),
        ("s", 2, "http://p/2", offer(3, 2) + offer(4, 4)),
        ("s", 3, "http://p/unvisited", offer(9, 9)),
    )
    result = run_search(requests, pages)
    rows = result.raw.orderBy("page_no", "pos").collect()
    assert [(r.titel, r.land, r.versand) for r in rows] == [
        ("Ski 1", "aus Schweiz", ""),
        ("Ski 2", "aus Schweiz", ""),
        ("Ski 4", "aus Schweiz", ""),
    ]
    clean = result.clean.orderBy("page_no", "pos").collect()
    assert [(r.price, r.currency, r.product_name, r.product_condition) for r in clean] == [
        (n + 0.5, "EUR", "Ski", "keine Angabe") for n in (1, 2, 4)
    ]
    assert [tuple(r) for r in offers_found(result.raw.select('search_id').distinct(), result.raw).collect()] == [("s", 3)]

    save_search(result, str(tmp_path))
    assert read_search(spark, str(tmp_path)).count() == 3
    one = read_search(spark, str(tmp_path), "s")
    assert one.count() == 3 and read_search(spark, str(tmp_path), "t").count() == 0
    assert "EqualTo(search_id,s)" in one._jdf.queryExecution().executedPlan().toString()


def test_pages_are_parsed_without_a_shuffle(spark):
    plan = extract_pages(pages_of(spark, ("s", 1, "u", "")))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_text(DUPLICATES, encoding="utf-8")
    (row,) = read_html_files(spark, str(tmp_path)).collect()
    assert row.html == DUPLICATES and row.url.endswith("a.html")


def test_repeated_link_held_by_most_rows(spark):
    """A link on every page: one row per task goes through the shuffle."""
    from pyspark.sql import functions as F

    rows = spark.range(20000).select(
        F.lit("s").alias("search_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("link"),
        (F.col("id") % 100 + 1).alias("page_no"),
        F.col("id").alias("pos"),
    )
    kept = seen_links(rows)
    assert kept.count() == 1 + 20000 - 6667
    assert kept.where("link = 'hot'").first().pos == 0
    assert kept._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


def test_executors_need_no_installed_package(tmp_path):
    """Run from another folder: workers cannot import the package from theirs."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from offerquarry import extract_pages\n"
        "spark = SparkSession.builder.master('local[2]')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "pages = spark.createDataFrame([('<li class=\"s-card\">',)], 'html string')\n"
        "assert len(extract_pages(pages).first().cards) == 1\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=120,
    )
    assert done.returncode == 0, done.stderr[-2000:]

"""Queries and steps that must do their whole job, on rows built here."""

import pathlib
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import feeds, queries
from checks.oracles import ORACLES
from checks.queries import QUERIES
from offerquarry import fixed
from offerquarry.functions import money
from offerquarry.operators import dedupe, walk, words
from offerquarry.operators.cards import Selectors, extract_pages
from offerquarry.operators.markup import TagList
from offerquarry.sources import listing_files, pages, shared

# Order key and product name of line items that all have one part, supplier and nation each.
NAMES = {8: "red widget", 2: "red gear", 3: "blue widget", 7: "red widget", 14: "red widget", 28: "green gear"}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))

    def table(name, rows, kinds):
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    table("nation", [(8, "INDIA")], "n_nationkey int, n_name string")
    table("supplier", [(4, 8)], "s_suppkey long, s_nationkey int")
    table(
        "part", [(key, name, "SMALL BRASS", 900.0 + key) for key, name in NAMES.items()],
        "p_partkey long, p_name string, p_type string, p_retailprice double",
    )
    table(
        "lineitem", [(key, n, key, 4, 10.0 * key + n) for key in NAMES for n in (1, 2)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double",
    )
    table(
        "orders", [(key, key % 5, "O", "1-URGENT", 1000.5 + key) for key in range(36)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double",
    )
    return folder


def test_keyword_filter_takes_all_titles_with_both_words(spark, tables):
    found = QUERIES["keyword_filter"](spark, tables).collect()
    assert {r.l_orderkey for r in found} == {7, 8, 14}
    assert "contains(lower(title), 'neuem')" not in ORACLES["keyword_filter"]


def test_tags_with_new_addresses_are_told_by_their_form():
    tags = TagList(["a.x", "a[href*='/itm/']", ".card"], [])
    tried = []
    tags._passed = lambda name, attrs, real=tags._passed: tried.append(name) or real(name, attrs)
    for n in range(50):
        tags.add(f"<div class='card'><a class=x href='/{'itm' if n % 2 else 'help'}/{n}'>t</a></div><a>u</a>")
    assert tried == ["div", "a", "a"]
    assert tags.fits[:2] == [4, 1] and tags.fits[2:4] == [4, 3]
    assert tags.within[:2] == [0, 4]


def test_long_chains_of_steps(spark):
    html = "<div class=a><p class=b><a href=1></a></p></div><p class=b><a href=2></a><i class=a><a href=3></a></i></p>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    chosen = Selectors(card="", title="", price="", attribute="", condition="", link="", image="", next=".a .b a")
    assert extract_pages(pages, chosen).head().next_href == "1"
    chosen = replace(chosen, next=".b .a a, .x a")
    assert extract_pages(pages, chosen).head().next_href == "3"


def test_scrape_stats_reads_pages_once(spark, tables, monkeypatch):
    read = []
    real = queries.extract_pages
    monkeypatch.setattr(queries, "extract_pages", lambda *args: read.append(1) or real(*args))
    found = {r.page_id: (r.cards_found, r.usable_offers) for r in QUERIES["scrape_stats"](spark, tables).collect()}
    assert len(read) == 1
    assert set(found) == set(range(36)) and {cards for cards, _ in found.values()} == {6}
    assert found[0] == (6, 2) and found[4] == (6, 1)  # the link of page 4 is that of page 1


def test_one_file_is_made_by_many_tasks(spark, tmp_path):
    values = ["a", None, "", ' "neu",\nx', "a,b", '"', " pad ", "é€", "\\", "a\n\nb", "NA"]
    rows = spark.createDataFrame([(v,) * 7 for v in values], ", ".join(f"{f} string" for f in fixed.RAW_FIELDS))
    plain, one = str(tmp_path / "plain"), str(tmp_path / "one")
    listing_files.write_raw_csv(rows.coalesce(1), plain)
    listing_files.write_raw_csv(rows.coalesce(1), one, one_file=True)
    texts = [[p.read_bytes() for p in (tmp_path / d).glob("part-*")] for d in ("plain", "one")]
    assert len(texts[1]) == 1 and texts[1] == texts[0]
    listing_files.write_raw_csv(rows.repartition(4), one, one_file=True)
    assert [len(p.read_bytes()) for p in (tmp_path / "one").glob("part-*")] == [len(texts[0][0])]
    listing_files.write_raw_csv(rows.limit(0), one, one_file=True)
    assert [p.read_text() for p in (tmp_path / "one").glob("part-*")] == [",".join(fixed.RAW_FIELDS) + "\n"]


def test_derived_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(feeds, "ROWS_A_TASK", 100)
    cores = spark.sparkContext.defaultParallelism
    assert feeds._dealt(spark.range(100 * cores + 250)).rdd.getNumPartitions() == cores + 3
    assert feeds._dealt(spark.range(5)).rdd.getNumPartitions() == cores


def test_long_walk_moves_numbers(spark, monkeypatch):
    stored = {}
    real = walk.write_and_read
    monkeypatch.setattr(walk, "write_and_read", lambda df, name: stored.setdefault(name, df.columns) and real(df, name))
    links = [("s", f"/{n}", n, f"/{n + 1}") for n in range(5)] + [("s", "/5", 5, "/2")]
    links = spark.createDataFrame(links, "search_id string, url string, page_id long, next_href string")
    starts = spark.createDataFrame([("s", "/0")], "search_id string, start_url string")
    found = walk.follow_links(starts, links).collect()
    assert sorted((r.page_no, r.url, r.page_id) for r in found) == [(n + 1, f"/{n}", n) for n in range(6)]
    assert stored["jumps"] == ["id", "ahead"] and stored["reached"] == ["id", "page_no"]


def test_keyword_postings_meet_without_a_join_by_query(spark):
    rows = spark.createDataFrame([(1, "red ski new"), (2, "red new"), (3, "ski red"), (None, "red ski")], "id int, title string")
    asked = [("a", "RED ski"), ("b", "new red"), ("c", "ski"), ("d", "red boot"), ("e", "")]
    found = words.search_index(words.word_index(rows, ["id"]), spark.createDataFrame(asked, "query_id string, query string"), ["id"])
    pairs = sorted(((r.query_id, r.id) for r in found.collect()), key=str)
    assert pairs == [("a", 1), ("a", 3), ("b", 1), ("b", 2), ("c", 1), ("c", 3), ("c", None)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "count(1) AS met" not in plan


def test_file_keys_are_made_once_a_file(spark, tmp_path):
    rows = spark.createDataFrame([(str(n),) * 7 for n in range(50)], ", ".join(f"{f} string" for f in fixed.RAW_FIELDS))
    path = str(tmp_path / "keys")
    listing_files.write_raw_csv(rows.repartition(3), path)
    raw = listing_files.read_raw_csv(spark, path, keep_order=True)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    _, below = plan.split("0*([0-9]{20,})")  # the key is in the plan once, over the stored splits
    assert "parquet" in below and "MapInArrow" not in below
    assert raw.select("source_file").distinct().count() == 3 and raw.count() == 50


def test_good_rows_alone_store_nothing(spark, tables, monkeypatch):
    def stored(*args):
        raise AssertionError("the derived rows were stored")

    monkeypatch.setattr(queries.cleaning, "write_and_read", stored)
    good = QUERIES["clean_good_rows"](spark, tables)
    assert "xxhash64" in good._jdf.queryExecution().optimizedPlan().toString()
    assert {r.l_orderkey for r in good.collect()} == {2, 3, 7, 8, 14, 28}


def test_hashed_keys_keep_the_first_row_of_equal_ones(spark):
    rows = [(0.0, "a", 2), (-0.0, "a", 1), (float("nan"), None, 4), (float("nan"), None, 3), (None, "a", 5), (None, None, 6)]
    kept = dedupe.keep_first(spark.createDataFrame(rows, "x double, t string, n int"), ["x", "t"], ["n"])
    assert sorted(r.n for r in kept.collect()) == [1, 3, 5, 6]


def test_amounts_try_a_pattern_once(spark):
    assert str(money.parse_number_eu(F.col("x"))).count("[0-9]{0,3})") == 1
    texts = ["CHF 1234,50 bis CHF 1234,99", ",", "a,b", ".", "1.2.3,4", "x 1  ", "é1'2€ü3,4567", None]
    made = spark.createDataFrame([(t,) for t in texts], "x string").select(money.parse_number_eu(F.col("x")))
    assert [r[0] for r in made.collect()] == [1234501234.99, None, None, None, 123.4, 1.0, 1234567.0, None]


def test_captured_files_are_written_by_tasks_and_read_many_to_a_task(spark, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "captured"), []
    table = [(1, "<p>a</p>"), (2, None), (3, "ä\n<b>"), (3, "ä\n<b>"), (None, "x")]
    pages.write_pages(spark.createDataFrame(table, "capture long, html string"), folder)
    texts = {p.parent.name: p.read_text() for p in (tmp_path / "captured").rglob("*") if p.is_file()}
    assert texts == {"capture=1": "<p>a</p>\n", "capture=2": "\n", "capture=3": "ä\n<b>\nä\n<b>\n", "capture=__HIVE_DEFAULT_PARTITION__": "x\n"}
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([b"y"])], ["capture", "html"])
    for _ in range(2):  # as of a task that is tried again
        assert list(pages._write_files(iter([batch]), folder, "part-1.txt"))[0].to_pydict() == {"files": [1]}
    assert [p.name for p in (tmp_path / "captured" / "capture=7").iterdir()] == ["part-1.txt"]

    store = pages.write_and_read
    monkeypatch.setattr(pages, "write_and_read", lambda *a: (seen.append(int(spark.conf.get(pages.OPEN_COST))), store(*a))[1])
    before = spark.conf.get(pages.OPEN_COST)
    files = pages.captured_files(spark, folder)
    manifest = files.selectExpr("file", "'s' AS search_id", "file AS url")
    done = str(tmp_path / "done")
    assert pages.new_captures(spark, folder, manifest, done, files).count() == 5
    assert seen == [pages.OPEN_BYTES] * 2 and spark.conf.get(pages.OPEN_COST) == before
    assert pages.new_captures(spark, folder, manifest, done, files).count() == 0


def test_roundtrip_sorts_before_texts_are_made_and_keeps_no_files(spark, tables):
    plan = feeds.ordered_listings(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "RoundRobin" not in plan
    assert plan.index("neuem Fenster") < plan.index("rangepartitioning")  # the upper step comes first
    in_order = [r.asDict() for r in feeds.ordered_listings(spark, tables).collect()]
    assert in_order == [r.asDict() for r in feeds.listings(spark, tables).orderBy(*feeds.LISTING_ORDER).collect()]
    before = len(QUERIES["raw_roundtrip"](spark, tables).collect())
    folder = pathlib.Path(shared._session_folder(spark).removeprefix("file://"))
    assert before and not list(folder.glob("raw-roundtrip-*"))


def test_packed_files_keep_rows_and_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing_files, "ROWS_A_FILE", 4)
    rows = [(f' "{n}",\nä', *["x"] * 6) for n in range(50)]
    table = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fixed.RAW_FIELDS)).coalesce(1)
    path = tmp_path / "packed"
    listing_files.write_raw_csv(table, str(path), packed=True)
    assert len(list(path.glob("*.csv.gz"))) == 13 and not list(path.glob("*.csv"))
    raw = listing_files.read_raw_csv(spark, str(path), keep_order=True).orderBy(*listing_files.FILE_ORDER)
    assert [tuple(r)[:7] for r in raw.collect()] == rows
    with pytest.raises(ValueError):
        listing_files.write_raw_csv(table, str(path), one_file=True, packed=True)


def test_tags_that_differ_in_addresses_are_read_once(monkeypatch):
    listed = TagList(["a.x", "a[href*='/itm/']", "a[href='/y']", "img"], ["src", "data-src"])
    full, read = [], TagList._read
    monkeypatch.setattr(TagList, "_read", lambda self, found: (full.append(found.group()), read(self, found))[1])
    for i in range(50):
        listed.add(f'<a class="x" href="/itm/{i}&amp;q">t</a><img data-src="{i}.png" src="">')
    assert listed.href[::2] == [f"/itm/{i}&q" for i in range(50)] and listed.fits == [1 | 2, 8] * 50
    assert listed.image[1::2] == [[("src", ""), ("data-src", f"{i}.png")] for i in range(50)]
    assert len(full) == 3  # each of the tags once, the addresses blanked
    # Quotes that stand elsewhere are read in full: here the address is part of a title.
    listed.clear()
    for value in ("/y", "/itm/"):
        listed.add(f'<a title="x href=" {value}="z">t</a>')
    listed.add("<a href='/y'>t</a><a href=\"/y\">t</a>")
    assert listed.fits == [4, 4] and listed.href == ["/y", "/y"]

"""Publishing searches, laying them out, and captured files as their source."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import queries
from offerquarry.plans.search import run_search
from offerquarry.sources import pages as page_files
from offerquarry.sources.pages import new_captures, page_text
from offerquarry.sources.published import matching, publish, published, remove_unpublished

RAW = "search_id string, page_no int, pos int, titel string, preis string, land string, link string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def row(search, pos, titel, preis="CHF 1.00", land="aus Schweiz", link="https://e/itm/1?_skw=x"):
    return (search, 1, pos, titel, preis, land, link)


def titles(spark, folder, **filters):
    return sorted((r.search_id, r.title) for r in published(spark, folder, **filters).collect())


def test_a_run_replaces_its_own_good_searches(spark, tmp_path):
    folder = str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        published(spark, folder)
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "search_id string")
    first = raw(spark, [row("a", 1, "A1"), row("a", 2, "A2"), row("b", 1, "B1"), row("c", 1, "C1", "EUR 9,50")])
    done = {r.search_id: r.published for r in publish(first, names, folder, url_column="link").collect()}
    assert done == {"a": True, "b": True, "c": True}
    # a is replaced, b has a row without a price, c is not named, d is new and empty.
    second = raw(spark, [row("a", 1, "A9"), row("b", 1, "B9"), row("b", 2, "B8", "Preis auf Anfrage")])
    named = spark.createDataFrame([("a",), ("b",), ("d",)], "search_id string")
    done = {r.search_id: r.published for r in publish(second, named, folder, url_column="link").collect()}
    assert done == {"a": True, "b": False, "d": True}
    assert titles(spark, folder) == [("a", "A9"), ("b", "B1"), ("c", "C1")]
    assert titles(spark, folder, max_price=2.0) == [("a", "A9"), ("b", "B1")]
    assert remove_unpublished(spark, folder) == []
    publish(first, names, folder, url_column="link")
    assert len(remove_unpublished(spark, folder)) == 1
    assert titles(spark, folder) == [("a", "A1"), ("a", "A2"), ("b", "B1"), ("c", "C1")]
    # A run that stopped before its manifest was complete is not seen.
    (tmp_path / "p/manifests/manifest-9").mkdir()
    assert len(titles(spark, folder)) == 4


def test_filters_reach_the_files(spark, tmp_path, capsys):
    rows = [
        row("a", i, f"T{i}", f"CHF {i % 100}.00", f"aus Land{i * 7 % 10}", f"https://e/itm/{i}?_skw=x")
        for i in range(4000)
    ]
    folder = str(tmp_path / "p")
    names = spark.createDataFrame([("a",)], "search_id string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows make one file
    try:
        publish(raw(spark, rows).repartition(4), names, folder, url_column="link")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = list((tmp_path / "p/data").rglob("*.parquet"))
    may_hold = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        places = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        stats = [meta.row_group(0).column(places[c]).statistics for c in ("product_origin", "price")]
        may_hold += stats[0].min <= "Land3" <= stats[0].max and stats[1].min <= 20
    assert len(files) >= 6 and may_hold <= 2
    found = published(spark, folder, land="Land3", max_price=20.0)
    assert found.count() == len([r for r in rows if r[5] == "aus Land3" and float(r[4][4:]) <= 20])
    matching(spark.read.parquet(f"{folder}/data"), "Land3", 20.0).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(product_origin,Land3)" in plan and "LessThanOrEqual(price,20.0)" in plan


CARD = (
    '<li class="s-item"><a class="s-item__link" href="https://e/itm/{0}?_skw=x"><h3 class="s-item__title">Schöne {0}</h3></a>'
    '<span class="s-item__price">CHF {0}.00</span></li>'
)


def test_captured_files_are_read_once(spark, tmp_path):
    folder, done = tmp_path / "pages", str(tmp_path / "done")
    (folder / "x").mkdir(parents=True)
    request = spark.createDataFrame([("s1", "ski", "9")], "search_id string, query string, max_price string")
    start = "https://www.ebay.ch/sch/i.html?_nkw=ski&_sacat=0&_from=R40&_trksid=m570.l1313&_udhi=9"
    head = '<html><head><meta charset="iso-8859-1"></head><body><ul class="srp-results">'
    tail = '</ul><a class="pagination__next" href="https://e/p2">Weiter</a></body></html>'
    (folder / "x/1.html").write_bytes((head + CARD.format(1) + tail).encode("cp1252"))
    manifest = [("x/1.html", "s1", start), ("2.html", "s1", "https://e/p2")]
    manifest = spark.createDataFrame(manifest, "file string, search_id string, url string")
    (folder / "other.html").write_text("not in the manifest")
    first = new_captures(spark, str(folder), manifest, done)
    assert first.count() == 1
    assert new_captures(spark, str(folder), manifest, done).count() == 0
    (folder / "2.html").write_text("<ul class='srp-results'>" + CARD.format(2) + "</ul>", encoding="utf-8")
    second = new_captures(spark, str(folder), manifest, done)
    assert [r.url for r in second.collect()] == ["https://e/p2"]
    result = run_search(request, first.unionByName(second)).clean
    assert sorted((r.title, r.price, r.page_no) for r in result.collect()) == [("Schöne 1", 1.0, 1), ("Schöne 2", 2.0, 2)]
    assert first.first().page_id != second.first().page_id


def test_pages_name_their_encoding(spark):
    pages = [
        ('<meta charset="utf-8">ü€', "utf-8"), ("<meta charset=latin1>ü€", "cp1252"), ("ü€", "utf-8"), ("ü€", "cp1252"),
        ("ü€", "utf-16"), ('<meta charset="utf-8">ü', "cp1252"), ("﻿ü", "utf-8"), ("", "utf-8"),
    ]
    rows = [(i, bytearray(text.encode(encoding))) for i, (text, encoding) in enumerate(pages)]
    found = spark.createDataFrame(rows, "n int, content binary").orderBy("n").select(page_text(F.col("content")).alias("t"))
    assert [r.t for r in found.collect()] == [text.removeprefix("﻿") for text, _ in pages]


def test_captured_files_are_listed_once_a_run(spark, tmp_path, monkeypatch):
    rows = [(n, f"https://e/{n}", f"<nav><ul><li><a href=/{n}>T{n}</a></li></ul></nav>") for n in range(5)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    listed = []
    real = page_files.captured_files
    for module in (queries, page_files):
        monkeypatch.setattr(module, "captured_files", lambda *args: listed.append(1) or real(*args))
    tasks = spark.conf.get(page_files.LISTING_TASKS)
    found = {(r.page_id, r.url, r.title_text) for r in queries.captured_cards(spark, str(tmp_path)).collect()}
    assert found == {(n, f"https://e/{n}", f"T{n}") for n in range(5)}
    assert len(listed) == 2  # one for each of the two runs
    assert spark.conf.get(page_files.LISTING_TASKS) == tasks

import pytest

from offerquarry import land_options, result_rows, result_view
from offerquarry.operators.ordering import with_position
from offerquarry.plans import results
from offerquarry.sources import listing_files, search_log


@pytest.fixture(scope="module")
def clean(spark):
    return spark.createDataFrame(
        [
            (1, "A", 12.5, "CHF", "Schweiz", "l1"),
            (2, " B ", 9.0, "EUR", "Österreich", "l2"),
            (3, None, None, None, "", None),
            (4, "D", 12.5, "USD", "Zypern", "l4"),
            (5, "E", 12345678.9, "CHF", "oman", "l5"),
            (6, "F", 9.0, "CHF", "Oman", "l6"),
        ],
        "n int, title string, price double, currency string, product_origin string, link string",
    )


def test_result_rows(clean):
    rows = result_rows(clean, keep=["n"]).orderBy("n").collect()
    assert rows[1].asDict() == {
        "produkt": "B", "preis": "9.0", "region": "Österreich", "link": "l2", "image": "",
        "aktualitaet": "", "versand": "", "währung": "EUR", "n": 2,
        "preis_text": "9.0 EUR", "sort_key": 9.0,
    }
    assert (rows[2].produkt, rows[2].preis, rows[2].sort_key) == ("", "", 0.0)
    assert rows[4].preis == "12345678.9"


def test_sort_is_stable_both_ways(clean):
    up = [r.n for r in result_view(clean, ["n"]).collect()]
    down = [r.n for r in result_view(clean, ["n"], ascending=False).collect()]
    assert up == [3, 2, 6, 1, 4, 5]
    assert down == [5, 1, 4, 2, 6, 3]


def test_filters(clean):
    assert [r.produkt for r in result_view(clean, ["n"], land="Oman").collect()] == ["F"]
    assert results.filter_land(result_rows(clean)).count() == 6
    assert results.filter_max_price(clean, 9.0).count() == 2
    assert results.filter_keywords(clean, "d").count() == 1


def test_land_options_in_german_order(clean):
    found = [r.region for r in land_options(result_rows(clean)).collect()]
    assert found == ["oman", "Oman", "Österreich", "Schweiz", "Zypern"]


def test_positions_over_many_ranges(spark):
    from pyspark.sql import functions as F

    df = spark.range(30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * 7 % 1000).alias("p")
    )
    numbered = with_position(df, [F.col("p").desc(), F.col("id").asc()])
    found = [r.id for r in numbered.orderBy("position").collect()]
    expected = sorted(range(30000), key=lambda i: (-(5 if i % 3 == 0 else i * 7 % 1000), i))
    assert found == expected
    assert numbered.agg(F.min("position"), F.max("position")).first() == (1, 30000)


def test_clean_csv_roundtrip(spark, clean, tmp_path):
    path = str(tmp_path / "clean")
    listing_files.write_clean_csv(clean, path)
    again = listing_files.read_clean_csv(spark, path)
    ours = result_rows(clean).drop("sort_key").collect()
    theirs = result_rows(again)
    assert sorted(theirs.drop("sort_key").collect()) == sorted(ours)
    assert {r.sort_key for r in theirs.collect()} == {0.0, 9.0, 12.5, 12345678.9}


def test_missing_clean_file_is_an_empty_table(spark, tmp_path):
    rows = result_rows(listing_files.read_clean_csv(spark, str(tmp_path / "none")))
    assert rows.count() == 0 and "währung" in rows.columns


RAW = [
    ("A", "Neu", "CHF 1.00", "aus Schweiz", "Gratis", "https://e/a", "https://e/a.jpg"),
    (' "B", 2\n', None, "CHF 2.00", "aus Österreich", "+ CHF 5.00", "https://e/b", None),
]


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_raw_csv_roundtrip(spark, tmp_path, encoding):
    path = str(tmp_path / "raw")
    raw = spark.createDataFrame(RAW, listing_files.text_schema(listing_files.fixed.RAW_FIELDS))
    listing_files.write_raw_csv(raw, path, encoding)
    assert sorted(listing_files.read_raw_csv(spark, path).collect()) == sorted(raw.collect())


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Preis,land\n1,Österreich\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("﻿Preis,land\n2,Österreich\n".encode("utf-8"))
    (tmp_path / "c.csv").write_bytes("Preis,land\n3,Österreich\n".encode("utf-8"))
    rows = listing_files.read_raw_csv(spark, str(tmp_path)).orderBy("Preis").collect()
    assert [tuple(r) for r in rows] == [(n, "Österreich") for n in "123"]


def test_differing_headers_fail_loudly(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Preis,land\n1,A\n")
    (tmp_path / "b.csv").write_text("land,Preis\nA,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        listing_files.read_raw_csv(spark, str(tmp_path)).collect()


def test_empty_raw_table_still_has_a_header(spark, tmp_path):
    path = str(tmp_path / "raw")
    schema = listing_files.text_schema(listing_files.fixed.RAW_FIELDS)
    listing_files.write_raw_csv(spark.createDataFrame([], schema), path)
    assert listing_files.read_raw_csv(spark, path).columns == schema.names


def test_search_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert search_log.read_search_log(spark, path).count() == 0
    for query, price, region in [(" iphone ", "100", "Schweiz"), ("ski", None, None)]:
        request = spark.createDataFrame(
            [(query, price, region)], "query string, max_price string, region string"
        )
        search_log.append_searches(request, path)
    rows = search_log.read_search_log(spark, path).orderBy("Produkt").collect()
    assert [tuple(r) for r in rows] == [("iphone", "100", "Schweiz", ""), ("ski", "", "", "")]


def test_clean_csv_has_no_file_order(spark, tmp_path):
    rows = spark.createDataFrame(
        [("Ski", 5.0, "file:/a.csv", 0, 1)],
        "title string, price double, source_file string, source_block long, source_row long",
    )
    listing_files.write_clean_csv(rows, str(tmp_path / "clean"))
    assert listing_files.read_clean_csv(spark, str(tmp_path / "clean")).collect() == [("Ski", "5.0")]


def test_files_lie_in_the_order_of_their_numbers(spark):
    names = ["a/part-100000-2.csv", "a/part-99999-10.csv", "a/part-99999-9.csv", "a/b.csv"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r.name for r in rows.orderBy(listing_files.file_key(rows.name)).collect()]
    assert found == ["a/b.csv", "a/part-99999-9.csv", "a/part-99999-10.csv", "a/part-100000-2.csv"]

import pytest

from offerquarry import MissingField, clean_listings, quality_report, split_listings
from offerquarry.operators.dedupe import count_duplicates, keep_first
from offerquarry.operators.headers import (
    find_roles,
    last_place,
    first_url_column,
    resolve_columns,
    unique_names,
)
from offerquarry.sources.listing_files import read_raw_csv

LINK = "https://m/itm/1?_skw=ski"


def table(spark, names, *rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], ["row_no", *[f"c{i}" for i in range(len(names))]]
    )
    return df.toDF("row_no", *names)


def rows_of(df):
    return [r.asDict() for r in df.orderBy("row_no").drop("row_no").collect()]


def test_roles_of_headers():
    roles = find_roles(["  Preis  ", "  VERSANDkosten ", " Titel ", "foobar"])
    assert (roles.price, roles.shipping, roles.title, roles.country) == (0, 1, 2, None)
    assert find_roles(["preis", "x", "PREIS"]).price == 2
    assert find_roles(["title", "Titel"]).title == 1
    assert last_place([" Link", "x", "LINK "], "link") == 2
    assert last_place(["a"], "link") is None


def test_unique_names():
    assert unique_names(["title", "Title", "x", "title"]) == ["title", "Title_2", "x", "title_3"]


def test_first_url_column(spark):
    df = table(spark, ["a", "A", "b"], ("x", "y", "ftp://x"), ("see https://x", "http://y", "z"))
    assert df.columns[first_url_column(df)] == "a"
    assert first_url_column(df.drop("a")) is None  # drops both by name
    assert first_url_column(df.select("row_no")) is None


def test_clean_rows(spark):
    raw = table(
        spark,
        ["titel", "aktualitaet", "preis", "land", "versand", "link", "image"],
        ("A", "Neu |", "CHF 1.00", "aus Schweiz", "Gratis", LINK, "a.jpg"),
        ("NA", None, "2,50", None, "+ EUR 5,00 Versand", LINK, None),
    )
    first, second = rows_of(clean_listings(raw, order_by=["row_no"]))
    assert first == {
        "title": "A",
        "product_condition": "Neu",
        "price": 1.0,
        "currency": "CHF",
        "product_origin": "Schweiz",
        "shipping_cost": 0.0,
        "price_with_shipping": 1.0,
        "product_name": "Ski",
        "link": LINK,
        "image": "a.jpg",
    }
    assert second == {
        "title": None,
        "product_condition": "keine Angabe",
        "price": 2.5,
        "currency": "EUR",
        "product_origin": "",
        "shipping_cost": 5.0,
        "price_with_shipping": 7.5,
        "product_name": "Ski",
        "link": LINK,
        "image": None,
    }


def test_headers_vary(spark):
    raw = table(
        spark,
        ["Price", " Titel", "title", "Herkunft", "LINK", "Link zum Bild"],
        ("5 €", "A", "other", "aus Wien", LINK, "b"),
    )
    (row,) = rows_of(clean_listings(raw, order_by=["row_no"]))
    assert list(row) == [
        "title", "price", "currency", "product_origin", "shipping_cost",
        "price_with_shipping", "product_name", "title_2", "link", "link_bild",
    ]
    assert row["title"] == "A" and row["title_2"] == "other"
    assert row["product_origin"] == "Wien" and row["shipping_cost"] == 0.0


def test_numeric_price_columns(spark):
    raw = spark.createDataFrame(
        [(1, 12345678.9, 3, LINK)], "row_no int, price double, versand int, link string"
    )
    (row,) = rows_of(clean_listings(raw, order_by=["row_no"]))
    assert (row["price"], row["shipping_cost"], row["currency"]) == (12345678.9, 3.0, "keine Angabe")
    assert "title" in row and row["title"] == ""


def test_gate_order_and_counts(spark):
    with pytest.raises(MissingField, match="price column"):
        clean_listings(table(spark, ["titel", "link"], ("A", LINK)), order_by=["row_no"])
    with pytest.raises(MissingField, match="URL column"):
        clean_listings(table(spark, ["titel", "preis"], ("A", "x")), order_by=["row_no"])
    bad = table(spark, ["preis", "link"], ("x", LINK), ("1", "https://m"), ("y", "z"))
    with pytest.raises(MissingField, match="product_name.* 2 rows"):
        clean_listings(bad, order_by=["row_no"])
    with pytest.raises(MissingField, match="price.* 2 rows"):
        clean_listings(table(spark, ["preis", "link"], ("x", LINK), ("Fr. 1.5", LINK)),
                       order_by=["row_no"])


def test_split_keeps_every_row_somewhere(spark):
    raw = table(
        spark,
        ["titel", "preis", "link"],
        ("A", "1", LINK), ("A", "1.0", LINK), ("a", "1", LINK), ("B", "x", LINK),
        ("C", "1", "https://m"), (None, "1", LINK), (None, "1", LINK),
    )
    good, bad = split_listings(raw, order_by=["row_no"])
    assert [r.row_no for r in good.orderBy("row_no").collect()] == [0, 2, 5]
    assert [(r.row_no, r.missing_field) for r in bad.orderBy("row_no").collect()] == [
        (3, "price"),
        (4, "product_name"),
    ]
    assert tuple(quality_report(raw).first()) == (7, 1, 1, 2)


def test_duplicates_without_a_link_column_use_the_first_url_column(spark):
    raw = table(
        spark,
        ["titel", "preis", "adresse"],
        ("A", "1", LINK), ("A", "1", LINK + "&b"), ("A", "1", LINK),
    )
    kept = clean_listings(raw, order_by=["row_no"])
    assert [r.row_no for r in kept.orderBy("row_no").collect()] == [0, 1]


def test_scope_keeps_searches_apart(spark):
    raw = table(
        spark,
        ["search_id", "preis", "link"],
        ("s", "1", LINK), ("t", "1", LINK), ("t", "1", LINK),
    )
    assert clean_listings(raw, order_by=["row_no"], scope=["search_id"]).count() == 2
    assert clean_listings(raw, order_by=["row_no"]).count() == 1


def test_order_is_required(spark):
    with pytest.raises(ValueError, match="order_by"):
        clean_listings(table(spark, ["preis", "link"], ("1", LINK)))


def test_keep_first_against_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [
        (n, rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.choice([None, 1.0, 2.0]))
        for n in rng.sample(range(3000), 3000)
    ]
    df = spark.createDataFrame(rows, "n int, k string, p double").repartition(7)
    first = {}
    for n, k, p in sorted(rows):
        first.setdefault((k, p), n)
    kept = keep_first(df, ["k", "p"], ["n"])
    assert {(r.k, r.p): r.n for r in kept.collect()} == first
    assert keep_first(kept, ["k", "p"], ["n"]).count() == kept.count()
    assert count_duplicates(df, ["k", "p"]).first()[0] == 3000 - len(first)


def test_resolve_columns(spark):
    raw = table(spark, [" Title ", "PREIS", "Price", "versand"], ("A", "1", "old", "2"))
    resolved = resolve_columns(raw)
    assert resolved.columns == [
        "titel", "aktualitaet", "preis", "land", "versand", "row_no", "Price",
    ]
    assert tuple(resolved.first()) == ("A", "", "1", "", "2", 0, "old")


def test_cleaning_plan_is_one_scan_and_one_shuffle(spark, tmp_path):
    table(spark, ["preis", "link"], ("1", LINK)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = clean_listings(raw, order_by=["row_no"])._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_raw_rows_are_read_once(spark):
    """Neither the gate nor the result goes back to the raw rows."""
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = table(spark, ["preis", "link"], ("1", LINK), ("1", LINK), ("2", LINK))
    raw = raw.mapInArrow(counting, raw.schema)
    clean = clean_listings(raw, order_by=["row_no"])
    assert clean.count() == 2 and clean.where("price > 1").count() == 1
    assert read.value == 3


def test_clean_an_empty_table(spark):
    raw = table(spark, ["preis", "link"], ("1", LINK)).where("preis = 'none'")
    with pytest.raises(MissingField):
        clean_listings(raw, order_by=["row_no"])
    assert clean_listings(raw, order_by=["row_no"], url_column="link").count() == 0


def test_clean_a_csv_file_in_file_order(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "Titel , Preis,Land,link\n"
        f'"A ""1""\nzwei",1,aus Wien,{LINK}\nB,"2,50",,{LINK}\n"A ""1""\nzwei",1,aus Bern,{LINK}\n',
        encoding="utf-8",
    )
    raw = read_raw_csv(spark, str(path), keep_order=True)
    rows = clean_listings(raw).orderBy("source_row").collect()
    assert [(r.title, r.price, r.product_origin) for r in rows] == [
        ('A "1"\nzwei', 1.0, "Wien"),
        ("B", 2.5, ""),
    ]


def test_names_come_from_the_first_url_column_even_before_link(spark):
    raw = table(
        spark,
        ["quelle", "preis", "link"],
        ("https://x/?skw=a", "1", "https://m"),
        ("https://x/?skw=b", "2", LINK),
    )
    names = [r["product_name"] for r in rows_of(clean_listings(raw, order_by=["row_no"]))]
    assert names == ["A", "B"]
    with pytest.raises(MissingField, match="product_name.* 1 rows"):
        clean_listings(raw, order_by=["row_no"], url_column="link")


def test_views_compute_only_the_columns_they_name(spark):
    raw = spark.createDataFrame(
        [("A", "CHF 1", "aus China", "u", "https://m.example/itm/1?_skw=a", 1, 1),
         ("A", "CHF 1", "aus Japan", "v", "https://m.example/itm/1?_skw=a", 1, 2),
         ("B", "CHF 2", "aus China", "w", "https://m.example/itm/2", 1, 3)],
        "titel string, preis string, land string, image string, link string, page_no int, pos int",
    )
    whole, bad = split_listings(raw, url_column="link")
    few, few_bad = split_listings(raw, url_column="link", columns=["product_origin"])
    assert set(few.columns) == {"title", "price", "product_name", "link", "product_origin", "page_no", "pos"}
    assert few.collect() == whole.select(few.columns).collect()
    assert [r.missing_field for r in few_bad.collect()] == [r.missing_field for r in bad.collect()]

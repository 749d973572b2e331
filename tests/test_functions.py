import re

import pytest
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions import images, money, text, urls


def check(evaluate, function, cases, kind="string"):
    assert evaluate(function, list(cases), kind) == list(cases.values())


def test_parse_number_eu(evaluate):
    check(
        evaluate,
        money.parse_number_eu,
        {
            "3.040,06": 3040.06,
            "12,5": 12.5,
            "10": 10.0,
            "1,234": 1.234,
            "1.234": 1.234,
            "1,234.56": 1.23456,
            "1,2345": 12345.0,
            "1,234,567": 1234.567,
            "1.234.567": None,
            "1.234.567,5": 1234567.5,
            "+ 12,00 EUR Versand": 12.0,
            "Fr. 12.50": None,
            "1'234.50": 1234.5,
            "CHF 159,61 bis CHF 191,78": 15961191.78,
            "CHF 1.50 bis CHF 2.50": None,
            "Gratis": None,
            "": None,
            "  ": None,
            None: None,
            ",": None,
            ",5": 0.5,
            "5,": 5.0,
            ".5": 0.5,
            "12.": 12.0,
            "1 234": 1234.0,
            "1 234": None,
            "CHF 12.50": 12.5,
            "5 , 2 3": 523.0,
            ".\t5,3": 5.3,
            "12,5 versand 1": 1251.0,
            "zzgl. 3": 3.0,
            "1d": 1.0,
            "nan": None,
            "Infinity": None,
        },
    )


def test_amounts_keep_their_digits(evaluate):
    """Properties on random texts: all digits count, in order; blanks around do not."""
    import random

    rng = random.Random(7)
    pieces = list("0123456789.,.,  '") + ["CHF", "€", "\t", " "]
    values = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(2000)]
    amounts = evaluate(money.parse_number_eu, values)
    assert amounts == evaluate(money.parse_number_eu, [f"  {v}\t" for v in values])
    for value, amount in zip(values, amounts):
        digits = "".join(c for c in value if c in "0123456789")
        if not digits:
            assert amount is None
        elif amount is not None:
            assert any(float(f"{digits[:i]}.{digits[i:]}0") == amount for i in range(len(digits) + 1))


def test_long_amounts(evaluate):
    groups = "1" + ".1" * 20_000
    long = "1.234,5 " * 15_000  # 120 KB
    assert evaluate(money.parse_number_eu, [groups + ",5", groups, long]) == [
        float("inf"), None, None,
    ]
    assert evaluate(money.parse_number_eu, ["0" + ".0" * 20_000 + "7,5", "x" * 120_000 + "1,5"]) == [7.5, 1.5]


def test_long_chf_format(evaluate):
    assert evaluate(money.chf_format, ["1" * 5000]) == ["CHF 11" + "'111" * 1666]


def test_extract_currency(evaluate):
    check(
        evaluate,
        money.extract_currency,
        {
            "CHF 12.00": "CHF",
            "12,00 €": "EUR",
            "Usd 99": "USD",
            "$ 1": "USD",
            "£15": "GBP",
            "Versandkostenfrei": "CHF",
            "CHF 5 / EUR 4": "EUR",
            "12": None,
            None: None,
        },
    )


def test_currency_fallback(spark):
    rows = spark.createDataFrame(
        [("5", "EUR 1"), ("CHF 5", "EUR 1"), ("5", "Gratis"), (None, None)],
        "p string, v string",
    )
    found = rows.select(money.currency_fallback(rows.p, rows.v).alias("c")).collect()
    assert [r.c for r in found] == ["EUR", "CHF", fixed.NOT_GIVEN, fixed.NOT_GIVEN]


def test_origin(evaluate):
    cases = {s: "Grossbritannien" for s in fixed.GREAT_BRITAIN_SPELLINGS}
    cases |= {
        "Deutschland": "Deutschland",
        " AUS  GroÃYbritannien ": "Grossbritannien",
        "aus ": "",
        "ausland": "ausland",
        "aus aus Wien": "aus Wien",
        None: "",
        "nan": "",
    }
    check(evaluate, text.clean_origin, cases)


def test_clean_title(evaluate):
    check(
        evaluate,
        text.clean_title,
        {
            "MacBook Pro – wird in neuem Fenster oder Tab geöffnet": "MacBook Pro",
            # the first phrase in list order counts, not the leftmost in the text
            "A opens in a new window or tab • wird in neuem Fenster geöffnet": (
                "A opens in a new window or tab"
            ),
            "  B  ": "B",
            "Wird in neuem Fenster geöffnet": "",
            "": "",
        },
    )


def test_is_advert(evaluate):
    check(
        evaluate,
        text.is_advert,
        {
            "iPad: neu": True,
            "Anzeigetafel": True,
            "Shop on eBay": True,
            "iPad neu": False,
        },
    )


def test_clean_condition(evaluate):
    check(
        evaluate,
        text.clean_condition,
        {
            "Neu |": "Neu",
            "Neu | |": "Neu |",
            "a|b |\n": "a|b",
            " | ": fixed.NOT_GIVEN,
            "": fixed.NOT_GIVEN,
            None: fixed.NOT_GIVEN,
            "None": fixed.NOT_GIVEN,
        },
    )


@pytest.mark.parametrize(
    "texts, land, versand",
    [
        (["+CHF 3.47 Versand", "aus Deutschland"], "aus Deutschland", "+CHF 3.47 Versand"),
        (["from China"], "aus Schweiz", ""),
        (["from Austria"], "from Austria", ""),
        ([], "aus Schweiz", ""),
        (None, "aus Schweiz", ""),
        (["+5 aus Lager", "Zug"], "aus Schweiz", "+5 aus Lager"),
        (["+5 aus Lager"], "+5 aus Lager", "+5 aus Lager"),
        (["Australien", "Gratis Versand"], "Australien", "Gratis Versand"),
        (["aus Wien", "aus Bern", "Versand 1", "Versand 2"], "aus Wien", "Versand 1"),
    ],
)
def test_attribute_rows(evaluate, texts, land, versand):
    assert evaluate(text.origin_row, [texts], "array<string>") == [land]
    assert evaluate(text.shipping_row, [texts], "array<string>") == [versand]


def test_cell_text(evaluate):
    assert evaluate(text.cell_text, ["  a b\x1f\n", None]) == ["a b", ""]


def test_missing_to_null(evaluate):
    assert evaluate(text.missing_to_null, ["NA", "null", " NA", "Na", ""]) == [
        None,
        None,
        " NA",
        "Na",
        None,
    ]


def test_skw_product_name(evaluate):
    check(
        evaluate,
        urls.skw_product_name,
        {
            "https://x/itm/1?_skw=led+lampe&a=b": "Led lampe",
            "https://x/?_skw=a&skw=b#z": "B",
            "https://x/?skw=&_skw=a": "A",
            "https://x/?skw=&skw=c&skw=d": "C",
            "https://x/?a=1&%5fskw=q": "Q",
            "https://x/?%73kw=%2541%2Bc": "A+c",
            "https://x/?skw=%20&_skw=a": None,
            "https://x/?skw=100%": "100%",
            "https://x/?skw=%C3%BCber": "Über",
            "https://x/?skw=a|b c": "A|b c",
            "https://x/?askw=a": None,
            "https://x/?b?skw=a&skw=c": "C",
            "https://x/#?skw=a": None,
            "https://[x/?skw=a": None,
            "https://[::1]/?skw=a": "A",
            " https://x/?s\tkw=a\nb": "Ab",
            "?skw=a": "A",
            "https://x/": None,
            "": None,
            None: None,
        },
    )


def test_skw_product_name_agrees_with_the_standard_library(evaluate):
    import random
    from urllib.parse import parse_qs, unquote, urlsplit

    def by_library(url):
        try:
            query = parse_qs(urlsplit(url).query)
        except ValueError:
            return None
        values = query.get("skw") or query.get("_skw") or [""]
        name = unquote(values[0]).strip()
        return name[:1].upper() + name[1:] or None

    rng = random.Random(3)
    pieces = ["skw=", "_skw=", "&", "=", "%20", "%", "+", "a", "ü", "#", "?", "%2B", "%25",
              "41", "%73kw=", " ", "/", "x;y", "%C3%A9", "%E2%82"]
    tails = ["".join(rng.choices(pieces, k=rng.randint(1, 10))) for _ in range(4000)]
    links = [rng.choice(["https://h/i?", "//h/?a=1&", "?"]) + t for t in tails]
    assert evaluate(urls.skw_product_name, links) == [by_library(u) for u in links]


def test_search_url(spark):
    rows = spark.createDataFrame(
        [
            ("LED Stehlampe", "200"),
            ("LED Stehlampe Wohnzimmer dimmbar grün hell", "12.50"),
            ("  a*b~c   d/e ", None),
            (None, "CHF"),
        ],
        "q string, p string",
    )
    found = [r[0] for r in rows.select(urls.search_url(rows.q, rows.p)).collect()]
    form = fixed.SEARCH_URL
    assert found == [
        form.format("LED+Stehlampe", "200"),
        form.format("LED+Stehlampe+Wohnzimmer+dimmbar+gr%C3%BCn", "1250"),
        form.format("a%2Ab~c+d%2Fe", ""),
        form.format("", ""),
    ]


def test_chf_format(evaluate):
    check(
        evaluate,
        money.chf_format,
        {
            "9000": "CHF 9'000",
            "12.50": "CHF 1'250",
            "1234567": "CHF 1'234'567",
            "007": "CHF 7",
            "0": "CHF 0",
            "abc": "abc",
            "²3": "²3",
            "٣٤": "CHF 34",
            None: None,
        },
    )


def test_float_text(evaluate):
    values = [0.0, 1.5, 1234567.0, 12345678.9, 1e15, 1e16, 1.5e16, 1e22, 0.001, 0.0005,
              5e-05, 1.2e-10, 123456789012.34, -2.5e8]
    assert evaluate(money.float_text, values, "double") == [repr(v) for v in values]


def test_sort_key(evaluate):
    check(
        evaluate,
        money.sort_key,
        {
            "1234.5 CHF": 1234.5,
            "CHF 12,5": 12.5,
            " EUR": 0.0,
            "1e3 EUR": 1000.0,
            "12,5,6": 12.5,
            "x 5": 0.0,
        },
    )


def test_image_url(evaluate):
    cases = [
        ({"src": "https://example.com/test.jpg"}, "https://example.com/test.jpg"),
        ({"src": "", "data-src": " a.jpg 1x, b 2x"}, "a.jpg"),
        ({"data-img": "a,b"}, "a,b"),
        ({"src": "  ", "data-src": "a"}, ""),
        ({"data-src": " ", "srcset": "a 1x"}, ""),
        ({"srcset": " , x.jpg 1x, y"}, "x.jpg"),
        ({"srcset": " , "}, ""),
        ({}, ""),
        (None, ""),
    ]
    found = evaluate(images.image_url, [c[0] for c in cases], "map<string,string>")
    assert found == [c[1] for c in cases]


def test_has_url(evaluate):
    assert evaluate(urls.has_url, ["see http://a", "HTTP://a", None]) == [True, False, None]


def test_expressions_stay_out_of_python(spark):
    rows = spark.range(1).select(F.lit("CHF 5").alias("t"))
    plan = rows.select(
        money.parse_number_eu(rows.t), urls.skw_product_name(rows.t), text.clean_title(rows.t)
    )._jdf.queryExecution().toString()
    assert "Python" not in plan and "PYTHON" not in plan


def test_plain_origins_are_cut_without_the_pattern(spark, evaluate):
    cases = {
        "aus Wien": "Wien", "aus ": "", "aus": "aus", "aus  \u00a0Wien ": "Wien", "aus aus Wien": "aus Wien",
        "AUS\tWien": "Wien", " aus Wien": "Wien", "ausWien": "ausWien", None: "", "aus Großbritannien": "Grossbritannien",
    }
    check(evaluate, text.clean_origin, cases)
    texts = spark.range(1).select(F.col("id").cast("string").alias("t"))
    plan = texts.select(text.clean_origin(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("StartsWith(") < plan.index("regexp_replace(")

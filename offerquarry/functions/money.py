"""Amounts and currencies in mixed European notation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions.text import WHITESPACE, strip


def extract_currency(text: Column) -> Column:
    """Code of the first currency key, in key order, that occurs in the text."""
    lowered = F.lower(text)
    result = F.lit(None).cast("string")
    for key, code in reversed(fixed.CURRENCY_KEYS.items()):
        result = F.when(lowered.contains(key), F.lit(code)).otherwise(result)
    return result


def currency_fallback(price_text: Column, shipping_text: Column | None) -> Column:
    """Currency of the price, else of the shipping text, else "not given"."""
    candidates = [extract_currency(price_text)]
    if shipping_text is not None:
        candidates.append(extract_currency(shipping_text))
    return F.coalesce(*candidates, F.lit(fixed.NOT_GIVEN))


# One number among characters that are no digits, dots or commas: 12.50, 12,5 or 99 ...
_ONE_NUMBER = r"\A[^0-9.,]*+([0-9]++\.?[0-9]*+|[0-9]*+,[0-9]{0,3})[^0-9.,]*+\z"
# ... or dots, then one comma: 1.234.567,50.  No group repeats, so long texts are safe.
_GROUPED_NUMBER = r"\A[^0-9.,]*+([0-9]++\.[0-9.]*+,[0-9]*+)[^0-9.,]*+\z"


def parse_number_eu(text: Column) -> Column:
    """Amount in a text as double, null if there is no readable one.

    A comma is the decimal mark.  With a comma present all dots are thousands
    marks; without one a dot is the decimal mark.  Several commas count as
    thousands marks, but for the last one if at most three characters follow.

    Most amounts are a single plain number, which one pattern reads; only the
    others go through all the rules.
    """
    plain = F.translate(_matched(text, _ONE_NUMBER), ",", ".")
    grouped = F.translate(_matched(text, _GROUPED_NUMBER), ",.", ".")
    # Cast only what looks right: a failing cast costs an exception inside.  Of matched
    # texts only a lone comma is no number, and it is none by the other rules either.
    return F.coalesce(
        plain.try_cast("double"),
        grouped.try_cast("double"),
        F.when(text.rlike("[0-9]"), _parse_any_number(text)),
    )


def _matched(text: Column, pattern: str) -> Column:
    """The first group of a pattern that takes the whole text, null if it does not; the
    pattern is tried once, unlike with a test before."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _decimal_dots(text: Column) -> Column:
    """Drop thousands marks and blanks, make decimal marks dots."""
    # Only commas, and a short rest after the last one: that one is the decimal mark.
    commas = F.regexp_replace(text, r"\A([^.]*),([^.,]{0,3})\z", "$1;$2")
    return F.when(
        text.contains(".") & text.contains(","), F.translate(text, ",. ", ".")
    ).otherwise(F.translate(commas, ";, ", "."))


# No digit, dot, comma or white space.  The plain ones are named first: to tell that they
# are none of all the kinds of white space takes a test for each of these.
_NO_AMOUNT = rf"[!-+\-/:-~]++|[^0-9.,{WHITESPACE}]++"


def _parse_any_number(text: Column) -> Column:
    """All rules; each step is linear in the length of the text."""
    step = F.regexp_replace(text, f"(?iu){fixed.AMOUNT_NOISE}", " ")
    step = strip(F.regexp_replace(step, _NO_AMOUNT, ""))
    step = strip(_bound(step, _decimal_dots))
    # Take it only if it has the shape of a number ("1d" would cast, too).
    shaped = F.regexp_extract(step, r"\A(?:[0-9]++\.?[0-9]*+|\.[0-9]++)\z", 0)
    return shaped.try_cast("double")


def shipping_cost(shipping_text: Column) -> Column:
    """Shipping amount; free, unknown or unreadable is 0."""
    return F.coalesce(parse_number_eu(shipping_text), F.lit(0.0))


@lru_cache(maxsize=None)
def _ranges(kind: str) -> str:
    """Regex class body of all digits ("all") or of those int() refuses ("odd")."""
    points = [
        c
        for c in range(0x110000)
        if chr(c).isdigit()
        and (kind == "all" or unicodedata.decimal(chr(c), None) is None)
    ]
    spans: list[list[int]] = []
    for c in points:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)


@lru_cache(maxsize=None)
def _decimal_digits() -> tuple[str, str]:
    """All decimal digits outside ASCII, and the ASCII digits they stand for."""
    chars = [
        chr(c)
        for c in range(0x80, 0x110000)
        if unicodedata.decimal(chr(c), None) is not None
    ]
    return "".join(chars), "".join(str(unicodedata.decimal(c)) for c in chars)


def digits_only(text: Column) -> Column:
    """All digit characters of the text, in any script."""
    return F.regexp_replace(text, f"[^{_ranges('all')}]", "")


def chf_format(value: Column) -> Column:
    """Digits of the value as "CHF 1'250"; a value without digits stays as is.

    The value also stays if its digits do not form an integer (superscript-like ones).
    """
    text = value.cast("string")
    digits = digits_only(text)
    usable = (digits != "") & ~digits.rlike(f"[{_ranges('odd')}]")
    ascii_digits = F.translate(digits, *_decimal_digits())
    number = F.regexp_replace(ascii_digits, r"\A0+(?=[0-9])", "")
    # From the end, so that each group of three is met once.
    grouped = F.reverse(F.regexp_replace(F.reverse(number), "([0-9]{3})(?=[0-9])", "$1'"))
    return F.when(usable, F.concat(F.lit("CHF "), grouped)).otherwise(text)


def float_text(number: Column) -> Column:
    """A double as text the way CSV files hold it: 12345678.9, not 1.23456789E7.

    Plain notation for sizes from 1e-4 up to 1e16, else a two-digit exponent
    (5e-05, 1e+16).
    """
    java = number.cast("string")
    size = F.abs(number)
    plain = F.regexp_replace(
        java.try_cast("decimal(38,21)").cast("string"), r"(\.[0-9]+?)0+\z", "$1"
    )
    scientific = F.regexp_replace(java, r"\.0E", "E")
    scientific = F.regexp_replace(scientific, r"E([0-9])", "e+$1")
    scientific = F.regexp_replace(scientific, r"E-([0-9])\z", "e-0$1")
    scientific = F.regexp_replace(scientific, r"E-", "e-")
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def sort_key(label: Column) -> Column:
    """Numeric key of a shown price such as "1234.5 CHF"; no number gives 0.

    The first "CHF" is taken out, the first comma becomes a dot, and the number
    at the start of the rest counts.
    """
    text = F.regexp_replace(label, r"(?s)\A(.*?)CHF", "$1")
    text = strip(F.regexp_replace(text, r"(?s)\A([^,]*),", "$1."))
    leading = F.regexp_extract(
        text, r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?", 0
    )
    return F.coalesce(leading.try_cast("double"), F.lit(0.0))


"""Search URLs, and product names from link parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions.money import digits_only
from offerquarry.functions.text import SPACE_CLASS, strip


def encode_query(query: Column) -> Column:
    """First five words of a search text, form-encoded for a URL."""
    words = F.slice(
        F.split(strip(query), f"{SPACE_CLASS}+", fixed.MAX_QUERY_WORDS + 1),
        1,
        fixed.MAX_QUERY_WORDS,
    )
    encoded = F.url_encode(F.array_join(words, " "))
    # Java's form encoding differs from RFC 3986's unreserved set in two places.
    return F.replace(
        F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def search_url(query: Column, max_price: Column) -> Column:
    """Start URL of a search; the price limit is reduced to its digits."""
    start, middle, end = fixed.SEARCH_URL.split("{}")
    digits = F.coalesce(digits_only(max_price.cast("string")), F.lit(""))
    return F.concat(
        F.lit(start),
        encode_query(F.coalesce(query, F.lit(""))),
        F.lit(middle),
        digits,
        F.lit(end),
    )


def _decode(text: Column) -> Column:
    """Percent-decoding that leaves a stray "%" alone."""
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


# The parameter names, each letter as it is or percent-encoded.
_SKW = "(?:s|%73)(?:k|%6[bB])(?:w|%77)="
_UNDERSCORE_SKW = f"(?:_|%5[fF]){_SKW}"

# A host part with only one kind of square bracket makes the whole URL unreadable.
_BROKEN_HOST = (
    r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    r"(?:[^/?#\]]*\[[^/?#\]]*|[^/?#\[]*\][^/?#\[]*)(?:[/?#]|\z)"
)

# Raw value of the first non-empty "skw" in the query part, or else "_skw".
_NAME_PARAMETER = (
    rf"(?s)\A[\x00-\x20]*+(?!{_BROKEN_HOST})[^#?]*\?"
    rf"(?:(?:[^#]*?&)??{_SKW}|(?:[^#]*?&)??{_UNDERSCORE_SKW})([^&#]+)"
)


def skw_product_name(url: Column) -> Column:
    """Product name in the ``skw`` parameter of a URL, else in ``_skw``.

    The value is decoded twice, trimmed, and its first character upper-cased.
    Null if there is no such parameter or nothing is left of it.
    """
    # Line breaks and tabs inside a URL do not count.
    breaks = url.contains("\t") | url.contains("\r") | url.contains("\n")
    address = F.when(breaks, F.translate(url, "\t\r\n", "")).otherwise(url)
    raw = F.regexp_extract(address, _NAME_PARAMETER, 1)
    once = _decode(raw)
    twice = _decode(F.replace(once, F.lit("+"), F.lit("%2B")))
    decoded = F.when(raw.contains("%"), twice).otherwise(F.translate(raw, "+", " "))
    name = strip(decoded)
    capital = F.concat(F.upper(F.left(name, F.lit(1))), F.substr(name, F.lit(2)))
    return F.nullif(capital, F.lit(""))


def has_url(text: Column) -> Column:
    return text.contains("http://") | text.contains("https://")


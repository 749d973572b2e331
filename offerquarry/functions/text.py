"""Text rules for titles, conditions and origins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerquarry import fixed

# Every character that Python's str.strip() and re's \s treat as white space.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
SPACE_CLASS = f"[{WHITESPACE}]"


def strip(text: Column) -> Column:
    """Trim all Unicode white space (Spark's plain ``trim`` only knows the blank)."""
    return F.trim(text, F.lit(WHITESPACE))


def cell_text(value: Column) -> Column:
    """A form or table cell: trimmed, missing becomes the empty string."""
    return F.coalesce(strip(value), F.lit(""))


def clean_title(title: Column) -> Column:
    """Cut a title at the first listed "opens in a new window" phrase it contains."""
    trimmed = strip(title)
    lowered = F.lower(trimmed)
    result = trimmed
    for phrase in reversed(fixed.TITLE_BAD_PHRASES):
        at = F.locate(phrase, lowered)
        head = F.rtrim(F.left(trimmed, at - 1), F.lit(fixed.TITLE_TAIL_CHARS))
        result = F.when(at > 0, strip(head)).otherwise(result)
    return result


def is_advert(title: Column) -> Column:
    """True if any advertising phrase occurs in the title, at any position."""
    return F.lower(title).rlike("|".join(map(re.escape, fixed.AD_TITLE_SUBSTRINGS)))


def _present(text: Column) -> Column:
    return F.when(
        text.isNull() | text.isin("nan", "NaN", "None"), F.lit("")
    ).otherwise(text)


def clean_condition(condition: Column) -> Column:
    """Drop one trailing bar, trim, and name the missing case."""
    text = strip(_present(condition))
    text = F.when(
        text.endswith("|"), strip(F.left(text, F.length(text) - 1))
    ).otherwise(text)
    return F.when(text == "", F.lit(fixed.NOT_GIVEN)).otherwise(text)


def fix_great_britain(origin: Column) -> Column:
    """Repair the known damaged spellings, exact match after trimming."""
    text = strip(origin)
    return F.when(
        text.isin(fixed.GREAT_BRITAIN_SPELLINGS), F.lit(fixed.GREAT_BRITAIN)
    ).otherwise(text)


def clean_origin(origin: Column) -> Column:
    """Drop a leading "aus ", repair spellings, trim; missing becomes empty."""
    text = _present(origin)
    # Most begin like this; the pattern takes longer than all else here.
    text = F.when(text.startswith("aus "), F.substr(text, F.lit(5))).otherwise(
        F.regexp_replace(text, rf"(?iu)^{SPACE_CLASS}*aus{SPACE_CLASS}+", "")
    )
    return fix_great_britain(text)


def _mentions_shipping(text: Column) -> Column:
    return F.lower(text).contains("versand")


def _is_shipping_row(text: Column) -> Column:
    return _mentions_shipping(text) | strip(text).startswith("+")


def _is_origin_row(text: Column) -> Column:
    lowered = F.lower(text)
    return ~_is_shipping_row(text) & (
        lowered.contains("aus ") | lowered.contains("from ")
    )


def shipping_row(attribute_texts: Column) -> Column:
    """First attribute text that speaks of shipping, else the empty string."""
    return F.coalesce(
        F.get(F.filter(attribute_texts, _is_shipping_row), F.lit(0)), F.lit("")
    )


def origin_row(attribute_texts: Column) -> Column:
    """First "aus/from" text, else the last text not about shipping.

    Whatever was found counts only if it contains "aus"; otherwise the home
    market is assumed.  So "from China" turns into the default, too.
    """
    found = F.coalesce(
        F.get(F.filter(attribute_texts, _is_origin_row), F.lit(0)),
        F.try_element_at(
            F.filter(attribute_texts, lambda t: ~_mentions_shipping(t)), F.lit(-1)
        ),
    )
    return F.when(F.lower(found).contains("aus"), found).otherwise(
        F.lit(fixed.DEFAULT_ORIGIN)
    )


def missing_to_null(text: Column) -> Column:
    """Turn the missing-value words into nulls (exact match, untrimmed)."""
    return F.when(text.isin(fixed.MISSING_WORDS), F.lit(None)).otherwise(text)

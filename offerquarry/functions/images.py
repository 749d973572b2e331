"""Image address out of the attributes of an ``img`` tag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions.text import WHITESPACE, strip


def first_of_srcset(srcset: Column) -> Column:
    """First address of a ``srcset`` list, else the empty string."""
    return F.regexp_extract(srcset, f"[^,{WHITESPACE}]+", 0)


def src_value(value: Column) -> Column:
    """An address as is; a text with both commas and blanks is read as ``srcset``."""
    text = strip(value)
    return F.when(
        text.contains(",") & text.contains(" "), first_of_srcset(text)
    ).otherwise(text)


def _attribute(attributes: Column, name: str) -> Column:
    return F.nullif(F.try_element_at(attributes, F.lit(name)), F.lit(""))


def image_url(attributes: Column) -> Column:
    """Best image address: ``src``, then the lazy-loading attributes, then ``srcset``.

    The first attribute that is not empty decides, even if only blanks are in it.
    """
    lazy = F.coalesce(
        *[_attribute(attributes, a) for a in fixed.IMAGE_FALLBACK_ATTRIBUTES]
    )
    return F.coalesce(
        strip(_attribute(attributes, "src")),
        src_value(lazy),
        first_of_srcset(_attribute(attributes, "srcset")),
        F.lit(""),
    )

"""The result view: shown columns, country filter, price sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions import money
from offerquarry.functions.text import cell_text


def result_rows(clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean listings as shown: trimmed texts, missing cells empty.

    ``preis`` shows the price without shipping.  ``sort_key`` is the number the
    price column sorts by.  ``keep`` names further columns to pass through.
    """
    kinds = dict(clean.dtypes)

    def shown(name: str) -> Column:
        if name not in kinds:
            return F.lit("")
        value = F.col(name)
        if kinds[name] == "double":
            value = money.float_text(value)
        return cell_text(value.cast("string"))

    rows = clean.select(
        *[shown(source).alias(name) for name, source in fixed.DISPLAY_FIELDS.items()],
        *(["price"] if kinds.get("price") == "double" else []),
        *keep,
    ).withColumn("preis_text", F.concat_ws(" ", "preis", "währung"))
    if kinds.get("price") == "double":
        key = F.coalesce(F.nanvl("price", F.lit(0.0)), F.lit(0.0))
        return rows.withColumn("sort_key", key).drop("price")
    return rows.withColumn("sort_key", money.sort_key(F.col("preis_text")))


def filter_land(rows: DataFrame, land: str = "") -> DataFrame:
    """Rows of one country; no choice keeps all."""
    return rows.where(F.col("region") == land) if land else rows


def filter_max_price(clean: DataFrame, limit: float) -> DataFrame:
    """Clean listings up to a price, for pages captured without a price limit."""
    return clean.where(F.col("price") <= limit)


def filter_keywords(clean: DataFrame, query: str) -> DataFrame:
    """Clean listings whose title holds every word of a search, ignoring case."""
    title = F.lower("title")
    for word in query.split():
        clean = clean.where(title.contains(word.lower()))
    return clean


def price_order(ascending: bool, order_by: Sequence[str]) -> list[Column]:
    """Sort columns: by price either way, equal prices in table order."""
    key = F.col("sort_key")
    return [key.asc() if ascending else key.desc(), *[F.col(c).asc() for c in order_by]]


def sort_by_price(
    rows: DataFrame, order_by: Sequence[str], ascending: bool = True
) -> DataFrame:
    return rows.orderBy(*price_order(ascending, order_by))


GERMAN = "de"


def land_options(rows: DataFrame) -> DataFrame:
    """Countries to choose from, in German dictionary order."""
    return (
        rows.where(F.col("region") != "")
        .select("region")
        .distinct()
        .orderBy(F.collate("region", GERMAN), "region")
    )


def result_view(
    clean: DataFrame,
    order_by: Sequence[str],
    land: str = "",
    ascending: bool = True,
) -> DataFrame:
    """Shown rows of one country (or all), sorted by price."""
    rows = filter_land(result_rows(clean, keep=order_by), land)
    return sort_by_price(rows, order_by, ascending)

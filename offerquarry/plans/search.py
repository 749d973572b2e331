"""A search over captured pages, from request to clean listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions.urls import search_url
from offerquarry.operators.cards import (
    Selectors,
    explode_cards,
    extract_pages,
    raw_listings,
)
from offerquarry.operators.dedupe import seen_links
from offerquarry.operators.walk import page_walk
from offerquarry.plans.clean import PAGE_ORDER, clean_listings
from offerquarry.sources.shared import write_and_read


def start_urls(requests: DataFrame) -> DataFrame:
    """``search_id, query, max_price`` to ``search_id, start_url``."""
    return requests.select(
        "search_id",
        search_url(F.col("query"), F.col("max_price")).alias("start_url"),
    )


def collect_searches(
    starts: DataFrame,
    extracted: DataFrame,
    max_pages: int = fixed.MAX_PAGES,
    item_path: str = fixed.ITEM_PATH,
) -> DataFrame:
    """Raw listings of all searches, each link once per search.

    ``extracted`` is the output of ``extract_pages`` with ``search_id, page_id,
    url``; it is read twice, so hand in a stored table.  Links are followed on
    narrow columns, then joined with the cards of the pages they reach.
    """
    visits = page_walk(
        starts, extracted.select("search_id", "url", "page_id", "next_href"), max_pages
    )
    # Visits first: cards of pages that no walk reaches are never exploded.
    pages = extracted.select("page_id", "cards", "next_href")
    visited = visits.drop("url").join(pages, "page_id").drop("page_id")
    found = raw_listings(explode_cards(visited), item_path)
    return seen_links(found).select("search_id", *PAGE_ORDER, *fixed.RAW_FIELDS)


def page_stats(extracted: DataFrame, listings: DataFrame) -> DataFrame:
    """Cards found and usable offers of every page, 0 where there are none.

    ``extracted`` has ``search_id, page_id, cards``; ``listings`` the offers with
    ``search_id, page_id`` after repeated links were dropped.
    """
    by = ["search_id", "page_id"]
    pages = extracted.select(*by, F.size("cards").cast("long").alias("cards_found"))
    usable = listings.groupBy(*by).agg(F.count("*").alias("usable_offers"))
    return pages.join(usable, by, "left").select(
        *by, "cards_found", F.coalesce("usable_offers", F.lit(0)).alias("usable_offers")
    )


def offers_found(requests: DataFrame, listings: DataFrame) -> DataFrame:
    """Number of raw listings of every search, 0 where there are none."""
    counts = listings.groupBy("search_id").agg(F.count("*").alias("offers_found"))
    return requests.select("search_id").join(counts, "search_id", "left").select(
        "search_id", F.coalesce("offers_found", F.lit(0)).alias("offers_found")
    )


@dataclass(frozen=True)
class SearchResult:
    raw: DataFrame
    clean: DataFrame


def run_search(
    requests: DataFrame,
    pages: DataFrame,
    *,
    selectors: Selectors = Selectors(),
    max_pages: int = fixed.MAX_PAGES,
) -> SearchResult:
    """Run many searches over captured pages.

    ``requests`` holds ``search_id, query, max_price``, ``pages`` holds
    ``search_id, page_id, url, html``; keep pages partitioned by search where one
    search is read at a time.  Each page of a requested search is parsed once (the
    stored ids are broadcast if Spark's limit allows it) and its cards are
    stored; the raw listings are stored before they are cleaned, so a stopped
    cleaning leaves them in place.
    """
    wanted = pages.select("search_id", "page_id", "url", "html").join(
        write_and_read(requests.select("search_id").distinct(), "searches"),
        "search_id",
        "left_semi",
    )
    extracted = write_and_read(extract_pages(wanted, selectors), "cards")
    raw = write_and_read(
        collect_searches(start_urls(requests), extracted, max_pages), "raw"
    )
    clean = clean_listings(raw, order_by=PAGE_ORDER, scope=["search_id"])
    return SearchResult(raw, clean)


def save_search(result: SearchResult, folder: str) -> None:
    """Write raw and clean listings as Parquet, each search's rows close together.

    Files hold ranges of search ids, so reading one search skips most row groups,
    while a very large search spreads over several files.
    """
    for name, table in (("raw", result.raw), ("clean", result.clean)):
        order = ["search_id", *PAGE_ORDER]
        table.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(
            "overwrite"
        ).parquet(f"{folder}/{name}")


def read_search(
    spark: SparkSession, folder: str, search_id: str | None = None
) -> DataFrame:
    """Saved clean listings, of one search or of all."""
    clean = spark.read.parquet(f"{folder}/clean")
    return clean if search_id is None else clean.where(F.col("search_id") == search_id)

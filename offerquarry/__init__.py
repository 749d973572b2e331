"""Listing prices on Spark: captured result pages in, clean price tables out."""

from offerquarry.operators.cards import Selectors, explode_cards, extract_pages
from offerquarry.operators.headers import MissingField
from offerquarry.plans.clean import clean_listings, quality_report, split_listings
from offerquarry.plans.results import land_options, result_rows, result_view
from offerquarry.plans.search import run_search

__all__ = [
    "MissingField",
    "Selectors",
    "clean_listings",
    "explode_cards",
    "extract_pages",
    "land_options",
    "quality_report",
    "result_rows",
    "result_view",
    "run_search",
    "split_listings",
]

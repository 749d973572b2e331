"""Following "next page" links over a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.sources.shared import drop_stored, write_and_read


def page_walk(
    starts: DataFrame, links: DataFrame, max_pages: int = fixed.MAX_PAGES
) -> DataFrame:
    """Pages each search visits, as ``search_id, page_no, url, page_id``.

    ``starts`` holds ``search_id, start_url``, one row per search; ``links`` holds
    ``search_id, url, page_id, next_href``.  The walk starts at the start URL and
    ends after ``max_pages`` pages, at a page without a next link, or at a link to
    a page that was not captured.  A page captured twice counts once, by its
    lowest ``page_id``.  Only these narrow columns move; page content does not.
    """
    captured = (
        links.groupBy("search_id", "url")
        .agg(F.min(F.struct("page_id", "next_href")).alias("first"))
        .select("search_id", "url", "first.page_id", "first.next_href")
    )
    # One row per search grows by one page per step, so each step is one join.
    walk = starts.select("search_id", F.col("start_url").alias("url_1"))
    for n in range(1, max_pages + 1):
        page = captured.select(
            "search_id",
            F.col("url").alias(f"url_{n}"),
            F.col("page_id").alias(f"page_{n}"),
            F.nullif(F.col("next_href"), F.lit("")).alias(f"url_{n + 1}"),
        )
        walk = walk.join(page, ["search_id", f"url_{n}"], "left")
    visits = [
        F.struct(
            F.lit(n).alias("page_no"),
            F.col(f"url_{n}").alias("url"),
            F.col(f"page_{n}").alias("page_id"),
        )
        for n in range(1, max_pages + 1)
    ]
    return walk.select("search_id", F.inline(F.array(*visits))).where(
        "page_id IS NOT NULL"
    )


def follow_links(starts: DataFrame, links: DataFrame, max_pages: int | None = None) -> DataFrame:
    """All pages each search reaches, as ``search_id, page_no, url, page_id``.

    Like ``page_walk`` for walks of any length, but a page counts once: the walk ends
    when it comes back to a page.  Jumps are doubled: after k rounds each page knows the
    page 2^k links ahead, and the first 2^k pages of a walk are known.  So a walk of 1000
    pages takes ten rounds, each a join of stored narrow tables, and the plan does not
    grow.  A round that reaches no new page is the last; loops end that way.
    """
    spark = starts.sparkSession
    page = ["search_id", "url"]
    captured = links.groupBy(*page).agg(F.min(F.struct("page_id", "next_href")).alias("first"))
    captured = captured.select(*page, "first.page_id", F.nullif("first.next_href", F.lit("")).alias("ahead"))
    # Stored with numbers: the rounds move these instead of searches and addresses.
    captured = write_and_read(captured.withColumn("id", F.monotonically_increasing_id()), "captured")
    there = captured.select("search_id", F.col("url").alias("ahead"), F.col("id").alias("ahead_id"))
    jumps = captured.where("ahead IS NOT NULL").select("search_id", "ahead", "id").join(there, ["search_id", "ahead"])
    jumps = write_and_read(jumps.select("id", F.col("ahead_id").alias("ahead")), "jumps")
    first = starts.select("search_id", F.col("start_url").alias("url")).distinct()
    reached = first.join(captured.select(*page, "id"), page).select("id", F.lit(1).cast("long").alias("page_no"))
    reached = write_and_read(reached, "reached")
    length, known = 1, reached.count()
    while known and (max_pages is None or length < max_pages):
        further = reached.join(jumps, "id").select(F.col("ahead").alias("id"), (F.col("page_no") + length).alias("page_no"))
        both = reached.unionByName(further).groupBy("id").agg(F.min("page_no").alias("page_no"))
        both = write_and_read(both, "reached")
        drop_stored(spark, reached)
        reached, before, known = both, known, both.count()
        length *= 2
        if known == before:
            break
        next_jump = jumps.select(F.col("id").alias("ahead"), F.col("ahead").alias("two"))
        doubled = jumps.join(next_jump, "ahead").select("id", F.col("two").alias("ahead"))
        doubled = write_and_read(doubled, "jumps")
        drop_stored(spark, jumps)
        jumps = doubled
    if max_pages is not None:
        reached = reached.where(F.col("page_no") <= max_pages)
    return reached.join(captured.select("id", *page, "page_id"), "id").select("search_id", "page_no", "url", "page_id")

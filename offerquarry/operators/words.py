"""Keyword search on whole words, by an index of postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def word_index(rows: DataFrame, key: Sequence[str], text: str = "title") -> DataFrame:
    """Postings: a row ``word, key...`` for each word of each text.

    Store it partitioned or sorted by ``word``, and a search reads only its own words.
    """
    return rows.select(F.explode(words_of(F.col(text))).alias("word"), *key)


def search_index(index: DataFrame, queries: DataFrame, key: Sequence[str]) -> DataFrame:
    """``query_id, key...``: the rows that hold all words of a query as whole words.

    ``queries`` holds ``query_id, query``; a query without words finds nothing.  The
    postings of all words asked for are brought together by row, once.  Queries are first
    cut down to those whose words all occur, and of each the rarest word leads: only rows
    that hold it are looked at, and their other words are tested where they lie.
    """
    asked = queries.select("query_id", words_of(F.col("query")).alias("words"))
    asked = asked.where(F.size("words") > 0)
    wanted = asked.select("query_id", F.size("words").alias("n"), F.explode("words").alias("word"))
    postings = index.join(wanted.select("word").distinct(), "word", "left_semi")
    often = postings.groupBy("word").agg(F.count("*").alias("often"))
    ranked = wanted.join(often, "word").groupBy("query_id", "n").agg(
        F.min(F.struct("often", "word")).alias("rarest"), F.collect_set("word").alias("found")
    )
    ranked = ranked.where(F.size("found") == F.col("n"))  # collects the words of one query
    leads = ranked.select("query_id", "n", F.col("rarest.word").alias("word"), F.array_remove("found", F.col("rarest.word")).alias("others"))
    done = postings.join(leads.where("n = 1"), "word").select("query_id", *key)
    # The words of a row lie together after one shuffle, however many queries ask for it.
    held = postings.dropna(subset=list(key)).groupBy(*key).agg(F.collect_list("word").alias("held"))
    led = held.withColumn("word", F.explode(F.array_distinct("held"))).join(leads.where("n > 1"), "word")
    lead = F.filter("held", lambda word: word == F.col("word"))
    others = F.filter("held", lambda word: F.array_contains("others", word))
    met = F.size(lead) * F.size(others)  # as in a join of the two: rows of equal keys count as pairs
    return done.unionByName(led.where(met == F.col("n") - 1).select("query_id", *key))

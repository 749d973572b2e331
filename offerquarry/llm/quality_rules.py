"""Quality rules whose limits come from the data (operator 10).

Each rule compares a ratio of a text's counts with limits.  The limits are not
fixed: for every language and source, quantile sketches of the ratios give the
quartiles q1 and q3, and a ratio is out of range if it lies further than ``REACH``
times the spread q3 - q1 (at least the rule's least spread) outside of them.

A sketch is a table of counts by bin.  Bins keep the five leading bits of a value,
so a quantile is at most 1/16 too low.  Sketches merge by adding counts, whatever
the order, so results are the same on every run.  The quartiles of a group of n
documents are drawn towards those of its language, as if ``PRIOR`` more documents lay
there, and a language's in the same way towards those of all documents: for groups of
every size by one formula, so that one document more or less hardly moves a limit.

Special cases: a null text is empty; a text with less than ``LEAST_WORDS`` words
fails; null languages and sources form groups of their own; rows with the same id,
or without one, are judged each by its own text; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.llm.text_stats import stats_column
from offerquarry.sources.shared import ship_code, write_and_read

LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
PRIOR = 200  # documents
REACH = 3


@dataclass(frozen=True)
class Rule:
    """``per`` times one count, divided by another; whole numbers throughout."""

    name: str
    per: int
    count: str
    by: str
    least_spread: int
    low: bool = False  # is there a lower limit, too?

    def value(self) -> Column:
        by = F.col(f"stats.{self.by}")
        return F.when(by > 0, F.expr(f"{self.per} * stats.{self.count} div stats.{self.by}"))


RULES = [
    Rule("symbols", 1000, "n_symbols", "n_words", 100),
    Rule("marks", 1000, "n_marks", "n_words", 100),
    Rule("upper", 1000, "n_upper", "word_chars", 50),
    Rule("digits", 1000, "n_digits", "word_chars", 50),
    Rule("dup_lines", 1000, "n_dup_lines", "n_lines", 100),
    Rule("word_length", 100, "word_chars", "n_words", 100, low=True),
]


def base_failed() -> Column:
    words, repeated = F.col("stats.n_words"), F.col("stats.n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def measure(docs: DataFrame) -> DataFrame:
    """``row`` (all of a document), ``lang``, ``source`` and ``stats``; no shuffle."""
    ship_code(docs.sparkSession)
    return docs.select(
        F.struct("*").alias("row"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        stats_column().alias("stats"),
    )


def sketches(measured: DataFrame) -> DataFrame:
    """Counts by language, source, rule and bin; tasks add up before the shuffle."""
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), r.value().alias("v")) for r in RULES])
    drop = F.expr("greatest(length(bin(v)) - 5, 0)")
    return (
        measured.select("lang", "source", F.inline(values))
        .where("v IS NOT NULL")
        .select("lang", "source", "rule", "v", drop.alias("drop"))
        .withColumn("bin", F.expr("shiftleft(shiftright(v, drop), drop)"))
        .groupBy("lang", "source", "rule", "bin")
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches to one for each ``keys`` and rule: ``q1``, ``q3`` and ``n``."""
    group = Window.partitionBy(*keys, "rule")
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    counted = merged.select("*", upto.alias("upto"), F.sum("n").over(group).alias("all"))
    return counted.groupBy(*keys, "rule").agg(
        F.min(F.when(F.expr("4 * upto >= all"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.expr("4 * upto >= 3 * all"), F.col("bin"))).alias("q3"),
        F.max("all").alias("n"),
    )


def limits(sketch: DataFrame) -> DataFrame:
    """One row per language and source: ``low_<rule>`` and ``high_<rule>``."""
    own = quartiles(sketch, ["lang", "source"])
    by_lang = quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("l"), F.col("rule").alias("l_rule"), F.struct("q1", "q3", "n").alias("of_lang")
    )
    overall = quartiles(sketch, []).select(
        F.col("rule").alias("o_rule"), F.struct("q1", "q3").alias("of_all")
    )
    both = own.join(
        by_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("l_rule"))
    ).join(overall, F.col("rule") == F.col("o_rule"))

    def drawn(n: str, own: str, to: str) -> str:
        return f"(({n} * {own} + {PRIOR} * {to}) div ({n} + {PRIOR}))"

    q = {
        name: F.expr(drawn("n", name, drawn("of_lang.n", f"of_lang.{name}", f"of_all.{name}")))
        for name in ("q1", "q3")
    }
    chosen = both.select("lang", "source", "rule", q["q1"].alias("q1"), q["q3"].alias("q3"))

    def limit(rule: Rule, high: bool) -> Column:
        reach = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(rule.least_spread))
        value = F.col("q3") + reach if high else F.col("q1") - reach
        return F.max(F.when(F.col("rule") == rule.name, value))

    return chosen.groupBy("lang", "source").agg(
        *[limit(r, True).alias(f"high_{r.name}") for r in RULES],
        *[limit(r, False).alias(f"low_{r.name}") for r in RULES if r.low],
    )


def verdicts(measured: DataFrame, limit: DataFrame) -> DataFrame:
    """Join each measured row with the limits of its language and source.

    A row without any ratio (no words) finds no limits and fails by its words.
    """
    limit = limit.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    checks = [F.coalesce(r.value() <= F.col(f"high_{r.name}"), F.lit(True)) for r in RULES]
    checks += [F.coalesce(r.value() >= F.col(f"low_{r.name}"), F.lit(True)) for r in RULES if r.low]
    same = F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(
        F.col("limit_source")
    )
    return measured.join(limit, same, "left").select(
        *measured.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & reduce(Column.__and__, checks)).alias("kept"),
    )


def stored_limits(measured: DataFrame) -> DataFrame:
    """The limits as a stored table.

    Its size in files is known when the join is planned: it is broadcast if below
    Spark's own limit for that, else both sides are shuffled.
    """
    return write_and_read(limits(write_and_read(sketches(measured), "sketches")), "limits")


def rate(docs: DataFrame) -> DataFrame:
    """``doc_id``, all counts, ``base_failed`` and ``kept``; a row per document."""
    narrow = measure(docs).select(F.col("row.doc_id").alias("doc_id"), "lang", "source", "stats")
    narrow = write_and_read(narrow, "measured")
    rated = verdicts(narrow, stored_limits(narrow))
    return rated.select("doc_id", "stats.*", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The texts are counted twice, once for the limits and once for the verdicts:
    that is cheaper than storing or shuffling them.
    """
    measured = measure(docs)
    limit = stored_limits(measured)
    return verdicts(measured, limit).where("kept").select("row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _oracle() -> str:
    spread = "CASE rule " + " ".join(f"WHEN '{r.name}' THEN {r.least_spread}" for r in RULES) + " END"
    two_sided = ", ".join(f"'{r.name}'" for r in RULES if r.low)

    def quartiles(keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""
            SELECT {by}rule, min(CASE WHEN 4 * upto >= total THEN bin END) AS q1,
                   min(CASE WHEN 4 * upto >= 3 * total THEN bin END) AS q3, max(total) AS n
            FROM (SELECT *, sum(n) OVER (PARTITION BY {by}rule ORDER BY bin) AS upto,
                         sum(n) OVER (PARTITION BY {by}rule) AS total
                  FROM (SELECT {by}rule, bin, sum(n) AS n FROM sketch GROUP BY {by}rule, bin))
            GROUP BY {by}rule"""

    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(text, chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
), windows AS (
    SELECT r, i, array_to_string(w[i : i + 7], ' ') AS run
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM worded)
), repeated AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 8)) AS p
          FROM windows JOIN (SELECT r, run FROM windows GROUP BY r, run HAVING count(*) > 1) USING (r, run))
    GROUP BY r
), counted AS (
    SELECT r, doc_id, lang, source, len(w) AS n_words,
           length(array_to_string(w, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g')) AS n_marks,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
           length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM worded LEFT JOIN repeated USING (r)
), valued AS (
    SELECT r, lang, source, u.rule, u.v
    FROM (SELECT r, lang, source, unnest([{", ".join(
        f"{{'rule': '{r.name}', 'v': CASE WHEN {r.by} > 0 THEN {r.per} * {r.count} // {r.by} END}}"
        for r in RULES)}]) AS u FROM counted)
    WHERE u.v IS NOT NULL
), sketch AS (
    SELECT lang, source, rule, bin, count(*) AS n
    FROM (SELECT *, (v::BIGINT >> greatest(length(bin(v::BIGINT)) - 5, 0)::BIGINT)
                    << greatest(length(bin(v::BIGINT)) - 5, 0)::BIGINT AS bin FROM valued)
    GROUP BY ALL
), chosen AS (
    SELECT own.lang, own.source, own.rule,
           ((own.n * own.q1 + {PRIOR} * ((l.n * l.q1 + {PRIOR} * o.q1) // (l.n + {PRIOR}))) // (own.n + {PRIOR}))::BIGINT AS q1,
           ((own.n * own.q3 + {PRIOR} * ((l.n * l.q3 + {PRIOR} * o.q3) // (l.n + {PRIOR}))) // (own.n + {PRIOR}))::BIGINT AS q3
    FROM ({quartiles("lang, source")}) own
    JOIN ({quartiles("lang")}) l ON own.lang IS NOT DISTINCT FROM l.lang AND own.rule = l.rule
    JOIN ({quartiles("")}) o ON own.rule = o.rule
), outside AS (
    SELECT DISTINCT r FROM valued v JOIN chosen c
    ON v.lang IS NOT DISTINCT FROM c.lang AND v.source IS NOT DISTINCT FROM c.source AND v.rule = c.rule
    WHERE v > q3 + {REACH} * greatest(q3 - q1, {spread.replace("rule", "c.rule", 1)})
       OR (c.rule IN ({two_sided}) AND v < q1 - {REACH} * greatest(q3 - q1, {spread.replace("rule", "c.rule", 1)}))
), based AS (
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed
    FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept
FROM based"""


ORACLE = _oracle()

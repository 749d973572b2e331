"""Mixing sources to target weights by pivotal rounding (operator 3).

A source takes part with as many words as its target says, so each of its documents
should be copied ``target / size of the source`` times: a whole number of copies and
a fraction.  Fractions are rounded in pairs.  Of two documents one hands words over to
the other until one fraction is 0 or 1; which way is drawn so that every fraction
keeps its mean, and the words of the two together do not change.

The rounding is a reduction tree: blocks of at most ``BLOCK`` documents of a source
are rounded one after the other, long documents first, which leaves one (mostly
short) document with a fraction; blocks of these are rounded in the same way, until
a single one is left.  That one is rounded to the nearer side, so a source's words are
off by at most half of one document.  Draws are hashes of the ids, so reruns agree.

Of n rows with the same id, source and size, floor(n * fraction) have one copy more, and
only what is left over is rounded with others; which rows that are follows their texts.

Special cases: repeated rows are copied each for itself, as said; a null text has size 0, and size 0 takes nothing; documents without source
form the last source; null ids are allowed.  All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import WORD, read_table
from offerquarry.operators.ordering import with_position
from offerquarry.sources.shared import write_and_read

WEIGHTS = [3, 1, 2]  # of the sources in code point order, repeating
SHARE = 150  # percent of all words
MOST_COPIES = 2
BLOCK = 128
SEED = 20


def sized(docs: DataFrame, extra: list[Column] = []) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *extra,
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources at their limit are set aside and the rest is shared anew, until no source
    is above its limit.  A round takes one aggregate over the sources, and at least
    one source leaves, all of those above the level at once.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_position(sources, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.expr(f"cast((position - 1) % {len(WEIGHTS)} + 1 AS int)"))
    ranked = write_and_read(
        ranked.select("source", "source_size", weight.cast("double").alias("weight")), "sources"
    )
    most = MOST_COPIES * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, fixed = 0.0, None
    while True:
        full = F.col("weight") * level >= most
        open_weight, full_words, n_full = ranked.agg(
            F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, most)), F.count_if(full)
        ).first()
        if n_full == fixed or open_weight is None:
            break
        fixed, level = n_full, (total * SHARE / 100 - (full_words or 0)) / open_weight
    return ranked.select(
        "source",
        "source_size",
        F.least(F.col("weight") * level, most.cast("double")).alias("target"),
    )


def _draw(*of: Column) -> Column:
    """A number in [0, 1) that depends on its arguments only."""
    return F.pmod(F.xxhash64(F.lit(SEED), *of), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pivot(carried: Column, item: Column) -> Column:
    """One step of a block: round ``carried`` against ``item``."""
    a, b = carried["left"], item
    a_words, b_words = a["words"], b["words"]
    give = F.least((1 - a["part"]) * a_words, b["part"] * b_words)  # from b to a
    take = F.least(a["part"] * a_words, (1 - b["part"]) * b_words)  # from a to b
    gives = _draw(a["doc_id"], b["doc_id"], a["words"], b["words"]) * (give + take) < take
    a_full = (1 - a["part"]) * a_words <= b["part"] * b_words
    b_full = (1 - b["part"]) * b_words <= a["part"] * a_words
    a_part = F.when(
        gives, F.when(a_full, F.lit(1.0)).otherwise(a["part"] + give / a_words)
    ).otherwise(F.when(b_full, a["part"] - take / a_words).otherwise(F.lit(0.0)))
    b_part = F.when(
        gives, F.when(a_full, b["part"] - give / b_words).otherwise(F.lit(0.0))
    ).otherwise(F.when(b_full, F.lit(1.0)).otherwise(b["part"] + take / b_words))

    def kept(x: Column, part: Column) -> Column:
        return F.struct(
            x["words"].alias("words"), x["doc_id"].alias("doc_id"), x["size"].alias("size"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)).alias("part"),
        )

    new_a, new_b = kept(a, a_part), kept(b, b_part)
    a_done = (a_part <= 0) | (a_part >= 1)
    return F.struct(
        F.when(a_done, new_b).otherwise(new_a).alias("left"),
        F.concat(carried["done"], F.array(F.when(a_done, new_a).otherwise(new_b))).alias("done"),
    )


def rounded(parts: DataFrame) -> DataFrame:
    """``doc_id, source, size, part`` with each part of ``parts`` rounded to 0 or 1.

    ``parts`` holds ``doc_id, source, size, words, part`` with words above 0 and parts
    between 0 and 1.
    """
    order = ["source", F.xxhash64("doc_id", "size", F.lit(SEED)), "doc_id", "size"]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    level = with_position(parts, order).withColumn("block", F.expr(f"position div {BLOCK}"))
    level = write_and_read(level.drop("position"), "level")
    done, last = [], False
    while not last:
        last = level.isEmpty() or level.agg(F.max("block")).first()[0] == 0
        items = F.sort_array(F.collect_list(F.struct("words", "doc_id", "size", "part")), asc=False)
        blocks = level.groupBy("source", "block").agg(items.alias("items"))
        first = F.struct(
            F.col("items")[0].alias("left"), F.expr("slice(items, 1, 0)").alias("done")
        )
        rest = F.expr("slice(items, 2, greatest(size(items) - 1, 0))")
        blocks = blocks.select("source", "block", F.aggregate(rest, first, _pivot).alias("r"))
        blocks = write_and_read(blocks.select("source", "block", "r.*"), "blocks")
        done.append(blocks.select("source", F.inline("done")))
        level = blocks.select("source", F.expr(f"block div {BLOCK}").alias("block"), "left.*")
    nearer = F.when(F.col("part") >= 0.5, 1.0).otherwise(0.0)
    result = level.select("source", "words", "doc_id", "size", nearer.alias("part"))
    for table in done:
        result = result.unionByName(table)
    return result.select("doc_id", "source", "size", "part")


def copies(sizes: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, n, whole, extra``: of the n rows that
    are equal in the first three, ``extra`` are copied once more than ``whole`` times.

    ``sizes`` is a stored table of ``doc_id, source, size``.
    """
    target = write_and_read(targets(sizes), "targets")
    documents = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    named = target.withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    documents = documents.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    share = F.when(F.col("size") > 0, F.col("n") * (rate - F.floor(rate))).otherwise(0.0)
    documents = documents.select(
        "*", F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).alias("whole"),
        F.floor(share).alias("sure"), (share - F.floor(share)).alias("part"),
    )
    documents = write_and_read(documents, "documents")
    open_ = documents.where("part > 0").select("doc_id", "source", "size", F.col("size").alias("words"), "part")
    drawn = rounded(open_).toDF("id", "of", "words", "drawn")
    extra = F.col("sure") + F.coalesce("drawn", F.lit(0.0)).cast("long")
    return documents.join(drawn, _same(), "left").select(
        "doc_id", "source", "size", "source_size", "target", "n", "whole", extra.alias("extra")
    )


def _same() -> Column:
    """Is a row of the document ``id, of, words``?"""
    return (
        F.col("doc_id").eqNullSafe(F.col("id"))
        & F.col("source").eqNullSafe(F.col("of"))
        & (F.col("size") == F.col("words"))
    )


def _copied(rows: DataFrame, decided: DataFrame, text: Column) -> DataFrame:
    """``rows`` (``doc_id, source, size`` and more) with ``source_size, target, copies``.

    Only rows of documents of which some rows, but not all, have a copy more are numbered:
    in ranges of their order, so that one document may hold any share of the rows.
    """
    decided = write_and_read(decided, "copies")
    named = decided.toDF("id", "of", "words", *decided.columns[3:])
    columns = [*rows.columns, "source_size", "target", "copies"]
    joined = rows.join(named, _same())
    uniform = F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)
    alike = joined.where("extra = 0 OR extra = n").withColumn("copies", uniform).select(columns)
    if decided.where("extra > 0 AND extra < n").isEmpty():
        return alike
    mixed = joined.where("extra > 0 AND extra < n").drop("id", "of", "words")
    mixed = mixed.withColumn("_text", F.xxhash64(text)).withColumn("_row", F.monotonically_increasing_id())
    keys = ["doc_id", "source", "size"]
    placed = with_position(mixed, [F.col(c) for c in (*keys, "_text", "_row")], "_position")
    first = placed.groupBy(*keys).agg(F.min("_position").alias("_first")).toDF("id", "of", "words", "_first")
    placed = placed.join(write_and_read(first, "first"), _same())
    more = F.when(F.col("_position") - F.col("_first") < F.col("extra"), 1).otherwise(0)
    return alike.unionByName(placed.withColumn("copies", F.col("whole") + more).select(columns))


def plan(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``; a row per document."""
    sizes = write_and_read(sized(docs), "sizes")
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    rows = _copied(sizes, copies(sizes), F.lit(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken)


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken."""
    decided = copies(write_and_read(sized(docs), "sizes"))
    rows = _copied(sized(docs, [F.struct("*").alias("row")]), decided, F.col("row.text"))
    repeated = rows.where("copies > 0").select("row", F.explode(F.expr("sequence(1L, cast(copies AS bigint))")).alias("n"))
    return repeated.select("row.*")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(read_table(spark, sf_dir, "documents")).drop("source")

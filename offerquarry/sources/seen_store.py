"""Links seen in earlier runs, kept as a table.

The table is partitioned by a bucket of the key's hash, and grows by the new keys of each
run.  A run does not shuffle it: a Bloom filter of the run's own keys is laid over it
first, so nearly only those rows move that are in the run as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.operators.dedupe import keep_first
from offerquarry.sources.shared import no_rows, write_and_read

BUCKETS = 64
PROBES = 3
BITS_A_KEY = 10
MOST_WORDS = 1 << 21  # of 64 bits each (32 MB as a table); larger runs go without a filter


def read_seen(spark: SparkSession, folder: str, kinds: str) -> DataFrame:
    """The keys seen so far; no table yet gives an empty one."""
    try:
        return spark.read.schema(kinds).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return no_rows(spark, kinds)


def _probes(keys: Sequence[str], bits: int) -> list[Column]:
    """Where the bits of a key lie."""
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) for i in range(PROBES)]


def bloom_words(keys: DataFrame, bits: int) -> DataFrame:
    """``word, mask``: the set bits of a Bloom filter, 64 to a word.

    Tasks set bits together before the shuffle; the table has at most ``bits / 64`` rows.
    """
    places = keys.select(F.explode(F.array(*_probes(keys.columns, bits))).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    return places.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("mask"))


def may_be_in(table: DataFrame, keys: Sequence[str], words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``table`` whose keys the filter may hold: all that it holds, and few
    others.  ``words`` is broadcast: its size is bounded by ``bits``."""
    columns = table.columns
    for i, probe in enumerate(_probes(keys, bits)):
        held = words.toDF(f"_word{i}", f"_mask{i}")
        table = table.withColumn(f"_bit{i}", probe).withColumn(f"_word{i}", F.shiftright(f"_bit{i}", 6))
        table = table.join(F.broadcast(held), f"_word{i}")
        bit = F.expr(f"shiftright(_mask{i}, cast(_bit{i} & 63 AS int)) & 1")
        table = table.where(bit == 1).select(columns)
    return table


def new_links(
    listings: DataFrame,
    folder: str,
    scope: Sequence[str] = ("search_id",),
    order_by: Sequence[str] = ("page_no", "pos"),
) -> DataFrame:
    """Listings whose link no earlier run has seen, the first of each; adds them to the
    table in ``folder``.

    Several runs give together what one run over all their listings gives, as long as
    they take pages in order.  The result is stored before its keys are added, so a run
    that stops before that leaves the table as it was; adding keys twice does no harm.
    """
    spark = listings.sparkSession
    keys = [*scope, "link"]
    first = write_and_read(keep_first(listings, keys, list(order_by)), "first")
    own = first.select(keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    seen = read_seen(spark, folder, f"{kinds}, bucket int").select(keys)
    bits = max(64, BITS_A_KEY * own.count())
    if bits <= 64 * MOST_WORDS:
        words = write_and_read(bloom_words(own, bits), "bloom")
        seen = may_be_in(seen, keys, words, bits)
    same = [first[k].eqNullSafe(seen[k]) for k in keys]
    found = write_and_read(first.join(seen, same, "left_anti"), "new")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")
    added = found.select(*keys, bucket).repartition("bucket")
    added.write.mode("append").partitionBy("bucket").parquet(folder)
    return found

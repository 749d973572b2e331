"""Keep-first duplicates removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampType
from pyspark.sql.window import Window


# Types whose equal values have equal hashes (texts: unless a collation makes them equal).
_HASHED = (StringType, NumericType, DateType, TimestampType, BooleanType)


def _plain(kind: DataType) -> bool:
    return kind == StringType() if isinstance(kind, StringType) else True


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row, in the given order, of each group of equal keys.

    Nulls are equal to each other.  Spark evaluates the rank limit before the
    shuffle as well, so each task sends at most one row per key: a key held by a
    third of all rows does not load a single task.  Rows are sorted by a hash of the
    keys first: it tells nearly all groups apart, so long texts are seldom compared.
    """
    hashed = [k for k in keys if isinstance(df.schema[k].dataType, _HASHED) and _plain(df.schema[k].dataType)]
    groups = [F.xxhash64(*hashed), *keys] if hashed else keys
    first = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by))
    return df.withColumn("_nth", first).where("_nth = 1").drop("_nth")


def seen_links(listings: DataFrame, scope: Sequence[str] = ("search_id",)) -> DataFrame:
    """First listing of each link within a search, by page, then position."""
    return keep_first(listings, [*scope, "link"], ["page_no", "pos"])


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows ``keep_first`` on these keys would remove."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed")
    )

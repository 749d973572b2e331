"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BOUND = "_bound_values"


def with_bound(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that later filters are to read, not to recompute.

    Spark moves a filter on a plain computed column below the projection, with the
    whole expression in it, so the column would be computed twice.  It does not do
    so for what comes out of unfolding an array, here always of one element.  The values
    are made in a projection below, as only there steps that they share are done once.
    """
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", values.alias(_BOUND)).select("*", F.inline(F.array(_BOUND))).drop(_BOUND)

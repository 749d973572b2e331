"""Append-only log of search requests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry import fixed
from offerquarry.functions.text import cell_text
from offerquarry.sources.listing_files import CSV_FORM, text_schema


def log_rows(requests: DataFrame) -> DataFrame:
    """Requests (``query, max_price, region``) as log rows; the link stays empty."""
    product, price, region, link = fixed.SEARCH_LOG_FIELDS
    return requests.select(
        cell_text(F.col("query")).alias(product),
        cell_text(F.col("max_price").cast("string")).alias(price),
        cell_text(F.col("region")).alias(region),
        F.lit("").alias(link),
    )


def append_searches(requests: DataFrame, path: str) -> None:
    """Add requests to the log; every file of it carries the header."""
    log_rows(requests).write.mode("append").options(**CSV_FORM).csv(path)


def read_search_log(spark: SparkSession, path: str) -> DataFrame:
    """The log as text columns; no file yet gives an empty table."""
    reader = spark.read.options(**CSV_FORM, multiLine=True).schema(
        text_schema(fixed.SEARCH_LOG_FIELDS)
    )
    try:
        log = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], text_schema(fixed.SEARCH_LOG_FIELDS))
    return log.fillna("")

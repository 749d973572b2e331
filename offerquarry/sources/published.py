"""Clean listings as published: the last good result of each search, laid out for reading.

Every run writes its rows to a version of its own and then a new manifest, which names the
version that holds each search's rows.  Readers take the last complete manifest, so they
see the old rows until the new ones are all there, and still do if a run stops.  A run
replaces only the searches that it names and that pass the gate.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.plans.clean import split_listings
from offerquarry.sources.shared import write_and_read

ROW_GROUP = 8 << 20  # bytes; small groups, so that their statistics tell something


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the complete manifests, the last one last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        return []
    found = [entry.getPath() for entry in files.listStatus(path)]
    marked = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted((p.toString() for p in marked), key=lambda p: int(p.rsplit("-", 1)[1]))


def _manifest(spark: SparkSession, folder: str) -> tuple[int, DataFrame | None]:
    paths = _manifests(spark, folder)
    if not paths:
        return 0, None
    return int(paths[-1].rsplit("-", 1)[1]), spark.read.parquet(paths[-1])


def laid_out(clean: DataFrame, first: Sequence[str] = ()) -> DataFrame:
    """Rows clustered by country and price, so that files and row groups hold narrow
    ranges of both; ties spread over files by link."""
    order = [*first, "product_origin", "price"]
    ties = [c for c in ("link",) if c in clean.columns]
    return clean.repartitionByRange(*order, *ties).sortWithinPartitions(*order, *ties)


def publish(
    raw: DataFrame, searches: DataFrame, folder: str, *, order_by: Sequence[str] | None = None, url_column: str | None = None
) -> DataFrame:
    """Clean and publish the raw listings of some searches.

    ``searches`` names them in ``search_id``, also those without listings: these are
    published as empty.  A search with a row that lacks a required field keeps its old
    rows.  Returns ``search_id, published``.
    """
    spark = raw.sparkSession
    good, bad = split_listings(raw, order_by=order_by, scope=["search_id"], url_column=url_column)
    stopped = write_and_read(bad.select("search_id").distinct(), "stopped")
    named = searches.select("search_id").distinct()
    passed = write_and_read(named.join(stopped, "search_id", "left_anti"), "passed")
    version = uuid.uuid4().hex
    rows = good.join(passed, "search_id", "left_semi")
    laid_out(rows).write.option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/data/version={version}")
    number, old = _manifest(spark, folder)
    new = passed.withColumn("version", F.lit(version))
    if old is not None:
        new = new.unionByName(old.join(passed, "search_id", "left_anti"))
    new.write.parquet(f"{folder}/manifests/manifest-{number + 1}")
    return named.join(stopped.withColumn("stopped", F.lit(True)), "search_id", "left").select(
        "search_id", F.col("stopped").isNull().alias("published")
    )


def published(spark: SparkSession, folder: str, *, land: str = "", max_price: float | None = None) -> DataFrame:
    """The published rows; a country or a highest price reads only the row groups that
    may hold such rows."""
    _, manifest = _manifest(spark, folder)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    versions = [row.version for row in manifest.select("version").distinct().collect()]  # of runs
    rows = spark.read.option("basePath", f"{folder}/data").parquet(*[f"{folder}/data/version={v}" for v in versions])
    rows = matching(rows, land, max_price)
    return rows.join(manifest, ["search_id", "version"], "left_semi").drop("version")


def matching(rows: DataFrame, land: str = "", max_price: float | None = None) -> DataFrame:
    """Filters on plain columns, which Spark hands on to the files' statistics."""
    tests: list[Column] = []
    if land:
        tests.append(F.col("product_origin") == land)
    if max_price is not None:
        tests.append(F.col("price") <= max_price)
    for test in tests:
        rows = rows.where(test)
    return rows


def remove_unpublished(spark: SparkSession, folder: str) -> list[str]:
    """Delete the versions that the last manifest does not name; returns their names.

    Call it when no reader works on an older manifest any more.
    """
    _, manifest = _manifest(spark, folder)
    named = {row.version for row in manifest.select("version").distinct().collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/data")
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    gone = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName().removeprefix("version=")
        if name not in named:
            files.delete(entry.getPath(), True)
            gone.append(name)
    return sorted(gone)

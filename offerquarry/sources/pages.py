"""Captured result pages."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.sources.shared import no_rows, ship_code, write_and_read


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Pages kept as a Parquet table with a ``html`` column.

    Parsing is CPU-heavy: with ``partitions``, rows are dealt out to that many tasks,
    for a table in fewer splits than there are cores.
    """
    pages = spark.read.parquet(path)
    return pages.repartition(partitions) if partitions else pages


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages kept as one HTML file each: ``url`` is the file's address."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )


def write_pages(pages: DataFrame, folder: str) -> None:
    """A file for each ``capture`` (whole numbers) below ``folder/capture=N``, which holds its
    ``html`` and a line end, of several rows one after the other.

    Files on local or mounted disks are written by Python tasks: there Hadoop's file system
    starts a process of its own for each new file and folder, to set its mode.
    """
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    place = system.makeQualified(path).toUri()
    named = pages.select("capture", "html").repartition("capture")
    if place.getScheme() != "file":
        # Tasks put their files in place; version 1 has the driver move all folders.
        writer = named.select("html", "capture").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.mode("append").partitionBy("capture").text(folder)
        return
    ship_code(spark)
    content = F.coalesce("html", F.lit("")).cast("binary")
    rows = named.select("capture", content.alias("html")).sortWithinPartitions("capture")
    target, name = place.getPath(), f"part-{uuid.uuid4().hex}.txt"  # a task that is tried again writes its files again
    done = rows.mapInArrow(lambda batches: _write_files(batches, target, name), "files long")
    done.write.format("noop").mode("overwrite").save()


def _write_files(batches: Iterator[pa.RecordBatch], folder: str, name: str) -> Iterator[pa.RecordBatch]:
    """Rows that lie side by side by their capture, each capture as one file."""
    rows = ((k.as_py(), v.as_py()) for b in batches for k, v in zip(b.column("capture"), b.column("html")))
    count = 0
    for capture, texts in groupby(rows, lambda row: row[0]):
        place = f"{folder}/capture={'__HIVE_DEFAULT_PARTITION__' if capture is None else capture}"
        begun = f"{place}/.{uuid.uuid4().hex}"
        os.makedirs(place, exist_ok=True)
        with open(begun, "wb") as file:
            for _, text in texts:
                file.write(text)
                file.write(b"\n")
        os.replace(begun, f"{place}/{name}")
        count += 1
    yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])


# Bytes 0x80 to 0x9F as Latin-1 has them, and as the web reads pages that claim Latin-1.
_CONTROLS = [bytes([b]) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_FROM = "".join(b.decode("latin-1") for b in _CONTROLS)
_TO = "".join(b.decode("cp1252") for b in _CONTROLS)
_CHARSET = r"(?i)charset\s*=\s*[\"']?\s*([a-z0-9_-]+)"
_HEAD = 4096  # bytes that may name the encoding


def page_text(content: Column) -> Column:
    """A page's bytes as text, by the encoding it names in its head.

    UTF-8, UTF-16 and Latin-1 (read as Windows-1252) are known; a page that names none of
    them, or is not what it says, is UTF-8 if that is valid and Windows-1252 if not.
    """
    head = F.decode(F.substring(content, 1, _HEAD), "ISO-8859-1")
    named = F.lower(F.regexp_extract(head, _CHARSET, 1))
    utf8 = F.regexp_replace(content.cast("string"), "^\ufeff", "")
    western = F.translate(F.decode(content, "ISO-8859-1"), _FROM, _TO)
    return (
        F.when(F.substring(content, 1, 2).isin(b"\xff\xfe", b"\xfe\xff"), F.decode(content, "UTF-16"))
        .when(named.isin("iso-8859-1", "latin1", "latin-1", "windows-1252", "cp1252"), western)
        .when(F.is_valid_utf8(content.cast("string")), utf8)
        .otherwise(western)
    )


OPEN_COST = "spark.sql.files.openCostInBytes"
#: What opening a captured file is taken to cost.  Spark's 4 MB put some 30 small files into
#: a task, so that starting the tasks takes longer than reading the files.
OPEN_BYTES = 256 << 10
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Tasks a core that list folders.
TASKS_A_CORE = 8


def captured_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder: ``file`` (path below the folder), ``changed``, and
    ``content``, which is not read unless it is asked for.

    The folder is listed once, by this call.  Spark would list up to 10,000 folders by a
    task each; a few tasks a core list many, one after the other.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    start = len(system.makeQualified(path).toString()) + 2
    tasks, before = LISTING_TASKS, spark.conf.get(LISTING_TASKS)
    spark.conf.set(tasks, str(min(int(before), TASKS_A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    finally:
        spark.conf.set(tasks, before)
    name = F.expr(f"substring(path, {start})").alias("file")
    return files.select(name, F.col("modificationTime").alias("changed"), "content")


def new_captures(
    spark: SparkSession, folder: str, manifest: DataFrame, done_folder: str, files: DataFrame | None = None
) -> DataFrame:
    """``search_id, page_id, url, html`` of the captured files not read before.

    ``manifest`` holds ``file, search_id, url``: which page of which search a file (named
    from the folder on) holds.  Page ids are hashes of search and file, so they stay the
    same.  Files read are remembered in ``done_folder``, with their time of change: older
    files are not even opened in the next run, the others are compared by name.  Files
    that the manifest does not name yet are left for a later run.  A caller that took its
    manifest from ``captured_files`` hands these on as ``files``: to list many files takes
    longer than to read them.
    """
    files = captured_files(spark, folder) if files is None else files
    kinds = "file string, changed timestamp"
    try:
        done = spark.read.schema(kinds).parquet(done_folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = no_rows(spark, kinds)
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, str(OPEN_BYTES))
    try:
        pages = _waiting_pages(files, manifest, done, done_folder)
    finally:
        spark.conf.set(OPEN_COST, before)
    return no_rows(spark, "search_id string, page_id long, url string, html string") if pages is None else pages


def _waiting_pages(files: DataFrame, manifest: DataFrame, done: DataFrame, done_folder: str) -> DataFrame | None:
    """The stored pages of files that are not done yet, which are done then; none: None."""
    listed = files.select("file", "changed")
    waiting = manifest.select("file", "search_id", "url").join(listed, "file")  # contents are not read here
    waiting = write_and_read(waiting.join(done.select("file"), "file", "left_anti"), "waiting")
    oldest = waiting.agg(F.min("changed")).first()[0]
    if oldest is None:
        return None
    # Spark leaves older files out when it lists them.
    contents = files.where(F.col("changed") >= F.lit(oldest)).select("file", "content")
    pages = contents.join(waiting, "file").select(
        "search_id",
        F.xxhash64("search_id", "file").alias("page_id"),
        "url",
        page_text(F.col("content")).alias("html"),
    )
    pages = write_and_read(pages, "captures")
    waiting.select("file", "changed").write.mode("append").parquet(done_folder)
    return pages

"""CSV records of files of any size, encoding and header, all files in one read.

A line break may lie in a quoted cell, so a line alone does not tell where a record
begins.  It does if one knows how many quotes stand before it in its file: an even
number means outside of a cell.  So files are read in splits, twice:

1. A count.  One aggregate gives each split its number of lines with an odd number of
   quotes, and whether all is valid UTF-8; the first split of a file also gives the
   header.  Sums over the splits of a file tell each split how many odd lines come
   before it.  The result is a stored table, a row per split.
2. The records.  Each split starts with its sum and joins its lines to records as they
   come.  Records across a split's border come from a second pass over those splits
   only, grouped by the number of odd lines before them.

Files are never listed on the driver; it gets the distinct header lines.  Quotes must be
doubled inside of quoted cells and not stand in others, as the writers here and most
programs do.  A header must be one line.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerquarry.functions.text import WHITESPACE
from offerquarry.sources.shared import ship_code, write_and_read

#: Splits whose state is sent to all tasks (some 300 bytes each); beyond that, the lines
#: are shuffled to the states of their splits and sorted again.
MOST_SENT = 100_000

_SCHEMA = "split long, row long, record long, line binary"
_ARROW = pa.schema([("split", pa.int64()), ("row", pa.int64()), ("record", pa.int64()), ("line", pa.binary())])


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines as bytes, with where they lie; big files in many splits."""
    # The line end is named, so that the return before it stays, and so do lone ones.
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (quotes % 2).alias("odd"),
        "value",
    )


def split_states(spark: SparkSession, path: str | list[str], encoding: str | None = None) -> DataFrame:
    """A stored row per split: ``path, block, before`` (odd lines before it in its file),
    ``odd`` (in it), ``utf8`` (is the whole file?), ``header`` (the file's first line) and
    ``split``, a number of its own."""
    splits = _lines(spark, path).groupBy("path", "block").agg(
        F.sum("odd").alias("odd"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.min_by(F.col("value").cast("binary"), "row").alias("first"),
    )
    file = Window.partitionBy("path")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    utf8 = F.min("utf8").over(file) if encoding is None else F.lit(encoding.upper() in ("UTF-8", "UTF8"))
    placed = splits.select(
        "path", "block", "odd",
        F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"),
        utf8.alias("utf8"),
        F.min_by("first", "block").over(file).alias("first"),
    )
    header = F.regexp_replace(decoded("first"), "^﻿|\r$", "")
    numbered = placed.withColumn("header", header).withColumn("split", F.monotonically_increasing_id())
    return write_and_read(numbered.drop("first"), "splits")


def decoded(line: str) -> Column:
    """Bytes as text, by the flag of their file."""
    return F.when(F.col("utf8"), F.col(line).cast("string")).otherwise(F.decode(line, "ISO-8859-1"))


def header_names(header: str) -> list[str]:
    return [name.strip(WHITESPACE) for name in next(csv.reader([header]), [])]


def _join_lines(batches: Iterator[pa.RecordBatch], torn: bool) -> Iterator[pa.RecordBatch]:
    """Lines of splits, in order, to records; ``torn``: only the lines, each on its own,
    of records that begin or end in another split."""
    split, count, held, header = None, 0, [], False  # held: lines of a record that is open yet
    for batch in batches:
        keys = batch.column("split").to_numpy()
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1) != 0).tolist()
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            if keys[start] != split:
                if torn:
                    yield from held
                split, count, held = keys[start], int(batch.column("before")[start].as_py()), []
                header = batch.column("block")[start].as_py() == 0
            odd = batch.column("odd").to_numpy()[start:end].astype(np.int64)
            after = count + np.cumsum(odd)
            before = after - odd
            count = int(after[-1])
            rows, lines = (batch.column(name).slice(start, end - start) for name in ("row", "line"))
            part = [batch.column("split").slice(start, end - start), rows, pa.array(before // 2), lines]
            part = pa.RecordBatch.from_arrays(part, schema=_ARROW)
            begins, ends = np.flatnonzero(before % 2 == 0), np.flatnonzero(after % 2 == 0)
            if not held:
                first = int(begins[0]) if len(begins) else len(odd)
                if torn and first:
                    yield part.slice(0, first)
                begins, ends, part = begins - first, ends[ends >= first] - first, part.slice(first)
            if not len(ends):
                held += [part] if part.num_rows else []
                continue
            if held:
                earlier = sum(h.num_rows for h in held)
                begins, ends = np.append(0, begins + earlier), ends + earlier
                part = pa.Table.from_batches([*held, part]).combine_chunks().to_batches()[0]
            stop = int(ends[-1]) + 1
            if not torn:
                yield _joined(part.slice(0, stop), begins[begins < stop], header)
                header = False
            held = [part.slice(stop)] if stop < part.num_rows else []
    if torn:
        yield from held


def _joined(lines: pa.RecordBatch, begins: np.ndarray, header: bool) -> pa.RecordBatch:
    """A row per record; ``header``: the first one is left out."""
    records = lines
    if len(begins) < lines.num_rows:
        offsets = pa.array(np.append(begins, lines.num_rows), pa.int32())
        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.column("line")), b"\n")
        firsts = [lines.column(name).take(pa.array(begins)) for name in ("split", "row", "record")]
        records = pa.RecordBatch.from_arrays([*firsts, texts], schema=_ARROW)
    return records.slice(1) if header else records


def few_splits(states: DataFrame) -> bool:
    """Can the states be sent to all tasks?"""
    return states.count() <= MOST_SENT


def records(spark: SparkSession, path: str | list[str], states: DataFrame) -> DataFrame:
    """``path, block, row, header, text``: a row per record but headers and blank lines.

    Sorted by path, block and row, records have the order of their files.
    """
    ship_code(spark)
    few = few_splits(states)

    def small(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    def joined(part: DataFrame, torn: bool) -> DataFrame:
        lines = _lines(spark, path).withColumn("line", F.col("value").cast("binary")).drop("value")
        both = lines.join(small(part), ["path", "block"])
        if not few:
            both = both.repartition("split").sortWithinPartitions("path", "block", "row")
        both = both.select("split", "odd", "before", "block", "row", "line")
        # What a split's lines share does not go through Python with each line.
        return both.mapInArrow(lambda b: _join_lines(b, torn), _SCHEMA).join(small(state), "split")

    state = states.select("split", "path", "block", "utf8", "header")
    numbers = ["split", "path", "block", "before"]
    whole = joined(states.select(numbers), torn=False)
    open_ends = states.where("before % 2 = 1 OR (before + odd) % 2 = 1")
    parts = joined(open_ends.select(numbers), torn=True)
    in_order = F.array_sort(F.collect_list(F.struct("block", "row", "line")))
    whole_again = parts.groupBy("path", "record").agg(
        in_order.alias("lines"), F.first("header").alias("header"), F.first("utf8").alias("utf8")
    )
    strings = F.transform("lines", lambda x: x["line"].cast("string"))
    whole_again = whole_again.select(
        "path", F.col("lines")[0]["block"].alias("block"), F.col("lines")[0]["row"].alias("row"),
        "header", "utf8", F.array_join(strings, "\n").cast("binary").alias("line"),
    )
    columns = ["path", "block", "row", "header", "utf8", "line"]
    every = whole.select(columns)
    every = every.unionByName(whole_again) if not open_ends.isEmpty() else every
    line = decoded("line")
    # Looked for first, as the pattern takes longer than all else here.
    text = F.when(line.contains("\r"), F.regexp_replace(line, "\r$", "")).otherwise(line)
    return every.select("path", "block", "row", "header", text.alias("text")).where("text <> ''")

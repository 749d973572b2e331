"""Listing tables as CSV files: raw input, clean output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from offerquarry import fixed
from offerquarry.functions.money import float_text
from offerquarry.functions.text import missing_to_null
from offerquarry.operators.headers import MissingField, find_roles, kept_name, unique_names
from offerquarry.sources.csv_records import few_splits, header_names, records, split_states
from offerquarry.sources.shared import drop_stored, write_and_read

# Quotes are doubled inside quoted cells, blanks are kept, nothing is empty-quoted.
CSV_FORM = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
}

# File order of rows: sort by these to get back the order in the files.
FILE_ORDER = ["source_file", "source_block", "source_row"]


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """Raw listing files, every cell as text, header names trimmed.

    A file that is not valid UTF-8 is read as Latin-1, as a whole, unless ``encoding``
    (UTF-8 or ISO-8859-1) is named.  Big files are read by many tasks, also if cells hold
    line breaks.  All files must have the same header; ``read_listing_files`` reads files
    with different ones.  ``keep_order`` adds the ``FILE_ORDER`` columns.
    """
    states, layouts = _layouts(spark, path, encoding)
    if len({tuple(layout.names) for layout in layouts}) != 1:
        raise ValueError(f"the files differ in their header: {[layout.header for layout in layouts]}")
    names = layouts[0].names
    rows = _cells(records(spark, path, states), len(names))
    return _placed(rows, [F.col("cells")[f"c{i}"] for i in range(len(names))], names, states if keep_order else None)


def read_listing_files(
    spark: SparkSession, path: str | list[str], *, encoding: str | None = None, keep_order: bool = False
) -> DataFrame:
    """Raw listing files whose headers may differ, as one table.

    Roles (title, condition, price, country, shipping) are found for each header by its
    synonyms and come first, under the fixed raw names; other columns follow by name, in
    the order in which they first appear.  A column that a file lacks is null there; a
    header without a price column raises ``MissingField``, with that header.
    """
    states, layouts = _layouts(spark, path, encoding)
    places: dict[str, dict[str, int]] = {name: {} for name in fixed.RAW_FIELDS[:5]}
    shown: dict[str, str] = {name.lower(): name for name in places}
    for layout in layouts:
        for name, place in layout.resolved():
            name = shown.setdefault(name.lower(), name)
            places.setdefault(name, {})[layout.header] = place
    rows = _cells(records(spark, path, states), max(len(layout.names) for layout in layouts))
    columns = []
    for by_header in places.values():
        chosen = F.lit(None).cast("string")
        for place in sorted(set(by_header.values())):
            headers = [F.lit(h) for h, p in by_header.items() if p == place]
            chosen = F.when(F.col("header").isin(headers), F.col("cells")[f"c{place}"]).otherwise(chosen)
        columns.append(chosen)
    return _placed(rows, columns, list(places), states if keep_order else None)


@dataclass(frozen=True)
class Layout:
    """A header line that some files share."""

    header: str
    names: list[str]

    def resolved(self) -> list[tuple[str, int]]:
        """Output names and places of its columns, roles under the raw names."""
        roles = find_roles(self.names)
        if roles.price is None:
            raise MissingField(f"no price column found in the header {self.header!r}")
        of_role = [roles.title, roles.condition, roles.price, roles.country, roles.shipping]
        found = [(n, p) for n, p in zip(fixed.RAW_FIELDS, of_role) if p is not None]
        rest = [p for p in range(len(self.names)) if p not in of_role]
        taken = fixed.RAW_FIELDS[:5]
        names = unique_names([*taken, *[kept_name(self.names[p]) for p in rest]])[len(taken) :]
        return found + list(zip(names, rest))


def _layouts(spark: SparkSession, path: str | list[str], encoding: str | None) -> tuple[DataFrame, list[Layout]]:
    """The states of all splits, and the distinct headers in the order of their files."""
    states = split_states(spark, path, encoding)
    first = states.groupBy("header").agg(F.min(file_key(F.col("path"))).alias("first"))
    headers = [row.header for row in first.orderBy("first").collect()]  # a row per layout
    if not headers:
        raise ValueError(f"no file with a header in {path}")
    return states, [Layout(header, header_names(header)) for header in headers]


def _cells(rows: DataFrame, width: int) -> DataFrame:
    """Records cut into ``cells.c0``, ``cells.c1`` and so on, missing ones null."""
    schema = ", ".join(f"c{i} string" for i in range(max(width, 1)))
    return rows.withColumn("cells", F.from_csv("text", schema, {**_cell_form(), "maxCharsPerColumn": "-1"}))


def _cell_form() -> dict[str, str]:
    """``CSV_FORM`` as column functions take it."""
    return {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_FORM.items() if k != "header"}


def _placed(rows: DataFrame, columns: list[Column], names: list[str], states: DataFrame | None) -> DataFrame:
    """Named columns; with the states of the splits also the ``FILE_ORDER``."""
    if states is not None:
        # A key is made once for each file: for each row, it took longer than all the rest.
        files = states.select("path").distinct().withColumn("file", file_key(F.col("path")))
        rows = rows.join(F.broadcast(files) if few_splits(states) else files, "path")
        columns = [*columns, F.col("file"), F.col("block"), F.col("row")]
        names = [*names, *FILE_ORDER]
    numbered = rows.select(*[c.alias(f"_{i}") for i, c in enumerate(columns)])
    return numbered.toDF(*names)


# What a column of texts may be read as, narrowest first.
WHOLE, DOUBLE, TEXT, BOOLEAN, EMPTY = "bigint", "double", "string", "boolean", "void"

_WHOLE = r"^[+-]?[0-9]{1,18}$"
#: Only texts that begin so are tried as numbers.
_NUMBER_STARTS = list("0123456789+-.iI")
_DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def inferred_types(raw: DataFrame) -> DataFrame:
    """``place, column, type, missing``: the narrowest type that holds all values of each
    text column, in one aggregate over all rows.

    Whole numbers (of up to 18 digits) lie below doubles and these below text; missing
    words count as nothing, but whole numbers next to them are doubles and flags are text,
    as a data frame without nulls would have it.  A column without values is void.
    """
    texts = [f.name for f in raw.schema.fields if isinstance(f.dataType, StringType)]
    numbered = raw.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(texts)])
    flags = []
    for i in range(len(texts)):
        value = F.trim(missing_to_null(F.col(f"c{i}")))
        rank = (
            F.when(value.isin("True", "False", "TRUE", "FALSE", "true", "false"), 1)
            .when(~F.left(value, F.lit(1)).isin(_NUMBER_STARTS), 8)
            .when(value.rlike(_WHOLE), 2)
            .when(value.rlike(_DOUBLE), 4)
            .when(value.isNotNull(), 8)
        )
        # Ranks are bits, so partial results merge by "or", in any order.
        flags.append(F.struct(
            F.lit(i).alias("place"), F.lit(texts[i]).alias("column"),
            F.coalesce(F.bit_or(rank), F.lit(0)).alias("bits"),
            F.coalesce(F.bool_or(value.isNull()), F.lit(False)).alias("missing"),
        ))
    if not texts:
        return raw.sparkSession.createDataFrame([], "place int, column string, type string, missing boolean")
    bits = F.col("bits")
    kind = (
        F.when(bits == 0, EMPTY)
        .when((bits == 1) & ~F.col("missing"), BOOLEAN)
        .when((bits == 2) & ~F.col("missing"), WHOLE)
        .when(bits.isin(2, 4, 6), DOUBLE)
        .otherwise(TEXT)
    )
    found = numbered.agg(F.array(*flags).alias("f")).select(F.inline("f"))
    return found.select("place", "column", kind.alias("type"), "missing")


def cast_inferred(raw: DataFrame) -> DataFrame:
    """``raw`` with its text columns as the types they hold; void ones stay text."""
    kinds = {r.column: r.type for r in inferred_types(raw).collect()}  # a row per column
    columns = []
    for name in raw.columns:
        value, kind = F.col(f"`{name}`"), kinds.get(name)
        if kind in (WHOLE, DOUBLE, BOOLEAN):
            value = F.trim(missing_to_null(value)).cast(kind)
        columns.append(value.alias(name))
    return raw.select(*columns)


def file_key(path: Column) -> Column:
    """A file's path, numbers filled up with zeros: as text, part-9 is before part-10."""
    filled = F.regexp_replace(path, "([0-9]+)", "0" * 19 + "$1")
    return F.regexp_replace(filled, "0*([0-9]{20,})", "$1")


#: Rows of a packed file, which is read by one task as a whole.
ROWS_A_FILE = 500_000


def write_raw_csv(
    listings: DataFrame, path: str, encoding: str = "UTF-8", one_file: bool = False, packed: bool = False
) -> None:
    """Raw listings as CSV files with the seven fixed columns; overwrites.

    ``packed`` compresses them with gzip, in files of ``ROWS_A_FILE`` rows at most.

    ``one_file`` writes a single file, in UTF-8.  Its one task gets the finished lines of
    the records, which all tasks make and store before; rows of several partitions get
    into it in any order.
    """
    raw = listings.select(*fixed.RAW_FIELDS)
    if one_file:
        if packed:
            raise ValueError("one file is not packed: its splits are read by many tasks")
        if encoding.upper() not in ("UTF-8", "UTF8"):
            raise ValueError(f"one file is written in UTF-8 only, not in {encoding}")
        lines = write_and_read(raw.select(F.to_csv(F.struct("*"), _cell_form()).alias("line")), "lines")
        if not lines.isEmpty():
            header = F.lit(",".join(fixed.RAW_FIELDS) + "\n")
            first = F.monotonically_increasing_id() == 0  # of the one partition
            text = F.when(first, F.concat(header, "line")).otherwise(F.col("line"))
            lines.coalesce(1).select(text.alias("value")).write.mode("overwrite").text(path)
            drop_stored(listings.sparkSession, lines)
            return
        raw = raw.limit(0).coalesce(1)
    form = {**CSV_FORM, "encoding": encoding}
    if packed:
        form |= {"compression": "gzip", "maxRecordsPerFile": ROWS_A_FILE}
    raw.write.mode("overwrite").options(**form).csv(path)


def write_clean_csv(listings: DataFrame, path: str) -> None:
    """Clean listings as CSV files, amounts in plain notation; overwrites.

    The ``FILE_ORDER`` columns tell where rows came from and are not written.
    """
    listings = listings.drop(*FILE_ORDER)
    doubles = {
        name: float_text(F.col(f"`{name}`"))
        for name, kind in listings.dtypes
        if kind == "double"
    }
    listings.withColumns(doubles).write.mode("overwrite").options(**CSV_FORM).csv(path)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Clean listings as text columns; no file yet gives an empty table."""
    reader = spark.read.options(**CSV_FORM, multiLine=True)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return spark.createDataFrame([], text_schema(list(fixed.DISPLAY_FIELDS.values())))


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])

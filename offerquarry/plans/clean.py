"""Raw listings to the clean listing table."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from offerquarry import fixed
from offerquarry.functions import money, text
from offerquarry.functions.urls import skw_product_name
from offerquarry.operators.binding import with_bound
from offerquarry.operators.dedupe import keep_first
from offerquarry.operators.headers import (
    MissingField,
    Roles,
    find_roles,
    first_flagged,
    first_url_column,
    kept_name,
    last_place,
    unique_names,
    url_flag_columns,
)
from offerquarry.sources.listing_files import FILE_ORDER
from offerquarry.sources.shared import write_and_read

PAGE_ORDER = ["page_no", "pos"]


@dataclass(frozen=True)
class Source:
    """A raw table as read up: missing-value words are null, columns numbered."""

    headers: list[str]
    roles: Roles
    texts: DataFrame  # c0, c1, ...: header names may differ in case only

    def text(self, place: int | None) -> Column | None:
        """A column as text."""
        if place is None:
            return None
        value, kind = F.col(f"c{place}"), self.texts.schema[place].dataType
        if isinstance(kind, StringType):
            return value
        if isinstance(kind, (DoubleType, FloatType)):
            return money.float_text(value.cast("double"))
        return value.cast("string")

    def price(self) -> Column:
        return money.parse_number_eu(self.text(self.roles.price))

    def product_name(self, url_place: int) -> Column:
        return skw_product_name(self.text(url_place))


def read_up(raw: DataFrame) -> Source:
    headers = [h.strip() for h in raw.columns]
    roles = find_roles(headers)
    if roles.price is None:
        raise MissingField("required field: no price column found")
    numbered = raw.toDF(*[f"c{i}" for i in range(len(headers))])
    texts = numbered.select(
        *[
            (
                text.missing_to_null(F.col(f.name))
                if isinstance(f.dataType, StringType)
                else F.col(f.name)
            ).alias(f.name)
            for f in numbered.schema
        ]
    )
    return Source(headers, roles, texts)


def named_place(source: Source, column: str) -> int:
    place = last_place(source.headers, column)
    if place is None:
        raise MissingField(f"required field: there is no column {column!r}")
    return place


NO_URL_COLUMN = "required field: no URL column to take product names from"


def find_url_place(source: Source, url_column: str | None) -> int:
    """The column with product names: the named one, else the first with a URL."""
    if url_column is not None:
        return named_place(source, url_column)
    place = first_url_column(source.texts)
    if place is None:
        raise MissingField(NO_URL_COLUMN)
    return place


def derive_once(
    source: Source, url_column: str | None, columns: Collection[str] | None = None
) -> Derived:
    """All rows under the clean columns, stored, so that nothing is computed twice.

    With ``columns``, only these and the ones that cleaning itself needs are stored.

    If the URL column is yet to be found, the pass that stores the rows looks for it
    and takes names from the column ``link`` meanwhile; only where another column
    comes first is there a second pass.
    """
    guess = last_place(source.headers, "link")
    flags = url_flag_columns(source.texts)
    if url_column is not None or guess is None or not flags:
        return derive(source, find_url_place(source, url_column), True, columns)
    seen = Observation()
    watched = replace(source, texts=source.texts.observe(seen, *flags))
    derived = derive(watched, guess, True, columns)
    place = first_flagged(seen.get)
    if place is None:
        raise MissingField(NO_URL_COLUMN)
    return derived if place == guess else derive(source, place, True, columns)


def check_required(rows: DataFrame) -> None:
    """Raise if any row lacks a product name or a price."""
    counts = rows.agg(
        F.count_if(F.col("product_name").isNull()).alias("no_name"),
        F.count_if(F.col("price").isNull()).alias("no_price"),
    ).head()
    if counts.no_name:
        raise MissingField(
            f"required field 'product_name' is missing in {counts.no_name} rows "
            f"(no 'skw' or '_skw' parameter)"
        )
    if counts.no_price:
        raise MissingField(
            f"required field 'price' is unreadable in {counts.no_price} rows"
        )


#: Columns by which bad and repeated rows are found.
NEEDED = ("title", "price", "product_name", "link")


@dataclass(frozen=True)
class Derived:
    """All raw rows under the clean columns."""

    rows: DataFrame
    keys: list[str]  # columns that are equal in duplicates


def derive(
    source: Source,
    url_place: int,
    store: bool = False,
    columns: Collection[str] | None = None,
) -> Derived:
    """Compute every clean column in one projection, for good and bad rows alike.

    With ``store`` the rows are written to the shared folder and read from there.
    ``columns`` leaves all other columns out, but for those of ``NEEDED``; without a
    column ``link`` any column may tell duplicates apart, so all stay.
    """
    headers, roles, texts = source.headers, source.roles, source.texts

    def column(place: int | None) -> Column | None:
        return None if place is None else F.col(f"c{place}")

    price_text = source.text(roles.price)
    shipping_text = source.text(roles.shipping)
    country_text = source.text(roles.country)
    condition_text = source.text(roles.condition)
    title = column(roles.title)

    shipping = (
        F.lit(0.0) if shipping_text is None else money.shipping_cost(shipping_text)
    )
    computed = with_bound(
        texts,
        {
            "price": source.price(),
            "shipping": shipping,
            "product_name": source.product_name(url_place),
        },
    )
    clean: dict[str, Column] = {
        "title": F.lit("") if title is None else title,
        "price": F.col("price"),
        "currency": money.currency_fallback(price_text, shipping_text),
        "product_origin": (
            F.lit("") if country_text is None else text.clean_origin(country_text)
        ),
        "shipping_cost": F.col("shipping"),
        "price_with_shipping": F.col("price") + F.col("shipping"),
        "product_name": F.col("product_name"),
    }
    if condition_text is not None:
        clean["product_condition"] = text.clean_condition(condition_text)
    elif "product_condition" in headers:
        clean["product_condition"] = column(headers.index("product_condition"))

    # Columns that were read up, or that a computed one of that name replaces.
    replaced = set(clean) - {"title"}
    used = {roles.title, roles.condition, roles.price, roles.country, roles.shipping}
    rest = [
        i for i, h in enumerate(headers) if i not in used and h not in replaced
    ]
    first = [n for n in fixed.CLEAN_ORDER if n in clean]
    names = unique_names([*first, *[kept_name(headers[i]) for i in rest]])
    rows = computed.select(
        *[clean[n].alias(n) for n in first],
        *[F.col(f"c{i}").alias(n) for i, n in zip(rest, names[len(first) :])],
    )
    if columns is not None and "link" in rows.columns:
        rows = rows.select(*[n for n in rows.columns if n in columns or n in NEEDED])
    if store:
        # Numbered, as files may not hold every name a header may have.
        numbered = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
        rows = write_and_read(numbered, "derived").toDF(*rows.columns)

    keys = ["title", "price"]
    if "link" in rows.columns:
        keys.append("link")
    else:
        place = first_url_column(rows)
        if place is not None and rows.columns[place] not in keys:
            keys.append(rows.columns[place])
    return Derived(rows, keys)


def row_order(df: DataFrame) -> list[str]:
    """Columns that tell which row came first."""
    for order in (PAGE_ORDER, FILE_ORDER):
        if set(order) <= set(df.columns):
            return order
    raise ValueError(f"pass order_by: found neither {PAGE_ORDER} nor {FILE_ORDER}")


def clean_listings(
    raw: DataFrame,
    *,
    order_by: Sequence[str] | None = None,
    scope: Sequence[str] = (),
    url_column: str | None = None,
) -> DataFrame:
    """The clean listing table; stops if any row lacks a name or a price.

    All rows are computed once and stored; the required fields are counted and the
    duplicates found on the stored columns.

    Of rows with equal title, price and link the first in ``order_by`` stays;
    ``scope`` columns (say, a search id) keep rows of different runs apart.  Product
    names come from ``url_column``, else from the first column with a URL anywhere.
    """
    order_by = list(order_by or row_order(raw))
    derived = derive_once(read_up(raw), url_column)
    check_required(derived.rows)
    return keep_first(derived.rows, [*scope, *derived.keys], order_by)


def split_listings(
    raw: DataFrame,
    *,
    order_by: Sequence[str] | None = None,
    scope: Sequence[str] = (),
    url_column: str | None = None,
    columns: Collection[str] | None = None,
    store: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Like ``clean_listings``, but bad rows do not stop the rest.

    Returns the clean table of the good rows, and the bad rows with the field
    they lack in ``missing_field``.  A view that shows few columns names them in
    ``columns``; others are then neither computed nor stored, but for the order, the
    scope and the columns of ``NEEDED``.  The derived rows are stored, as both results
    come from them; a caller that takes only one, once, sets ``store`` to false.
    """
    order_by = list(order_by or row_order(raw))
    if columns is not None:
        columns = {*columns, *order_by, *scope}
    source = read_up(raw)
    if store:
        derived = derive_once(source, url_column, columns)
    else:
        derived = derive(source, find_url_place(source, url_column), columns=columns)
    missing = F.when(F.col("product_name").isNull(), F.lit("product_name")).when(
        F.col("price").isNull(), F.lit("price")
    )
    flagged = derived.rows.withColumn("missing_field", missing)
    good = flagged.where("missing_field IS NULL").drop("missing_field")
    bad = flagged.where("missing_field IS NOT NULL")
    return keep_first(good, [*scope, *derived.keys], order_by), bad


def quality_report(
    raw: DataFrame, *, scope: Sequence[str] = (), url_column: str | None = None
) -> DataFrame:
    """One row of counts: rows read, lacking a name, lacking a price, duplicates.

    Duplicates are counted among the good rows.
    """
    source = read_up(raw)
    derived = derive(source, find_url_place(source, url_column))
    keys = [*scope, *derived.keys]
    groups = (
        derived.rows.withColumn("_no_name", F.col("product_name").isNull())
        .groupBy(*keys, "_no_name")
        .agg(F.count("*").alias("n"))
    )
    n, no_name, no_price = F.col("n"), F.col("_no_name"), F.col("price").isNull()

    def total(of: Column, name: str) -> Column:
        return F.coalesce(F.sum(of), F.lit(0)).alias(name)

    return groups.agg(
        total(n, "rows_read"),
        total(F.when(no_name, n), "missing_product_name"),
        total(F.when(no_price, n), "missing_price"),
        total(F.when(~no_name & ~no_price, n - 1), "duplicates_removed"),
    )

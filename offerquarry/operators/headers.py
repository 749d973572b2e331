"""Finding the columns of a listing table under varying header names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from offerquarry import fixed
from offerquarry.functions.urls import has_url


def _key(header: str) -> str:
    """Headers that differ in case or outer blanks are the same."""
    return header.strip().lower()


def last_place(headers: Sequence[str], name: str) -> int | None:
    """Place of the last column of that name."""
    return max((i for i, h in enumerate(headers) if _key(h) == _key(name)), default=None)


@dataclass(frozen=True)
class Roles:
    """Places of the columns that play a role in cleaning."""

    title: int | None
    condition: int | None
    price: int | None
    country: int | None
    shipping: int | None


_SYNONYMS = {
    "title": fixed.TITLE_HEADERS,
    "condition": fixed.CONDITION_HEADERS,
    "price": fixed.PRICE_HEADERS,
    "country": fixed.COUNTRY_HEADERS,
    "shipping": fixed.SHIPPING_HEADERS,
}


def find_roles(headers: Sequence[str]) -> Roles:
    """The column of each role: the best ranked synonym, of equal names the last."""
    meanings: dict[str, list[tuple[str, int]]] = {}
    for role, names in _SYNONYMS.items():
        for rank, name in enumerate(names):
            meanings.setdefault(_key(name), []).append((role, rank))
    found: dict[str, tuple[int, int]] = {}
    for place, header in enumerate(headers):
        for role, rank in meanings.get(_key(header), ()):
            found[role] = min(found.get(role, (rank, -place)), (rank, -place))
    return Roles(**{role: -found[role][1] if role in found else None for role in _SYNONYMS})


def kept_name(header: str) -> str:
    """Output name of a column that cleaning passes through."""
    lowered = header.strip().lower()
    if lowered == "link":
        return "link"
    if lowered in fixed.PICTURE_LINK_HEADERS:
        return "link_bild"
    return header


def unique_names(names: Sequence[str]) -> list[str]:
    """Number repeated names (compared without case): title, title_2, ..."""
    taken: set[str] = set()
    result = []
    for name in names:
        new, n = name, 1
        while new.lower() in taken:
            n += 1
            new = f"{name}_{n}"
        taken.add(new.lower())
        result.append(new)
    return result


def resolve_columns(raw: DataFrame) -> DataFrame:
    """A raw listing table under the names ``titel .. image``, text as it is.

    Columns found under a synonym get the fixed raw name, a missing title,
    condition, country or shipping column is added empty, others follow.
    """
    headers = [h.strip() for h in raw.columns]
    roles = find_roles(headers)
    if roles.price is None:
        raise MissingField("no price column found")
    numbered = raw.toDF(*[f"c{i}" for i in range(len(headers))])
    found = dict(
        zip(
            fixed.RAW_FIELDS,
            [roles.title, roles.condition, roles.price, roles.country, roles.shipping],
        )
    )
    taken = set(found.values())
    rest = [i for i in range(len(headers)) if i not in taken]
    names = unique_names([*found, *[kept_name(headers[i]) for i in rest]])
    columns = [
        F.lit("") if place is None else F.col(f"c{place}") for place in found.values()
    ] + [F.col(f"c{i}") for i in rest]
    return numbered.select(*[c.alias(n) for c, n in zip(columns, names)])


def url_flag_columns(df: DataFrame) -> list[Column]:
    """An aggregate per text column: does any of its values hold a URL?"""
    return [
        F.coalesce(F.bool_or(has_url(F.col(f"`{f.name}`"))), F.lit(False)).alias(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
    ]


def url_flags(df: DataFrame) -> DataFrame:
    """One row with a flag per text column, see ``url_flag_columns``."""
    return df.agg(*url_flag_columns(df))


def first_url_column(df: DataFrame) -> int | None:
    """Place of the first column in which any value holds a URL, else None.

    One aggregate pass over the text columns; only flags come to the driver.
    """
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    flags = url_flag_columns(numbered)
    return first_flagged(numbered.agg(*flags).head().asDict()) if flags else None


def first_flagged(flags: dict[str, bool]) -> int | None:
    """Place of the first flag that is set, of flags named c0, c1, ..."""
    return next((int(n[1:]) for n, v in flags.items() if v is True), None)


class MissingField(ValueError):
    """A required field is absent, so nothing may be written."""

"""Column expressions, all of them built-in. ``named_value`` uses functions over array
elements, which Spark interprets; the rest becomes part of generated code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotledger import schemas as S

DECIMALS = 6  # of the ledger's number type


def nulls_last(names: list[str]) -> list[Column]:
    """Ascending order with NULLs at the end (Spark puts them first by default)."""
    return [F.col(name).asc_nulls_last() for name in names]


def as_day(as_of: dt.date | str | Column | None) -> Column:
    """The reporting day; the clock's day when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def loses_digits(text: Column | str) -> Column:
    """Whether a number has more decimals than the ledger keeps, judged by its digits as written.

    Any cast would have rounded both sides of a comparison. Zeros at the end do not count.
    """
    text = F.col(text) if isinstance(text, str) else text
    plain = text.rlike(rf"^\s*[+-]?[0-9]*\.?[0-9]{{0,{DECIMALS}}}0*\s*$")
    whole, part, power = (
        F.regexp_extract(text, r"^\s*[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?", i) for i in (1, 2, 3)
    )
    digits = F.concat(whole, part)
    kept = F.rtrim(digits, F.lit("0"))
    zeros = F.length(digits) - F.length(kept)
    decimals = F.length(part) - zeros - F.coalesce(F.nullif(power, F.lit("")).cast("int"), F.lit(0))
    return ~plain & (kept != "") & (decimals > DECIMALS)


def exact_number(text: Column | str) -> Column:
    """Text as the ledger's number type; a value it cannot hold fails the query.

    A plain cast would fail on bad text and on too many digits before the point, but
    would round digits behind it without a word.
    """
    text = F.col(text) if isinstance(text, str) else text
    message = F.concat(F.lit("more decimals than the ledger keeps: "), text)
    refused = F.raise_error(message).cast(S.NUMERIC)
    return F.when(loses_digits(text), refused).otherwise(text.cast(S.NUMERIC))


def join_text(*parts: Column | str) -> Column:
    """Concatenation in which a NULL counts as empty text."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def month_key(day: Column | str) -> Column:
    """``2000-07`` for any day of July 2000."""
    return F.date_format(day, "yyyy-MM")


def last_segment(href: Column) -> Column:
    """Text after the last slash; NULL for missing or empty text."""
    return F.when(href != "", F.element_at(F.split(href, "/"), -1))


def named_value(pairs: Column, name: str, field: str | None = None) -> Column:
    """Value of the first entry called ``name`` in an array of JSON objects.

    Entries without a value are passed over, an explicit null is not. With
    ``field`` the value is itself an object and its field is taken; entries whose
    value lacks the field are passed over.
    """

    def inner(entry: Column) -> Column:
        return F.from_json(F.try_element_at(entry, F.lit("value")), "MAP<STRING, STRING>")

    def matches(entry: Column) -> Column:
        called = F.try_element_at(entry, F.lit("name")) == name
        if field is None:
            return called & F.map_contains_key(entry, "value")
        return called & F.coalesce(F.map_contains_key(inner(entry), field), F.lit(False))

    found = F.get(F.filter(pairs, matches), F.lit(0))
    if field is None:
        return F.try_element_at(found, F.lit("value"))
    return F.try_element_at(inner(found), F.lit(field))


def movement_parts(quantity: Column, doc_type: Column) -> dict[str, Column]:
    """The signed quantity sorted into real or relocated, in or out; 0 elsewhere."""

    def part(kind: Column, sign: Column) -> Column:
        return F.when(kind & sign, quantity).otherwise(F.lit(0))

    moved, inward, outward = doc_type == "move", quantity > 0, quantity < 0
    return {
        "real_in": part(~moved, inward),
        "real_out": part(~moved, outward),
        "move_in": part(moved, inward),
        "move_out": part(moved, outward),
    }


def operation_tags(close: Column, slot_id: Column) -> Column:
    """Anomalies of one operation, joined into one text; empty when there is none."""
    return F.concat_ws(
        S.TAG_SEPARATOR,
        F.when(close < 0, S.TAG_OVERDRAFT),
        F.when(slot_id == S.OFF_SLOT, S.TAG_OUT_OF_SLOT),
    )


def occupancy(close: Column, real_out: Column) -> Column:
    """1 occupied, 2 impossible (negative stock), 0 free.

    A slot emptied by a real shipment counts as occupied on that day.
    """
    return (
        F.when(close < 0, 2)
        .when((close > 0) | ((close == 0) & (real_out != 0)), 1)
        .otherwise(0)
    )


def balance_tags(items_in_slot: Column, close: Column, expected: Column) -> Column:
    """Anomalies of one slot, item and day; empty when there is none.

    Evaluated on every row of the daily grid, so it picks one of four texts and joins none.
    """
    mixed, unexpected = items_in_slot > 1, (close > 0) & (close != expected)
    return (
        F.when(mixed & unexpected, S.TAG_MIXED_SLOT + S.TAG_SEPARATOR + S.TAG_UNEXPECTED)
        .when(mixed, S.TAG_MIXED_SLOT)
        .when(unexpected, S.TAG_UNEXPECTED)
        .otherwise("")
    )

"""Prices, percentages and dates as Column expressions; invalid input is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = 1e-9


def parse_price(text: Column) -> Column:
    """Text with a decimal comma or point, thousands marks, currency and unit.

    The last separator decides: with both kinds, it is the decimal one. A lone
    point before one or two last digits is decimal, otherwise it marks thousands.
    """
    bare = F.regexp_extract(F.regexp_replace(text, r"\s", ""), r"(-?[0-9][0-9.,]*)", 1)
    bare = F.regexp_replace(bare, r"[.,]+$", "")
    comma, point = F.instr(F.reverse(bare), ","), F.instr(F.reverse(bare), ".")
    as_comma = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    plain = (
        F.when((comma > 0) & ((point == 0) | (comma < point)), as_comma)
        .when((comma > 0) & (point < comma), F.replace(bare, F.lit(","), F.lit("")))
        .when((point > 0) & ~bare.rlike(r"^-?[0-9]+\.[0-9]{1,2}$"), F.replace(bare, F.lit("."), F.lit("")))
        .otherwise(bare)
    )
    return plain.try_cast("double")


def parse_discount(text: Column) -> Column:
    """'-19%' is -0.19; without a sign it stays positive."""
    number = F.replace(F.regexp_extract(text, r"([+-]?\s*[0-9]+(?:[.,][0-9]+)?)\s*%", 1), F.lit(","), F.lit("."))
    return F.round(F.regexp_replace(number, r"\s", "").try_cast("double") / 100, 6)


def compare_price(old: str, new: str) -> dict[str, Column]:
    """change_type, change_amount (4 places) and change_ratio (6 places; none for a base of zero)."""
    before, after = F.col(old), F.col(new)
    kind = F.when(before.isNull(), "NEW").when(F.abs(after - before) <= TOLERANCE, "UNCHANGED").when(after > before, "UP").otherwise("DOWN")
    return {
        "change_type": kind,
        "change_amount": F.round(after - before, 4),
        "change_ratio": F.round(F.try_divide(after - before, F.when(before != 0, before)), 6),
    }


def is_anomaly(price: Column, most: float) -> Column:
    """At or under zero, or over the maximum; a missing price is none."""
    return F.coalesce((price <= 0) | (price > most), F.lit(False))


def merge_observed(complete: Column, observed: Column, base: Column) -> Column:
    """A complete observation may clear a value; a partial one only sets it."""
    return F.when(complete, observed).otherwise(F.coalesce(observed, base))


def discount(current: Column, original: Column, badge: Column) -> Column:
    return F.when((badge > -1) & (badge < 0), badge).otherwise(F.round(F.try_divide(current - original, F.when(original != 0, original)), 6))


def parse_date(text: Column) -> Column:
    """ISO dates and timestamps, day-first dates, and spreadsheet serial numbers."""
    trimmed = F.trim(text)
    serial = F.when(trimmed.rlike(r"^[0-9]{4,6}$"), F.date_add(F.lit("1899-12-30").cast("date"), trimmed.try_cast("int")))
    tries = [F.try_to_timestamp(trimmed, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")]
    return F.coalesce(serial, F.try_to_timestamp(F.substring(trimmed, 1, 10), F.lit("yyyy-MM-dd")).cast("date"), *tries)


def business_date(utc: Column, zone: str = "Europe/Madrid") -> Column:
    return F.to_date(F.from_utc_timestamp(utc, zone))

"""Hashes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def multipart_hash(*parts: Column) -> Column:
    """SHA-256 over parts: a null is byte 00, other values their trimmed text; byte 1F follows each."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.when(part.isNull(), F.lit("\u0000")).otherwise(F.trim(part.cast("string"))), F.lit("\u001f")]
    return F.sha2(F.concat(*pieces).cast("binary"), 256)


def value_hash(value: Column) -> Column:
    return F.sha2(F.coalesce(value.cast("string"), F.lit("")).cast("binary"), 256)


def short_id(*parts: Column) -> Column:
    """The first 24 digits of the hash of parts joined by byte 1F."""
    return F.substring(F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"), 256), 1, 24)


def normal_hash(value: Column) -> Column:
    """Blank, none, null and nan mean no hash."""
    trimmed = F.lower(F.trim(value))
    return F.when(~trimmed.isin("", "none", "null", "nan"), trimmed)


def hash_split(group: Column, ratio: float) -> Column:
    """Whether a group falls in the first part of a deterministic split: its first 8 hash digits over 2**32 - 1."""
    return F.conv(F.substring(F.sha2(group.cast("binary"), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0) < ratio


def sku_of_url(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/p/(\d+)/", 1), F.lit(""))


#: fixed values: the facts whose change is a change of a product's content, in the order in which they are hashed
FACT_FIELDS = ("name_es", "cat1_es", "cat2_es", "spec_es", "desc_es", "details_es", "product_url", "image_url")


def fact_hash(fields: dict[str, Column]) -> Column:
    """Hash of a product's facts; neither prices nor renderings belong to them, and an absent fact is not an empty one."""
    bare = lambda c: F.regexp_replace(c.cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return multipart_hash(*[bare(fields[f]) if f in fields else F.lit(None).cast("string") for f in FACT_FIELDS])


def persisted_hash(value: Column) -> Column:
    """A stored hash as it is; blank, none, null, nan and n/a are no hash."""
    text = F.trim(value)
    return F.when(~F.lower(text).isin("", "none", "null", "nan", "n/a"), text)

"""Bounded, seeded samples of labelled and unlabelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_share(column: str, seed: int) -> Column:
    """A number in [0, 1) fixed by the identifier and the seed."""
    return (F.xxhash64(F.lit(seed), F.col(column).cast("string")).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def sampled(docs: DataFrame, strata: DataFrame, doc_id: str, text: str, rows: int, size: int, seed: int) -> DataFrame:
    """(doc_id, text, stratum) of a sample with about `rows` rows and `size` bytes of text at most in each stratum.

    strata: (doc_id, stratum), one row per document. Identifiers are picked by
    hash before any text is fetched, and the pick, of bounded size, is broadcast.
    Documents whose text alone is larger than a tenth of the bound, nulls, and
    rows with a null identifier are no candidates.
    """
    sizes = docs.select(F.col(doc_id).alias("_id"), F.octet_length(text).alias("_n")).where(F.col("_n").isNotNull() & F.col("_id").isNotNull() & (F.col("_n") <= size // 10))
    joined = sizes.join(strata.select(F.col(doc_id).alias("_id"), "stratum"), "_id").select("_id", "_n", "stratum", hash_share("_id", seed).alias("_u"))
    totals = {r[0]: (r[1], r[2]) for r in joined.groupBy("stratum").agg(F.count(F.lit(1)), F.sum("_n")).collect()}
    share = F.lit(0.0)
    for stratum, (n, total) in totals.items():
        share = F.when(F.col("stratum") == stratum, min(1.0, rows / max(n, 1), size / max(total, 1))).otherwise(share)
    pick = joined.where(F.col("_u") < share).select("_id", "stratum").dropDuplicates(["_id"])
    return docs.select(F.col(doc_id).alias("_id"), text).join(F.broadcast(pick), "_id").withColumnRenamed("_id", doc_id)

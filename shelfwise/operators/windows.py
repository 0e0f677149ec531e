"""Window operators: previous, latest and first rows of a key, ranks with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """Adds the values that the key's row before has: {new column: source column}."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(old).over(window) for new, old in columns.items()})


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The columns of each key's last row: an aggregate with partial results, so a hot key costs one row a task."""
    chosen = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_last"))
    return chosen.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in columns])


def first(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    chosen = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return chosen.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


def top_rank(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """(keys, value, conflict): the value at the best rank; several different ones there are a conflict without a value."""
    best = df.withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1")
    found = best.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    conflict = ~F.col("_low").eqNullSafe(F.col("_high"))
    return found.select(*keys, F.when(~conflict, F.col("_low")).alias(value), conflict.alias("conflict"))


def keep_latest(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")

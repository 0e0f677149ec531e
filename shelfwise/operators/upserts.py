"""Upserts, append-only inserts, referential checks and keyed differences on immutable tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of changes replace those of state, field by field where the change has a value; new keys are added."""
    old = state.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    new = changes.select(*keys, *[F.col(c).alias(f"_c_{c}") for c in columns])
    return old.join(new, keys, "full_outer").select(*keys, *[F.coalesce(f"_c_{c}", f"_s_{c}").alias(c) for c in columns])


def insert_ignore(log: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows to append: those whose key the log lacks, each key once."""
    return rows.dropDuplicates([key]).join(log.select(key), key, "left_anti")


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows without a parent; a null key has none."""
    return rows.join(parents.select(key).distinct(), key, "left_anti")


def keyed_difference(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, left_value, right_value): keys on one side only, and fields that differ."""
    a = left.select(key, F.lit(True).alias("_a"), *[F.col(c).cast("string").alias(f"_a_{c}") for c in columns])
    b = right.select(key, F.lit(True).alias("_b"), *[F.col(c).cast("string").alias(f"_b_{c}") for c in columns])
    both = a.join(b, key, "full_outer")
    entry = lambda field, x, y: F.struct(F.lit(field).alias("field"), x.cast("string").alias("left_value"), y.cast("string").alias("right_value"))
    here, there = F.coalesce("_a", F.lit(False)), F.coalesce("_b", F.lit(False))
    found = [F.when(here & ~there, entry("MISSING_RIGHT", F.col(key), F.lit(None))), F.when(~here & there, entry("MISSING_LEFT", F.lit(None), F.col(key)))]
    found += [F.when(here & there & ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), entry(c, F.col(f"_a_{c}"), F.col(f"_b_{c}"))) for c in columns]
    return both.select(key, F.explode(F.array_compact(F.array(*found))).alias("d")).select(key, "d.*")


def rule_union(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) for every rule a row breaks, in one pass."""
    broken = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]))
    return rows.select(key, F.explode(broken).alias("rule"))


def counts_of(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return rows.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def unique_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def first_value(*columns: Column) -> Column:
    """The first non-blank of several text columns."""
    return reduce(lambda a, b: F.coalesce(a, b), [F.when(F.trim(c) != "", c) for c in columns])

"""Dictionary lookups, precedence with source labels, term matching and translation memory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.phrases import spans, words_of


def resolve(candidates: list[tuple[str, Column]], blocked: Column | None = None) -> tuple[Column, Column]:
    """(value, source label): the first non-blank candidate; nothing where blocked."""
    value, label = F.lit(None).cast("string"), F.lit("UNRESOLVED")
    for name, column in reversed(candidates):
        there = F.trim(F.coalesce(column, F.lit(""))) != ""
        value, label = F.when(there, column).otherwise(value), F.when(there, F.lit(name)).otherwise(label)
    if blocked is not None:
        value, label = F.when(~blocked, value), F.when(blocked, F.lit("SOURCE_BLOCKED")).otherwise(label)
    return value, label


def scoped_rules(rows: DataFrame, rules: DataFrame, scopes: list[str], term: str) -> DataFrame:
    """Rows with the most specific rule of their term: (rows.*, target, conflict).

    A rule's null scope fits everything. Rules meet rows by term, an equi-join;
    several targets at the best specificity are a conflict without a target.
    """
    named = rules.select(F.col(term).alias("_term"), "target", *[F.col(s).alias(f"_r_{s}") for s in scopes])
    fits = F.lit(True)
    specific = F.lit(0)
    for s in scopes:
        fits = fits & (F.col(f"_r_{s}").isNull() | (F.col(f"_r_{s}") == F.col(s)))
        specific = specific + F.col(f"_r_{s}").isNotNull().cast("int")
    # what a row gets follows from its term and scopes: equal ones are looked up once
    asked = rows.select(term, *scopes).distinct()
    joined = asked.join(named, F.col(term) == F.col("_term")).where(fits).withColumn("_s", specific)
    by_rank = joined.groupBy(term, *scopes, "_s").agg(F.min("target").alias("_lo"), F.max("target").alias("_hi"))
    found = by_rank.groupBy(term, *scopes).agg(F.max_by(F.struct("_lo", "_hi"), "_s").alias("_best"))
    found = found.select(F.col(term).alias("_t"), *[F.col(s).alias(f"_f_{s}") for s in scopes], F.col("_best._lo").alias("_lo"), F.col("_best._hi").alias("_hi"))
    same = F.col(term).eqNullSafe(F.col("_t"))
    for s in scopes:
        same = same & F.col(s).eqNullSafe(F.col(f"_f_{s}"))
    out = rows.join(found, same, "left")
    conflict = F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False))
    return out.select(*rows.columns, F.when(~conflict, F.col("_lo")).alias("target"), conflict.alias("conflict"))


def term_matches(rows: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, target): terms of any number of words that stand in a text, at word boundaries; signs between words do not matter."""
    normal = terms.select(words_of("term").alias("_g"), "term", "target").where("_g <> ''")
    found = spans(rows.select(key, words_of(text).alias("_words")), normal, [key], "_words", "_g").select(key, "phrase").distinct()
    return found.join(normal, F.col("phrase") == F.col("_g")).select(key, "term", "target").distinct()


def longest_match(matches: DataFrame, key: str) -> DataFrame:
    """Of each key the longest matched term; the first in order of equals."""
    return matches.groupBy(key).agg(F.max_by(F.struct("term", "target"), F.struct(F.length("term"), F.col("term"))).alias("m")).select(key, "m.*")


def memory_lookup(rows: DataFrame, memory: DataFrame, keys: list[str]) -> DataFrame:
    """Newest memory entry with null-safe equality on all keys: (rows.*, target)."""
    newest = memory.groupBy(*keys).agg(F.max_by("target", "created_at").alias("target"))
    named = newest.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "target")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_m_{k}"))
    return rows.join(named, same, "left").drop(*[f"_m_{k}" for k in keys])


def select_evidence(evidence: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, conflict): the best rank decides; differing values there conflict; the latest of equals is taken."""
    best = evidence.withColumn("_k", F.rank().over(Window.partitionBy(key).orderBy("rank"))).where("_k = 1")
    found = best.groupBy(key).agg(F.countDistinct(value).alias("_n"), F.max_by(value, F.struct("observed_at", "reference")).alias("_v"))
    return found.select(key, F.when(F.col("_n") <= 1, F.col("_v")).alias(value), (F.col("_n") > 1).alias("conflict"))

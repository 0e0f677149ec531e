"""Projections, planning, drift, queues and revision control as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.texts import is_blank

STATUSES = {"NEW": "ACTIVE", "REAPPEARED": "ACTIVE", "ACTIVE": "ACTIVE", "MISSING_FIRST": "MISSING", "MISSING_CONTINUED": "MISSING", "OFFLINE": "OFFLINE"}
#: Reasons for an update, the first that holds.
REASONS = ("NEW_SKU", "REAPPEARED", "PRICE_CHANGED", "DETAIL_MISSING", "DETAIL_STALE")


def valid_price(price: Column, invalid: Column) -> Column:
    """A price that a review marked invalid is not shown."""
    return F.when(~F.coalesce(invalid, F.lit(False)), price)


def product_status(classification: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in STATUSES.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, classification), F.lit("UNKNOWN"))


def remarks(notes: list[tuple[Column, str | Column]]) -> Column:
    """Notes that hold, joined by a spaced bar."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n if isinstance(n, Column) else F.lit(n)) for c, n in notes])), " | ")


def localization_status(fields: list[Column], stale: Column, review: Column) -> Column:
    """BLOCKED, STALE, REVIEW_PENDING, INCOMPLETE, COMPLETE, in this precedence."""
    missing = is_blank(fields[0])
    for f in fields[1:]:
        missing = missing | is_blank(f)
    return F.when(review == "BLOCKED", "BLOCKED").when(stale, "STALE").when(review == "REVIEW_PENDING", "REVIEW_PENDING").when(missing, "INCOMPLETE").otherwise("COMPLETE")


def plan_updates(rows: DataFrame, conditions: dict[str, Column], budget: int) -> DataFrame:
    """Rows that need work with their first reason; the first `budget` by reason and SKU get a detail request.

    The budget is the feature: a top-k over the planned rows only.
    """
    reason = F.coalesce(*[F.when(conditions[name], F.lit(name)) for name in REASONS if name in conditions])
    planned = rows.withColumn("reason", reason).where(F.col("reason").isNotNull())
    rank = F.array_position(F.array(*[F.lit(r) for r in REASONS]), F.col("reason"))
    chosen = planned.orderBy(rank, "sku").limit(budget).select("sku", F.lit(True).alias("_chosen"))
    return planned.join(chosen, "sku", "left").withColumn("need_detail", F.coalesce("_chosen", F.lit(False))).drop("_chosen")


def drift(today: DataFrame, before: DataFrame, key: str, value: str, collapse: float = 0.5) -> DataFrame:
    """Keys whose value fell by more than the share, or vanished: (key, before, today, finding)."""
    a, b = before.select(key, F.col(value).alias("before")), today.select(key, F.col(value).alias("today"))
    both = a.join(b, key, "left")
    finding = F.when(F.col("today").isNull(), "VANISHED").when(F.col("today") < (1 - collapse) * F.col("before"), "COLLAPSE")
    return both.withColumn("finding", finding).where(F.col("finding").isNotNull())


def queue_requests(rows: DataFrame, fields: list[str], old_hash: str, new_hash: str) -> DataFrame:
    """(sku, requested, priority): blank fields, or all of them where the source's hash changed."""
    changed = ~F.col(old_hash).eqNullSafe(F.col(new_hash))
    blanks = F.array_compact(F.array(*[F.when(is_blank(F.col(f)), F.lit(f)) for f in fields]))
    asked = F.when(changed, F.array(*[F.lit(f) for f in fields])).otherwise(blanks)
    priority = F.when(F.col(old_hash).isNull(), "P0").when(changed, "P1").when(F.size(asked) == len(fields), "P2").otherwise("P3")
    return rows.select("sku", asked.alias("requested"), priority.alias("priority")).where(F.size("requested") > 0)


def approved_revision(revisions: DataFrame, findings: DataFrame) -> DataFrame:
    """Of each unit the highest approved revision without an open blocking finding."""
    open_ = findings.where(F.col("open") & F.col("severity").isin("BLOCKER", "ERROR", "HIGH")).select("revision_id")
    clean = revisions.where("approved").join(open_, "revision_id", "left_anti")
    return clean.groupBy("unit").agg(F.max_by("revision_id", F.struct("revision", "revision_id")).alias("revision_id"), F.max("revision").alias("revision"))


def source_versions(rows: DataFrame, key: str, order: list[str], digest: str) -> DataFrame:
    """Slowly changing versions: a row starts one where its hash differs from the row's before; valid until the next starts."""
    window = Window.partitionBy(key).orderBy(*order)
    started = rows.withColumn("_before", F.lag(digest).over(window)).where(~F.col(digest).eqNullSafe(F.col("_before")) | F.col("_before").isNull())
    return started.drop("_before").withColumns({"version": F.row_number().over(window), "valid_to": F.lead(order[0]).over(window)})


def supersede(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Older pending rows of a key become SUPERSEDED; the newest keeps its status."""
    newest = rows.groupBy(key).agg(F.max(F.struct(*order)).alias("_newest"))
    joined = rows.join(newest, key)
    old = (F.struct(*order) < F.col("_newest")) & (F.col("status") == "PENDING")
    return joined.withColumn("status", F.when(old, "SUPERSEDED").otherwise(F.col("status"))).drop("_newest")


def mined_rules(feedback: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Patterns seen at least so often, with a confidence that saturates at 0.99."""
    grouped = feedback.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return grouped.withColumn("confidence", F.least(F.lit(0.99), F.round(0.6 + 0.1 * F.least(F.col("n"), F.lit(4)), 2)))


def multiset_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other: (side, row columns)."""
    return left.exceptAll(right).withColumn("side", F.lit("LEFT")).unionByName(right.exceptAll(left).withColumn("side", F.lit("RIGHT")))

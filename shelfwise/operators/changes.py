"""What a day changes: price facts of the current rows, events of a day, originals that are proven absent, facts without a word on presence.

Facts are one aggregate per SKU over the history, with partial results on the map side, so a
hot SKU costs a row per task; current rows meet them by SKU. Events come from one pass over
paired rows. Nulls: a null price is no observation and no anomaly; a null flag is false; a
null hash equals a null hash. A SKU without history has only its own prices. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.prices import TOLERANCE, compare_price, is_anomaly

#: verdicts that change nothing or clear the original; every other one is a fault
NO_ORIGINAL, CLEAR = "NO_ORIGINAL", "CLEAR"


class AbsenceRefused(ValueError):
    """Some evidence has a fault, so nothing of the batch is applied."""


def discount_of(badge: Column, promoted: Column, current: Column, original: Column) -> Column:
    """The badge's share while a promotion runs, if it is one of a price; else what the original price says."""
    stated = F.when(promoted & (badge > -1) & (badge < 0), badge)
    shown = F.when((original > current) & (current > 0), F.round((current - original) / original, 6))
    return F.coalesce(stated, shown)


def price_facts(current: DataFrame, history: DataFrame, order: list[str], period: str) -> DataFrame:
    """One row for each current row: last real change, the period's change, extrema and discount.

    current: sku, current_price, original_price, badge_discount, promoted, last_valid_price.
    history: sku, observed_at, old_price, new_price, change_type and the columns of `order`.
    Extrema cover old and new prices, the current price and the last valid one, above zero.
    A change counts only between two prices above zero; the period's last row speaks for it.
    """
    sound = lambda c: F.when(c > 0, c)
    real = F.col("change_type").isin("UP", "DOWN") & (F.col("old_price") > 0) & (F.col("new_price") > 0)
    day, at = F.date_format("observed_at", "yyyy-MM-dd"), F.struct(*order)
    change = compare_price("old_price", "new_price")
    row = F.struct(F.col("old_price").alias("last_price"), change["change_type"].alias("direction"), change["change_amount"].alias("amount"), change["change_ratio"].alias("ratio"), day.alias("day"))
    facts = history.groupBy("sku").agg(
        F.max_by(row, F.when(real, at)).alias("last"), F.max_by("change_type", F.when(day == period, at)).alias("of_period"), F.max(F.when(real, 1)).alias("changed"),
        F.least(F.min(sound(F.col("old_price"))), F.min(sound(F.col("new_price")))).alias("low"), F.greatest(F.max(sound(F.col("old_price"))), F.max(sound(F.col("new_price")))).alias("high"),
    )
    joined = current.join(facts, "sku", "left").withColumn("last", F.when(F.col("changed") == 1, F.col("last")))
    now, valid = sound(F.col("current_price")), sound(F.col("last_valid_price"))
    return joined.select(
        "sku", "last.last_price", F.col("last.direction").alias("price_direction"), F.coalesce("of_period", F.lit("UNCHANGED")).alias("price_change"), F.col("last.amount").alias("change_amount"),
        F.col("last.ratio").alias("change_percent"), F.col("last.day").alias("last_change_date"), F.least("low", now, valid).alias("price_min"), F.greatest("high", now, valid).alias("price_max"),
        discount_of(F.col("badge_discount"), F.coalesce("promoted", F.lit(False)), F.col("current_price"), F.col("original_price")).alias("discount"),
    )


def day_events(pairs: DataFrame, most: float, flags: dict[str, tuple[str, str]]) -> DataFrame:
    """(sku, event_type, old_price, new_price, change_amount, change_percent, old_value, new_value) of a day.

    pairs: sku, known (a row was there before), first_presence, old_/new_ price, content_hash and
    each flag. An anomalous price makes a review and no price event. A row that was not there, or
    is present for the first time, is FIRST_SEEN and has no change of content.
    flags: column -> (event when it is set, event when it is cleared).
    """
    new, odd = F.col("new_price"), is_anomaly(F.col("new_price"), most)
    change = compare_price("old_price", "new_price")
    kind = F.when(new.isNotNull() & ~odd & (change["change_type"] != "UNCHANGED"), change["change_type"])
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def event(name: Column, price: bool = False, old: Column = text, to: Column = text) -> Column:
        moved = price & kind.isin("UP", "DOWN") if price else F.lit(False)
        return F.struct(
            name.alias("event_type"), (F.col("old_price") if price else none).alias("old_price"), (new if price else none).alias("new_price"),
            F.when(moved, change["change_amount"]).alias("change_amount"), F.when(moved, change["change_ratio"]).alias("change_percent"), old.alias("old_value"), to.alias("new_value"),
        )

    seen = F.coalesce("known", F.lit(False)) & ~F.coalesce("first_presence", F.lit(False))
    found = [F.when(odd, event(F.lit("PRICE_ANOMALY"), True)), F.when(kind.isNotNull(), event(F.concat(F.lit("PRICE_"), kind), True))]
    for column, (on, off) in flags.items():
        old, now = F.coalesce(f"old_{column}", F.lit(False)), F.coalesce(f"new_{column}", F.lit(False))
        found.append(F.when(old != now, event(F.when(now, on).otherwise(off), old=old.cast("string"), to=now.cast("string"))))
    before, after = F.col("old_content_hash"), F.col("new_content_hash")
    found.append(F.when(seen & ~before.eqNullSafe(after), event(F.lit("CONTENT_CHANGE"), old=F.substring(before, 1, 12), to=F.substring(after, 1, 12))).when(~seen, event(F.lit("FIRST_SEEN"))))
    return pairs.select("sku", F.explode(F.array_compact(F.array(*found))).alias("e")).select("sku", "e.*")


def kept_extrema(low: Column, high: Column, price: Column, most: float) -> tuple[Column, Column]:
    """Lowest and highest price after a new one; an anomaly or a missing price changes neither."""
    sound = F.when(~is_anomaly(price, most), price)
    return F.least(low, sound), F.greatest(high, sound)


def absence_verdicts(evidence: DataFrame, products: DataFrame, host: str, zone: str) -> DataFrame:
    """(sku, verdict) of each row of evidence that a product shows no original price: the first fault, NO_ORIGINAL or CLEAR.

    evidence: sku, complete, articles (array), url, original_count, discount_count, original_text,
    discount_text, observed_at (UTC, without zone), business_date, price, expected_original.
    products: sku, product_url, status, current_price, original_price, one row for each SKU.
    """
    many = evidence.groupBy(F.col("sku").alias("_key")).agg((F.count(F.lit(1)) > 1).alias("_many"))
    own = products.select("sku", F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in ("product_url", "status", "current_price", "original_price")])
    yes = lambda c: F.coalesce(c, F.lit(False))
    local_day = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col("observed_at").cast("timestamp_ntz")))
    original, expected = F.col("_original_price"), F.col("expected_original")
    rules = [
        ("DUPLICATE_SKU", yes(~F.col("_many"))), ("SKU_MISSING", yes(F.col("_there"))), ("EVIDENCE_INCOMPLETE", yes(F.col("complete"))), ("SKU_MISMATCH", yes(F.col("articles") == F.array("sku"))),
        ("URL_MISMATCH", yes((F.col("url") == F.col("_product_url")) & (F.try_parse_url("url", F.lit("HOST")) == host))),
        ("NOT_CONFIRMED", yes((F.col("original_count") == 0) & (F.col("discount_count") == 0) & (F.col("original_text") == "") & (F.col("discount_text") == ""))),
        ("DATE_MISMATCH", yes(local_day == F.col("business_date"))), ("CURRENT_PRICE_MISMATCH", yes((F.col("price") > 0) & (F.abs(F.col("price") - F.col("_current_price")) <= TOLERANCE))),
        ("SKU_NOT_CURRENT", yes(F.col("_status") == "CURRENT")), ("ORIGINAL_CHANGED", original.isNull() | yes((original > 0) & (expected > 0) & (F.abs(original - expected) <= TOLERANCE))),
    ]
    fault = F.coalesce(*[F.when(~holds, F.lit(name)) for name, holds in rules])
    joined = evidence.join(many, F.col("sku").eqNullSafe(F.col("_key")), "left").join(own, "sku", "left")
    return joined.select("sku", F.coalesce(fault, F.when(original.isNull(), NO_ORIGINAL).otherwise(CLEAR)).alias("verdict"))


def without_originals(products: DataFrame, verdicts: DataFrame, shown: int = 20) -> DataFrame:
    """Products with proven absences applied: all of a batch or, with an error that names faults, nothing of it."""
    faults = verdicts.where(~F.col("verdict").isin(NO_ORIGINAL, CLEAR))
    named = faults.orderBy("sku", "verdict").limit(shown).collect()
    if named:
        raise AbsenceRefused("; ".join(f"{r.sku}: {r.verdict}" for r in named))
    clear = verdicts.where(F.col("verdict") == CLEAR).select("sku", F.lit(True).alias("_clear"))
    joined = products.join(clear, "sku", "left")
    return joined.withColumn("original_price", F.when(F.col("_clear").isNull(), F.col("original_price"))).select(*products.columns)


def positive_scope_faults(rows: DataFrame, permissions: DataFrame, prior: DataFrame, observations: DataFrame, issues: DataFrame, fields: list[str], frozen: list[str]) -> DataFrame:
    """(sku, fault) of rows that bring facts without a word on presence; none: the rows may be committed.

    rows, prior: sku, canonical_id, status, first_seen, last_seen, missing_count, `fields` and `frozen` (prior: what
    is stored). permissions: sku, canonical_id, allowed (map of field to the hash of its value). observations: sku,
    presence_state, complete, absence_capable. issues: sku, level, field_name. A field may change only where it is
    allowed, and then to the value of that hash; frozen fields don't change; a new SKU is UNKNOWN and was never
    seen; each SKU is in rows, permissions and observations once; an observation is PRESENT and claims nothing
    more; a blocking issue, or a review of an allowed field, stops its SKU. All faults of a SKU are given; null and
    empty values are the same. Every relation meets the others by SKU, once.
    """
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    yes, digest = lambda c: F.coalesce(c, F.lit(False)), lambda c: F.sha2(text(c).cast("binary"), 256)
    kept = ["canonical_id", "status", "first_seen", "last_seen", "missing_count", *fields, *frozen]
    kept = list(dict.fromkeys(kept))

    def once(frame: DataFrame, name: str, columns: list[str]) -> DataFrame:
        """One row for each SKU with its number of rows, so that repeats are a fault and don't multiply; of several the first as JSON speaks."""
        return frame.groupBy("sku").agg(F.count(F.lit(1)).alias(f"{name}_n"), F.min_by(F.struct(*columns), F.to_json(F.struct(*columns))).alias(name))

    seen = observations.groupBy("sku").agg(F.count(F.lit(1)).alias("seen_n"), F.bool_and(yes(F.col("presence_state") == "PRESENT") & ~F.coalesce("complete", F.lit(True)) & ~F.coalesce("absence_capable", F.lit(True))).alias("seen_only"))
    marks = issues.groupBy("sku").agg(F.bool_or(yes(F.col("level") == "HARD_BLOCK") & ~yes(F.col("field_name") == "presence")).alias("blocked"), F.collect_set(F.when(F.col("level") == "FIELD_REVIEW", F.col("field_name"))).alias("reviewed"))
    own = once(rows, "row", kept).join(once(permissions, "may", ["canonical_id", "allowed"]), "sku", "full").join(seen, "sku", "full")
    joined = own.join(prior.select("sku", F.struct(*kept).alias("old")), "sku", "left").join(marks, "sku", "left")
    there, known, allowed = F.col("row").isNotNull() & F.col("may").isNotNull(), F.col("old").isNotNull(), F.col("may.allowed")
    judged = lambda name, holds, when=there: F.when(when & ~yes(holds), F.lit(name))
    may = lambda f: yes(F.map_contains_key(allowed, F.lit(f)))
    found = [
        judged("SKU_SCOPE_MISMATCH", (F.col("row_n") == 1) & (F.col("may_n") == 1), F.lit(True)), judged("OBSERVATION_SCOPE_MISMATCH", (F.col("seen_n") == 1) & F.col("may").isNotNull(), F.lit(True)),
        judged("NO_ABSENCE_AUTHORITY", F.col("seen_only"), F.col("seen_n").isNotNull()), judged("IDENTITY_MISMATCH", (F.col("row.canonical_id") == F.col("may.canonical_id")) & (~known | (F.col("old.canonical_id") == F.col("may.canonical_id")))),
        judged("NEW_IDENTITY_MUST_BE_UNKNOWN", (F.col("row.status") == "UNKNOWN") & (text(F.col("row.first_seen")) == "") & (text(F.col("row.last_seen")) == "") & (F.coalesce("row.missing_count", F.lit(0)) == 0), there & ~known),
        judged("QA_NOT_READY", ~yes(F.col("blocked")) & ~yes(F.arrays_overlap("reviewed", F.map_keys(allowed)))),
    ]
    found += [judged(f"LIFECYCLE_CHANGED:{f}", text(F.col(f"row.{f}")) == text(F.col(f"old.{f}")), there & known) for f in frozen]
    found += [judged(f"VALUE_HASH_MISMATCH:{f}", digest(F.col(f"row.{f}")) == F.element_at(allowed, f), there & may(f)) for f in fields]
    found += [judged(f"UNAUTHORIZED_FIELD:{f}", text(F.col(f"row.{f}")) == text(F.col(f"old.{f}")), there & ~may(f)) for f in fields]
    return joined.select("sku", F.explode(F.array_compact(F.array(*found))).alias("fault"))

"""The daily update: plans, listing facts, trusted fields, current rows, price projection, heads and gates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.texts import is_blank

DETAIL = ("NEW", "REAPPEARED", "CONTENT_CHANGE", "IMAGE_CHANGE", "DETAIL_PENDING", "MISSING_FIELD", "DETAIL_REFRESH")


def other_text(a: Column, b: Column) -> Column:
    return F.trim(F.coalesce(a.cast("string"), F.lit(""))) != F.trim(F.coalesce(b.cast("string"), F.lit("")))


def listing_difference(rows: DataFrame, fields: list[str], sets: tuple[str, ...] = ()) -> Column:
    """Names of the fields a card shows and that differ from the card before (before_<field>); `sets` compare as sets of a comma list."""

    def differs(f: str) -> Column:
        own, before = F.col(f), F.col(f"before_{f}")
        if f in sets:
            parts = lambda c: F.array_sort(F.array_distinct(F.split(F.coalesce(c, F.lit("")), ",")))
            return parts(own) != parts(before)
        return other_text(own, before)

    return F.array_compact(F.array(*[F.when(F.col(f).isNotNull() & differs(f), F.lit(f)) for f in fields]))


def listing_merge(field: str, own: Column, card: Column, from_detail: Column, always: bool = False) -> dict[str, Column]:
    """A card's value fills an empty field; one from this run's detail page stays. `always`: the card's value wins otherwise too."""
    shown = F.coalesce(card.cast("string"), F.lit("")) != ""
    taken = shown & ~from_detail & (F.lit(always) | (F.coalesce(own.cast("string"), F.lit("")) == ""))
    state = F.when(from_detail, "DETAIL_CURRENT_RUN").when(taken | (shown & ~other_text(own, card)), "LISTING_CURRENT_RUN")
    return {field: F.when(taken, card).otherwise(own), f"{field}_source": state}


def update_plan(rows: DataFrame, when: dict[str, Column], unknown_listing: Column, unknown_fresh: Column, budget: int) -> DataFrame:
    """sku, reason, need_detail of the rows that need work.

    `when` has a condition for each reason; of those of one stage the first holds, and a
    later stage overrides an earlier: a change of price or badge, a change of the card, then
    the state of the detail page. NEW and REAPPEARED stand alone. The budget goes to cards
    without a known predecessor first, then to details of unknown age, in the order of SKUs.
    """
    no = F.lit(False)

    def stage(*names: str) -> Column:
        return F.coalesce(*[F.when(F.coalesce(when.get(n, no), no), F.lit(n)) for n in names], F.lit(None).cast("string"))

    alone = stage("NEW", "REAPPEARED")
    reason = F.coalesce(alone, stage("DETAIL_PENDING", "MISSING_FIELD", "DETAIL_REFRESH"), stage("IMAGE_CHANGE", "CONTENT_CHANGE"), stage("PRICE_CHANGE_CANDIDATE", "PRICE_METADATA_CHANGE", "BADGE_CHANGE"))
    card = F.coalesce(stage("IMAGE_CHANGE", "CONTENT_CHANGE").isNotNull(), no)
    planned = rows.withColumns({"reason": reason, "_active": alone.isNull()}).withColumn("need_detail", F.coalesce(F.col("reason").isin(*DETAIL), no) | (F.col("_active") & card))
    asked = planned.withColumn("_ask", F.when(~F.col("_active") | F.col("need_detail"), None).when(F.coalesce(unknown_listing, no), 1).when(F.coalesce(unknown_fresh, no), 2))
    # the budget is the feature: the first rows by priority and SKU
    chosen = asked.where("_ask IS NOT NULL").orderBy("_ask", "sku").limit(budget).select("sku", F.col("_ask").alias("_chosen"))
    named = F.when(F.col("_chosen") == 1, "LISTING_BASELINE_UNKNOWN").when(F.col("_chosen") == 2, "DETAIL_FRESHNESS_UNKNOWN")
    out = asked.join(chosen, "sku", "left").withColumns({"reason": F.coalesce(named, "reason"), "need_detail": F.col("need_detail") | F.col("_chosen").isNotNull()})
    return out.where(F.col("reason").isNotNull()).drop("_ask", "_chosen", "_active")


def current_rows(baseline: DataFrame, updated: DataFrame, today: DataFrame, fields: list[str], run_date: str) -> DataFrame:
    """The current catalogue: SKUs present today, their updated row before the baseline's; a first sight defaults to today's."""
    a = baseline.select("sku", F.struct("first_seen", *fields).alias("_a"))
    b = updated.select("sku", F.struct("first_seen", *fields).alias("_b"))
    seen = today.select("sku", F.col("first_seen").alias("_first")).dropDuplicates(["sku"])
    row = F.when(F.col("_b").isNotNull(), F.col("_b")).otherwise(F.col("_a"))
    out = seen.join(a, "sku", "left").join(b, "sku", "left").withColumn("_row", row)
    first = F.coalesce(F.nullif(F.col("_row.first_seen"), F.lit("")), "_first", F.lit(run_date))
    return out.select("sku", *[F.col(f"_row.{f}").alias(f) for f in fields], first.alias("first_seen"), F.lit("CURRENT").alias("status"), F.lit(run_date).alias("last_seen"), F.lit(0).alias("missing_count"))


def trusted_fields(today: DataFrame, baseline: DataFrame, issues: DataFrame, fields: list[str], with_price: tuple[str, ...] = ()) -> DataFrame:
    """sku, each field and its state: a field under review goes back to its last value; a price under review takes `with_price` along."""
    marks = issues.groupBy("sku").agg(F.collect_set("field_name").alias("_marks"))
    old = baseline.select("sku", *[F.col(f).alias(f"_old_{f}") for f in fields])
    joined = today.join(marks, "sku", "left").join(old, "sku", "left")
    own = F.coalesce("_marks", F.array().cast("array<string>"))
    out = {}
    for f in fields:
        bad = F.array_contains(own, f)
        bad = bad | F.array_contains(own, "current_price") if f in with_price else bad
        kept = F.when(F.col(f"_old_{f}").isNotNull(), "HISTORY_RETAINED").otherwise("SOURCE_MISSING")
        out |= {f: F.when(bad, F.col(f"_old_{f}")).otherwise(F.col(f)), f"{f}_state": F.when(bad, kept).otherwise("CURRENT_RUN")}
    return joined.select("sku", *[v.alias(k) for k, v in out.items()])


def price_projection(history: DataFrame, period: str, most: float) -> DataFrame:
    """For each SKU the last real change, the change of a day, and the extrema without anomalies: one aggregate."""
    order = F.struct("observed_at", "k1", "k2", "k3")
    real, day = F.col("change_type").isin("UP", "DOWN"), F.date_format("observed_at", "yyyy-MM-dd")
    sound = lambda c: F.when((F.col(c) > 0) & (F.col(c) <= most), F.col(c))
    facts = history.groupBy("sku").agg(
        F.max_by(F.struct("old_price", "new_price", "change_type", day.alias("day")), F.when(real, order)).alias("last"), F.max_by("change_type", F.when(day == period, order)).alias("period_change"),
        F.least(F.min(sound("old_price")), F.min(sound("new_price"))).alias("price_min"), F.greatest(F.max(sound("old_price")), F.max(sound("new_price"))).alias("price_max"),
    )
    last = F.when(F.col("last.change_type").isin("UP", "DOWN"), F.col("last"))
    return facts.withColumn("last", last).select(
        "sku", F.col("last.old_price").alias("last_price"), F.col("last.change_type").alias("price_direction"), F.round(F.col("last.new_price") - F.col("last.old_price"), 4).alias("change_amount"),
        F.col("last.day").alias("last_change_date"), F.coalesce("period_change", F.lit("UNCHANGED")).alias("price_change"), "price_min", "price_max",
    )


def last_of_day(rows: DataFrame, keys: list[str], at: str, order: list[str], value: str) -> DataFrame:
    """Each key's last value of each day."""
    return rows.groupBy(*keys, F.to_date(at).alias("day")).agg(F.max_by(value, F.struct(*order)).alias(value))


def record_baseline(rows: DataFrame, keys: list[str], order: list[Column], value: str, spans: Iterable[int] = (7, 30)) -> DataFrame:
    """Medians of each key's last records: the baseline of runs without a formal date."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_n") <= max(spans)).groupBy(*keys).agg(*[F.median(F.when(F.col("_n") <= n, F.col(value))).alias(f"median_{n}") for n in spans])


def presence_head(commits: DataFrame, runs: DataFrame, observations: DataFrame) -> DataFrame:
    """The newest commit of a passed, real run with a complete observation of everything: one row."""
    whole = observations.where("observation_complete").select("run_id").distinct()
    good = commits.where("status = 'COMMITTED' AND commit_scope = 'FULL_OBSERVATION'").join(runs.where("qa_state IN ('PASS', 'PASS_PRESENCE_ONLY') AND NOT dry_run"), "run_id").join(whole, "run_id", "left_semi")
    return good.agg(F.max_by(F.struct("commit_id", "run_id", "committed_at"), F.struct("committed_at", "commit_id")).alias("head")).where("head IS NOT NULL").select("head.*")


def presence_mode(sitemap: Column, listing_complete: Column, access: Column) -> Column:
    return F.when(sitemap & listing_complete & (access == "NORMAL"), "FULL").when(sitemap, "SITEMAP_FALLBACK").otherwise("INCOMPLETE")


def sku_match(rows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Adds match: SKU_EXACT, SKU_UNKNOWN or NO_SKU."""
    known = baseline.select(F.col("sku").alias("_known")).distinct()
    joined = rows.join(known, F.col("sku") == F.col("_known"), "left")
    return joined.withColumn("match", F.when(is_blank(F.col("sku")), "NO_SKU").when(F.col("_known").isNotNull(), "SKU_EXACT").otherwise("SKU_UNKNOWN")).drop("_known")


def share(part: Column, whole: Column) -> Column:
    """Per cent; of nothing it is 0."""
    return F.when(whole == 0, 0.0).otherwise(100.0 * part / whole)


def run_gate(counts: DataFrame, limits: dict[str, float]) -> DataFrame:
    """(check, value, passed, level) of each run-level rule; counts has one row for each run.

    A sitemap fallback does not judge the gap to the listing and bears a restricted access.
    """
    fallback = F.col("presence_mode") == "SITEMAP_FALLBACK"
    before, now = F.col("yesterday_total"), F.col("today_total")
    larger = F.greatest("sitemap_count", "listing_count")
    rules = [
        ("fetch_not_blocked", F.col("blocked").cast("double"), ~F.col("blocked") | fallback, "HARD_BLOCK"), ("access_state_complete", (F.col("access_state") != "NORMAL").cast("double"), (F.col("access_state") == "NORMAL") | fallback, "HARD_BLOCK"),
        ("observation_valid", F.col("observation_valid").cast("double"), F.col("observation_valid"), "HARD_BLOCK"), ("total_drop", share(F.greatest(before - now, F.lit(0)), before), None, "HARD_BLOCK"), ("total_rise", share(F.greatest(now - before, F.lit(0)), before), None, "HARD_BLOCK"),
        ("sitemap_listing_gap", F.when(fallback, 0.0).otherwise(share(F.abs(F.col("sitemap_count") - F.col("listing_count")), larger)), None, "HARD_BLOCK"), ("new_sku", share(F.col("new_count"), F.greatest(now, F.lit(1))), None, "HARD_BLOCK"),
        ("missing", share(F.col("missing_count"), F.greatest(before, F.lit(1))), None, "HARD_BLOCK"), ("anomaly_count", F.col("anomaly_count").cast("double"), None, "WARNING"),
    ]
    made = [F.struct(F.lit(name).alias("check"), F.round(value, 6).alias("value"), (F.lit(True) & (value <= limits[name]) if passed is None else passed).alias("passed"), F.lit(level).alias("level")) for name, value, passed, level in rules]
    keys = [c for c in ("run_id",) if c in counts.columns]
    return counts.select(*keys, F.explode(F.array(*made)).alias("r")).select(*keys, "r.*")


def field_issues(rows: DataFrame, least: float, most: float) -> DataFrame:
    """(level, sku, field_name, reason): identity and field findings of products, with keys seen twice by one aggregate of keys."""
    repeated = lambda c: rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(c).alias(f"_{c}"))
    joined = rows
    for c in ("sku", "canonical_id"):
        joined = joined.join(repeated(c), F.col(c) == F.col(f"_{c}"), "left")
    price = F.col("current_price")
    rules = [
        ("HARD_BLOCK", "sku", "PRODUCT_SKU_INVALID", ~F.coalesce(F.col("sku"), F.lit("")).rlike("^[0-9]+$")), ("HARD_BLOCK", "canonical_id", "CANONICAL_ID_MISSING", is_blank(F.col("canonical_id"))),
        ("HARD_BLOCK", "sku", "DUPLICATE_SKU", F.col("_sku").isNotNull()), ("HARD_BLOCK", "canonical_id", "DUPLICATE_CANONICAL_ID", F.col("_canonical_id").isNotNull()), ("HARD_BLOCK", "product_url", "PRODUCT_URL_MISSING", is_blank(F.col("product_url"))),
        ("FIELD_REVIEW", "current_price", "PRICE_SOURCE_MISSING", price.isNull()), ("FIELD_REVIEW", "current_price", "PRICE_NOT_OBSERVED_THIS_RUN", price.isNotNull() & F.col("price_state").isin("HISTORY_RETAINED", "SOURCE_MISSING")),
        ("FIELD_REVIEW", "cat1", "CATEGORY_SOURCE_MISSING", is_blank(F.col("cat1")) & is_blank(F.col("cat2"))), ("FIELD_REVIEW", "current_price", "PRICE_OUT_OF_RANGE", (price < least) | (price > most) | F.isnan(price)),
    ]
    made = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(field).alias("field_name"), F.lit(reason).alias("reason"))) for level, field, reason, c in rules]))
    return joined.select("sku", F.explode(made).alias("i")).select("i.level", "sku", "i.field_name", "i.reason")


def override_reasons(o: dict[str, Column], run_id: Column, metrics_hash: Column, now: Column) -> Column:
    """Why an override of a gate does not hold; none: it holds."""
    return F.array_compact(F.array(
        F.when(is_blank(o["actor"]), "ACTOR_MISSING"), F.when(is_blank(o["reason"]), "REASON_MISSING"), F.when(~o["run_id"].eqNullSafe(run_id), "RUN_MISMATCH"), F.when(~o["metrics_hash"].eqNullSafe(metrics_hash), "METRICS_MISMATCH"),
        F.when(~F.coalesce(o["one_shot"], F.lit(False)), "NOT_ONE_SHOT"), F.when(F.coalesce(o["expires_at"] <= now, F.lit(True)), "EXPIRED"),
    ))


def approval(candidate_reasons: Column, field_low_risk: Column, confidence: Column, source_unchanged: Column, human_conflict: Column, scope_conflict: Column, enabled: bool, shadow: bool = True, threshold: float = 0.95) -> dict[str, Column]:
    """(failed, decision): nothing is approved while a reason stands or the gate is closed."""
    no = F.lit(False)
    own = F.array_compact(F.array(
        F.when(~F.coalesce(source_unchanged, no), "SOURCE_HASH_CHANGED"), F.when(F.coalesce(human_conflict, no), "HUMAN_OVERRIDE_CONFLICT"), F.when(F.coalesce(scope_conflict, no), "SCOPED_TERM_CONFLICT"),
        F.when(F.coalesce(confidence, F.lit(0.0)) < threshold, "CONFIDENCE_BELOW_THRESHOLD"), F.when(~F.coalesce(field_low_risk, no), "FIELD_NOT_LOW_RISK"),
    ))
    failed = F.array_distinct(F.concat(candidate_reasons, own))
    safe = "AUTO_APPROVED" if enabled else "WOULD_AUTO_APPROVE" if shadow else "REVIEW_REQUIRED"
    return {"failed": failed, "decision": F.when(F.size(failed) > 0, "REVIEW_REQUIRED").otherwise(safe)}


def candidate_reasons(source: Column, value: Column, same_sku: Column, same_hash: Column, confidence: Column, longest: int = 4000) -> Column:
    """Why a candidate text for a source text can't be taken: other identity, too long, an address, a dropped number, confidence out of range."""
    numbers = lambda c: F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d+(?:[.,]\d+)?"), F.lit(0)))
    address = value.rlike(r"(?i)https?://|www\.")
    fits = F.length(value) <= longest
    return F.array_compact(F.array(
        F.when(~F.coalesce(same_sku, F.lit(False)), "SKU_MISMATCH"), F.when(~F.coalesce(same_hash, F.lit(False)), "SOURCE_HASH_MISMATCH"), F.when(~fits, "TOO_LONG"), F.when(fits & address, "URL_CONTAMINATION"),
        F.when(fits & ~address & (F.size(F.array_except(numbers(source), numbers(value))) > 0), "NUMBER_DROPPED"), F.when(~confidence.between(0, 1), "CONFIDENCE_OUT_OF_RANGE"),
    ))

"""Gates, eligibility and evidence checks: each returns rows or reasons, and is a join by key or one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.evidence import has_cjk
from shelfwise.functions.texts import is_blank, measurements, numbers
from shelfwise.operators.phrases import longest, spans
from shelfwise.operators.upserts import keyed_difference, rule_union
from shelfwise.operators.windows import latest


def reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, in their order, joined by bars; a null check does not hold."""
    return F.array_join(F.array_compact(F.array(*[F.when(check, name) for name, check in checks.items()])), "|")


def master_findings(rows: DataFrame, provenance: DataFrame, fields: list[str]) -> DataFrame:
    """(sku, rule): faults of master rows, and fields with a value but without provenance (key, field)."""
    target = [f"zh_{c}" for c in fields]
    held = provenance.groupBy("sku").agg(F.collect_set("field").alias("_held"))
    # merged, not broadcast: provenance has a row for each cell, however small its file is
    known = rows.join(held.hint("merge"), "sku", "left")
    bare = {f"PROVENANCE_{c.upper()}": ~is_blank(F.col(f"zh_{c}")) & ~F.coalesce(F.array_contains("_held", c), F.lit(False)) for c in fields}
    found = rule_union(known, "sku", {
        "BLANK_SKU": is_blank(F.col("sku")), "PRICE": F.col("current_price").isNull() | (F.col("current_price") <= 0), "PROMOTION_WITHOUT_ORIGINAL": F.col("promotion") & F.col("original_price").isNull(),
        "SOURCE_INCOMPLETE": F.greatest(*[is_blank(F.col(f"es_{c}")) for c in fields]), "TARGET_INCOMPLETE": F.greatest(*[is_blank(F.col(c)) for c in target]), **bare,
    })
    repeated = rows.groupBy("sku").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sku", F.lit("DUPLICATE_SKU").alias("rule"))
    return found.unionAll(repeated)


def suppressed(findings: DataFrame, entries: DataFrame, now: Column, most_days: int = 90) -> DataFrame:
    """Findings with a flag: a confirmed entry of the same field and the same three hashes, of at most so many days, is in force."""
    keys = ["sku", "field", "source_hash", "current_hash", "reviewed_hash"]
    force = entries.where((F.col("status") == "CONFIRMED") & (F.col("reviewed_at") <= now) & (now < F.col("expires_at")) & (F.datediff("expires_at", "reviewed_at") <= most_days))
    return findings.join(force.select(*keys).distinct().withColumn("suppressed", F.lit(True)), keys, "left").withColumn("suppressed", F.coalesce("suppressed", F.lit(False)))


def formal_target(rows: DataFrame, pairs: dict[str, str], status: str = "translation_status") -> DataFrame:
    """Target fields as they may be published: source text is never put in their place; missing ones make the row pending."""
    missing = F.array_compact(F.array(*[F.when(is_blank(F.col(zh)) & ~is_blank(F.col(es)), zh) for zh, es in pairs.items()]))
    unset = F.coalesce(F.upper(status), F.lit("")).isin("", "FALLBACK_ES", "NOT_CONFIGURED")
    return rows.withColumn("missing", F.array_join(missing, "|")).withColumns({
        "formal_status": F.when((F.col("missing") != "") | unset, "PENDING").otherwise(F.col(status)), "display_fallback": F.when(F.col("missing") != "", "ES"),
    })


def commit_allowed(state: Column, override_valid: Column, required: Column) -> Column:
    """Whether a run with this collection state may be committed."""
    named = F.upper(F.coalesce(state, F.lit("")))
    return F.when(named == "COLLECTION_BLOCKED", False).when(named == "COLLECTION_DEGRADED", override_valid).when(named == "", ~required).otherwise(named.isin("COLLECTION_OK", "COLLECTION_WARN"))


def freshness(status: Column, has_row: Column) -> Column:
    return F.when(F.coalesce(status, F.lit("")) != "", status).when(has_row, "NO_FRESHNESS_STATUS").otherwise("NO_LOCALIZATION")


def confirmed_brand(review: Column, confidence: Column) -> Column:
    """A reviewed brand, or one with recognised evidence that waits for no review."""
    review, confidence = F.upper(F.trim(F.coalesce(review, F.lit("")))), F.upper(F.trim(F.coalesce(confidence, F.lit(""))))
    return (review == "HUMAN_REVIEWED") | (confidence.isin("REFERENCE", "HUMAN_CONFIRMED", "AI_REVIEWED") & (review != "NEEDS_HUMAN_REVIEW"))


def product_source_hash(*fields: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[F.trim(F.coalesce(c, F.lit(""))) for c in fields]), 256)


def without_spans(text: Column, spans: list[str]) -> Column:
    """The text without the first place of each span, longest spans first."""
    for span in sorted(spans, key=lambda s: (-len(s), s)):
        at = F.instr(text, span)
        text = F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + len(span), F.length(text)))).otherwise(text)
    return F.trim(text)


def title_brands(titles: DataFrame, aliases: DataFrame, least: int = 3) -> DataFrame:
    """(sku, brand): the longest alias of at least so many characters that stands in the title with no word character beside it; of equals the first, of its brands the least."""
    named = aliases.select(F.lower(F.trim("alias")).alias("phrase"), "brand").where(F.length("phrase") >= least).groupBy("phrase").agg(F.min("brand").alias("brand"))
    best = longest(spans(titles, named, ["sku"], "title"), ["sku"]).join(named, "phrase").select("sku", "brand")
    return titles.select("sku").join(best, "sku", "left")


def enrichment_candidates(current: DataFrame, known: DataFrame) -> DataFrame:
    """(sku, reason): products that the dictionary lacks, whose source changed, or that wait for review."""
    both = current.join(known.select("sku", F.col("source_hash").alias("known_hash"), "review_status"), "sku", "left")
    reason = F.when(F.col("known_hash").isNull(), "NEW").when(F.col("known_hash") != F.col("source_hash"), "SOURCE_HASH_CHANGED").when(F.col("review_status") == "NEEDS_REVIEW", "NEEDS_REVIEW")
    return both.select("sku", reason.alias("reason")).where("reason IS NOT NULL")


def key_faults(rows: DataFrame, key: str) -> DataFrame:
    """(key, fault, n): blank keys and keys of several rows; keys are trimmed."""
    named = rows.groupBy(F.trim(F.coalesce(key, F.lit(""))).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return named.where("key = '' OR n > 1").select("key", F.when(F.col("key") == "", "BLANK").otherwise("DUPLICATE").alias("fault"), "n")


def running_extrema(history: DataFrame, keys: list[str], order: list[str], price: str, least: float, most: float) -> DataFrame:
    """Lowest and highest price of a key so far; missing prices and those outside the bounds leave them as they are."""
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.when(F.col(price).between(least, most), F.col(price))
    return history.withColumns({"low": F.min(valid).over(so_far), "high": F.max(valid).over(so_far)})


def daily_source(runs: DataFrame) -> DataFrame:
    """The newest usable run of a date: committed, passed, not dry, whole in scope and with a hash of its metrics."""
    usable = runs.where((F.col("qa") == "PASS") & F.col("committed") & ~F.col("dry") & (F.col("scope") == "FULL") & F.col("metrics_hash").isNotNull())
    return latest(usable, ["day"], ["committed_at", "run_id"], ["run_id"])


def translation_plan(source: DataFrame, approved: DataFrame, fields: list[str]) -> DataFrame:
    """(sku, field) with a source text but no approved text of the same source hash."""
    cells = source.select("sku", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in fields])).alias("cell")).where(~is_blank(F.col("cell.value")))
    return cells.select("sku", "cell.field", F.sha2("cell.value", 256).alias("source_hash")).join(approved, ["sku", "field", "source_hash"], "left_anti")


def additions(terms: DataFrame, proposed: DataFrame, scope: list[str]) -> DataFrame:
    """Proposed terms that their scope lacks, once each; of several the smallest target."""
    return proposed.groupBy(*scope).agg(F.min("target").alias("target")).join(terms, scope, "left_anti")


def allowed_tokens(rows: DataFrame) -> DataFrame:
    """Distinct tokens of reviewed rows (no status counts as reviewed): each alias, and each of its words."""
    status = F.upper(F.trim(F.coalesce("review_status", F.lit(""))))
    aliases = rows.where(status.isin("", "APPROVED", "HUMAN_REVIEWED")).select(F.explode(F.split("aliases", r"[|,]")).alias("alias")).select(F.trim("alias").alias("alias"))
    return aliases.select(F.explode(F.array_union(F.array("alias"), F.split("alias", r"\s+"))).alias("token")).where("token <> ''").distinct()


def decided(backlog: DataFrame, decisions: DataFrame) -> DataFrame:
    """(id, state, outcome): the last decision on a pending entry holds if it was made on the entry's present evidence."""
    last = latest(decisions, ["id"], ["seq"], ["decision", "evidence_hash"]).withColumnRenamed("evidence_hash", "seen")
    rows = backlog.join(last, "id", "left")
    outcome = F.when(F.col("decision").isNull(), "OPEN").when(F.col("state") != "PENDING", "CLOSED").when(~F.col("seen").eqNullSafe(F.col("evidence_hash")), "EVIDENCE_CHANGED").otherwise("APPLIED")
    state = F.when(F.col("decision") == "ASSIGN", "RESOLVED").when(F.col("decision") == "REJECT", "REJECTED").otherwise(F.col("state"))
    return rows.withColumn("outcome", outcome).select("id", F.when(F.col("outcome") == "APPLIED", state).otherwise(F.col("state")).alias("state"), "outcome")


def reusable(cells: DataFrame, held: DataFrame) -> DataFrame:
    """(sku, field, reused): the target text, where it is in target script, fresh, and bound to the source text as it is now."""
    rows = cells.join(held, ["sku", "field"], "left")
    good = ~is_blank(F.col("source")) & (F.col("snapshot") == F.col("source")) & F.col("freshness").isin("CURRENT", "FRESH") & has_cjk(F.col("target"))
    return rows.select("sku", "field", F.when(good, F.col("target")).alias("reused"))


def evidence_faults(products: DataFrame, observed: DataFrame, receipts: DataFrame) -> DataFrame:
    """(sku, reasons) of current products without sight, with another price than was seen and no marker, or with a receipt of another value."""
    rows = products.join(observed, "sku", "left").join(receipts, "sku", "left")
    why = reasons({
        "NOT_PRESENT": ~F.coalesce("present", F.lit(False)), "PRICE_DIFFERS": F.coalesce("present", F.lit(False)) & ~F.coalesce("invalid", F.lit(False)) & ~F.col("price").eqNullSafe(F.col("seen_price")),
        "NO_RECEIPT": F.col("receipt_hash").isNull(), "RECEIPT_DIFFERS": F.col("receipt_hash") != F.col("value_hash"),
    })
    return rows.select("sku", why.alias("reasons")).where("reasons <> ''")


def exception_faults(exceptions: DataFrame, issues: DataFrame, now: Column, required: list[str], most_days: int = 90) -> DataFrame:
    """(key, reasons): why an exception does not hold; none means that it does."""
    rows = exceptions.join(issues.select("key", F.col("source_hash").alias("present_hash")), "key", "left")
    why = reasons({
        "INCOMPLETE": F.greatest(F.lit(False), F.lit(False), *[is_blank(F.col(c)) for c in required]), "ACTOR": ~F.coalesce(F.col("actor").startswith("human:"), F.lit(False)), "NO_ISSUE": F.col("present_hash").isNull(),
        "SOURCE_CHANGED": F.col("present_hash") != F.col("source_hash"), "EXPIRED": F.col("expires_at") <= now, "TOO_LONG": F.datediff("expires_at", "created_at") > most_days,
    })
    return rows.select("key", why.alias("reasons"))


def refresh_plan(rows: DataFrame, now: Column, days: int) -> DataFrame:
    """(sku, plan): what a product's detail page is read for, the first that holds."""
    plan = F.when(F.col("state").isin("FAILED", "BLOCKED"), "RETRY").when(is_blank(F.col("detail_hash")), "MISSING").when(F.col("read_at").isNull() | (F.datediff(now, "read_at") > days), "EXPIRED").otherwise("KEEP")
    return rows.select("sku", plan.alias("plan"))


def shadow_difference(left: DataFrame, right: DataFrame, fields: list[str], left_events: DataFrame, right_events: DataFrame) -> DataFrame:
    """(sku, field, n): fields in which two pipelines differ, and events that only one of them has, as a multiset."""
    cells = keyed_difference(left, right, "sku", fields).groupBy("sku", "field").agg(F.count(F.lit(1)).alias("n"))
    counted = left_events.withColumn("n", F.lit(1)).unionAll(right_events.withColumn("n", F.lit(-1))).groupBy(*left_events.columns).agg(F.sum("n").alias("n")).where("n <> 0")
    return cells.unionAll(counted.groupBy("sku").agg(F.sum(F.abs("n")).alias("n")).select("sku", F.lit("events").alias("field"), "n"))


def gold_counters(rows: DataFrame) -> DataFrame:
    """One row of counts over (key, field, source, prediction, gold); rows without identity or gold are counted as invalid and not judged."""
    valid = ~(is_blank(F.col("key")) | is_blank(F.col("field")) | is_blank(F.col("gold")))
    text = lambda name: F.coalesce(name, F.lit(""))
    held, shown = F.array_sort(numbers(text("source"))), F.array_sort(numbers(text("prediction")))
    units, shown_units = F.size(measurements(text("source"))), F.size(measurements(text("prediction")))
    flags = {
        "rows": valid, "invalid_rows": ~valid, "field_exact": valid & (F.trim(text("prediction")) == F.trim("gold")), "number_mismatch": valid & (held != shown),
        "unit_mismatch": valid & (units > 0) & (units != shown_units), "target_script": valid & has_cjk(F.col("prediction")),
    }
    return rows.agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])


def guarded_split(rows: DataFrame, group: str, order: list[str], ratio: float) -> DataFrame:
    """Adds part, 'valid' or 'train', by a hash of the group; a part that would be empty gets the last row in order, if there is more than that."""
    share = F.conv(F.substring(F.sha2(group, 256), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))
    dealt = rows.withColumn("_valid", share < ratio)
    whole = dealt.agg(F.count(F.lit(1)).alias("_n"), F.count_if("_valid").alias("_m"), F.max(F.struct(*order)).alias("_last"))
    last = F.struct(*order) == F.col("_last")
    valid = F.when((F.col("_m") == 0) & last, True).when((F.col("_m") == F.col("_n")) & (F.col("_n") > 1) & last, False).otherwise(F.col("_valid"))
    joined = dealt.withColumn("_one", F.lit(1)).join(F.broadcast(whole.withColumn("_one", F.lit(1))), "_one")
    return joined.withColumn("part", F.when(valid, "valid").otherwise("train")).drop("_valid", "_one", "_n", "_m", "_last")

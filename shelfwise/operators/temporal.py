"""Presence reconciliation, lifecycle, change events, field merge and presence history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Consecutive observed absences after which a SKU is offline.
OFFLINE_AFTER = 3

#: Days of a calendar that is broadcast: over a century.
MOST_DAYS = 40_000


def reconcile(today: DataFrame, yesterday: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each SKU of three keyed relations: presence today, yesterday, ever, and which sources hold it.

    today: (sku, sitemap, listing, nuevo, promo flags).
    """
    sources = ["sitemap", "listing", "nuevo", "promo"]
    tagged = (
        today.select("sku", *sources, F.lit(True).alias("t"), F.lit(False).alias("y"))
        .unionByName(yesterday.select("sku", *[F.lit(False).alias(s) for s in sources], F.lit(False).alias("t"), F.lit(True).alias("y")))
        .unionByName(known.select("sku", *[F.lit(False).alias(s) for s in sources], F.lit(False).alias("t"), F.lit(False).alias("y")))
    )
    one = tagged.groupBy("sku").agg(*[F.bool_or(F.coalesce(s, F.lit(False))).alias(s) for s in sources], F.bool_or("y").alias("present_yesterday"))
    flag = F.when(F.col("sitemap") & F.col("listing"), "BOTH").when(F.col("sitemap"), "SITEMAP_ONLY").when(F.col("listing"), "LISTING_ONLY").when(F.col("nuevo") | F.col("promo"), "AUXILIARY_ONLY").otherwise("NONE")
    return one.withColumn("source_flag", flag).withColumn("present_today", F.col("source_flag") != "NONE")


def step(present: Column, status: Column, ever_seen: Column, missing: Column, threshold: int = OFFLINE_AFTER) -> dict[str, Column]:
    """One day of the state machine: classification, new status and new count of absences."""
    more = missing + 1
    gone = ever_seen & ~present & (status != "OFFLINE")
    kind = (
        F.when(present & ~ever_seen, "NEW")
        .when(present & status.isin("MISSING", "OFFLINE"), "REAPPEARED")
        .when(present, "ACTIVE")
        .when(gone & (more >= threshold), "OFFLINE")
        .when(gone & (more == 1), "MISSING_FIRST")
        .when(gone, "MISSING_CONTINUED")
        .otherwise("ABSENT")
    )
    after = F.when(present, "ACTIVE").when(gone & (more >= threshold), "OFFLINE").when(gone, "MISSING").otherwise(status)
    return {"classification": kind, "status": after, "missing_count": F.when(present, 0).when(gone, more).otherwise(missing)}


def replay(cells: DataFrame, threshold: int = OFFLINE_AFTER) -> DataFrame:
    """(sku, day, present) to classification, status and missing_count on every observed day, without a loop over days.

    Cells not validly observed are left out by the caller: they advance nothing.
    A SKU's days are one partition; islands of absence are numbered by the
    running count of presences.
    """
    days = Window.partitionBy("sku").orderBy("day")
    island = Window.partitionBy("sku", "_seen").orderBy("day")
    numbered = cells.withColumns({"_seen": F.sum(F.col("present").cast("int")).over(days.rowsBetween(Window.unboundedPreceding, 0)), "_before": F.lag("present").over(days)})
    numbered = numbered.withColumn("_gone", F.sum((~F.col("present")).cast("int")).over(island.rowsBetween(Window.unboundedPreceding, 0)))
    gone = F.col("_gone")
    kind = (
        F.when(F.col("_seen") == 0, "ABSENT")
        .when(F.col("present") & (F.col("_seen") == 1), "NEW")
        .when(F.col("present") & ~F.col("_before"), "REAPPEARED")
        .when(F.col("present"), "ACTIVE")
        .when(gone == threshold, "OFFLINE")
        .when(gone > threshold, "ABSENT")
        .when(gone == 1, "MISSING_FIRST")
        .otherwise("MISSING_CONTINUED")
    )
    status = F.when(F.col("_seen") == 0, "UNKNOWN").when(F.col("present"), "ACTIVE").when(gone >= threshold, "OFFLINE").otherwise("MISSING")
    count = F.when(F.col("_seen") == 0, 0).when(F.col("present"), 0).otherwise(F.least(gone, F.lit(threshold)))
    return numbered.select("sku", "day", "present", kind.alias("classification"), status.alias("status"), count.cast("int").alias("missing_count"))


def state_of(replayed: DataFrame) -> DataFrame:
    """The state after the last day: dates of first and last presence, status, absences, offline date, ever offline."""
    return replayed.groupBy("sku").agg(
        F.min(F.when(F.col("present"), F.col("day"))).alias("first_seen"), F.max(F.when(F.col("present"), F.col("day"))).alias("last_seen"),
        F.max_by("status", "day").alias("status"), F.max_by("missing_count", "day").alias("missing_count"),
        F.max(F.when(F.col("classification") == "OFFLINE", F.col("day"))).alias("last_offline"), F.bool_or(F.col("classification") == "OFFLINE").alias("ever_offline"),
    )


def observations(replayed: DataFrame, complete: Column) -> DataFrame:
    """Presence as a word: an absence counts only where the day's observation is complete."""
    return replayed.withColumn("presence_state", F.when(F.col("present"), "PRESENT").when(complete, "ABSENT").otherwise("UNKNOWN"))


def lifecycle_events(replayed: DataFrame) -> DataFrame:
    """(sku, day, event_type) of the days on which the state changes; first sightings of reappearing SKUs are none."""
    names = {"NEW": "FIRST_SEEN", "REAPPEARED": "REAPPEARED", "OFFLINE": "OFFLINE_CONFIRMED", "MISSING_FIRST": "MISSING_FIRST", "MISSING_CONTINUED": "MISSING_CONTINUED"}
    kinds = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return replayed.where(F.col("classification").isin(*names)).select("sku", "day", kinds[F.col("classification")].alias("event_type"))


def change_events(pairs: DataFrame, flags: list[tuple[str, str, str]], content: list[str]) -> DataFrame:
    """Events of before/after rows: (sku, event_type, old_value, new_value).

    pairs has old_<c> and new_<c>; flags: (column, event when set, event when cleared).
    """
    found = []
    for column, on, off in flags:
        old, new = F.coalesce(F.col(f"old_{column}"), F.lit(False)), F.coalesce(F.col(f"new_{column}"), F.lit(False))
        found.append(F.when(new & ~old, F.struct(F.lit(on).alias("event_type"), F.lit("false").alias("old_value"), F.lit("true").alias("new_value"))).when(old & ~new, F.struct(F.lit(off).alias("event_type"), F.lit("true").alias("old_value"), F.lit("false").alias("new_value"))))
    for column in content:
        old, new = F.col(f"old_{column}").cast("string"), F.col(f"new_{column}").cast("string")
        found.append(F.when(~old.eqNullSafe(new), F.struct(F.lit(f"CHANGED_{column.upper()}").alias("event_type"), old.alias("old_value"), new.alias("new_value"))))
    return pairs.select("sku", F.explode(F.array_compact(F.array(*found))).alias("e")).select("sku", "e.*")


def merge_fields(base: DataFrame, observed: DataFrame, fields: list[str]) -> DataFrame:
    """Field by field: an observed value wins, else the old one is retained; <field>_state names the source."""
    joined = base.select("sku", *[F.col(c).alias(f"_b_{c}") for c in fields]).join(observed.select("sku", *[F.col(c).alias(f"_o_{c}") for c in fields]), "sku", "full_outer")
    out = {}
    for c in fields:
        old, new = F.col(f"_b_{c}"), F.col(f"_o_{c}")
        out[c] = F.coalesce(new, old)
        out[f"{c}_state"] = F.when(new.isNotNull(), "CURRENT_VERIFIED").when(old.isNotNull(), "HISTORY_RETAINED").otherwise("SOURCE_MISSING")
    return joined.select("sku", *[v.alias(k) for k, v in out.items()])


def presence_history(members: DataFrame, days: DataFrame, facts: DataFrame) -> DataFrame:
    """(sku, day, presence): 1, 0 or null. days: (day, complete); an absence is 0 only on complete days.

    days is a calendar: of up to MOST_DAYS days it is broadcast to the members,
    a longer table is refused, as it is none.
    """
    n_days = days.count()
    if n_days > MOST_DAYS:
        raise ValueError(f"{n_days} days; a calendar has at most {MOST_DAYS}")
    cells = members.select("sku").distinct().join(F.broadcast(days))
    return cells.join(facts.select("sku", "day", F.lit(1).alias("_p")).distinct(), ["sku", "day"], "left").select("sku", "day", F.coalesce("_p", F.when(F.col("complete"), 0)).alias("presence"))


def presence_matrix(history: DataFrame, days: list[str]) -> DataFrame:
    """Wide form for export: one column for each named day."""
    return history.withColumn("day", F.col("day").cast("string")).groupBy("sku").pivot("day", days).agg(F.max("presence"))


def valid_absences(rows: DataFrame, coverage: DataFrame, before: DataFrame, known: DataFrame, sitemap_valid: bool) -> DataFrame:
    """rows (sku, present, …) with absence_valid and presence_state: an absence counts with a valid sitemap or whole coverage of the SKU's own category, else it is UNKNOWN.

    coverage: (category, complete) of the day, of which any complete row is enough;
    before, known: (sku, category), the former first. Categories are compared
    without case and outer spaces; a SKU without one has no covered category.
    """
    label = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    last = before.select(F.col("sku").alias("_b"), label(F.col("category")).alias("_bc"))
    ever = known.select(F.col("sku").alias("_k"), label(F.col("category")).alias("_kc"))
    own = rows.join(last, F.col("sku") == F.col("_b"), "left").join(ever, F.col("sku") == F.col("_k"), "left")
    # the record of the day before decides where there is one, even if its category is blank
    own = own.withColumn("_category", F.when(F.col("_b").isNotNull(), F.col("_bc")).otherwise(F.coalesce("_kc", F.lit(""))))
    whole = coverage.groupBy(label(F.col("category")).alias("_label")).agg(F.bool_or("complete").alias("_complete")).where("_label <> ''")
    joined = own.join(whole, F.col("_category") == F.col("_label"), "left")
    valid = F.lit(sitemap_valid) | F.coalesce("_complete", F.lit(False))
    state = F.when(F.col("present"), "PRESENT").when(valid, "ABSENT").otherwise("UNKNOWN")
    return joined.select(*rows.columns, valid.alias("absence_valid"), state.alias("presence_state"))

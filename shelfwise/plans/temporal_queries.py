"""Presence, lifecycle, change events, field merge and presence history."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.prices import merge_observed
from shelfwise.operators.temporal import change_events, lifecycle_events, merge_fields, observations, presence_history, reconcile, replay, state_of, step, valid_absences
from shelfwise.operators.upserts import counts_of
from shelfwise.operators.windows import first
from shelfwise.plans.registry import query
from shelfwise.sources.relations import GRID, PRESENCE, dated, grid, presence, table

TODAY, YESTERDAY = "2024-01-20", "2024-01-19"

REPLAY = f"""{GRID},
s1 AS (SELECT *, sum(present::INT) OVER (PARTITION BY sku ORDER BY day) AS seen, lag(present) OVER (PARTITION BY sku ORDER BY day) AS before FROM grid),
s2 AS (SELECT *, sum((NOT present)::INT) OVER (PARTITION BY sku, seen ORDER BY day) AS gone FROM s1),
replay AS (
  SELECT sku, day, present,
    CASE WHEN seen = 0 THEN 'ABSENT' WHEN present AND seen = 1 THEN 'NEW' WHEN present AND NOT before THEN 'REAPPEARED' WHEN present THEN 'ACTIVE'
         WHEN gone = 3 THEN 'OFFLINE' WHEN gone > 3 THEN 'ABSENT' WHEN gone = 1 THEN 'MISSING_FIRST' ELSE 'MISSING_CONTINUED' END AS classification,
    CASE WHEN seen = 0 THEN 'UNKNOWN' WHEN present THEN 'ACTIVE' WHEN gone >= 3 THEN 'OFFLINE' ELSE 'MISSING' END AS status,
    (CASE WHEN seen = 0 OR present THEN 0 ELSE least(gone, 3) END)::INT AS missing_count
  FROM s2)"""


def replayed(spark, sf_dir):
    return replay(grid(spark, sf_dir))


@query(f"WITH {REPLAY} SELECT * REPLACE (day::VARCHAR AS day) FROM replay")
def lifecycle_replay(spark, sf_dir):
    return dated(replayed(spark, sf_dir))


@query(f"""WITH {REPLAY} SELECT sku, (min(day) FILTER (present))::VARCHAR AS first_seen, (max(day) FILTER (present))::VARCHAR AS last_seen, arg_max(status, day) AS status, arg_max(missing_count, day) AS missing_count,
  (max(day) FILTER (classification = 'OFFLINE'))::VARCHAR AS last_offline, bool_or(classification = 'OFFLINE') AS ever_offline FROM replay GROUP BY sku""")
def lifecycle_state(spark, sf_dir):
    return dated(state_of(replayed(spark, sf_dir)))


@query(f"""WITH {REPLAY} SELECT sku, day::VARCHAR AS day, CASE classification WHEN 'NEW' THEN 'FIRST_SEEN' WHEN 'OFFLINE' THEN 'OFFLINE_CONFIRMED' ELSE classification END AS event_type
FROM replay WHERE classification IN ('NEW', 'REAPPEARED', 'OFFLINE', 'MISSING_FIRST', 'MISSING_CONTINUED')""")
def lifecycle_event_log(spark, sf_dir):
    return dated(lifecycle_events(replayed(spark, sf_dir)))


@query(f"""WITH {REPLAY} SELECT day::VARCHAR AS day, classification, count(*) AS n FROM replay GROUP BY day, classification""")
def run_counters(spark, sf_dir):
    return dated(replayed(spark, sf_dir)).groupBy("day", "classification").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {REPLAY}, bad AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE event_type = 'error' AND value > 99)
SELECT r.sku, r.day::VARCHAR AS day, CASE WHEN present THEN 'PRESENT' WHEN b.day IS NULL THEN 'ABSENT' ELSE 'UNKNOWN' END AS presence_state, classification FROM replay r LEFT JOIN bad b ON r.day = b.day""")
def observation_rows(spark, sf_dir):
    """Absences of a day with a severe failure are unknown."""
    bad = table(spark, sf_dir, "events").where("event_type = 'error' AND value > 99").select(F.to_date("ts").alias("day")).distinct().withColumn("_bad", F.lit(True))
    joined = replayed(spark, sf_dir).join(bad, "day", "left")
    return dated(observations(joined, F.col("_bad").isNull())).select("sku", "day", "presence_state", "classification")


@query(f"""WITH {PRESENCE}, t AS (SELECT * FROM presence WHERE day = DATE '{TODAY}'), y AS (SELECT DISTINCT sku FROM presence WHERE day = DATE '{YESTERDAY}' AND (sitemap OR listing OR nuevo OR promo)),
k AS (SELECT DISTINCT user_id::VARCHAR AS sku FROM events), u AS (SELECT sku FROM t UNION SELECT sku FROM y UNION SELECT sku FROM k)
SELECT u.sku, coalesce(sitemap, false) AS sitemap, coalesce(listing, false) AS listing, coalesce(nuevo, false) AS nuevo, coalesce(promo, false) AS promo, y.sku IS NOT NULL AS present_yesterday,
  CASE WHEN sitemap AND listing THEN 'BOTH' WHEN sitemap THEN 'SITEMAP_ONLY' WHEN listing THEN 'LISTING_ONLY' WHEN nuevo OR promo THEN 'AUXILIARY_ONLY' ELSE 'NONE' END AS source_flag,
  coalesce(sitemap OR listing OR nuevo OR promo, false) AS present_today
FROM u LEFT JOIN t USING (sku) LEFT JOIN y USING (sku)""")
def presence_reconciliation(spark, sf_dir):
    seen = presence(spark, sf_dir)
    today = seen.where(F.col("day") == F.lit(TODAY).cast("date"))
    yesterday = seen.where((F.col("day") == F.lit(YESTERDAY).cast("date")) & (F.col("sitemap") | F.col("listing") | F.col("nuevo") | F.col("promo")))
    known = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku")).distinct()
    return reconcile(today, yesterday, known)


@query("""SELECT DISTINCT present, status AS before, ever_seen, missing,
  CASE WHEN present AND NOT ever_seen THEN 'NEW' WHEN present AND status IN ('MISSING', 'OFFLINE') THEN 'REAPPEARED' WHEN present THEN 'ACTIVE'
       WHEN ever_seen AND status <> 'OFFLINE' AND missing + 1 >= 3 THEN 'OFFLINE' WHEN ever_seen AND status <> 'OFFLINE' AND missing = 0 THEN 'MISSING_FIRST'
       WHEN ever_seen AND status <> 'OFFLINE' THEN 'MISSING_CONTINUED' ELSE 'ABSENT' END AS classification,
  CASE WHEN present THEN 0 WHEN ever_seen AND status <> 'OFFLINE' THEN missing + 1 ELSE missing END AS missing_count
FROM (SELECT event_id % 2 = 0 AS present, CASE event_id % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'MISSING' ELSE 'OFFLINE' END AS status, event_id % 5 <> 0 AS ever_seen, (event_id % 4)::INT AS missing FROM events)""")
def decision_table(spark, sf_dir):
    """One step of the state machine over all combinations of its inputs."""
    kinds = F.when(F.col("event_id") % 3 == 0, "ACTIVE").when(F.col("event_id") % 3 == 1, "MISSING").otherwise("OFFLINE")
    cases = table(spark, sf_dir, "events").select((F.col("event_id") % 2 == 0).alias("present"), kinds.alias("before"), (F.col("event_id") % 5 != 0).alias("ever_seen"), (F.col("event_id") % 4).cast("int").alias("missing")).distinct()
    after = step(F.col("present"), F.col("before"), F.col("ever_seen"), F.col("missing"))
    return cases.select("present", "before", "ever_seen", "missing", after["classification"].alias("classification"), after["missing_count"].alias("missing_count"))


@query(f"""WITH {PRESENCE}, a AS (SELECT * FROM presence WHERE day = DATE '{YESTERDAY}'), b AS (SELECT * FROM presence WHERE day = DATE '{TODAY}'),
p AS (SELECT sku, a.promo AS op, b.promo AS np, a.nuevo AS oo, b.nuevo AS no, a.failed::VARCHAR AS of, b.failed::VARCHAR AS nf FROM a JOIN b USING (sku))
SELECT sku, 'PROMO_START' AS event_type, 'false' AS old_value, 'true' AS new_value FROM p WHERE np AND NOT op
UNION ALL SELECT sku, 'PROMO_END', 'true', 'false' FROM p WHERE op AND NOT np
UNION ALL SELECT sku, 'NEW_BADGE_ON', 'false', 'true' FROM p WHERE no AND NOT oo
UNION ALL SELECT sku, 'NEW_BADGE_OFF', 'true', 'false' FROM p WHERE oo AND NOT no
UNION ALL SELECT sku, 'CHANGED_FAILED', of, nf FROM p WHERE of IS DISTINCT FROM nf""")
def badge_and_content_events(spark, sf_dir):
    seen = presence(spark, sf_dir)
    names = ["promo", "nuevo", "failed"]
    old = seen.where(F.col("day") == F.lit(YESTERDAY).cast("date")).select("sku", *[F.col(c).alias(f"old_{c}") for c in names])
    new = seen.where(F.col("day") == F.lit(TODAY).cast("date")).select("sku", *[F.col(c).alias(f"new_{c}") for c in names])
    return change_events(old.join(new, "sku"), [("promo", "PROMO_START", "PROMO_END"), ("nuevo", "NEW_BADGE_ON", "NEW_BADGE_OFF")], ["failed"])


@query("""WITH a AS (SELECT o_custkey::VARCHAR AS sku, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS label, max(o_totalprice) AS price FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1),
b AS (SELECT o_custkey::VARCHAR AS sku, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS label, max(CASE WHEN o_totalprice > 200000 THEN o_totalprice END) AS price FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1)
SELECT coalesce(a.sku, b.sku) AS sku, coalesce(b.label, a.label) AS label, CASE WHEN b.label IS NOT NULL THEN 'CURRENT_VERIFIED' WHEN a.label IS NOT NULL THEN 'HISTORY_RETAINED' ELSE 'SOURCE_MISSING' END AS label_state,
  coalesce(b.price, a.price) AS price, CASE WHEN b.price IS NOT NULL THEN 'CURRENT_VERIFIED' WHEN a.price IS NOT NULL THEN 'HISTORY_RETAINED' ELSE 'SOURCE_MISSING' END AS price_state
FROM a FULL JOIN b ON a.sku = b.sku""")
def merged_fields(spark, sf_dir):
    """Field-level merge with provenance of an older and a newer observation."""
    orders = table(spark, sf_dir, "orders").withColumn("sku", F.col("o_custkey").cast("string"))
    last = F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("label")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    old = orders.where(F.col("o_orderdate") < cut).groupBy("sku").agg(last, F.max("o_totalprice").alias("price"))
    new = orders.where(F.col("o_orderdate") >= cut).groupBy("sku").agg(last, F.max(F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice"))).alias("price"))
    return merge_fields(old, new, ["label", "price"])


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 100000 THEN o_totalprice END ELSE coalesce(CASE WHEN o_totalprice > 100000 THEN o_totalprice END, o_custkey::DOUBLE) END AS price FROM orders")
def partial_and_complete_prices(spark, sf_dir):
    """A complete observation may clear a price, a partial one only sets it."""
    seen = F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", merge_observed(F.col("o_orderstatus") == "F", seen, F.col("o_custkey").cast("double")).alias("price"))


@query(f"""WITH {PRESENCE}, days AS (SELECT day, count(*) FILTER (failed) < 12 AS complete FROM presence GROUP BY day), facts AS (SELECT DISTINCT sku, day FROM presence WHERE sitemap OR listing)
SELECT m.sku, d.day::VARCHAR AS day, CASE WHEN f.sku IS NOT NULL THEN 1 WHEN complete THEN 0 END AS presence
FROM (SELECT DISTINCT sku FROM facts) m CROSS JOIN days d LEFT JOIN facts f ON f.sku = m.sku AND f.day = d.day""")
def presence_long(spark, sf_dir):
    """Tri-state history: an absence counts on days with few failures."""
    seen = presence(spark, sf_dir)
    days = seen.groupBy("day").agg((F.count_if("failed") < 12).alias("complete"))
    facts = seen.where("sitemap OR listing").select("sku", "day")
    return dated(presence_history(facts, days, facts))


@query(f"""WITH {PRESENCE} SELECT sku, min(day)::VARCHAR AS first_seen, max(day)::VARCHAR AS last_seen, count(DISTINCT day) AS days_seen FROM presence WHERE sitemap OR listing OR nuevo OR promo GROUP BY sku""")
def first_and_last_seen(spark, sf_dir):
    seen = presence(spark, sf_dir).where("sitemap OR listing OR nuevo OR promo")
    return dated(seen).groupBy("sku").agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.countDistinct("day").alias("days_seen"))


@query("""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'view') WHERE n = 1""")
def first_card_wins(spark, sf_dir):
    return first(table(spark, sf_dir, "events").where("event_type = 'view'"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query(f"""WITH {REPLAY} SELECT count(*) FILTER (classification = 'NEW') AS new, count(*) FILTER (classification = 'REAPPEARED') AS reappeared, count(*) FILTER (classification = 'OFFLINE') AS offline,
  count(*) FILTER (status = 'MISSING') AS missing, count(*) FILTER (present) AS present FROM replay WHERE day = DATE '{TODAY}'""")
def day_summary(spark, sf_dir):
    day = replayed(spark, sf_dir).where(F.col("day") == F.lit(TODAY).cast("date"))
    kind = F.col("classification")
    return counts_of(day, {"new": kind == "NEW", "reappeared": kind == "REAPPEARED", "offline": kind == "OFFLINE", "missing": F.col("status") == "MISSING", "present": F.col("present")})


@query("""WITH r AS (SELECT p_partkey::VARCHAR AS sku, p_size % 2 = 0 AS present FROM part), b AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE ' ' || upper(p_type) END AS category FROM part WHERE p_partkey % 3 = 0),
k AS (SELECT p_partkey::VARCHAR AS sku, p_brand AS category FROM part WHERE p_partkey % 5 <> 0), c AS (SELECT lower(p_type) AS category, bool_or(p_size = 50) AS complete FROM part GROUP BY p_type UNION ALL SELECT p_brand || ' ', bool_and(p_partkey % 11 <> 0) FROM part GROUP BY p_brand UNION ALL SELECT '', true),
o AS (SELECT r.*, lower(trim(CASE WHEN b.sku IS NOT NULL THEN b.category ELSE coalesce(k.category, '') END)) AS category FROM r LEFT JOIN b USING (sku) LEFT JOIN k USING (sku)),
v AS (SELECT sku, present, category <> '' AND EXISTS (SELECT 1 FROM c WHERE lower(trim(c.category)) = o.category AND c.complete) AS absence_valid FROM o)
SELECT sku, present, absence_valid, CASE WHEN present THEN 'PRESENT' WHEN absence_valid THEN 'ABSENT' ELSE 'UNKNOWN' END AS presence_state FROM v""")
def absence_states(spark, sf_dir):
    """Absences by the coverage of each SKU's own category, after yesterday's record or any older one."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    sku = key.cast("string").alias("sku")
    before = part.where(key % 3 == 0).select(sku, F.when(key % 7 == 0, " ").otherwise(F.concat(F.lit(" "), F.upper("p_type"))).alias("category"))
    known = part.where(key % 5 != 0).select(sku, F.col("p_brand").alias("category"))
    by_type = part.groupBy(F.lower("p_type").alias("category")).agg(F.bool_or(F.col("p_size") == 50).alias("complete"))
    by_brand = part.groupBy(F.concat("p_brand", F.lit(" ")).alias("category")).agg(F.bool_and(key % 11 != 0).alias("complete"))
    coverage = by_type.union(by_brand).union(spark.range(1).select(F.lit("").alias("category"), F.lit(True).alias("complete")))
    return valid_absences(part.select(sku, (F.col("p_size") % 2 == 0).alias("present")), coverage, before, known, False)

"""The daily update over the star-schema tables: plans, listing facts, trusted fields, current rows, heads and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import updates as u
from shelfwise.plans.registry import query
from shelfwise.sources.relations import HISTORY, price_history, table, part_key, part_price, part_size, part_sku


@query("""WITH p AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS sku, p_size AS s, p_retailprice AS price FROM part),
r AS (SELECT *, CASE WHEN s = 1 THEN 'NEW' WHEN s = 2 THEN 'REAPPEARED' WHEN k % 31 = 0 THEN 'DETAIL_PENDING' WHEN k % 23 = 0 THEN 'MISSING_FIELD' WHEN k % 19 = 0 THEN 'DETAIL_REFRESH' WHEN k % 17 = 0 THEN 'IMAGE_CHANGE' WHEN k % 13 = 0 THEN 'CONTENT_CHANGE'
  WHEN price > 1500 THEN 'PRICE_CHANGE_CANDIDATE' WHEN s = 9 THEN 'PRICE_METADATA_CHANGE' WHEN s = 8 THEN 'BADGE_CHANGE' END AS reason FROM p),
n AS (SELECT *, coalesce(reason IN ('NEW', 'REAPPEARED', 'DETAIL_PENDING', 'MISSING_FIELD', 'DETAIL_REFRESH', 'IMAGE_CHANGE', 'CONTENT_CHANGE'), false) OR (s NOT IN (1, 2) AND (k % 17 = 0 OR k % 13 = 0)) AS need FROM r),
a AS (SELECT *, CASE WHEN s IN (1, 2) OR need THEN NULL WHEN k % 11 = 0 THEN 1 WHEN k % 7 = 0 THEN 2 END AS ask FROM n),
c AS (SELECT sku, ask FROM a WHERE ask IS NOT NULL ORDER BY ask, sku LIMIT 150)
SELECT a.sku, CASE c.ask WHEN 1 THEN 'LISTING_BASELINE_UNKNOWN' WHEN 2 THEN 'DETAIL_FRESHNESS_UNKNOWN' ELSE reason END AS reason, need OR c.ask IS NOT NULL AS need_detail
FROM a LEFT JOIN c USING (sku) WHERE reason IS NOT NULL OR c.ask IS NOT NULL""")
def full_update_plan(spark, sf_dir):
    """All twelve reasons, and a budget that two kinds of probes share."""
    rows = table(spark, sf_dir, "part").select(part_sku(), part_key(), part_size(), part_price())
    when = {
        "NEW": part_size() == 1, "REAPPEARED": part_size() == 2, "DETAIL_PENDING": part_key() % 31 == 0, "MISSING_FIELD": part_key() % 23 == 0, "DETAIL_REFRESH": part_key() % 19 == 0, "IMAGE_CHANGE": part_key() % 17 == 0, "CONTENT_CHANGE": part_key() % 13 == 0,
        "PRICE_CHANGE_CANDIDATE": part_price() > 1500, "PRICE_METADATA_CHANGE": part_size() == 9, "BADGE_CHANGE": part_size() == 8,
    }
    return u.update_plan(rows, when, part_key() % 11 == 0, part_key() % 7 == 0, 150).select("sku", "reason", "need_detail")


@query("""SELECT p_partkey::VARCHAR AS sku, concat_ws(',', CASE WHEN p_size % 3 = 1 THEN 'name' END, CASE WHEN p_size % 5 = 0 THEN 'cats' END) AS changed FROM part""")
def listing_differences(spark, sf_dir):
    """Only fields a card shows are compared, categories as sets."""
    cats = F.when(part_size() % 5 == 0, "a,c").otherwise("b,a,b")
    rows = table(spark, sf_dir, "part").select(part_sku(), F.when(part_size() % 3 == 0, None).when(part_size() % 3 == 1, F.concat("p_name", F.lit("x"))).otherwise(F.concat(F.lit(" "), "p_name")).alias("name"), F.col("p_name").alias("before_name"), cats.alias("cats"), F.lit("a,b").alias("before_cats"))
    return rows.select("sku", F.array_join(u.listing_difference(rows, ["name", "cats"], ("cats",)), ",").alias("changed"))


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size % 4 = 0 THEN NULLIF(p_type, 'x') ELSE p_brand END AS name, CASE WHEN p_size % 7 = 0 THEN 'DETAIL_CURRENT_RUN' WHEN p_size % 4 = 0 THEN 'LISTING_CURRENT_RUN' END AS name_source,
  CASE WHEN p_size % 5 = 0 THEN 'new' ELSE 'old' END AS unit, CASE WHEN p_size % 5 = 0 THEN 'LISTING_CURRENT_RUN' END AS unit_source FROM part WHERE p_size % 28 <> 0""")
def listing_facts(spark, sf_dir):
    """Cards fill empty fields; a unit price from a card always counts; details of this run stay."""
    rows = table(spark, sf_dir, "part").where("p_size % 28 <> 0")
    name = u.listing_merge("name", F.when(part_size() % 4 != 0, F.col("p_brand")), F.when(part_size() % 4 == 0, F.col("p_type")).otherwise(F.lit("other")), part_size() % 7 == 0)
    unit = u.listing_merge("unit", F.lit("old"), F.when(part_size() % 5 == 0, "new"), F.lit(False), True)
    return rows.select(part_sku(), *[v.alias(k) for k, v in {**name, **unit}.items()])


@query("""WITH b AS (SELECT p_partkey::VARCHAR AS sku, p_name AS name, p_retailprice AS price, CASE WHEN p_size % 3 <> 0 THEN '2020-01-01' ELSE '' END AS first_seen FROM part WHERE p_partkey % 2 = 0),
up AS (SELECT p_partkey::VARCHAR AS sku, 'new ' || p_name AS name, NULL::DOUBLE AS price, NULL AS first_seen FROM part WHERE p_partkey % 5 = 0),
t AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size % 2 = 0 THEN '2021-02-02' END AS first_seen FROM part WHERE p_partkey % 3 <> 0)
SELECT t.sku, CASE WHEN up.sku IS NOT NULL THEN up.name ELSE b.name END AS name, CASE WHEN up.sku IS NOT NULL THEN up.price ELSE b.price END AS price,
  coalesce(nullif(CASE WHEN up.sku IS NOT NULL THEN up.first_seen ELSE b.first_seen END, ''), t.first_seen, '2024-01-31') AS first_seen, 'CURRENT' AS status, '2024-01-31' AS last_seen, 0 AS missing_count
FROM t LEFT JOIN b USING (sku) LEFT JOIN up USING (sku)""")
def current_rows(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    baseline = part.where(part_key() % 2 == 0).select(part_sku(), F.col("p_name").alias("name"), part_price().alias("price"), F.when(part_size() % 3 != 0, "2020-01-01").otherwise("").alias("first_seen"))
    updated = part.where(part_key() % 5 == 0).select(part_sku(), F.concat(F.lit("new "), "p_name").alias("name"), F.lit(None).cast("double").alias("price"), F.lit(None).cast("string").alias("first_seen"))
    today = part.where(part_key() % 3 != 0).select(part_sku(), F.when(part_size() % 2 == 0, "2021-02-02").alias("first_seen"))
    return u.current_rows(baseline, updated, today, ["name", "price"], "2024-01-31")


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 7 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END ELSE p_retailprice + 1 END AS current_price,
  CASE WHEN p_partkey % 7 <> 0 THEN 'CURRENT_RUN' WHEN p_partkey % 2 = 0 THEN 'HISTORY_RETAINED' ELSE 'SOURCE_MISSING' END AS current_price_state,
  CASE WHEN p_partkey % 7 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 5.0 END ELSE 6.0 END::DOUBLE AS original_price, CASE WHEN p_partkey % 7 <> 0 THEN 'CURRENT_RUN' WHEN p_partkey % 2 = 0 THEN 'HISTORY_RETAINED' ELSE 'SOURCE_MISSING' END AS original_price_state,
  CASE WHEN p_partkey % 11 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN p_name END ELSE 'new ' || p_name END AS name, CASE WHEN p_partkey % 11 <> 0 THEN 'CURRENT_RUN' WHEN p_partkey % 2 = 0 THEN 'HISTORY_RETAINED' ELSE 'SOURCE_MISSING' END AS name_state FROM part""")
def trusted_fields(spark, sf_dir):
    """A price under review takes the original price back with it."""
    part = table(spark, sf_dir, "part")
    today = part.select(part_sku(), (part_price() + 1).alias("current_price"), F.lit(6.0).alias("original_price"), F.concat(F.lit("new "), "p_name").alias("name"))
    baseline = part.where(part_key() % 2 == 0).select(part_sku(), part_price().alias("current_price"), F.lit(5.0).alias("original_price"), F.col("p_name").alias("name"))
    issues = part.where(part_key() % 7 == 0).select(part_sku(), F.lit("current_price").alias("field_name")).unionAll(part.where(part_key() % 11 == 0).select(part_sku(), F.lit("name").alias("field_name")))
    return u.trusted_fields(today, baseline, issues.unionAll(issues), ["current_price", "original_price", "name"], ("original_price",))


@query(f"""WITH {HISTORY}, o AS (SELECT *, strftime(observed_at, '%Y-%m-%d') AS day FROM history),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM o WHERE change_type IN ('UP', 'DOWN')) WHERE rn = 1),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM o WHERE day = '2000-06-15') WHERE rn = 1),
m AS (SELECT sku, least(min(old_price) FILTER (old_price > 0 AND old_price <= 2500), min(new_price) FILTER (new_price > 0 AND new_price <= 2500)) AS price_min, greatest(max(old_price) FILTER (old_price > 0 AND old_price <= 2500), max(new_price) FILTER (new_price > 0 AND new_price <= 2500)) AS price_max FROM o GROUP BY sku)
SELECT m.sku, l.old_price AS last_price, l.change_type AS price_direction, round(l.new_price - l.old_price, 4) AS change_amount, l.day AS last_change_date, coalesce(d.change_type, 'UNCHANGED') AS price_change, price_min, price_max
FROM m LEFT JOIN l USING (sku) LEFT JOIN d USING (sku)""")
def price_projection(spark, sf_dir):
    """The last real change, a day's change, and extrema that ignore anomalies."""
    return u.price_projection(price_history(spark, sf_dir), "2000-06-15", 2500.0)


@query("""SELECT user_id, strftime(ts::DATE, '%Y-%m-%d') AS day, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id, ts::DATE""")
def last_of_day(spark, sf_dir):
    return u.last_of_day(table(spark, sf_dir, "events"), ["user_id"], "ts", ["ts", "event_id"], "value").withColumn("day", F.col("day").cast("string"))


@query("""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
SELECT user_id, median(value) FILTER (n <= 7) AS median_7, median(value) FILTER (n <= 30) AS median_30 FROM r WHERE n <= 30 GROUP BY user_id""")
def record_baselines(spark, sf_dir):
    return u.record_baseline(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], "value")


@query("""SELECT 'c' || o_orderkey AS commit_id, 'r' || o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS committed_at FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' AND o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') ORDER BY o_orderdate DESC, commit_id DESC LIMIT 1""")
def presence_head(spark, sf_dir):
    """The newest commit that may speak for presence, as an aggregate."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    commits = orders.select(F.concat(F.lit("c"), k).alias("commit_id"), F.concat(F.lit("r"), k).alias("run_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("committed_at"), F.when(F.col("o_orderstatus") == "F", "COMMITTED").otherwise("OPEN").alias("status"), F.when(F.col("o_orderpriority") != "5-LOW", "FULL_OBSERVATION").otherwise("FACTS").alias("commit_scope"))
    runs = orders.select(F.concat(F.lit("r"), k).alias("run_id"), F.when(k % 2 == 0, "PASS").otherwise("FAIL").alias("qa_state"), (k % 5 == 0).alias("dry_run"))
    seen = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("r"), F.col("l_orderkey")).alias("run_id"), (F.col("l_returnflag") == "A").alias("observation_complete"))
    return u.presence_head(commits, runs, seen)


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 <> 0 AND event_type <> 'error' THEN 'FULL' WHEN event_id % 2 = 0 THEN 'SITEMAP_FALLBACK' ELSE 'INCOMPLETE' END AS mode FROM events""")
def presence_modes(spark, sf_dir):
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", u.presence_mode(k % 2 == 0, k % 3 != 0, F.when(F.col("event_type") == "error", "RESTRICTED").otherwise("NORMAL")).alias("mode"))


@query("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id::VARCHAR END AS sku, CASE WHEN event_id % 10 = 0 THEN 'NO_SKU' WHEN user_id IN (SELECT p_partkey FROM part WHERE p_size > 20) THEN 'SKU_EXACT' ELSE 'SKU_UNKNOWN' END AS match FROM events""")
def sku_matches(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("user_id").cast("string")).alias("sku"))
    return u.sku_match(rows, table(spark, sf_dir, "part").where("p_size > 20").select(part_sku()))


@query("""WITH c AS (SELECT ts::DATE AS day, count(*) FILTER (event_id % 2 = 0) AS a, count(*) AS b, count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'click') AS l, count(*) FILTER (event_type = 'signup') AS s, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY 1),
r AS (SELECT strftime(day, '%Y-%m-%d') AS run_id, day(day) % 5 = 0 AS blocked, day(day) % 4 = 0 AS fallback, CASE WHEN day(day) % 3 = 0 THEN 'X' ELSE 'NORMAL' END AS access, day(day) % 7 <> 0 AS valid, 2 * a AS y, b AS t, v AS sm, l AS li, s, e FROM c)
SELECT run_id, 'fetch_not_blocked' AS "check", blocked::INT::DOUBLE AS value, NOT blocked OR fallback AS passed, 'HARD_BLOCK' AS level FROM r
UNION ALL SELECT run_id, 'access_state_complete', (access <> 'NORMAL')::INT::DOUBLE, access = 'NORMAL' OR fallback, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'observation_valid', valid::INT::DOUBLE, valid, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'total_drop', round(coalesce(100.0::DOUBLE * greatest(y - t, 0) / nullif(y, 0), 0), 6), coalesce(100.0::DOUBLE * greatest(y - t, 0) / nullif(y, 0), 0) <= 5, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'total_rise', round(coalesce(100.0::DOUBLE * greatest(t - y, 0) / nullif(y, 0), 0), 6), coalesce(100.0::DOUBLE * greatest(t - y, 0) / nullif(y, 0), 0) <= 5, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'sitemap_listing_gap', round(CASE WHEN fallback THEN 0 ELSE coalesce(100.0::DOUBLE * abs(sm - li) / nullif(greatest(sm, li), 0), 0) END, 6), CASE WHEN fallback THEN 0 ELSE coalesce(100.0::DOUBLE * abs(sm - li) / nullif(greatest(sm, li), 0), 0) END <= 10, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'new_sku', round(100.0::DOUBLE * s / greatest(t, 1), 6), 100.0::DOUBLE * s / greatest(t, 1) <= 20, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'missing', round(100.0::DOUBLE * e / greatest(y, 1), 6), 100.0::DOUBLE * e / greatest(y, 1) <= 20, 'HARD_BLOCK' FROM r
UNION ALL SELECT run_id, 'anomaly_count', e::DOUBLE, e <= 60, 'WARNING' FROM r""")
def run_gate(spark, sf_dir):
    """The run-level rules of every day."""
    n = lambda c: F.count(F.when(c, 1))
    kind, day = F.col("event_type"), F.dayofmonth("day")
    counts = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(n(F.col("event_id") % 2 == 0).alias("half"), F.count(F.lit(1)).alias("today_total"), n(kind == "view").alias("sitemap_count"), n(kind == "click").alias("listing_count"), n(kind == "signup").alias("new_count"), n(kind == "error").alias("missing_count"))
    counts = counts.select(
        F.col("day").cast("string").alias("run_id"), (day % 5 == 0).alias("blocked"), F.when(day % 4 == 0, "SITEMAP_FALLBACK").otherwise("FULL").alias("presence_mode"), F.when(day % 3 == 0, "X").otherwise("NORMAL").alias("access_state"),
        (day % 7 != 0).alias("observation_valid"), (2 * F.col("half")).alias("yesterday_total"), "today_total", "sitemap_count", "listing_count", "new_count", "missing_count", F.col("missing_count").alias("anomaly_count"),
    )
    return u.run_gate(counts, {"total_drop": 5, "total_rise": 5, "sitemap_listing_gap": 10, "new_sku": 20, "missing": 20, "anomaly_count": 60})


@query("""WITH p AS (SELECT CASE WHEN p_partkey % 97 = 0 THEN 'x' || p_partkey WHEN p_partkey % 50 = 0 THEN '7' ELSE p_partkey::VARCHAR END AS sku, CASE WHEN p_partkey % 89 = 0 THEN ' ' ELSE 'ACT' || (p_partkey // 2 * 2 + CASE WHEN p_size = 5 THEN 0 ELSE p_partkey % 2 END) END AS cid,
  CASE WHEN p_partkey % 83 <> 0 THEN '/p/' END AS url, CASE WHEN p_partkey % 79 <> 0 THEN p_retailprice END AS price, CASE WHEN p_partkey % 73 = 0 THEN 'HISTORY_RETAINED' ELSE 'CURRENT_VERIFIED' END AS state, CASE WHEN p_partkey % 71 <> 0 THEN p_type END AS cat1, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS cat2 FROM part),
d AS (SELECT *, count(*) OVER (PARTITION BY sku) AS ns, count(*) OVER (PARTITION BY cid) AS nc FROM p)
SELECT 'HARD_BLOCK' AS level, sku, 'sku' AS field_name, 'PRODUCT_SKU_INVALID' AS reason FROM d WHERE NOT regexp_full_match(sku, '[0-9]+')
UNION ALL SELECT 'HARD_BLOCK', sku, 'canonical_id', 'CANONICAL_ID_MISSING' FROM d WHERE trim(cid) = '' UNION ALL SELECT 'HARD_BLOCK', sku, 'sku', 'DUPLICATE_SKU' FROM d WHERE ns > 1 UNION ALL SELECT 'HARD_BLOCK', sku, 'canonical_id', 'DUPLICATE_CANONICAL_ID' FROM d WHERE nc > 1
UNION ALL SELECT 'HARD_BLOCK', sku, 'product_url', 'PRODUCT_URL_MISSING' FROM d WHERE url IS NULL UNION ALL SELECT 'FIELD_REVIEW', sku, 'current_price', 'PRICE_SOURCE_MISSING' FROM d WHERE price IS NULL
UNION ALL SELECT 'FIELD_REVIEW', sku, 'current_price', 'PRICE_NOT_OBSERVED_THIS_RUN' FROM d WHERE price IS NOT NULL AND state = 'HISTORY_RETAINED' UNION ALL SELECT 'FIELD_REVIEW', sku, 'cat1', 'CATEGORY_SOURCE_MISSING' FROM d WHERE cat1 IS NULL AND cat2 IS NULL
UNION ALL SELECT 'FIELD_REVIEW', sku, 'current_price', 'PRICE_OUT_OF_RANGE' FROM d WHERE price < 902 OR price > 1800""")
def field_issues(spark, sf_dir):
    """Identity and field findings of products."""
    rows = table(spark, sf_dir, "part").select(
        F.when(part_key() % 97 == 0, F.concat(F.lit("x"), part_key())).when(part_key() % 50 == 0, "7").otherwise(part_key().cast("string")).alias("sku"), F.when(part_key() % 89 == 0, " ").otherwise(F.concat(F.lit("ACT"), (F.floor(part_key() / 2) * 2 + F.when(part_size() == 5, 0).otherwise(part_key() % 2)).cast("long"))).alias("canonical_id"),
        F.when(part_key() % 83 != 0, "/p/").alias("product_url"), F.when(part_key() % 79 != 0, part_price()).alias("current_price"), F.when(part_key() % 73 == 0, "HISTORY_RETAINED").otherwise("CURRENT_VERIFIED").alias("price_state"), F.when(part_key() % 71 != 0, F.col("p_type")).alias("cat1"), F.when(part_key() % 2 == 0, F.col("p_brand")).alias("cat2"),
    )
    return u.field_issues(rows, 902.0, 1800.0)


@query("""SELECT event_id, concat_ws(',', CASE WHEN event_id % 2 = 0 THEN 'ACTOR_MISSING' END, CASE WHEN event_type = 'error' THEN 'REASON_MISSING' END, CASE WHEN user_id <> 1 THEN 'RUN_MISMATCH' END, CASE WHEN event_id % 3 <> 0 THEN 'METRICS_MISMATCH' END, CASE WHEN event_id % 5 <> 0 THEN 'NOT_ONE_SHOT' END, CASE WHEN event_id % 7 = 0 OR ts <= TIMESTAMP '2024-01-15' THEN 'EXPIRED' END) AS reasons FROM events""")
def override_reasons(spark, sf_dir):
    k = F.col("event_id")
    o = {"actor": F.when(k % 2 == 0, " ").otherwise("a"), "reason": F.when(F.col("event_type") != "error", "r"), "run_id": F.col("user_id"), "metrics_hash": k % 3, "one_shot": F.when(k % 5 == 0, True), "expires_at": F.when(k % 7 != 0, F.col("ts"))}
    return table(spark, sf_dir, "events").select("event_id", F.array_join(u.override_reasons(o, F.lit(1), F.lit(0), F.lit("2024-01-15").cast("timestamp_ntz")), ",").alias("reasons"))


@query("""WITH c AS (SELECT p_partkey AS k, concat_ws(',', CASE WHEN p_partkey % 41 = 0 THEN 'SKU_MISMATCH' END, CASE WHEN p_partkey % 29 = 0 THEN 'SOURCE_HASH_MISMATCH' END, CASE WHEN p_partkey % 43 = 0 THEN 'TOO_LONG' END, CASE WHEN p_partkey % 43 <> 0 AND p_size = 7 THEN 'URL_CONTAMINATION' END,
  CASE WHEN p_partkey % 43 <> 0 AND p_size <> 7 AND p_size % 10 = 3 THEN 'NUMBER_DROPPED' END, CASE WHEN p_size = 50 THEN 'CONFIDENCE_OUT_OF_RANGE' END) AS reasons, p_size AS s FROM part),
f AS (SELECT *, concat_ws(',', nullif(reasons, ''), CASE WHEN k % 31 = 0 THEN 'SOURCE_HASH_CHANGED' END, CASE WHEN k % 37 = 0 THEN 'HUMAN_OVERRIDE_CONFLICT' END, CASE WHEN s < 5 THEN 'CONFIDENCE_BELOW_THRESHOLD' END, CASE WHEN k % 3 = 0 THEN 'FIELD_NOT_LOW_RISK' END) AS failed FROM c)
SELECT k AS p_partkey, reasons, failed, CASE WHEN failed = '' THEN 'WOULD_AUTO_APPROVE' ELSE 'REVIEW_REQUIRED' END AS decision FROM f""")
def candidate_approvals(spark, sf_dir):
    """Reasons against a candidate text, and the decision of the approval policy in shadow mode."""
    confidence = F.when(part_size() == 50, 1.5).when(part_size() < 5, 0.5).otherwise(0.99)
    source = F.concat(F.lit("caja "), (part_size() + 100).cast("string"))
    value = F.when(part_key() % 43 == 0, F.repeat(F.lit("x"), 4001)).when(part_size() == 7, "see https://x.example").when(part_size() % 10 == 3, "box 1").otherwise(F.concat(F.lit("box "), (part_size() + 100).cast("string")))
    reasons = u.candidate_reasons(source, value, part_key() % 41 != 0, part_key() % 29 != 0, confidence)
    judged = u.approval(F.col("r"), part_key() % 3 != 0, confidence, part_key() % 31 != 0, part_key() % 37 == 0, F.lit(False), enabled=False)
    return table(spark, sf_dir, "part").withColumn("r", reasons).select("p_partkey", F.array_join("r", ",").alias("reasons"), F.array_join(judged["failed"], ",").alias("failed"), judged["decision"].alias("decision"))

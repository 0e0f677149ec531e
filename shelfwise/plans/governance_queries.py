"""Projections, planning, drift, queues, revisions and multiset parity."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.prices import business_date, parse_date
from shelfwise.operators.governance import approved_revision, drift, localization_status, mined_rules, multiset_parity, plan_updates, product_status, queue_requests, remarks, source_versions, supersede, valid_price
from shelfwise.plans.registry import query
from shelfwise.plans.temporal_queries import REPLAY, TODAY, replayed
from shelfwise.sources.relations import table


@query("""SELECT p_partkey, CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice END AS price,
  concat_ws(' | ', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice < 950 THEN 'from ' || p_brand END) AS remarks FROM part""")
def display_rows(spark, sf_dir):
    invalid = F.col("p_partkey") % 17 == 0
    notes = remarks([(F.col("p_size") > 40, "large"), (F.col("p_retailprice") < 950, F.concat(F.lit("from "), F.col("p_brand")))])
    return table(spark, sf_dir, "part").select("p_partkey", valid_price(F.col("p_retailprice"), invalid).alias("price"), notes.alias("remarks"))


@query(f"""WITH {REPLAY} SELECT sku, classification, CASE WHEN classification IN ('NEW', 'REAPPEARED', 'ACTIVE') THEN 'ACTIVE' WHEN classification LIKE 'MISSING%' THEN 'MISSING' WHEN classification = 'OFFLINE' THEN 'OFFLINE' ELSE 'UNKNOWN' END AS product_status
FROM replay WHERE day = DATE '{TODAY}'""")
def product_statuses(spark, sf_dir):
    day = replayed(spark, sf_dir).where(F.col("day") == F.lit(TODAY).cast("date"))
    return day.select("sku", "classification", product_status(F.col("classification")).alias("product_status"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'BLOCKED' WHEN o_orderkey % 7 = 0 THEN 'STALE' WHEN o_orderkey % 5 = 0 THEN 'REVIEW_PENDING' WHEN o_orderkey % 3 = 0 THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS status FROM orders""")
def localization_statuses(spark, sf_dir):
    k = F.col("o_orderkey")
    review = F.when(k % 11 == 0, "BLOCKED").when(k % 5 == 0, "REVIEW_PENDING").otherwise("APPROVED")
    fields = [F.col("o_orderpriority"), F.when(k % 3 != 0, F.col("o_orderstatus")).otherwise(" ")]
    return table(spark, sf_dir, "orders").select("o_orderkey", localization_status(fields, k % 7 == 0, review).alias("status"))


@query("""WITH p AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size = 1 THEN 'NEW_SKU' WHEN p_size = 2 THEN 'REAPPEARED' WHEN p_retailprice > 1040 THEN 'PRICE_CHANGED' WHEN p_size = 50 THEN 'DETAIL_MISSING' END AS reason FROM part),
r AS (SELECT *, row_number() OVER (ORDER BY CASE reason WHEN 'NEW_SKU' THEN 1 WHEN 'REAPPEARED' THEN 2 WHEN 'PRICE_CHANGED' THEN 3 ELSE 4 END, sku) AS n FROM p WHERE reason IS NOT NULL)
SELECT sku, reason, n <= 60 AS need_detail FROM r""")
def update_plan(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("sku"), "p_size", "p_retailprice")
    size = F.col("p_size")
    return plan_updates(rows, {"NEW_SKU": size == 1, "REAPPEARED": size == 2, "PRICE_CHANGED": F.col("p_retailprice") > 1040, "DETAIL_MISSING": size == 50}, 60).select("sku", "reason", "need_detail")


@query("""WITH a AS (SELECT user_id, count(*) AS before FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1), b AS (SELECT user_id, count(*) AS today FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type = 'view' GROUP BY 1)
SELECT user_id, before, today, CASE WHEN today IS NULL THEN 'VANISHED' ELSE 'COLLAPSE' END AS finding FROM a LEFT JOIN b USING (user_id) WHERE today IS NULL OR today < 0.5 * before""")
def metric_drift(spark, sf_dir):
    events, cut = table(spark, sf_dir, "events"), F.lit("2024-01-16").cast("timestamp_ntz")
    before = events.where(F.col("ts") < cut).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    today = events.where((F.col("ts") >= cut) & (F.col("event_type") == "view")).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return drift(today, before, "user_id", "n")


@query("""WITH q AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 9 = 0 THEN 'old' ELSE p_brand END AS old, p_brand AS new, CASE WHEN p_size > 25 THEN p_type ELSE '' END AS f1, CASE WHEN p_size > 10 THEN p_name END AS f2 FROM part)
SELECT sku, CASE WHEN old IS DISTINCT FROM new THEN 'f1,f2' ELSE concat_ws(',', CASE WHEN f1 = '' THEN 'f1' END, CASE WHEN f2 IS NULL THEN 'f2' END) END AS requested,
  CASE WHEN old IS NULL THEN 'P0' WHEN old IS DISTINCT FROM new THEN 'P1' WHEN f1 = '' AND f2 IS NULL THEN 'P2' ELSE 'P3' END AS priority
FROM q WHERE old IS DISTINCT FROM new OR f1 = '' OR f2 IS NULL""")
def translation_queue(spark, sf_dir):
    k, brand = F.col("p_partkey"), F.col("p_brand")
    rows = table(spark, sf_dir, "part").select(
        k.cast("string").alias("sku"), F.when(k % 10 == 0, None).when(k % 9 == 0, "old").otherwise(brand).alias("old"), brand.alias("new"),
        F.when(F.col("p_size") > 25, F.col("p_type")).otherwise("").alias("f1"), F.when(F.col("p_size") > 10, F.col("p_name")).alias("f2"),
    )
    return queue_requests(rows, ["f1", "f2"], "old", "new").withColumn("requested", F.array_join("requested", ","))


@query("""WITH c AS (SELECT o_custkey AS unit, o_orderkey AS revision_id, year(o_orderdate) AS revision FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 AND l_linestatus = 'F'))
SELECT unit, arg_max(revision_id, (revision, revision_id)) AS revision_id, max(revision) AS revision FROM c GROUP BY unit""")
def approved_revisions(spark, sf_dir):
    revisions = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit"), F.col("o_orderkey").alias("revision_id"), F.year("o_orderdate").cast("long").alias("revision"), (F.col("o_orderstatus") == "F").alias("approved"))
    findings = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("revision_id"), (F.col("l_linestatus") == "F").alias("open"), F.when(F.col("l_quantity") > 45, "HIGH").otherwise("INFO").alias("severity"))
    return approved_revision(revisions, findings)


@query("""WITH s AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
c AS (SELECT * FROM s WHERE before IS NULL OR before <> o_orderstatus)
SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS version, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to FROM c""")
def status_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return source_versions(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus")


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' AND n > 1 THEN 'SUPERSEDED' WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'SUCCESS' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)""")
def superseded_projections(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.when(F.col("o_orderstatus") == "P", "PENDING").otherwise("SUCCESS").alias("status"))
    return supersede(rows, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey", "status")


@query("""SELECT l_returnflag, l_linestatus, l_partkey, count(*) AS n, least(0.99, round(0.6 + 0.1 * least(count(*), 4), 2))::DOUBLE AS confidence FROM lineitem GROUP BY ALL HAVING count(*) >= 3""")
def feedback_rules(spark, sf_dir):
    return mined_rules(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_partkey"], 3)


@query("""WITH a AS (SELECT l_returnflag AS f, l_quantity AS q FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT l_returnflag AS f, l_quantity AS q FROM lineitem WHERE l_orderkey % 2 = 1),
c AS (SELECT coalesce(x.f, y.f) AS f, coalesce(x.q, y.q) AS q, coalesce(x.n, 0) - coalesce(y.n, 0) AS d FROM (SELECT f, q, count(*) AS n FROM a GROUP BY ALL) x FULL JOIN (SELECT f, q, count(*) AS n FROM b GROUP BY ALL) y ON x.f = y.f AND x.q = y.q)
SELECT f, q, CASE WHEN d > 0 THEN 'LEFT' ELSE 'RIGHT' END AS side FROM c, unnest(generate_series(1, abs(d))) WHERE d <> 0""")
def multiset_differences(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 2).alias("h"), F.col("l_returnflag").alias("f"), F.col("l_quantity").alias("q"))
    return multiset_parity(rows.where("h = 0").drop("h"), rows.where("h = 1").drop("h"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso, strftime(ts, '%Y-%m-%d') AS local_form, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS business_day FROM events""")
def parsed_dates(spark, sf_dir):
    """Dates written two ways are read back; winter days in Madrid are one hour ahead of UTC."""
    return table(spark, sf_dir, "events").select(
        "event_id", parse_date(F.date_format("ts", "yyyy-MM-dd")).cast("string").alias("iso"), parse_date(F.date_format("ts", "dd/MM/yyyy")).cast("string").alias("local_form"), business_date(F.col("ts").cast("timestamp")).cast("string").alias("business_day")
    )

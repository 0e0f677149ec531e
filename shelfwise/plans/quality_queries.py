"""Data quality: metrics, medians, gates, drift, audits, parity, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators.quality import COLLECTION_RULES, DRIFT_RULES, baselines, coverage, gate, gate_states, long_form, rule_findings, run_metrics
from shelfwise.operators.upserts import insert_ignore, keyed_difference, orphans, rule_union, unique_violations, upsert
from shelfwise.plans.registry import query
from shelfwise.sources.relations import dated, table

METRICS = """wide AS (
  SELECT ts::DATE AS day, count(*)::DOUBLE AS total, count(*) FILTER (event_type = 'view')::DOUBLE AS views, count(*) FILTER (event_type = 'error')::DOUBLE AS failures,
         count(DISTINCT user_id)::DOUBLE AS skus FROM events GROUP BY 1),
metrics AS (SELECT day, metric, value FROM wide UNPIVOT (value FOR metric IN (total, views, failures, skus)))"""
BASE = f"""{METRICS},
base AS (
  SELECT a.metric, a.day, a.value, median(CASE WHEN b.day >= a.day - 7 THEN b.value END) AS median_7, median(b.value) AS median_30,
         any_value(p.previous) AS previous
  FROM metrics a LEFT JOIN metrics b ON a.metric = b.metric AND b.day < a.day AND b.day >= a.day - 30
  LEFT JOIN (SELECT metric, day, lag(value) OVER (PARTITION BY metric ORDER BY day) AS previous FROM metrics) p ON p.metric = a.metric AND p.day = a.day
  GROUP BY a.metric, a.day, a.value)"""


def metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    wide = events.groupBy("day").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "error").alias("failures"), F.countDistinct("user_id").alias("skus"))
    return long_form(wide, ["day"], ["total", "views", "failures", "skus"])


@query(f"WITH {METRICS} SELECT day::VARCHAR AS day, metric, value FROM metrics")
def collection_metrics(spark, sf_dir):
    return dated(metrics(spark, sf_dir))


@query(f"WITH {BASE} SELECT * REPLACE (day::VARCHAR AS day) FROM base")
def calendar_baselines(spark, sf_dir):
    return dated(baselines(metrics(spark, sf_dir)))


@query(f"""WITH {BASE}, g AS (SELECT *, round(100.0 * (median_7 - value) / nullif(median_7, 0), 4) AS drop_percent FROM base)
SELECT metric, day::VARCHAR AS day, value, drop_percent, CASE WHEN drop_percent >= 60 THEN 'COLLECTION_BLOCKED' WHEN drop_percent >= 40 THEN 'COLLECTION_DEGRADED' WHEN drop_percent >= 20 THEN 'COLLECTION_WARN' ELSE 'COLLECTION_OK' END AS state FROM g""")
def collection_gate(spark, sf_dir):
    return dated(gate(baselines(metrics(spark, sf_dir)))).select("metric", "day", "value", "drop_percent", "state")


@query("""SELECT l_returnflag, round(count(CASE WHEN l_discount > 0 THEN 1 END) / count(*), 6) AS discount_coverage, round(count(CASE WHEN l_tax > 0 THEN 1 END) / count(*), 6) AS tax_coverage FROM lineitem GROUP BY 1""")
def field_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.when(F.col("l_discount") > 0, 1).alias("discount"), F.when(F.col("l_tax") > 0, 1).alias("tax"))
    return coverage(rows, ["l_returnflag"], ["discount", "tax"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return unique_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT l_orderkey, 'QUANTITY_RANGE' AS rule FROM lineitem WHERE l_quantity > 49 UNION ALL SELECT l_orderkey, 'HIGH_DISCOUNT' FROM lineitem WHERE l_discount >= 0.1
UNION ALL SELECT l_orderkey, 'RETURNED_OPEN' FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'""")
def rule_audit(spark, sf_dir):
    rules = {"QUANTITY_RANGE": F.col("l_quantity") > 49, "HIGH_DISCOUNT": F.col("l_discount") >= 0.1, "RETURNED_OPEN": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")}
    return rule_union(table(spark, sf_dir, "lineitem"), "l_orderkey", rules)


@query("""SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def orphan_events(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return orphans(table(spark, sf_dir, "events").select("event_id", "user_id"), parents, "user_id")


@query("""WITH l AS (SELECT s_suppkey AS k, s_name AS name, s_nationkey AS nation FROM supplier WHERE s_suppkey % 7 <> 0), r AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN upper(s_name) ELSE s_name END AS name, s_nationkey AS nation FROM supplier WHERE s_suppkey % 11 <> 0)
SELECT l.k, 'MISSING_RIGHT' AS field, l.k::VARCHAR AS left_value, NULL AS right_value FROM l ANTI JOIN r USING (k)
UNION ALL SELECT r.k, 'MISSING_LEFT', NULL, r.k::VARCHAR FROM r ANTI JOIN l USING (k)
UNION ALL SELECT k, 'name', l.name, r.name FROM l JOIN r USING (k) WHERE l.name IS DISTINCT FROM r.name
UNION ALL SELECT k, 'nation', l.nation::VARCHAR, r.nation::VARCHAR FROM l JOIN r USING (k) WHERE l.nation IS DISTINCT FROM r.nation""")
def parity_difference(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    right = rows.where("k % 11 <> 0").withColumn("name", F.when(F.col("k") % 5 == 0, F.upper("name")).otherwise(F.col("name")))
    return keyed_difference(rows.where("k % 7 <> 0"), right, "k", ["name", "nation"])


@query("""SELECT coalesce(a.k, b.k) AS k, coalesce(b.name, a.name) AS name, coalesce(b.balance, a.balance) AS balance
FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey AS k, NULL::VARCHAR AS name, c_acctbal + 1 AS balance FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k""")
def upserted_state(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    changes = rows.where("k % 2 = 0").select("k", F.lit(None).cast("string").alias("name"), (F.col("balance") + 1).alias("balance"))
    return upsert(rows.where("k % 3 <> 0"), changes, ["k"], ["name", "balance"])


@query("""SELECT DISTINCT user_id::VARCHAR || '-' || event_type || '-' || ts::DATE::VARCHAR AS event_key FROM events WHERE ts >= TIMESTAMP '2024-01-15'
EXCEPT SELECT user_id::VARCHAR || '-' || event_type || '-' || ts::DATE::VARCHAR FROM events WHERE ts < TIMESTAMP '2024-01-16'""")
def appended_events(spark, sf_dir):
    key = F.concat_ws("-", F.col("user_id").cast("string"), "event_type", F.to_date("ts").cast("string")).alias("event_key")
    events = table(spark, sf_dir, "events")
    log = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).select(key)
    return insert_ignore(log, events.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).select(key), "event_key")


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1, 2""")
def queue_histogram(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P' ORDER BY CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 ELSE 2 END, o_orderdate, o_orderkey LIMIT 100""")
def queue_claim(spark, sf_dir):
    """The next pending entries by priority and age: a top-k, not a sort of all."""
    head = F.substring("o_orderpriority", 1, 1)
    rank = F.when(head == "1", 0).when(head == "2", 1).otherwise(2)
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").orderBy(rank, "o_orderdate", "o_orderkey").limit(100).select("o_orderkey", "o_orderpriority")


@query("""SELECT k FROM (SELECT c_custkey AS k FROM customer UNION SELECT s_suppkey + 20 FROM supplier) EXCEPT (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey + 20 FROM supplier)""")
def symmetric_difference(spark, sf_dir):
    a, b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 20).alias("k"))
    return a.union(b).distinct().exceptAll(a.intersect(b))


def rules_sql() -> str:
    return ", ".join(f"({k}, '{m}', '{kind}', {limit}, '{level}', '{code}')" for k, (m, kind, limit, level, code) in enumerate(COLLECTION_RULES + DRIFT_RULES))


LISTED = f"""listed AS (SELECT ts::DATE AS day, user_id AS sku, CASE WHEN event_type <> 'error' AND day(ts) % 4 <> 0 OR value > 30 THEN value END AS price, CASE event_type WHEN 'purchase' THEN value WHEN 'click' THEN value + CASE WHEN day(ts) % 8 = 0 THEN 0 ELSE 1 END END AS original,
  CASE WHEN user_id % 9 = 0 THEN ' ' ELSE 'c' || user_id % 5 END AS cat1, CASE WHEN day(ts) % 6 = 0 AND event_type = 'view' THEN NULL ELSE event_type END AS cat2, CASE WHEN event_id % 400 = 0 THEN 'Leer más' ELSE 's' END AS spec,
  CASE WHEN day(ts) % 5 = 0 AND value > 30 THEN '' WHEN event_id % 300 = 0 THEN 'd <b>' ELSE 'd' END AS description, props AS details FROM events WHERE day(ts) % 7 <> 3 OR user_id % 3 = 0),
wide AS (SELECT day, count(DISTINCT sku)::DOUBLE AS listing_unique, (count(DISTINCT sku) FILTER (price > 0))::DOUBLE AS current_valid, (count(*) - count(DISTINCT sku)) / count(*) AS duplicate_rate, count(*) FILTER (price > 0) / count(*) AS price_coverage,
  count(*) FILTER (trim(cat1) <> '') / count(*) AS cat1_coverage, count(*) FILTER (trim(cat2) <> '') / count(*) AS cat2_coverage, count(*) FILTER (trim(spec) <> '') / count(*) AS spec_coverage, count(*) FILTER (trim(description) <> '') / count(*) AS description_coverage, count(*) FILTER (trim(details) <> '') / count(*) AS details_coverage,
  count(*) FILTER (price = original) / nullif(count(*) FILTER (price IS NOT NULL AND original IS NOT NULL), 0) AS original_price_equals_current_ratio, count(*) FILTER (spec = 'Leer más') / count(*) AS ui_contamination_rate, count(*) FILTER (description = 'd <b>') / count(*) AS html_contamination_rate,
  (count(DISTINCT cat1) FILTER (trim(cat1) <> ''))::DOUBLE AS successful_category_count FROM listed GROUP BY day),
metrics AS (SELECT day, metric, value FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(* EXCLUDE (day))))),
based AS (SELECT a.day, a.metric, a.value, median(b.value) AS base FROM metrics a LEFT JOIN metrics b ON b.metric = a.metric AND b.day < a.day AND b.day >= a.day - 7 GROUP BY ALL),
rules AS (SELECT * FROM (VALUES {rules_sql()}) r(ord, metric, kind, lim, level, code)),
measured AS (SELECT b.*, r.* EXCLUDE (metric), CASE kind WHEN 'DROP_PERCENT' THEN CASE WHEN base > 0 THEN 100 * (base - value) / base END WHEN 'DROP_POINTS' THEN CASE WHEN abs(value) <= 1 AND abs(base) <= 1 THEN 100 * (base - value) ELSE base - value END ELSE value END AS measure FROM based b JOIN rules r ON r.metric = b.metric),
findings AS (SELECT day, metric, code, level, value, base, round(measure, 6) AS measure FROM measured WHERE round(measure, 6) IS NOT NULL AND CASE kind WHEN 'BELOW' THEN measure < lim WHEN 'ABOVE' THEN measure > lim ELSE measure >= lim END QUALIFY row_number() OVER (PARTITION BY day, metric, code ORDER BY ord) = 1)"""


def listed_metrics(spark, sf_dir):
    """Daily metrics of a listing made of events, with days on which prices, categories, texts or whole products are missing."""
    kind, value, number = F.col("event_type"), F.col("value"), F.dayofmonth("ts")
    rows = table(spark, sf_dir, "events").where((number % 7 != 3) | (F.col("user_id") % 3 == 0)).select(
        F.to_date("ts").alias("day"), F.col("user_id").alias("sku"), F.when(((kind != "error") & (number % 4 != 0)) | (value > 30), value).alias("price"),
        F.when(kind == "purchase", value).when(kind == "click", value + F.when(number % 8 == 0, 0).otherwise(1)).alias("original_price"), F.when(F.col("user_id") % 9 == 0, " ").otherwise(F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string"))).alias("cat1"),
        F.when(~((number % 6 == 0) & (kind == "view")), kind).alias("cat2"), F.when(F.col("event_id") % 400 == 0, "Leer más").otherwise("s").alias("spec"),
        F.when((number % 5 == 0) & (value > 30), "").when(F.col("event_id") % 300 == 0, "d <b>").otherwise("d").alias("description"), F.col("props").alias("details"),
    )
    return run_metrics(rows, ["day"])


@query(f"WITH {LISTED} SELECT day::VARCHAR AS day, metric, round(value, 9) AS value FROM metrics")
def run_metric_rows(spark, sf_dir):
    """Thirteen metrics of each day's rows in one aggregate."""
    return dated(listed_metrics(spark, sf_dir).withColumn("value", F.round("value", 9)))


@query(f"WITH {LISTED} SELECT day::VARCHAR AS day, metric, code, level, round(value, 9) AS value, round(base, 9) AS base, measure FROM findings")
def collection_findings(spark, sf_dir):
    """Drops, low and high values by tables of rules over the metrics and their seven-day medians."""
    found = rule_findings(baselines(listed_metrics(spark, sf_dir)), ["day"], COLLECTION_RULES + DRIFT_RULES)
    return dated(found.withColumns({"value": F.round("value", 9), "base": F.round("base", 9)}))


@query(f"WITH {LISTED}, w AS (SELECT day, bool_or(level = 'BLOCK') AS b FROM findings WHERE level <> 'HIGH' GROUP BY day) SELECT m.day::VARCHAR AS day, CASE WHEN b THEN 'COLLECTION_BLOCKED' WHEN b IS NOT NULL THEN 'COLLECTION_WARN' ELSE 'COLLECTION_OK' END AS state FROM wide m LEFT JOIN w ON w.day = m.day")
def collection_states(spark, sf_dir):
    metrics = listed_metrics(spark, sf_dir)
    return dated(gate_states(rule_findings(baselines(metrics), ["day"], COLLECTION_RULES), ["day"], metrics))

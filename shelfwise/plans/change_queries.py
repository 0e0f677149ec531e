"""Price facts, events of a day, proven absences and coverage losses over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import changes
from shelfwise.operators.commits import coverage_regression
from shelfwise.plans.registry import query
from shelfwise.sources.relations import HISTORY, part_key, part_price, part_size, part_sku, price_history, table

PERIOD, MOST, TODAY, YESTERDAY = "1997-06-15", 90.0, "2024-01-20", "2024-01-19"
HOST, ZONE = "shop.example", "Europe/Madrid"


@query(f"""WITH {HISTORY}, c AS (SELECT p_partkey::VARCHAR AS sku, p_retailprice AS cur, p_retailprice * (0.5 + p_size / 40.0) AS orig, round(-3.0 * p_size / 100, 6) AS badge, p_size % 2 = 0 AS promoted, p_retailprice - 1000 AS valid FROM part),
o AS (SELECT *, strftime(observed_at, '%Y-%m-%d') AS day FROM history),
l AS (SELECT * FROM o WHERE change_type IN ('UP', 'DOWN') AND old_price > 0 AND new_price > 0 QUALIFY row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) = 1),
d AS (SELECT * FROM o WHERE day = '{PERIOD}' QUALIFY row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) = 1),
p AS (SELECT sku, old_price AS x FROM o UNION ALL SELECT sku, new_price FROM o UNION ALL SELECT sku, cur FROM c UNION ALL SELECT sku, valid FROM c),
m AS (SELECT sku, min(x) AS lo, max(x) AS hi FROM p WHERE x > 0 GROUP BY sku)
SELECT c.sku, l.old_price AS last_price, l.change_type AS price_direction, coalesce(d.change_type, 'UNCHANGED') AS price_change, round(l.new_price - l.old_price, 4) AS change_amount,
  round((l.new_price - l.old_price) / l.old_price, 6) AS change_percent, l.day AS last_change_date, lo AS price_min, hi AS price_max,
  CASE WHEN promoted AND badge > -1 AND badge < 0 THEN badge WHEN orig > cur AND cur > 0 THEN round((cur - orig) / orig, 6) END AS discount
FROM c LEFT JOIN l USING (sku) LEFT JOIN d USING (sku) LEFT JOIN m USING (sku)""")
def price_facts(spark, sf_dir):
    """Current rows with their last real change, the period's change, extrema with the last valid price, and discount."""
    current = table(spark, sf_dir, "part").select(
        part_sku(), part_price().alias("current_price"), (part_price() * (F.lit(0.5) + part_size() / 40.0)).alias("original_price"), F.round(F.lit(-3.0) * part_size() / 100, 6).alias("badge_discount"),
        (part_size() % 2 == 0).alias("promoted"), (part_price() - 1000).alias("last_valid_price"),
    )
    return changes.price_facts(current, price_history(spark, sf_dir), ["observed_at", "k1", "k2", "k3"], PERIOD)


FLAGS = {"promo": ("PROMO_START", "PROMO_END"), "badge": ("NEW_BADGE_ON", "NEW_BADGE_OFF"), "sustainable": ("SUSTAINABLE_ON", "SUSTAINABLE_OFF")}


@query(f"""WITH d AS (SELECT user_id::VARCHAR AS sku, ts::DATE AS day, arg_max(value, (ts, event_id)) AS price, bool_or(event_type = 'purchase') AS promo, bool_or(event_type = 'signup') AS badge, bool_or(event_type = 'error') AS sustainable, sha256(min(event_type)) AS hash FROM events GROUP BY 1, 2),
f AS (SELECT user_id::VARCHAR AS sku, min(ts::DATE) FILTER (event_type = 'view') AS first FROM events GROUP BY 1),
p AS (SELECT t.sku, y.sku IS NOT NULL AND f.first IS DISTINCT FROM DATE '{TODAY}' AS seen, y.price AS old_price, t.price AS new_price, t.price <= 0 OR t.price > {MOST} AS odd,
  coalesce(y.promo, false) AS op, t.promo AS np, coalesce(y.badge, false) AS ob, t.badge AS nb, coalesce(y.sustainable, false) AS os, t.sustainable AS ns, y.hash AS oh, t.hash AS nh
  FROM d t LEFT JOIN d y ON y.sku = t.sku AND y.day = DATE '{YESTERDAY}' LEFT JOIN f ON f.sku = t.sku WHERE t.day = DATE '{TODAY}'),
e AS (SELECT sku, 'PRICE_ANOMALY' AS event_type, old_price, new_price, NULL::DOUBLE AS change_amount, NULL::DOUBLE AS change_percent, NULL::VARCHAR AS old_value, NULL::VARCHAR AS new_value FROM p WHERE odd
UNION ALL SELECT sku, 'PRICE_NEW', old_price, new_price, NULL, NULL, NULL, NULL FROM p WHERE NOT odd AND old_price IS NULL
UNION ALL SELECT sku, CASE WHEN new_price > old_price THEN 'PRICE_UP' ELSE 'PRICE_DOWN' END, old_price, new_price, round(new_price - old_price, 4), CASE WHEN old_price <> 0 THEN round((new_price - old_price) / old_price, 6) END, NULL, NULL FROM p WHERE NOT odd AND abs(new_price - old_price) > 1e-9
UNION ALL SELECT sku, CASE WHEN np THEN 'PROMO_START' ELSE 'PROMO_END' END, NULL, NULL, NULL, NULL, op::VARCHAR, np::VARCHAR FROM p WHERE op <> np
UNION ALL SELECT sku, CASE WHEN nb THEN 'NEW_BADGE_ON' ELSE 'NEW_BADGE_OFF' END, NULL, NULL, NULL, NULL, ob::VARCHAR, nb::VARCHAR FROM p WHERE ob <> nb
UNION ALL SELECT sku, CASE WHEN ns THEN 'SUSTAINABLE_ON' ELSE 'SUSTAINABLE_OFF' END, NULL, NULL, NULL, NULL, os::VARCHAR, ns::VARCHAR FROM p WHERE os <> ns
UNION ALL SELECT sku, 'CONTENT_CHANGE', NULL, NULL, NULL, NULL, left(oh, 12), left(nh, 12) FROM p WHERE seen AND oh IS DISTINCT FROM nh
UNION ALL SELECT sku, 'FIRST_SEEN', NULL, NULL, NULL, NULL, NULL, NULL FROM p WHERE NOT seen)
SELECT * FROM e""")
def day_events(spark, sf_dir):
    """All events of a day: prices, anomalies under review, three badges, content and first sights."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku"), F.to_date("ts").alias("day"), "ts", "event_id", "event_type", "value")
    kind = lambda name: F.bool_or(F.col("event_type") == name)
    daily = events.groupBy("sku", "day").agg(F.max_by("value", F.struct("ts", "event_id")).alias("price"), kind("purchase").alias("promo"), kind("signup").alias("badge"), kind("error").alias("sustainable"), F.sha2(F.min("event_type").cast("binary"), 256).alias("content_hash"))
    first = events.groupBy("sku").agg(F.min(F.when(F.col("event_type") == "view", F.col("day"))).alias("first"))
    names = ["price", "content_hash", *FLAGS]
    of = lambda day, prefix: daily.where(F.col("day") == F.lit(day).cast("date")).select("sku", *[F.col(c).alias(f"{prefix}_{c}") for c in names])
    pairs = of(TODAY, "new").join(of(YESTERDAY, "old").withColumn("known", F.lit(True)), "sku", "left").join(first, "sku", "left")
    return changes.day_events(pairs.withColumn("first_presence", F.col("first") == F.lit(TODAY).cast("date")), MOST, FLAGS)


@query(f"""WITH e AS (SELECT l_partkey::VARCHAR AS sku, l_partkey AS k, l_suppkey AS s, l_linenumber AS n, l_returnflag AS flag, l_shipdate::DATE AS day, l_tax AS tax, l_discount AS disc FROM lineitem WHERE l_quantity = 1),
p AS (SELECT p_partkey::VARCHAR AS sku, p_size, p_retailprice AS price, CASE WHEN p_size % 5 <> 0 THEN p_retailprice + p_size END AS original FROM part WHERE p_size <> 50),
m AS (SELECT sku, count(*) AS c FROM e GROUP BY sku)
SELECT e.sku, CASE WHEN m.c > 1 THEN 'DUPLICATE_SKU' WHEN p.sku IS NULL THEN 'SKU_MISSING' WHEN n = 7 THEN 'EVIDENCE_INCOMPLETE' WHEN n = 6 THEN 'SKU_MISMATCH' WHEN n = 5 THEN 'URL_MISMATCH'
  WHEN flag = 'R' THEN 'NOT_CONFIRMED' WHEN n = 4 THEN 'DATE_MISMATCH' WHEN tax > 0.07 THEN 'CURRENT_PRICE_MISMATCH' WHEN p_size > 45 THEN 'SKU_NOT_CURRENT' WHEN original IS NOT NULL AND disc > 0.08 THEN 'ORIGINAL_CHANGED'
  WHEN original IS NULL THEN 'NO_ORIGINAL' ELSE 'CLEAR' END AS verdict
FROM e JOIN m USING (sku) LEFT JOIN p USING (sku)""")
def price_absences(spark, sf_dir):
    """Evidence that products show no original price, each row with its first fault."""
    part = table(spark, sf_dir, "part")
    address = lambda sku: F.concat(F.lit(f"https://{HOST}/p/"), sku)
    products = part.where(part_size() != 50).select(
        part_sku(), address(part_key().cast("string")).alias("product_url"), F.when(part_size() > 45, "OFFLINE").otherwise("CURRENT").alias("status"), part_price().alias("current_price"), F.when(part_size() % 5 != 0, part_price() + part_size()).alias("original_price"),
    )
    prices = part.select(part_sku(), part_price().alias("_price"), part_size().alias("_size"))
    n, sku, day = F.col("l_linenumber"), F.col("l_partkey").cast("string"), F.to_date("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").where("l_quantity = 1").withColumn("sku", sku).join(prices, "sku")
    evidence = lines.select(
        "sku", (n != 7).alias("complete"), F.when(n == 6, F.array("sku", F.lit("other"))).otherwise(F.array("sku")).alias("articles"), F.when(n == 5, F.concat(F.lit("https://elsewhere.example/p/"), "sku")).otherwise(address(F.col("sku"))).alias("url"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("original_count"), F.lit(0).alias("discount_count"), F.lit("").alias("original_text"), F.lit("").alias("discount_text"),
        (day.cast("timestamp_ntz") + F.expr("INTERVAL 10 HOURS")).alias("observed_at"), F.when(n == 4, F.date_add(day, 1)).otherwise(day).alias("business_date"),
        F.when(F.col("l_tax") > 0.07, F.col("_price") + 0.01).otherwise(F.col("_price")).alias("price"), (F.col("_price") + F.col("_size") + F.when(F.col("l_discount") > 0.08, 1).otherwise(0)).alias("expected_original"),
    )
    return changes.absence_verdicts(evidence, products, HOST, ZONE)


@query("""WITH b AS (SELECT count(*) AS t, count(CASE WHEN l_quantity > 5 THEN l_linestatus END) AS c, count(CASE WHEN l_discount >= 0.05 THEN l_returnflag END) AS s, count(l_tax) AS x FROM lineitem),
a AS (SELECT count(CASE WHEN l_quantity > 40 THEN l_linestatus END) AS c, count(CASE WHEN l_discount >= 0.06 THEN l_returnflag END) AS s, 0 AS x FROM lineitem)
SELECT * FROM (SELECT 'comment' AS column, b.c AS before, a.c AS after FROM a, b UNION ALL SELECT 'mode', b.s, a.s FROM a, b UNION ALL SELECT 'tax', b.x, a.x FROM a, b) WHERE before > 0 AND after < 0.5 * before""")
def coverage_losses(spark, sf_dir):
    """Columns whose filled values drop by more than half between two states of a table."""
    lines = table(spark, sf_dir, "lineitem")
    state = lambda most, share, tax: lines.select(F.when(F.col("l_quantity") > most, F.col("l_linestatus")).alias("comment"), F.when(F.col("l_discount") >= share, F.col("l_returnflag")).alias("mode"), tax.alias("tax"))
    return coverage_regression(state(5, 0.05, F.col("l_tax")), state(40, 0.06, F.lit(None).cast("double")), ["comment", "mode", "tax"])


@query("""WITH r AS (SELECT p_partkey::VARCHAR AS sku, p_partkey AS k, p_size AS s, p_name AS name, p_type AS kind FROM part WHERE p_size <> 1),
m AS (SELECT p_partkey::VARCHAR AS sku, p_size AS s FROM part WHERE p_size <> 2), o AS (SELECT user_id::VARCHAR AS sku, count(*) AS n, bool_and(event_type <> 'error' AND value <= 99.5) AS only_seen FROM events WHERE event_type <> 'view' GROUP BY 1),
a AS (SELECT DISTINCT p_partkey::VARCHAR AS sku, p_size AS s, p_partkey AS k FROM part WHERE p_size <> 3),
i AS (SELECT l_partkey::VARCHAR AS sku, bool_or(l_quantity = 50 AND l_discount = 0.1) AS blocked, bool_or(l_quantity = 50 AND l_discount = 0.09) AS reviewed FROM lineitem GROUP BY 1),
j AS (SELECT coalesce(r.sku, m.sku, o.sku) AS sku, r.sku IS NOT NULL AS has_r, m.sku IS NOT NULL AS has_m, o.n, o.only_seen, a.sku IS NOT NULL AS known, r.s, r.k, coalesce(blocked, false) AS blocked, coalesce(reviewed, false) AS reviewed
  FROM r FULL JOIN m ON r.sku = m.sku FULL JOIN o ON o.sku = coalesce(r.sku, m.sku) LEFT JOIN a ON a.sku = coalesce(r.sku, m.sku, o.sku) LEFT JOIN i ON i.sku = coalesce(r.sku, m.sku, o.sku))
SELECT sku, 'SKU_SCOPE_MISMATCH' AS fault FROM j WHERE NOT (has_r AND has_m) UNION ALL SELECT sku, 'OBSERVATION_SCOPE_MISMATCH' FROM j WHERE NOT (coalesce(n = 1, false) AND has_m)
UNION ALL SELECT sku, 'NO_ABSENCE_AUTHORITY' FROM j WHERE n IS NOT NULL AND NOT only_seen UNION ALL SELECT sku, 'IDENTITY_MISMATCH' FROM j WHERE has_r AND has_m AND s = 4
UNION ALL SELECT sku, 'NEW_IDENTITY_MUST_BE_UNKNOWN' FROM j WHERE has_r AND has_m AND NOT known UNION ALL SELECT sku, 'QA_NOT_READY' FROM j WHERE has_r AND has_m AND (blocked OR (reviewed AND s <= 25))
UNION ALL SELECT sku, 'LIFECYCLE_CHANGED:status' FROM j WHERE has_r AND has_m AND known AND s = 5
UNION ALL SELECT sku, 'VALUE_HASH_MISMATCH:name' FROM j WHERE has_r AND has_m AND s <= 25 AND s = 6
UNION ALL SELECT sku, 'UNAUTHORIZED_FIELD:name' FROM j WHERE has_r AND has_m AND s > 25 AND (NOT known OR s = 30)
UNION ALL SELECT sku, 'UNAUTHORIZED_FIELD:kind' FROM j WHERE has_r AND has_m AND (NOT known OR s = 7)""")
def positive_scopes(spark, sf_dir):
    """All faults of rows that bring facts under permissions and say nothing of presence."""
    part, size = table(spark, sf_dir, "part"), part_size()
    texts = {"canonical_id": F.concat(F.lit("C"), "p_partkey"), "status": F.lit("CURRENT"), "first_seen": F.lit("2024-01-01"), "last_seen": F.lit("2024-01-02"), "missing_count": F.lit(0), "name": F.col("p_name"), "kind": F.col("p_type")}
    stored = part.where(size != 3).select(part_sku(), *[v.alias(k) for k, v in texts.items()])
    other = {"canonical_id": 4, "status": 5, "kind": 7, "name": 30}
    rows = part.where(size != 1).select(part_sku(), *[(F.when(size == other[k], F.concat(v, F.lit(" "))).otherwise(v) if k in other else v).alias(k) for k, v in texts.items()])
    digest = F.sha2(F.when(size == 6, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name")).cast("binary"), 256)
    permissions = part.where(size != 2).select(part_sku(), texts["canonical_id"].alias("canonical_id"), F.when(size <= 25, F.create_map(F.lit("name"), digest)).otherwise(F.create_map().cast("map<string,string>")).alias("allowed"))
    observations = table(spark, sf_dir, "events").where("event_type <> 'view'").select(
        F.col("user_id").cast("string").alias("sku"), F.when(F.col("event_type") != "error", "PRESENT").otherwise("UNKNOWN").alias("presence_state"), F.lit(False).alias("complete"), (F.col("value") > 99.5).alias("absence_capable")
    )
    lines = table(spark, sf_dir, "lineitem").where("l_quantity = 50 AND l_discount IN (0.1, 0.09)")
    issues = lines.select(F.col("l_partkey").cast("string").alias("sku"), F.when(F.col("l_discount") == 0.1, "HARD_BLOCK").otherwise("FIELD_REVIEW").alias("level"), F.lit("name").alias("field_name"))
    return changes.positive_scope_faults(rows, permissions, stored, observations, issues, ["name", "kind"], ["status"])

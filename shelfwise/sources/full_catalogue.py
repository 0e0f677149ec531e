"""Catalogue rows with localizations, images, price review, lifecycle and events, read from the star-schema tables.

Each relation is one scan of a table; the whole row is left joins by SKU of
aggregates with one row for each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.windows import latest
from shelfwise.sources.relations import CATALOG, HISTORY, canonical_id, price_history, table

EVENT_KINDS = {"view": "FIRST_SEEN", "click": "PRICE_DOWN", "signup": "NEW_BADGE_ON", "purchase": "REAPPEARED", "error": "CONTENT_CHANGE"}


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, raw prices, status, flags): a product's own row."""
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    sku = k.cast("string")
    return table(spark, sf_dir, "part").select(
        sku.alias("sku"), canonical_id(sku).alias("canonical_id"), F.col("p_name").alias("name"), F.when(k % 4 != 0, F.concat(F.lit("zh "), "p_name")).alias("name_zh"),
        price.alias("raw_price"), F.when(k % 3 == 0, price * 1.25).when(k % 3 == 1, price).alias("raw_original"),
        F.when(size % 5 == 0, "OFFLINE").when(size % 5 == 1, "MISSING").otherwise("CURRENT").alias("status"),
        (size % 2 == 0).alias("promotion"), (size % 7 == 0).alias("new_badge"), (k % 5 == 0).alias("sustainable"), F.concat(F.lit("/p/"), sku).alias("product_url"),
    )


def localizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, language, six fields, review_status, freshness_status): at most one row for a SKU and language."""
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    es = part.select(
        k.cast("string").alias("sku"), F.lit("es").alias("language"), F.col("p_name").alias("name"), F.col("p_type").alias("cat1"), F.col("p_brand").alias("cat2"), F.col("p_size").cast("string").alias("spec"),
        F.when(k % 8 != 0, F.concat_ws(" ", "p_name", "p_type")).alias("description"), F.concat(F.lit("Marca: "), "p_brand").alias("details"), F.lit(None).cast("string").alias("review_status"), F.lit(None).cast("string").alias("freshness_status"),
    )
    zh = part.where(k % 4 != 0).select(
        k.cast("string").alias("sku"), F.lit("zh").alias("language"), F.concat(F.lit("zh "), "p_name").alias("name"), F.lower("p_type").alias("cat1"), F.when(k % 10 != 1, F.lower("p_brand")).alias("cat2"),
        F.when(k % 14 == 3, "").otherwise(F.col("p_size").cast("string")).alias("spec"), F.concat_ws(" ", "p_name", "p_type").alias("description"), F.when(k % 22 != 5, F.concat(F.lit("P: "), "p_brand")).alias("details"),
        F.when(k % 11 == 0, "BLOCKED").when(k % 13 == 0, "PENDING").when(k % 7 == 0, "review_pending").otherwise("APPROVED").alias("review_status"), F.when(k % 9 == 0, "STALE").otherwise("FRESH").alias("freshness_status"),
    )
    return es.unionByName(zh)


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").where(k % 3 != 2).select(k.cast("string").alias("sku"), F.when(k % 2 == 0, "AVAILABLE").otherwise("FAILED").alias("image_status"), F.when(k % 10 != 4, F.concat(F.lit("img/"), k.cast("string"))).alias("image_path"))


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, id, event_type, occurred_at)."""
    kinds = F.create_map(*[F.lit(x) for pair in EVENT_KINDS.items() for x in pair])
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku"), F.col("event_id").alias("id"), F.coalesce(kinds[F.col("event_type")], F.col("event_type")).alias("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("occurred_at"))


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, offline_date): the day after which a SKU of an event log is silent, for those with an error last."""
    log = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("sku")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last"), F.max("ts").alias("at"))
    return log.select("sku", F.when(F.col("last") == "error", F.date_format("at", "yyyy-MM-dd")).alias("offline_date"))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history with its day as text."""
    return price_history(spark, sf_dir).withColumn("observed_at", F.date_format("observed_at", "yyyy-MM-dd"))


def price_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, invalid_price, invalid_original): markers of a run's evidence, one row for a SKU however often it is marked."""
    marks = table(spark, sf_dir, "part").where("p_partkey % 17 = 0 OR p_partkey % 19 = 0")
    k, sku = F.col("p_partkey"), F.col("p_partkey").cast("string").alias("sku")
    whole = marks.where(k % 17 == 0).select(sku, F.lit(1).alias("invalid_price"), F.lit(None).cast("int").alias("invalid_original"))
    fields = marks.where(k % 19 == 0).select(sku, F.lit(None).cast("int").alias("invalid_price"), F.lit(1).alias("invalid_original"))
    return whole.unionByName(fields).groupBy("sku").agg(F.max("invalid_price").alias("invalid_price"), F.max("invalid_original").alias("invalid_original"))


def with_current_prices(rows: DataFrame, review: DataFrame) -> DataFrame:
    """current_price and original_price: null where the review marks them, the original also where it marks the price."""
    joined = rows.join(review, "sku", "left")
    bad = F.coalesce("invalid_price", F.lit(0)) == 1
    bad_original = bad | (F.coalesce("invalid_original", F.lit(0)) == 1)
    return joined.withColumns({"current_price": F.when(~bad, F.col("raw_price")), "original_price": F.when(~bad_original, F.col("raw_original"))}).drop("invalid_price", "invalid_original")


def extrema_with_current(history: DataFrame, products: DataFrame) -> DataFrame:
    """(sku, historical_low, historical_high) over old, new and current prices; a product without history has its own."""
    prices = history.select("sku", F.explode(F.array("old_price", "new_price")).alias("price")).unionAll(products.select("sku", F.col("raw_price").alias("price"))).where(F.col("price").isNotNull())
    return prices.groupBy("sku").agg(F.min("price").alias("historical_low"), F.max("price").alias("historical_high"))


#: Relations of the whole row that have one row at most for a SKU: without them the rows are the same ones.
BY_SKU = ("change", "extrema", "event", "sight")


def full_rows(spark: SparkSession, sf_dir: str, by_sku: tuple[str, ...] = BY_SKU) -> DataFrame:
    """The catalogue's whole row: product, ES, ZH, image, latest change, extrema, latest event, first and last sight.

    by_sku: which of the last four a query reads; the others' tables are not
    read, sorted or joined.
    """
    own = products(spark, sf_dir)
    rows = with_current_prices(own, price_review(spark, sf_dir))
    both = localizations(spark, sf_dir)
    fields = ["name", "cat1", "cat2", "spec", "description", "details"]
    es = both.where("language = 'es'").select("sku", *[F.col(c).alias(f"es_{c}") for c in fields])
    zh = both.where("language = 'zh'").select("sku", *[F.col(c).alias(f"zh_{c}") for c in [*fields, "review_status", "freshness_status"]])
    history = price_history(spark, sf_dir)
    last = latest(history, ["sku"], ["observed_at", "k1", "k2", "k3"], ["old_price", "new_price", "change_type", "observed_at"])
    last = last.select(
        "sku", F.date_format("observed_at", "yyyy-MM-dd").alias("changed_at"), F.col("change_type").alias("price_change"), F.round(F.col("new_price") - F.col("old_price"), 4).alias("change_amount"),
        F.round(F.try_divide(100 * (F.col("new_price") - F.col("old_price")), F.when(F.col("old_price") != 0, F.col("old_price"))), 4).alias("change_percent"),
    )
    event = latest(event_history(spark, sf_dir), ["sku"], ["occurred_at", "id"], ["event_type", "occurred_at"]).select("sku", F.col("event_type").alias("recent_event_type"), F.col("occurred_at").alias("recent_event_at"))
    seen = history.groupBy("sku").agg(F.date_format(F.min("observed_at"), "yyyy-MM-dd").alias("first_seen"), F.date_format(F.max("observed_at"), "yyyy-MM-dd").alias("last_checked"))
    seen = seen.withColumn("last_seen", F.when(F.col("sku").cast("long") % 6 != 0, F.col("last_checked")))
    held = {"change": last, "extrema": extrema_with_current(history, own), "event": event, "sight": seen}
    for other in (es, zh, images(spark, sf_dir), *[held[name] for name in BY_SKU if name in by_sku]):
        # each has rows for most SKUs, so it is merged: small files are no reason to broadcast them
        rows = rows.join(other.hint("merge"), "sku", "left")
    return rows


FULL = f"""{CATALOG}, {HISTORY},
products AS (
  SELECT p_partkey::VARCHAR AS sku, c.canonical_id, p_name AS name, CASE WHEN p_partkey % 4 <> 0 THEN 'zh ' || p_name END AS name_zh, p_retailprice AS raw_price,
    CASE p_partkey % 3 WHEN 0 THEN p_retailprice * 1.25 WHEN 1 THEN p_retailprice END AS raw_original,
    CASE p_size % 5 WHEN 0 THEN 'OFFLINE' WHEN 1 THEN 'MISSING' ELSE 'CURRENT' END AS status, p_size % 2 = 0 AS promotion, p_size % 7 = 0 AS new_badge, p_partkey % 5 = 0 AS sustainable,
    '/p/' || p_partkey::VARCHAR AS product_url, CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice END AS current_price,
    CASE WHEN p_partkey % 17 <> 0 AND p_partkey % 19 <> 0 THEN CASE p_partkey % 3 WHEN 0 THEN p_retailprice * 1.25 WHEN 1 THEN p_retailprice END END AS original_price
  FROM part JOIN catalog c ON c.sku = p_partkey::VARCHAR),
es AS (
  SELECT p_partkey::VARCHAR AS sku, p_name AS es_name, p_type AS es_cat1, p_brand AS es_cat2, p_size::VARCHAR AS es_spec,
    CASE WHEN p_partkey % 8 <> 0 THEN p_name || ' ' || p_type END AS es_description, 'Marca: ' || p_brand AS es_details FROM part),
zh AS (
  SELECT p_partkey::VARCHAR AS sku, 'zh ' || p_name AS zh_name, lower(p_type) AS zh_cat1, CASE WHEN p_partkey % 10 <> 1 THEN lower(p_brand) END AS zh_cat2,
    CASE WHEN p_partkey % 14 = 3 THEN '' ELSE p_size::VARCHAR END AS zh_spec, p_name || ' ' || p_type AS zh_description, CASE WHEN p_partkey % 22 <> 5 THEN 'P: ' || p_brand END AS zh_details,
    CASE WHEN p_partkey % 11 = 0 THEN 'BLOCKED' WHEN p_partkey % 13 = 0 THEN 'PENDING' WHEN p_partkey % 7 = 0 THEN 'review_pending' ELSE 'APPROVED' END AS zh_review_status,
    CASE WHEN p_partkey % 9 = 0 THEN 'STALE' ELSE 'FRESH' END AS zh_freshness_status
  FROM part WHERE p_partkey % 4 <> 0),
images AS (
  SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 2 = 0 THEN 'AVAILABLE' ELSE 'FAILED' END AS image_status, CASE WHEN p_partkey % 10 <> 4 THEN 'img/' || p_partkey::VARCHAR END AS image_path
  FROM part WHERE p_partkey % 3 <> 2),
event_history AS (
  SELECT user_id::VARCHAR AS sku, event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS occurred_at,
    CASE event_type WHEN 'view' THEN 'FIRST_SEEN' WHEN 'click' THEN 'PRICE_DOWN' WHEN 'signup' THEN 'NEW_BADGE_ON' WHEN 'purchase' THEN 'REAPPEARED' WHEN 'error' THEN 'CONTENT_CHANGE' ELSE event_type END AS event_type
  FROM events),
lifecycle AS (
  SELECT user_id::VARCHAR AS sku, CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN strftime(max(ts), '%Y-%m-%d') END AS offline_date FROM events GROUP BY 1),
change_log AS (SELECT sku, strftime(observed_at, '%Y-%m-%d') AS observed_at, old_price, new_price FROM history),
last_change AS (
  SELECT sku, strftime(observed_at, '%Y-%m-%d') AS changed_at, change_type AS price_change, round(new_price - old_price, 4) AS change_amount, round(100 * (new_price - old_price) / nullif(old_price, 0), 4) AS change_percent
  FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM history) WHERE rn = 1),
extrema AS (
  SELECT sku, min(price) AS historical_low, max(price) AS historical_high
  FROM (SELECT sku, old_price AS price FROM history WHERE old_price IS NOT NULL UNION ALL SELECT sku, new_price FROM history UNION ALL SELECT sku, raw_price FROM products) GROUP BY sku),
last_event AS (
  SELECT sku, event_type AS recent_event_type, occurred_at AS recent_event_at FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY occurred_at DESC, id DESC) AS rn FROM event_history) WHERE rn = 1),
seen AS (
  SELECT sku, strftime(min(observed_at), '%Y-%m-%d') AS first_seen, strftime(max(observed_at), '%Y-%m-%d') AS last_checked, CASE WHEN sku::BIGINT % 6 <> 0 THEN strftime(max(observed_at), '%Y-%m-%d') END AS last_seen
  FROM history GROUP BY sku),
full_rows AS (
  SELECT * FROM products LEFT JOIN es USING (sku) LEFT JOIN zh USING (sku) LEFT JOIN images USING (sku) LEFT JOIN last_change USING (sku) LEFT JOIN extrema USING (sku) LEFT JOIN last_event USING (sku) LEFT JOIN seen USING (sku))"""

"""The engine's relations, read from the star-schema tables, and the same relations as SQL.

Every relation is one DataFrame with declared columns; scans read only what a
query selects, as nothing is cached or collected here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.prices import compare_price
from shelfwise.operators.windows import previous


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_key() -> Column:
    """Columns of parts, made when a query is built: a Column needs a session."""
    return F.col("p_partkey")


def part_size() -> Column:
    return F.col("p_size")


def part_price() -> Column:
    return F.col("p_retailprice")


def part_sku() -> Column:
    return F.col("p_partkey").cast("string").alias("sku")


def dated(df: DataFrame) -> DataFrame:
    """Dates as ISO text, the form in which results leave the engine."""
    return df.withColumns({name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "date"})


def canonical_id(sku: Column) -> Column:
    """A prefix and the SKU, padded to seven digits but never cut."""
    return F.concat(F.lit("ACT"), F.when(F.length(sku) >= 7, sku).otherwise(F.lpad(sku, 7, "0")))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    sku = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        sku.alias("sku"), canonical_id(sku).alias("canonical_id"), F.col("p_name").alias("name"), F.col("p_type").alias("cat1"),
        F.col("p_brand").alias("cat2"), F.col("p_size").cast("string").alias("spec"), F.col("p_retailprice").alias("current_price"),
    )


CATALOG = """catalog AS (
  SELECT p_partkey::VARCHAR AS sku, 'ACT' || CASE WHEN length(p_partkey::VARCHAR) >= 7 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 7, '0') END AS canonical_id,
         p_name AS name, p_type AS cat1, p_brand AS cat2, p_size::VARCHAR AS spec, p_retailprice AS current_price
  FROM part)"""


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, observed_at, seq keys, old_price, new_price, change_type): consecutive observed prices of a SKU."""
    seen = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("sku"), F.col("l_shipdate").alias("observed_at"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), F.col("l_extendedprice").alias("k3"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 10000 + 0.5) / 10000).alias("new_price"),
    )
    lagged = previous(seen, ["sku"], ["observed_at", "k1", "k2", "k3"], {"old_price": "new_price"})
    return lagged.withColumns(compare_price("old_price", "new_price"))


HISTORY = """history AS (
  SELECT *, CASE WHEN old_price IS NULL THEN 'NEW' WHEN abs(new_price - old_price) <= 1e-9 THEN 'UNCHANGED' WHEN new_price > old_price THEN 'UP' ELSE 'DOWN' END AS change_type
  FROM (
    SELECT l_partkey::VARCHAR AS sku, l_shipdate AS observed_at, l_orderkey AS k1, l_linenumber AS k2, l_extendedprice AS k3,
           floor(l_extendedprice / l_quantity * 10000 + 0.5) / 10000 AS new_price,
           lag(floor(l_extendedprice / l_quantity * 10000 + 0.5) / 10000) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS old_price
    FROM lineitem))"""

SOURCES = {"sitemap": "view", "listing": "click", "nuevo": "signup", "promo": "purchase"}


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, day, one flag for each source, failed): what the sources of a day say of a SKU."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku"), F.to_date("ts").alias("day"), "event_type")
    flags = [F.bool_or(F.col("event_type") == kind).alias(name) for name, kind in SOURCES.items()]
    return events.groupBy("sku", "day").agg(*flags, F.bool_or(F.col("event_type") == "error").alias("failed"))


PRESENCE = """presence AS (
  SELECT user_id::VARCHAR AS sku, ts::DATE AS day, bool_or(event_type = 'view') AS sitemap, bool_or(event_type = 'click') AS listing,
         bool_or(event_type = 'signup') AS nuevo, bool_or(event_type = 'purchase') AS promo, bool_or(event_type = 'error') AS failed
  FROM events GROUP BY 1, 2)"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, day, present): every SKU of the events on every day of them; days are few, so they go as an array."""
    seen = presence(spark, sf_dir).select("sku", "day", (F.col("sitemap") | F.col("listing") | F.col("nuevo") | F.col("promo")).alias("present"))
    span = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    skus = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku")).distinct()
    days = skus.join(F.broadcast(span)).select("sku", F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(seen, ["sku", "day"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


GRID = (
    PRESENCE
    + """,
grid AS (
  SELECT s.sku, d.day, coalesce(p.sitemap OR p.listing OR p.nuevo OR p.promo, false) AS present
  FROM (SELECT DISTINCT user_id::VARCHAR AS sku FROM events) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(ts::DATE) FROM events), (SELECT max(ts::DATE) FROM events), INTERVAL 1 DAY))::DATE AS day) d
  LEFT JOIN presence p ON p.sku = s.sku AND p.day = d.day)"""
)

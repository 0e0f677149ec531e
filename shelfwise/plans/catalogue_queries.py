"""Catalogue queries: filters, joins to latest changes and extrema, sort and page."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.identity import fact_hash, hash_split, multipart_hash, normal_hash, short_id, value_hash, persisted_hash
from shelfwise.functions.prices import discount, is_anomaly, parse_discount, parse_price
from shelfwise.operators.catalogue import CatalogueQuery, matched, natural_order, page, selection, with_price_facts
from shelfwise.operators.windows import keep_latest, latest, top_rank
from shelfwise.plans.registry import query
from shelfwise.sources.relations import CATALOG, HISTORY, catalog, price_history, table

FACTS = f"""{CATALOG}, {HISTORY},
last_change AS (
  SELECT sku, observed_at AS changed_at, change_type AS price_change, round(new_price - old_price, 4) AS change_amount,
         round(100 * (new_price - old_price) / nullif(old_price, 0), 4) AS change_percent
  FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM history) WHERE rn = 1),
extrema AS (
  SELECT sku, least(min(old_price), min(new_price)) AS historical_low, greatest(max(old_price), max(new_price)) AS historical_high FROM history GROUP BY sku),
facts AS (SELECT * FROM catalog LEFT JOIN last_change USING (sku) LEFT JOIN extrema USING (sku))"""
SHOWN = ["sku", "canonical_id", "name", "cat1", "cat2", "current_price", "price_change", "change_amount", "change_percent", "historical_low", "historical_high"]
COLUMNS = ", ".join(SHOWN)


def facts(spark, sf_dir):
    return with_price_facts(catalog(spark, sf_dir), price_history(spark, sf_dir))


@query(f"WITH {FACTS} SELECT {COLUMNS} FROM facts WHERE price_change = 'UP' AND current_price >= 900 ORDER BY change_percent DESC NULLS LAST, sku LIMIT 50")
def catalogue_page(spark, sf_dir):
    """Flagship: products whose last price change went up, by size of the change."""
    q = CatalogueQuery(price_change="UP", min_price=900.0, sort="change_percent", descending=True, limit=50)
    return page(matched(facts(spark, sf_dir), q), q).select(*SHOWN)


@query(f"WITH {FACTS} SELECT count(DISTINCT sku) AS matched_count, count(*) - count(DISTINCT sku) AS duplicates FROM facts WHERE price_change = 'DOWN'")
def catalogue_count(spark, sf_dir):
    found = matched(facts(spark, sf_dir), CatalogueQuery(price_change="DOWN"))
    return found.agg(F.countDistinct("sku").alias("matched_count"), (F.count(F.lit(1)) - F.countDistinct("sku")).alias("duplicates"))


@query(f"WITH {CATALOG} SELECT sku, name, cat1, current_price FROM catalog WHERE (lower(sku) LIKE '%1%' OR lower(name) LIKE '%1%') AND current_price BETWEEN 950 AND 1400")
def catalogue_keyword(spark, sf_dir):
    q = CatalogueQuery(keyword=" 1 ", min_price=950.0, max_price=1400.0)
    return matched(catalog(spark, sf_dir), q).select("sku", "name", "cat1", "current_price")


@query(f"WITH {FACTS} SELECT {COLUMNS} FROM facts WHERE abs(coalesce(change_amount, 0)) >= 100 AND coalesce(historical_low, current_price) <= 1000 AND coalesce(historical_high, current_price) >= 1500")
def catalogue_extrema(spark, sf_dir):
    q = CatalogueQuery(min_change_amount=100.0, historical_low_max=1000.0, historical_high_min=1500.0)
    return matched(facts(spark, sf_dir), q).select(*SHOWN)


@query(f"""WITH {CATALOG} SELECT sku, cat1, cat2 FROM catalog WHERE sku IN (SELECT user_id::VARCHAR FROM events WHERE event_type IN ('purchase', 'signup') AND strftime(ts, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-20')""")
def catalogue_events(spark, sf_dir):
    """Conditions on one and the same event row, as a semi-join."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("sku"), "event_type", F.date_format("ts", "yyyy-MM-dd").alias("occurred_at"))
    q = CatalogueQuery(event_types=("purchase", "signup"), event_from="2024-01-10", event_to="2024-01-20")
    return matched(catalog(spark, sf_dir), q, events).select("sku", "cat1", "cat2")


@query(f"""WITH {CATALOG}, e AS (SELECT DISTINCT user_id::VARCHAR AS sku FROM events WHERE event_type = 'purchase')
SELECT c.sku, e.sku IS NOT NULL AS purchased, c.current_price FROM catalog c LEFT JOIN e USING (sku) WHERE e.sku IS NOT NULL OR c.current_price < 950""")
def exists_or_price(spark, sf_dir):
    """EXISTS under OR: a flag from a left join."""
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("sku")).distinct().withColumn("_p", F.lit(True))
    joined = catalog(spark, sf_dir).join(bought, "sku", "left").withColumn("purchased", F.coalesce("_p", F.lit(False)))
    return joined.where(F.col("purchased") | (F.col("current_price") < 950)).select("sku", "purchased", "current_price")


@query(f"WITH {CATALOG} SELECT sku, name FROM (SELECT *, row_number() OVER (ORDER BY sku::BIGINT) AS n FROM catalog) WHERE n > 20 AND n <= 60")
def natural_sku_page(spark, sf_dir):
    return catalog(spark, sf_dir).orderBy(*natural_order()).offset(20).limit(40).select("sku", "name")


@query(f"WITH {HISTORY} SELECT sku, observed_at, old_price, new_price, change_type, round(new_price - old_price, 4) AS change_amount, round((new_price - old_price) / nullif(old_price, 0), 6) AS change_ratio FROM history")
def price_changes(spark, sf_dir):
    return price_history(spark, sf_dir).select("sku", "observed_at", "old_price", "new_price", "change_type", "change_amount", "change_ratio")


@query(f"WITH {HISTORY} SELECT sku, observed_at, new_price, change_type FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM history) WHERE rn = 1")
def latest_price(spark, sf_dir):
    return latest(price_history(spark, sf_dir), ["sku"], ["observed_at", "k1", "k2", "k3"], ["observed_at", "new_price", "change_type"])


@query(f"WITH {HISTORY} SELECT sku, change_type, observed_at, new_price FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY observed_at DESC, k1 DESC, k2 DESC, k3 DESC) AS rn FROM history) WHERE rn <= 3")
def latest_three_prices(spark, sf_dir):
    order = [F.col(c).desc() for c in ("observed_at", "k1", "k2", "k3")]
    return keep_latest(price_history(spark, sf_dir), ["sku"], order, 3).select("sku", "change_type", "observed_at", "new_price")


@query(f"WITH {HISTORY} SELECT change_type, count(*) AS n, min(new_price) AS lowest, max(new_price) AS highest FROM history GROUP BY change_type")
def change_histogram(spark, sf_dir):
    return price_history(spark, sf_dir).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"), F.min("new_price").alias("lowest"), F.max("new_price").alias("highest"))


@query(f"WITH {HISTORY} SELECT sku, count(*) AS anomalies FROM history WHERE new_price <= 0 OR new_price > 1500 GROUP BY sku")
def price_anomalies(spark, sf_dir):
    return price_history(spark, sf_dir).where(is_anomaly(F.col("new_price"), 1500.0)).groupBy("sku").agg(F.count(F.lit(1)).alias("anomalies"))


@query("""SELECT p_partkey, p_retailprice AS comma, p_retailprice AS point, floor(p_retailprice) AS whole, NULL::DOUBLE AS bad FROM part""")
def parsed_prices(spark, sf_dir):
    """Prices written in local forms are read back."""
    price = F.col("p_retailprice")
    local = F.translate(F.format_number(price, 2), ".,", ",.")
    return table(spark, sf_dir, "part").select(
        "p_partkey", parse_price(F.concat(local, F.lit(" €/ud."))).alias("comma"), parse_price(F.concat(F.lit("€ "), F.format_number(price, 2))).alias("point"),
        parse_price(F.translate(F.format_number(F.floor(price), 0), ",", ".")).alias("whole"), parse_price(F.lit("N/A")).alias("bad"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, round(-l_discount, 6) AS parsed, CASE WHEN l_discount > 0 AND l_discount < 1 THEN -l_discount ELSE round((l_extendedprice * (1 - l_discount) - l_extendedprice) / nullif(l_extendedprice, 0), 6) END AS discount
FROM lineitem WHERE l_discount > 0""")
def parsed_discounts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_discount > 0")
    text = F.concat(F.lit("-"), F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    original = F.col("l_extendedprice")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", parse_discount(text).alias("parsed"), discount(original * (1 - F.col("l_discount")), original, -F.col("l_discount")).alias("discount"))


@query("""SELECT p_partkey, sha256(trim(p_name) || chr(31) || trim(p_brand) || chr(31) || p_size::VARCHAR || chr(31)) AS content_hash,
  sha256(coalesce(p_type, '')) AS value_hash, substr(sha256(p_partkey::VARCHAR || chr(31) || p_brand), 1, 24) AS review_id,
  CASE WHEN lower(trim(p_type)) NOT IN ('', 'none', 'null', 'nan') THEN lower(trim(p_type)) END AS normal FROM part""")
def content_hashes(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", multipart_hash(F.col("p_name"), F.col("p_brand"), F.col("p_size")).alias("content_hash"), value_hash(F.col("p_type")).alias("value_hash"),
        short_id(F.col("p_partkey"), F.col("p_brand")).alias("review_id"), normal_hash(F.col("p_type")).alias("normal"),
    )


@query("""SELECT p_partkey, ('0x' || substr(sha256(p_brand || p_size::VARCHAR), 1, 8))::BIGINT / 4294967295.0::DOUBLE < 0.2 AS in_test FROM part""")
def hashed_split(spark, sf_dir):
    """A leak-free split: all rows of a group fall on one side."""
    return table(spark, sf_dir, "part").select("p_partkey", hash_split(F.concat("p_brand", F.col("p_size").cast("string")), 0.2).alias("in_test"))


@query("""SELECT o_custkey, CASE WHEN lo IS NOT DISTINCT FROM hi THEN lo END AS o_orderpriority, lo IS DISTINCT FROM hi AS conflict
FROM (SELECT o_custkey, min(o_orderpriority) AS lo, max(o_orderpriority) AS hi FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC) AS r FROM orders) WHERE r = 1 GROUP BY o_custkey)""")
def top_rank_conflicts(spark, sf_dir):
    """The value at the best rank; differing ties are a conflict."""
    return top_rank(table(spark, sf_dir, "orders"), ["o_custkey"], [F.to_date("o_orderdate").desc()], "o_orderpriority")


@query(f"WITH {CATALOG} SELECT '" + CatalogueQuery(cat2=("Brand#11", "Brand#12", "Brand#21")).digest() + "' AS query_hash, sku FROM catalog WHERE coalesce(cat2, '') IN ('Brand#11', 'Brand#12', 'Brand#21')")
def frozen_selection(spark, sf_dir):
    q = CatalogueQuery(cat2=("Brand#11", "Brand#12", "Brand#21"))
    return selection(matched(catalog(spark, sf_dir), q), q)


@query("""SELECT n_name, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance, count(DISTINCT c_custkey) AS kinds
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE' GROUP BY n_name, c_mktsegment""")
def segment_profile(spark, sf_dir):
    """Chained inner joins; dimensions of fixed size are small enough for Spark to broadcast."""
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = joined.join(table(spark, sf_dir, "region").where("r_name = 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"), F.countDistinct("c_custkey").alias("kinds"))


@query("""WITH f AS (SELECT p_partkey, [' ' || p_name || chr(9), p_type, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END, p_size::VARCHAR, CASE WHEN p_size % 5 = 0 THEN '' ELSE 'd' END, NULL, 'https://x.example/' || p_partkey, CASE WHEN p_size % 2 = 0 THEN 'i' END] AS x FROM part)
SELECT p_partkey, sha256(array_to_string(list_transform(x, lambda v: coalesce(regexp_replace(v, '^[\\s]+|[\\s]+$', '', 'g'), chr(0)) || chr(31)), '')) AS facts, CASE p_partkey % 4 WHEN 0 THEN 'ABc' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'x' END AS stored FROM f""")
def fact_hashes(spark, sf_dir):
    """Content hashes over all eight facts, of which some are absent and some empty."""
    size = F.col("p_size")
    facts = {
        "name_es": F.concat(F.lit(" "), "p_name", F.lit("\t")), "cat1_es": F.col("p_type"), "cat2_es": F.when(size % 3 != 0, F.col("p_brand")), "spec_es": size.cast("string"), "desc_es": F.when(size % 5 == 0, "").otherwise("d"),
        "product_url": F.concat(F.lit("https://x.example/"), F.col("p_partkey").cast("string")), "image_url": F.when(size % 2 == 0, "i"),
    }
    stored = F.get(F.array(F.lit(" ABc "), F.lit(" N/A"), F.lit(" "), F.lit("x")), (F.col("p_partkey") % 4).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", fact_hash(facts).alias("facts"), persisted_hash(stored).alias("stored"))

"""Dictionary resolution, scoped rules, terminology, translation memory, evidence, sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators.resolution import longest_match, memory_lookup, resolve, scoped_rules, select_evidence, term_matches
from shelfwise.plans.registry import query
from shelfwise.sources.files import merge_sheets, seed_matrix, sitemap_skus
from shelfwise.sources.relations import CATALOG, catalog, table


@query(f"""WITH {CATALOG}, m AS (SELECT p_partkey::VARCHAR AS sku, upper(p_name) AS v FROM part WHERE p_partkey % 10 = 0), d AS (SELECT p_brand AS cat2, 'brand ' || min(p_brand) AS v FROM part WHERE p_brand LIKE '%1' GROUP BY 1)
SELECT sku, CASE WHEN sku::BIGINT % 13 = 0 THEN NULL ELSE coalesce(m.v, d.v, name) END AS value, CASE WHEN sku::BIGINT % 13 = 0 THEN 'SOURCE_BLOCKED' WHEN m.v IS NOT NULL THEN 'MANUAL' WHEN d.v IS NOT NULL THEN 'TERM' ELSE 'FALLBACK' END AS source
FROM catalog LEFT JOIN m USING (sku) LEFT JOIN d USING (cat2)""")
def resolved_names(spark, sf_dir):
    """Precedence manual, term, fallback; blocked sources never fall back."""
    base = catalog(spark, sf_dir)
    manual = base.where("CAST(sku AS LONG) % 10 = 0").select("sku", F.upper("name").alias("m"))
    brands = base.where("cat2 LIKE '%1'").groupBy("cat2").agg(F.concat(F.lit("brand "), F.min("cat2")).alias("d"))
    value, source = resolve([("MANUAL", F.col("m")), ("TERM", F.col("d")), ("FALLBACK", F.col("name"))], F.col("sku").cast("long") % 13 == 0)
    return base.join(manual, "sku", "left").join(brands, "cat2", "left").select("sku", value.alias("value"), source.alias("source"))


RULES = """rules AS (
  SELECT p_type AS cat1, NULL::VARCHAR AS cat2, 'type ' || p_type AS target FROM part GROUP BY p_type
  UNION ALL SELECT p_type, p_brand, 'pair ' || p_type || p_brand FROM part WHERE p_size > 45 GROUP BY p_type, p_brand
  UNION ALL SELECT p_type, p_brand, 'other ' || p_type FROM part WHERE p_size > 48 GROUP BY p_type, p_brand)"""


@query(f"""WITH {CATALOG}, {RULES}, j AS (SELECT c.sku, c.cat1, c.cat2, r.target, rank() OVER (PARTITION BY c.sku ORDER BY CASE WHEN r.cat2 IS NULL THEN 0 ELSE 1 END DESC) AS k
  FROM catalog c JOIN rules r ON r.cat1 = c.cat1 AND (r.cat2 IS NULL OR r.cat2 = c.cat2))
SELECT sku, cat1, cat2, CASE WHEN min(target) = max(target) THEN min(target) END AS target, min(target) <> max(target) AS conflict FROM j WHERE k = 1 GROUP BY sku, cat1, cat2""")
def scoped_targets(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    kind, brand = F.col("p_type"), F.col("p_brand")
    wide = parts.select(kind.alias("cat1"), F.lit(None).cast("string").alias("cat2"), F.concat(F.lit("type "), kind).alias("target")).distinct()
    pair = parts.where("p_size > 45").select(kind.alias("cat1"), brand.alias("cat2"), F.concat(F.lit("pair "), kind, brand).alias("target")).distinct()
    other = parts.where("p_size > 48").select(kind.alias("cat1"), brand.alias("cat2"), F.concat(F.lit("other "), kind).alias("target")).distinct()
    return scoped_rules(catalog(spark, sf_dir).select("sku", "cat1", "cat2"), wide.union(pair).union(other), ["cat2"], "cat1")


GRAMS = """w AS (SELECT item_id AS doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM w, (VALUES (1), (2), (3), (4)) v(n) WHERE len(w) >= n)),
t AS (SELECT array_to_string(list_filter(string_split_regex(lower(term), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''), ' ') AS g, term, target FROM (
  SELECT array_to_string(string_split(text, ' ')[1:2], ' ') AS term, item_id::VARCHAR AS target FROM benchmark)),
hits AS (SELECT DISTINCT doc_id, term, target FROM g JOIN t USING (g) WHERE g <> '')"""


def benchmark_terms(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 2), " ").alias("term"), F.col("item_id").cast("string").alias("target"))


@query(f"WITH {GRAMS} SELECT * FROM hits")
def terminology_hits(spark, sf_dir):
    """Terms that stand in texts: an equality of word n-grams."""
    return term_matches(table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id"), benchmark_terms(spark, sf_dir), "doc_id", "text")


@query(f"WITH {GRAMS} SELECT doc_id, arg_max(term, (length(term), term)) AS term, arg_max(target, (length(term), term, target)) AS target FROM hits GROUP BY doc_id")
def longest_terms(spark, sf_dir):
    hits = term_matches(table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "doc_id"), benchmark_terms(spark, sf_dir), "doc_id", "text")
    one = hits.groupBy("doc_id", "term").agg(F.max("target").alias("target"))
    return longest_match(one, "doc_id")


@query(f"WITH {GRAMS.replace('SELECT item_id AS doc_id, list_filter', 'SELECT doc_id, list_filter', 1).replace('FROM benchmark),', 'FROM documents),', 1)} SELECT * FROM hits")
def document_terms(spark, sf_dir):
    """The benchmark's terms that stand in whole documents."""
    return term_matches(table(spark, sf_dir, "documents"), benchmark_terms(spark, sf_dir), "doc_id", "text")


@query("""WITH m AS (SELECT o_orderpriority AS a, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS b, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS target FROM orders GROUP BY 1, 2),
r AS (SELECT DISTINCT o_orderpriority AS a, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS b FROM orders)
SELECT r.a, r.b, m.target FROM r LEFT JOIN m ON r.a IS NOT DISTINCT FROM m.a AND r.b IS NOT DISTINCT FROM m.b""")
def memory_hits(spark, sf_dir):
    """Null-safe scope equality; the newest entry wins."""
    orders = table(spark, sf_dir, "orders")
    scope = lambda out: F.when(F.col("o_orderstatus") != out, F.col("o_orderstatus")).alias("b")
    memory = orders.select(F.col("o_orderpriority").alias("a"), scope("P"), F.col("o_orderkey").alias("target"), F.struct("o_orderdate", "o_orderkey").alias("created_at"))
    return memory_lookup(orders.select(F.col("o_orderpriority").alias("a"), scope("F")).distinct(), memory, ["a", "b"])


@query("""WITH e AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END AS r, (value > 50)::VARCHAR AS v, ts, event_id FROM events),
k AS (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY r) AS n FROM e)
SELECT user_id, CASE WHEN count(DISTINCT v) <= 1 THEN arg_max(v, (ts, event_id)) END AS v, count(DISTINCT v) > 1 AS conflict FROM k WHERE n = 1 GROUP BY user_id""")
def chosen_evidence(spark, sf_dir):
    rank = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2).otherwise(3)
    evidence = table(spark, sf_dir, "events").select("user_id", rank.alias("rank"), (F.col("value") > 50).cast("string").alias("v"), F.col("ts").alias("observed_at"), F.col("event_id").alias("reference"))
    return select_evidence(evidence, "user_id", "v")


@query("""SELECT s_suppkey, d AS day, p AS presence FROM (SELECT s_suppkey, unnest(['2026-07-01', '2026-07-02', '2026-07-03']) AS d, unnest([1, CASE WHEN s_suppkey % 2 = 0 THEN 0 END, NULL]) AS p FROM supplier)""")
def seeded_presence(spark, sf_dir):
    """A wide matrix with blanks to tri-state rows."""
    wide = table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("1").alias("26.07.01"), F.when(F.col("s_suppkey") % 2 == 0, "0").otherwise(" ").alias("26.07.02"), F.lit("UNKNOWN").alias("26.07.03"))
    return seed_matrix(wide, ["s_suppkey"]).withColumn("day", F.col("day").cast("string"))


@query("""SELECT s_suppkey::VARCHAR AS sku, 'https://shop.example/es/p/' || s_suppkey || '/item' AS url FROM supplier""")
def sitemap_urls(spark, sf_dir):
    key = F.col("s_suppkey").cast("string")
    one = F.concat(F.lit("<url><loc> https://shop.example/es/p/"), key, F.lit("/item </loc></url><url><loc>https://shop.example/es/p/"), key, F.lit("/later</loc></url><loc>https://shop.example/about</loc>"))
    return sitemap_skus(table(spark, sf_dir, "supplier").select(one.alias("xml")))


@query("""SELECT coalesce(a.k, b.k) AS k, coalesce(a.name, b.name) AS name FROM (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS name FROM nation WHERE n_nationkey < 20) a
FULL JOIN (SELECT n_nationkey AS k, lower(n_name) AS name FROM nation WHERE n_nationkey > 5) b ON a.k = b.k""")
def merged_sheets(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    first = rows.where("k < 20").withColumn("name", F.when(F.col("k") % 2 == 0, F.col("name")))
    return merge_sheets(first, rows.where("k > 5").withColumn("name", F.lower("name")), "k", ["name"])

"""Evidence of single fields: prices, staleness, addresses, badges, contamination, hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import evidence as e
from shelfwise.functions.identity import multipart_hash
from shelfwise.plans.registry import query
from shelfwise.sources.relations import table, part_key, part_price, part_size


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query("""SELECT p_partkey, p_partkey % 7 <> 0 AND (p_size <> 3 OR p_partkey % 2 = 0) AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AS complete FROM part""")
def price_evidence(spark, sf_dir):
    """A complete observation says so and shows nothing unreadable."""
    whole = F.when(part_size() == 3, "0").otherwise(F.floor(part_price()).cast("string"))
    original = F.when(part_key() % 11 == 0, "n/a").when(part_key() % 2 == 0, "1.234,50 €").otherwise(" ")
    discount = F.when(part_key() % 13 == 0, "abc").when(part_key() % 3 == 0, "-19%").otherwise("")
    return parts(spark, sf_dir).select("p_partkey", e.complete_price(part_key() % 7 != 0, whole, F.when(part_key() % 2 == 0, "50").otherwise(""), original, discount).alias("complete"))


@query("""SELECT p_partkey, p_partkey % 5 <> 4 AS valid, CASE WHEN p_partkey % 5 IN (0, 1) THEN p_size + 0.5 END AS price, (p_size + 0.5) AS prefix FROM part""")
def optional_prices(spark, sf_dir):
    text = F.when(part_key() % 5 == 0, F.concat(part_size().cast("string"), F.lit(",5"))).when(part_key() % 5 == 1, F.concat(F.lit(" "), part_size().cast("string"), F.lit(".5 "))).when(part_key() % 5 == 2, "  ").when(part_key() % 5 == 4, "NaN")
    valid, price = e.optional_price(text)
    return parts(spark, sf_dir).select("p_partkey", valid.alias("valid"), price.alias("price"), e.numeric_prefix(F.concat(part_size().cast("string"), F.lit(",5 €/kg"))).alias("prefix"))


@query("""WITH s AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 10 <> 0 THEN ts END AS seen, CASE event_id % 6 WHEN 0 THEN 'PENDING' WHEN 1 THEN NULL ELSE 'complete' END AS status, CASE event_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN '' ELSE 'b' END AS dh, CASE event_id % 5 WHEN 0 THEN NULL ELSE 'b' END AS sh FROM events)
SELECT event_id, CASE WHEN seen IS NULL THEN false ELSE upper(coalesce(status, 'COMPLETE')) <> 'COMPLETE' OR (dh <> '' AND coalesce(sh, '') <> '' AND dh <> sh) OR TIMESTAMP '2024-01-20' - seen >= INTERVAL 7 DAY END AS planned,
  seen IS NULL OR upper(coalesce(status, '')) <> 'COMPLETE' OR (coalesce(sh, '') <> '' AND dh <> sh) OR TIMESTAMP '2024-01-20' - seen > INTERVAL 7 DAY AS stale FROM s""")
def detail_staleness(spark, sf_dir):
    """The two rules of staleness, which differ in unknown times, unknown states and the last moment."""
    k, now = F.col("event_id"), F.lit("2024-01-20").cast("timestamp")
    at = F.when(k % 10 != 0, F.col("ts").cast("timestamp"))
    status, detail, source = F.when(k % 6 == 0, "PENDING").when(k % 6 != 1, "complete"), F.when(k % 4 == 0, "a").when(k % 4 == 1, "").otherwise("b"), F.when(k % 5 != 0, "b")
    return table(spark, sf_dir, "events").select("event_id", e.stale_for_planning(at, status, detail, source, now, 7).alias("planned"), e.stale_detail(at, status, detail, source, now, 7).alias("stale"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'https://shop.example.com/es/p/' || p_partkey || '/lamp' WHEN 1 THEN 'https://shop.example.com/es/p/' || p_partkey || '/' WHEN 2 THEN '' ELSE '' END AS url FROM part""")
def verified_urls(spark, sf_dir):
    own = lambda scheme, sku, tail: F.concat(F.lit(f"{scheme}://shop.example.com/es/p/"), sku.cast("string"), F.lit(tail))
    first = F.when(part_key() % 4 == 0, own("https", part_key(), "/lamp")).when(part_key() % 4 == 1, own("http", part_key(), "/x")).when(part_key() % 4 == 2, own("https", part_key() + 1, "/x"))
    second = F.when(part_key() % 4 == 1, own("https", part_key(), "/")).when(part_key() % 4 == 3, F.lit("not an address"))
    return parts(spark, sf_dir).select("p_partkey", e.verified_url(part_key().cast("string"), "shop.example.com", "/es/p/", first, second).alias("url"))


def part_tags():
    return F.concat_ws(
        " | ", F.when(part_key() % 2 == 0, "Nuevo"), F.when(part_key() % 3 == 0, F.concat(F.lit("Promoción semanal "), (part_key() % 31).cast("string"), F.lit("/2 - "), (part_key() % 28 + 1).cast("string"), F.lit("/3"))),
        F.when(part_key() % 5 == 0, F.concat(F.lit("-"), (part_key() % 60 + 1).cast("string"), F.lit("%"))), F.when(part_key() % 7 == 0, "Más sostenible"),
    )


@query("""SELECT p_partkey, p_partkey % 3 = 0 AS promotion_active, p_partkey % 2 = 0 AS new_badge, p_partkey % 7 = 0 AS sustainable_badge, CASE WHEN p_partkey % 5 = 0 THEN round(-(p_partkey % 60 + 1) / 100.0, 6)::DOUBLE END AS discount,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 31 BETWEEN 1 AND 29 THEN strftime(make_date(2024, 2, (p_partkey % 31)::INT), '%Y-%m-%d') END AS promotion_start, CASE WHEN p_partkey % 3 = 0 THEN strftime(make_date(2024, 3, (p_partkey % 28 + 1)::INT), '%Y-%m-%d') END AS promotion_end FROM part""")
def badge_facts(spark, sf_dir):
    """Dates no calendar has are null."""
    facts = e.badge_facts(part_tags(), F.lit(2024))
    return parts(spark, sf_dir).select("p_partkey", *[(v.cast("string") if k.startswith("promotion_") and k != "promotion_active" else v).alias(k) for k, v in facts.items()])


@query("""SELECT p_partkey, concat_ws(' | ', CASE WHEN p_partkey % 5 = 0 AND p_size % 2 = 0 THEN '-' || (p_partkey % 60 + 1) || '%' END, CASE WHEN p_partkey % 7 = 0 THEN 'Más sostenible' END, CASE WHEN p_size % 3 = 0 THEN 'Nuevo' END,
  CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'Promoción semanal ' || (p_partkey % 31) || '/2 - ' || (p_partkey % 28 + 1) || '/3' ELSE 'Promoción semanal' END END) AS tags FROM part""")
def badge_states(spark, sf_dir):
    """Badges rebuilt from page membership."""
    return parts(spark, sf_dir).select("p_partkey", e.badge_state(part_tags(), part_size() % 3 == 0, part_size() % 2 == 0).alias("tags"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'CLEAN' WHEN 1 THEN 'CONTAMINATED_UNIT_PRICE' WHEN 2 THEN 'CONTAMINATED_PROCESS_NOTE' WHEN 3 THEN 'VALID_PROMOTION' WHEN 4 THEN 'CONTAMINATED_BADGE_LEAKAGE' ELSE 'CLEAN' END AS own,
  CASE p_partkey % 6 WHEN 1 THEN 'CONTAMINATED_UNIT_PRICE' WHEN 2 THEN 'CONTAMINATED_PROCESS_NOTE' ELSE 'CLEAN' END AS in_channel, p_partkey % 6 = 5 AS interface FROM part""")
def promotion_classes(spark, sf_dir):
    texts = F.element_at(F.array(*[F.lit(t) for t in (" ", "2,50 €/kg con descuento", "Workflow oferta", "Oferta nuevo", "Nuevo", " Leer MÁS")]), (part_key() % 6 + 1).cast("int"))
    return parts(spark, sf_dir).select("p_partkey", e.promotion_class(texts).alias("own"), e.promotion_class(texts, F.lit(True)).alias("in_channel"), e.is_interface_text(texts).alias("interface"))


@query("""SELECT p_partkey, p_size % 3 = 0 AS flag, p_size % 4 = 0 AS cjk, CASE p_size % 4 WHEN 0 THEN '2 €/千克' WHEN 1 THEN '2 €/升' WHEN 2 THEN '2 €/次洗涤' ELSE '2 €/件' END AS unit, lower(p_name) AS key FROM part""")
def coercions(spark, sf_dir):
    flag = F.element_at(F.array(F.lit(" YES "), F.lit("0"), F.lit("no")), (part_size() % 3 + 1).cast("int"))
    unit = F.element_at(F.array(F.lit("2 €/kg"), F.lit("2 €/L"), F.lit("2 €/lav"), F.lit("2 €/ud.")), (part_size() % 4 + 1).cast("int"))
    return parts(spark, sf_dir).select("p_partkey", e.to_bool(flag).alias("flag"), e.has_cjk(F.when(part_size() % 4 == 0, "a 中 b").otherwise("abc")).alias("cjk"), e.unit_price_text(unit).alias("unit"), e.category_key(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("key"))


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) || ' cafe' AS family, CASE p_size % 5 WHEN 0 THEN 'mass' WHEN 1 THEN 'volume' WHEN 2 THEN 'length' WHEN 3 THEN 'count' ELSE 'xyz' END AS kind FROM part""")
def family_keys(spark, sf_dir):
    name = F.concat_ws(" ", "p_name", F.lit("Café"), F.concat(part_size().cast("string"), F.lit(",5 ml")), F.lit("varios colores"))
    unit = F.element_at(F.array(*[F.lit(u) for u in ("KG", "ml.", "cm", "Uds.", "xyz")]), (part_size() % 5 + 1).cast("int"))
    return parts(spark, sf_dir).select("p_partkey", e.family_key(name).alias("family"), e.measure_kind(unit).alias("kind"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Material del cuerpo: ' || p_type ELSE 'Color: ' || p_type END AS label, CASE p_size % 3 WHEN 0 THEN 'SOURCE_PROSE_TYPO' WHEN 1 THEN 'SOURCE_PHYSICAL_STATE_INVALID' ELSE '' END AS codes FROM part""")
def repaired_labels(spark, sf_dir):
    label = F.when(part_size() % 2 == 0, F.concat(F.lit(" Material: del cuerpo: "), "p_type")).otherwise(F.concat(F.lit("Color: "), "p_type", F.lit(" ")))
    found = e.source_findings(F.when(part_size() % 3 == 0, "velas Inoloras").otherwise("inoloras2"), F.when(part_size() % 3 == 1, "Peso: 1; sustancia : es Válido").otherwise("Sustancia: a; Válido"))
    return parts(spark, sf_dir).select("p_partkey", e.repaired_label(label).alias("label"), F.array_join(found, ",").alias("codes"))


@query("""SELECT p_partkey, sha256(trim(p_name) || chr(31) || trim(p_type) || chr(31) || chr(31) || p_size::VARCHAR || chr(31)) AS localization_hash, sha256(trim(p_name) || chr(31)) AS name_hash,
  sha256(p_retailprice::VARCHAR || chr(31) || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END || chr(31)) AS price_hash,
  sha256('{"brand":' || CASE WHEN p_size = 1 THEN 'null' ELSE '"' || p_brand || '"' END || ',"name":"' || p_name || '"}') AS source_hash,
  sha256('["' || p_partkey || '","' || p_brand || '"]') AS queue_id, sha256('PRICE|CURRENT|' || p_partkey || '||' || p_brand || '|') AS issue FROM part""")
def evidence_hashes(spark, sf_dir):
    """Hashes of several fields, one field, prices, canonical JSON, a queue's entry and an issue."""
    sku = part_key().cast("string")
    return parts(spark, sf_dir).select(
        "p_partkey", e.localization_source_hash(F.col("p_name"), F.col("p_type"), F.lit(None).cast("string"), part_size()).alias("localization_hash"), e.localization_source_hash(F.col("p_name")).alias("name_hash"),
        multipart_hash(part_price(), part_size() % 2 == 0).alias("price_hash"), e.json_hash(name=F.col("p_name"), brand=F.when(part_size() != 1, F.col("p_brand"))).alias("source_hash"), e.list_hash(sku, F.col("p_brand")).alias("queue_id"),
        e.issue_id(F.lit("PRICE"), F.lit("CURRENT"), sku, F.lit(None), F.col("p_brand"), F.lit(None)).alias("issue"),
    )


@query("""WITH h AS (SELECT l_returnflag, sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_linestatus) AS d FROM lineitem)
SELECT l_returnflag, count(*) AS n, sum(('0x' || substr(d, 1, 15))::BIGINT)::VARCHAR AS low, sum(('0x' || substr(d, 16, 15))::BIGINT)::VARCHAR AS high FROM h GROUP BY l_returnflag""")
def rows_digests(spark, sf_dir):
    """A digest of rows that does not hang on their order and needs no sort."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", e.issue_id(*[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")]).alias("d"))
    low, high = e.rows_digest(F.col("d"))
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), low.cast("string").alias("low"), high.cast("string").alias("high"))

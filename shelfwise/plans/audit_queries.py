"""Gates, eligibility, evidence and dictionary checks over the star-schema tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.texts import is_blank
from shelfwise.operators import audits as a
from shelfwise.operators.upserts import keyed_difference
from shelfwise.plans.registry import query
from shelfwise.sources.full_catalogue import FULL, event_history, full_rows, images, localizations, products
from shelfwise.sources.relations import HISTORY, part_key, part_price, part_size, part_sku, price_history, table

FIELDS = ["name", "cat1", "cat2", "spec", "description", "details"]
BLANK_ES = " OR ".join(f"coalesce(trim(es_{c}), '') = ''" for c in FIELDS)
BLANK_ZH = " OR ".join(f"coalesce(trim(zh_{c}), '') = ''" for c in FIELDS)
BARE = " UNION ALL ".join(f"SELECT sku, 'PROVENANCE_{c.upper()}' AS rule FROM full_rows WHERE coalesce(trim(zh_{c}), '') <> '' AND sku::BIGINT % 23 = {i}" for i, c in enumerate(FIELDS))


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query(f"""WITH {FULL}
SELECT sku, 'PRICE' AS rule FROM full_rows WHERE current_price IS NULL OR current_price <= 0 UNION ALL SELECT sku, 'PROMOTION_WITHOUT_ORIGINAL' FROM full_rows WHERE promotion AND original_price IS NULL
UNION ALL SELECT sku, 'SOURCE_INCOMPLETE' FROM full_rows WHERE {BLANK_ES} UNION ALL SELECT sku, 'TARGET_INCOMPLETE' FROM full_rows WHERE {BLANK_ZH}
UNION ALL SELECT sku, 'DUPLICATE_SKU' FROM full_rows GROUP BY sku HAVING count(*) > 1 UNION ALL {BARE}""")
def master_gate(spark, sf_dir):
    """Faults of master rows; in this table one field of each 23rd product lacks its provenance."""
    held = parts(spark, sf_dir).select(part_sku(), F.explode(F.array(*[F.when(part_key() % 23 != i, c) for i, c in enumerate(FIELDS)])).alias("field")).where("field IS NOT NULL")
    return a.master_findings(full_rows(spark, sf_dir, ()), held, FIELDS)


@query(f"""WITH {FULL} SELECT count(*) FILTER (status = 'CURRENT') AS current, count(*) - count(DISTINCT sku) AS duplicate_sku, count(*) FILTER (status = 'CURRENT' AND (current_price IS NULL OR current_price <= 0)) AS invalid_price,
count(*) FILTER (status = 'CURRENT' AND coalesce(trim(product_url), '') = '') AS missing_product_url, count(*) FILTER (status NOT IN ('CURRENT', 'OFFLINE', 'UNKNOWN')) AS lifecycle_exceptions FROM products""")
def operations_quality(spark, sf_dir):
    """Counts of a status page, summed by SKU and then over all."""
    k = F.col("sku").cast("long")
    rows = products(spark, sf_dir).withColumn("current_price", F.when(k % 17 != 0, F.col("raw_price")))
    here = F.col("status") == "CURRENT"
    checks = {"current": here, "invalid_price": here & (F.col("current_price").isNull() | (F.col("current_price") <= 0)), "missing_product_url": here & is_blank(F.col("product_url")), "lifecycle_exceptions": ~F.col("status").isin("CURRENT", "OFFLINE", "UNKNOWN")}
    by_sku = rows.groupBy("sku").agg((F.count(F.lit(1)) - 1).alias("duplicate_sku"), *[F.count_if(check).alias(name) for name, check in checks.items()])
    return by_sku.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("current", "duplicate_sku", "invalid_price", "missing_product_url", "lifecycle_exceptions")])


@query(f"""WITH {FULL}, p AS (SELECT sku FROM products WHERE status <> 'MISSING')
SELECT 'ORPHAN_EVENT' AS rule, sku, count(*) AS n FROM event_history WHERE sku NOT IN (SELECT sku FROM p) GROUP BY sku UNION ALL SELECT 'ORPHAN_PRICE', sku, count(*) FROM history WHERE sku NOT IN (SELECT sku FROM p) GROUP BY sku
UNION ALL SELECT 'EVENT_DOMAIN', sku, count(*) FROM event_history WHERE event_type NOT IN ('FIRST_SEEN', 'PRICE_DOWN', 'NEW_BADGE_ON', 'REAPPEARED') GROUP BY sku""")
def database_findings(spark, sf_dir):
    """Rows without a parent and values outside their domain, counted by SKU before they meet their parents: a row for each SKU is sorted, not one for each price."""
    known = products(spark, sf_dir).where("status <> 'MISSING'").select("sku")
    events = event_history(spark, sf_dir)
    odd = events.where(~F.col("event_type").isin("FIRST_SEEN", "PRICE_DOWN", "NEW_BADGE_ON", "REAPPEARED"))
    counted = lambda df: df.groupBy("sku").agg(F.count(F.lit(1)).alias("n"))
    # a left join: an anti join would be moved below the counts, and sort all prices where the parents are no small table
    parent = known.distinct().withColumn("_parent", F.lit(True))
    lone = lambda df: counted(df).join(parent, "sku", "left").where("_parent IS NULL")
    found = [("ORPHAN_EVENT", lone(events)), ("ORPHAN_PRICE", lone(price_history(spark, sf_dir))), ("EVENT_DOMAIN", counted(odd))]
    rows = [df.select(F.lit(rule).alias("rule"), "sku", "n") for rule, df in found]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query("""WITH f AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS sku, p_name AS source, p_brand AS current, p_type AS reviewed FROM part)
SELECT sku, (k % 3 <> 2 AND k % 5 <> 1 AND k % 7 <> 3 AND DATE '1998-01-01' + (k % 40)::INT <= DATE '1998-01-31' AND DATE '1998-01-31' < DATE '1998-01-01' + (k % 40)::INT + (CASE WHEN k % 4 = 0 THEN 91 ELSE 30 END) AND k % 4 <> 0) AS suppressed FROM f""")
def difference_whitelist(spark, sf_dir):
    """Confirmed differences whose three hashes still hold, for 90 days at most."""
    k = part_key()
    field = F.lit("name").alias("field")
    findings = parts(spark, sf_dir).select(part_sku(), field, F.md5("p_name").alias("source_hash"), F.md5("p_brand").alias("current_hash"), F.md5("p_type").alias("reviewed_hash"))
    since = F.date_add(F.lit("1998-01-01").cast("date"), (k % 40).cast("int"))
    entries = parts(spark, sf_dir).select(
        part_sku(), field, F.md5(F.when(k % 5 == 1, "old").otherwise(F.col("p_name"))).alias("source_hash"), F.md5("p_brand").alias("current_hash"), F.md5(F.when(k % 7 == 3, "old").otherwise(F.col("p_type"))).alias("reviewed_hash"),
        F.when(k % 3 == 2, "DRAFT").otherwise("CONFIRMED").alias("status"), since.alias("reviewed_at"), F.date_add(since, F.when(k % 4 == 0, 91).otherwise(30)).alias("expires_at"),
    )
    return a.suppressed(findings, entries, F.lit("1998-01-31").cast("date")).select("sku", "suppressed")


MISSING = " || ".join(f"CASE WHEN coalesce(trim(zh_{c}), '') = '' AND coalesce(trim(es_{c}), '') <> '' THEN '{c}|' ELSE '' END" for c in FIELDS)


@query(f"""WITH {FULL}, m AS (SELECT sku, zh_review_status, rtrim({MISSING}, '|') AS missing FROM full_rows)
SELECT sku, missing, CASE WHEN missing <> '' OR zh_review_status IS NULL THEN 'PENDING' ELSE zh_review_status END AS formal_status, CASE WHEN missing <> '' THEN 'ES' END AS display_fallback FROM m""")
def formal_targets(spark, sf_dir):
    """What may be published in the target language; source text is never put in its place."""
    both = localizations(spark, sf_dir)
    es = both.where("language = 'es'").select("sku", *[F.col(c).alias(f"es_{c}") for c in FIELDS])
    zh = both.where("language = 'zh'").select("sku", "review_status", *FIELDS)
    return a.formal_target(es.join(zh, "sku", "left"), {c: f"es_{c}" for c in FIELDS}, "review_status").select("sku", "missing", "formal_status", "display_fallback")


@query(f"WITH {FULL} SELECT sku, CASE WHEN sku::BIGINT % 4 = 0 THEN 'NO_LOCALIZATION' WHEN sku::BIGINT % 12 = 1 THEN 'NO_FRESHNESS_STATUS' ELSE zh_freshness_status END AS freshness FROM full_rows")
def freshness_statuses(spark, sf_dir):
    """Freshness of a target row, where there is one."""
    k = F.col("sku").cast("long")
    zh = localizations(spark, sf_dir).where("language = 'zh'").select("sku", F.when(k % 12 != 1, F.col("freshness_status")).alias("status"), F.lit(True).alias("there"))
    return parts(spark, sf_dir).select(part_sku()).join(zh, "sku", "left").select("sku", a.freshness(F.col("status"), F.coalesce("there", F.lit(False))).alias("freshness"))


@query("""SELECT o_orderkey AS run_id, CASE o_orderkey % 6 WHEN 0 THEN false WHEN 1 THEN o_custkey % 2 = 0 WHEN 2 THEN o_custkey % 3 <> 0 WHEN 3 THEN o_custkey % 3 <> 0 WHEN 4 THEN true ELSE false END AS allowed FROM orders""")
def commit_permissions(spark, sf_dir):
    """Collection state, override and requirement decide whether a run may be committed."""
    k = F.col("o_orderkey") % 6
    state = F.when(k == 0, "COLLECTION_BLOCKED").when(k == 1, "collection_degraded").when(k == 2, "").when(k == 4, "COLLECTION_WARN").when(k == 5, "ODD")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), a.commit_allowed(state, F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0).alias("allowed"))


CELLS = "SELECT p_partkey::VARCHAR AS sku, p_name, p_type, p_brand, p_partkey AS k FROM part"


@query(f"""WITH c AS ({CELLS}) SELECT sku, 'name' AS field, p_name AS before, upper(p_name) AS after, 'REPAIRED' AS rule FROM c WHERE k % 3 = 0 AND p_name <> upper(p_name)
UNION ALL SELECT sku, 'type', p_type, NULL, 'CLEARED' FROM c WHERE k % 10 = 1 UNION ALL SELECT sku, 'brand', NULL, p_brand, 'FILLED' FROM c WHERE k % 7 = 2""")
def repair_events(spark, sf_dir):
    """One event for each cell that a repair changed."""
    k = part_key()
    before = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.when(k % 7 != 2, F.col("p_brand")).alias("brand"))
    after = parts(spark, sf_dir).select(part_sku(), F.when(k % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"), F.when(k % 10 != 1, F.col("p_type")).alias("type"), F.col("p_brand").alias("brand"))
    cells = keyed_difference(before, after, "sku", ["name", "type", "brand"])
    rule = F.when(F.col("left_value").isNull(), "FILLED").when(F.col("right_value").isNull(), "CLEARED").otherwise("REPAIRED")
    return cells.select("sku", "field", F.col("left_value").alias("before"), F.col("right_value").alias("after"), rule.alias("rule"))


@query(f"""WITH c AS ({CELLS}), e AS (SELECT 'name' AS field, 'REPAIRED' AS rule, k FROM c WHERE k % 3 = 0 AND p_name <> upper(p_name) UNION ALL SELECT 'type', 'CLEARED', k FROM c WHERE k % 10 = 1 UNION ALL SELECT 'brand', 'FILLED', k FROM c WHERE k % 7 = 2)
SELECT field, rule, count(*) AS n, count(*) FILTER (k % 2 = 0) AS urgent FROM e GROUP BY 1, 2""")
def wave_summary(spark, sf_dir):
    """Repaired cells by field and rule, and how many of them are urgent."""
    return repair_events(spark, sf_dir).groupBy("field", "rule").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sku").cast("long") % 2 == 0).alias("urgent"))


@query("""WITH t AS (SELECT p_partkey::VARCHAR AS sku, ' ' || lower(p_name) || ' ' AS title FROM part), b AS (SELECT lower(split_part(p_name, ' ', 1)) AS alias FROM part WHERE p_partkey % 9 = 0 UNION SELECT lower(split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2)) FROM part WHERE p_partkey % 5 = 0 AND split_part(p_name, ' ', 2) <> ''),
m AS (SELECT sku, upper(alias) AS brand, row_number() OVER (PARTITION BY sku ORDER BY length(alias) DESC, alias) AS n FROM t JOIN b ON length(alias) >= 3 AND contains(title, ' ' || alias || ' ')) SELECT t.sku, m.brand FROM t LEFT JOIN m ON m.sku = t.sku AND n = 1""")
def title_brands(spark, sf_dir):
    """The longest confirmed alias in each title, as whole words."""
    rows = parts(spark, sf_dir)
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    aliases = rows.where("p_partkey % 9 = 0").select(F.lower(first).alias("alias")).union(rows.where(part_key() % 5 == 0).where(second != "").select(F.lower(F.concat_ws(" ", first, second)))).distinct()
    return a.title_brands(rows.select(part_sku(), F.col("p_name").alias("title")), aliases.withColumn("brand", F.upper("alias")))


@query("""SELECT p_partkey::VARCHAR AS sku, trim(regexp_replace(regexp_replace(regexp_replace(p_type, 'POLISHED', ''), 'BRASS', ''), 'TIN', '')) AS shown FROM part""")
def forbidden_spans(spark, sf_dir):
    """Texts without the first place of each forbidden span."""
    return parts(spark, sf_dir).select(part_sku(), a.without_spans(F.col("p_type"), ["TIN", "BRASS", "POLISHED"]).alias("shown"))


@query(f"""WITH {HISTORY} SELECT sku, k1, k2, k3, min(CASE WHEN new_price BETWEEN 1000 AND 1800 THEN new_price END) OVER w AS low, max(CASE WHEN new_price BETWEEN 1000 AND 1800 THEN new_price END) OVER w AS high
FROM history WINDOW w AS (PARTITION BY sku ORDER BY observed_at, k1, k2, k3 ROWS UNBOUNDED PRECEDING)""")
def running_extrema(spark, sf_dir):
    """Lowest and highest valid price so far."""
    return a.running_extrema(price_history(spark, sf_dir), ["sku"], ["observed_at", "k1", "k2", "k3"], "new_price", 1000, 1800).select("sku", "k1", "k2", "k3", "low", "high")


@query("""WITH u AS (SELECT o_orderdate AS day, o_orderkey AS run_id, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_totalprice DESC, o_orderkey DESC) AS n FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 0 AND o_orderpriority <> '1-URGENT' AND o_custkey % 11 <> 0) SELECT strftime(day, '%Y-%m-%d') AS day, run_id FROM u WHERE n = 1""")
def daily_sources(spark, sf_dir):
    """The newest usable run of each day."""
    runs = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderkey").alias("run_id"), F.col("o_totalprice").alias("committed_at"), F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("FAIL").alias("qa"),
        (F.col("o_orderkey") % 7 != 0).alias("committed"), (F.col("o_orderpriority") == "1-URGENT").alias("dry"), F.lit("FULL").alias("scope"), F.when(F.col("o_custkey") % 11 != 0, F.md5("o_orderstatus")).alias("metrics_hash"),
    )
    return a.daily_source(runs)


@query("""SELECT l_orderkey AS run_id, l_linenumber AS line, o_custkey AS source, o_totalprice AS digest FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_returnflag = 'R'""")
def committed_evidence(spark, sf_dir):
    """Evidence rows of committed runs."""
    runs = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("source"), F.col("o_totalprice").alias("digest"))
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("line")).join(runs, "run_id")


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 6 = 0 THEN 'NEW' WHEN p_partkey % 5 = 1 THEN 'SOURCE_HASH_CHANGED' ELSE 'NEEDS_REVIEW' END AS reason FROM part WHERE p_partkey % 6 = 0 OR p_partkey % 5 = 1 OR p_partkey % 8 = 3""")
def enrichment_candidates(spark, sf_dir):
    """Products that a dictionary lacks or holds in an older or unreviewed form."""
    k, digest = part_key(), a.product_source_hash(F.col("p_name"), F.col("p_type"))
    known = parts(spark, sf_dir).where(k % 6 != 0).select(part_sku(), F.when(k % 5 == 1, "old").otherwise(digest).alias("source_hash"), F.when(k % 8 == 3, "NEEDS_REVIEW").otherwise("APPROVED").alias("review_status"))
    return a.enrichment_candidates(parts(spark, sf_dir).select(part_sku(), digest.alias("source_hash")), known)


@query("""SELECT p_partkey::VARCHAR AS sku, sha256(trim(p_name) || chr(31) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE trim(p_type) END || chr(31) || trim(p_brand) || chr(31) || p_size::VARCHAR) AS source_hash FROM part""")
def product_source_hashes(spark, sf_dir):
    """Hash of a product's four source fields; null and empty are the same."""
    return parts(spark, sf_dir).select(part_sku(), a.product_source_hash(F.concat(F.lit(" "), "p_name"), F.when(part_key() % 3 != 0, F.col("p_type")), F.col("p_brand"), part_size().cast("string")).alias("source_hash"))


@query("""WITH k AS (SELECT CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_name END AS key FROM part) SELECT key, CASE WHEN key = '' THEN 'BLANK' ELSE 'DUPLICATE' END AS fault, count(*) AS n FROM k GROUP BY key HAVING key = '' OR count(*) > 1""")
def dictionary_faults(spark, sf_dir):
    """Blank and repeated keys of a dictionary."""
    return a.key_faults(parts(spark, sf_dir).select(F.when(part_key() % 50 != 0, F.concat("p_name", F.lit(" "))).alias("key")), "key")


@query("""SELECT p_partkey::VARCHAR AS sku, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN p_partkey % 2 = 0 AND true ELSE p_partkey % 2 = 0 AND false END AS confirmed FROM part""")
def confirmed_brands(spark, sf_dir):
    """Brands that may affect a displayed text."""
    review = F.when(part_size() % 3 == 0, "human_reviewed").when(part_size() % 3 == 2, "NEEDS_HUMAN_REVIEW")
    return parts(spark, sf_dir).select(part_sku(), a.confirmed_brand(review, F.when(part_key() % 2 == 0, "AI_REVIEWED").otherwise("GUESS")).alias("confirmed"))


@query(f"""WITH {FULL} SELECT p.sku, concat_ws('|', CASE WHEN i.sku IS NULL THEN 'NO_MANIFEST' END, CASE WHEN i.image_status <> 'AVAILABLE' THEN 'NOT_AVAILABLE' END, CASE WHEN coalesce(i.image_path, '') = '' THEN 'NO_FILE' END, CASE WHEN p.sku::BIGINT % 8 = 2 AND i.sku IS NOT NULL THEN 'URL_CHANGED' END) AS reasons
FROM products p LEFT JOIN images i ON i.sku = p.sku""")
def image_eligibility(spark, sf_dir):
    """Why an image may not be delivered; none means that it may."""
    held = images(spark, sf_dir).withColumn("held_url", F.concat(F.lit("/p/"), F.when(F.col("sku").cast("long") % 8 == 2, "old").otherwise(F.col("sku"))))
    rows = products(spark, sf_dir).select("sku", "product_url").join(held, "sku", "left")
    why = a.reasons({"NO_MANIFEST": F.col("held_url").isNull(), "NOT_AVAILABLE": F.col("image_status") != "AVAILABLE", "NO_FILE": is_blank(F.col("image_path")), "URL_CHANGED": F.col("held_url") != F.col("product_url")})
    return rows.select("sku", why.alias("reasons"))


@query(f"""WITH {FULL} SELECT sku, concat_ws('|', CASE WHEN current_price IS NULL THEN 'NO_PRICE' END, CASE WHEN original_price <= current_price THEN 'ORIGINAL_NOT_ABOVE' END, CASE WHEN coalesce(trim(zh_cat2), '') = '' THEN 'NO_CATEGORY' END, CASE WHEN status <> 'CURRENT' THEN 'NOT_CURRENT' END) AS reasons FROM full_rows""")
def export_faults(spark, sf_dir):
    """Rules that an output row breaks, in their order."""
    rows = full_rows(spark, sf_dir, ())
    why = a.reasons({"NO_PRICE": F.col("current_price").isNull(), "ORIGINAL_NOT_ABOVE": F.col("original_price") <= F.col("current_price"), "NO_CATEGORY": is_blank(F.col("zh_cat2")), "NOT_CURRENT": F.col("status") != "CURRENT"})
    return rows.select("sku", why.alias("reasons"))


@query("""WITH r AS (SELECT unnest(string_split_regex(p_name || '| ' || p_type || ',' || p_brand, '[|,]')) AS alias FROM part WHERE p_partkey % 3 <> 1), t AS (SELECT trim(alias) AS alias FROM r)
SELECT DISTINCT token FROM (SELECT alias AS token FROM t UNION ALL SELECT unnest(string_split_regex(alias, '\\s+')) FROM t) WHERE token <> ''""")
def allowed_tokens(spark, sf_dir):
    """Tokens that a target text may keep."""
    status = F.when(part_key() % 3 == 1, "DRAFT").when(part_key() % 3 == 2, "approved ")
    return a.allowed_tokens(parts(spark, sf_dir).select(F.concat("p_name", F.lit("| "), "p_type", F.lit(","), "p_brand").alias("aliases"), status.alias("review_status")))


@query("""WITH p AS (SELECT lower(p_name) AS source, p_brand AS family, min(p_type) AS target FROM part GROUP BY 1, 2) SELECT source, family, target FROM p WHERE (source, family) NOT IN (SELECT lower(p_name), p_brand FROM part WHERE p_partkey % 2 = 0)""")
def term_additions(spark, sf_dir):
    """Terms that their scope lacks, once each."""
    rows = parts(spark, sf_dir).select(F.lower("p_name").alias("source"), F.col("p_brand").alias("family"), F.col("p_type").alias("target"), part_key().alias("k"))
    return a.additions(rows.where("k % 2 = 0").select("source", "family"), rows, ["source", "family"])


@query("""WITH c AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS sku, 'name' AS field, p_name AS value FROM part UNION ALL SELECT p_partkey, p_partkey::VARCHAR, 'type', CASE WHEN p_partkey % 5 <> 0 THEN p_type END FROM part)
SELECT sku, field, sha256(value) AS source_hash FROM c WHERE value IS NOT NULL AND NOT (k % 4 = 0 AND NOT (field = 'type' AND k % 8 = 0))""")
def translation_plans(spark, sf_dir):
    """Fields that need work: no approved text of the same source."""
    k = part_key()
    approved = parts(spark, sf_dir).where(k % 4 == 0).select(part_sku(), F.explode(F.array(F.struct(F.lit("name").alias("field"), F.sha2("p_name", 256).alias("source_hash")), F.struct(F.lit("type").alias("field"), F.when(k % 8 == 0, "old").otherwise(F.sha2("p_type", 256)).alias("source_hash")))).alias("c")).select("sku", "c.field", "c.source_hash")
    source = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.when(k % 5 != 0, F.col("p_type")).alias("type"))
    return a.translation_plan(source, approved, ["name", "type"])


@query("""SELECT p_partkey::VARCHAR AS sku, concat_ws('|', CASE WHEN p_partkey % 3 = 0 THEN 'NOT_APPROVED' END, CASE WHEN p_partkey % 4 = 0 THEN 'NO_PROVENANCE' END, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 5 = 0 THEN 'SOURCE_MISMATCH' END, CASE WHEN p_retailprice > 1500 THEN 'TARGET_MISMATCH' END) AS conflicts FROM part""")
def apply_previews(spark, sf_dir):
    """All conflicts of a candidate with its provenance and the present values."""
    k = part_key()
    held = parts(spark, sf_dir).where(k % 4 != 0).select(part_sku(), F.when(k % 5 == 0, "old").otherwise(F.md5("p_name")).alias("held_hash"))
    rows = parts(spark, sf_dir).select(part_sku(), k.alias("k"), F.md5("p_name").alias("source_hash"), part_price().alias("target")).join(held, "sku", "left")
    why = a.reasons({"NOT_APPROVED": F.col("k") % 3 == 0, "NO_PROVENANCE": F.col("held_hash").isNull(), "SOURCE_MISMATCH": F.col("held_hash") != F.col("source_hash"), "TARGET_MISMATCH": F.col("target") > 1500})
    return rows.select("sku", why.alias("conflicts"))


@query("""WITH b AS (SELECT p_partkey AS k, p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 5 = 0 THEN 'RESOLVED' ELSE 'PENDING' END AS state FROM part)
SELECT id, CASE WHEN state = 'PENDING' AND k % 3 <> 0 AND k % 4 <> 1 THEN CASE WHEN k % 2 = 0 THEN 'REJECTED' ELSE 'RESOLVED' END ELSE state END AS state,
CASE WHEN k % 3 = 0 THEN 'OPEN' WHEN state <> 'PENDING' THEN 'CLOSED' WHEN k % 4 = 1 THEN 'EVIDENCE_CHANGED' ELSE 'APPLIED' END AS outcome FROM b""")
def backlog_decisions(spark, sf_dir):
    """Decisions on missing categories, bound to the evidence they were made on."""
    k, ident = part_key(), part_key().cast("string").alias("id")
    backlog = parts(spark, sf_dir).select(ident, F.md5("p_name").alias("evidence_hash"), F.when(k % 5 == 0, "RESOLVED").otherwise("PENDING").alias("state"))
    seen = F.when(k % 4 == 1, "old").otherwise(F.md5("p_name")).alias("evidence_hash")
    first = parts(spark, sf_dir).where(k % 3 != 0).select(ident, F.md5("p_name").alias("evidence_hash"), F.lit("ASSIGN").alias("decision"), F.lit(1).alias("seq"))
    second = parts(spark, sf_dir).where(k % 3 != 0).select(ident, seen, F.when(k % 2 == 0, "REJECT").otherwise("ASSIGN").alias("decision"), F.lit(2).alias("seq"))
    return a.decided(backlog, first.unionAll(second))


@query("""SELECT p_partkey::VARCHAR AS sku, 'name' AS field, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 <> 1 AND p_partkey % 5 <> 2 THEN '中 ' || p_name END AS reused FROM part""")
def reused_localizations(spark, sf_dir):
    """Target texts that may be used again, as their source is the same."""
    k, field = part_key(), F.lit("name").alias("field")
    cells = parts(spark, sf_dir).select(part_sku(), field, F.col("p_name").alias("source"), F.when(k % 5 == 2, F.col("p_name")).otherwise(F.concat(F.lit("中 "), "p_name")).alias("target"))
    held = parts(spark, sf_dir).where(k % 3 != 0).select(part_sku(), field, F.col("p_name").alias("snapshot"), F.when(k % 4 == 1, "STALE").otherwise("FRESH").alias("freshness"))
    return a.reusable(cells, held)


@query(f"""WITH {FULL}, e AS (SELECT DISTINCT sku FROM event_history), r AS (SELECT p.sku, p.sku::BIGINT AS k, e.sku IS NOT NULL AS present FROM products p LEFT JOIN e ON e.sku = p.sku WHERE status = 'CURRENT'),
f AS (SELECT sku, concat_ws('|', CASE WHEN NOT present THEN 'NOT_PRESENT' END, CASE WHEN present AND k % 9 = 0 AND k % 17 <> 0 THEN 'PRICE_DIFFERS' END, CASE WHEN k % 10 = 3 THEN 'NO_RECEIPT' END, CASE WHEN k % 10 = 4 THEN 'RECEIPT_DIFFERS' END) AS reasons FROM r)
SELECT * FROM f WHERE reasons <> ''""")
def commit_evidence(spark, sf_dir):
    """Whether a run's current products were seen, at their price, with receipts of their values."""
    k = F.col("sku").cast("long")
    current = products(spark, sf_dir).where("status = 'CURRENT'").select("sku", F.col("raw_price").alias("price"), (k % 17 == 0).alias("invalid"), F.md5("name").alias("value_hash"))
    present = event_history(spark, sf_dir).select("sku").distinct().withColumn("present", F.lit(True))
    seen = present.join(products(spark, sf_dir).select("sku", F.when(k % 9 == 0, F.col("raw_price") + 1).otherwise(F.col("raw_price")).alias("seen_price")), "sku")
    receipts = products(spark, sf_dir).where(k % 10 != 3).select("sku", F.when(k % 10 == 4, "old").otherwise(F.md5("name")).alias("receipt_hash"))
    return a.evidence_faults(current, seen, receipts)


@query("""SELECT p_partkey::VARCHAR AS key, concat_ws('|', CASE WHEN p_partkey % 6 = 1 THEN 'INCOMPLETE' END, CASE WHEN p_partkey % 7 = 2 THEN 'ACTOR' END, CASE WHEN p_partkey % 8 = 3 THEN 'NO_ISSUE' END, CASE WHEN p_partkey % 8 <> 3 AND p_partkey % 5 = 4 THEN 'SOURCE_CHANGED' END,
CASE WHEN p_size <= 20 THEN 'EXPIRED' END, CASE WHEN p_size > 45 THEN 'TOO_LONG' END) AS reasons FROM part""")
def exception_validity(spark, sf_dir):
    """Exceptions against their issues, for so many days at most."""
    k = part_key()
    listed = parts(spark, sf_dir).select(
        k.cast("string").alias("key"), F.when(k % 6 != 1, "why").otherwise(" ").alias("reason"), F.when(k % 7 == 2, "bot:x").otherwise("human:x").alias("actor"), F.when(k % 5 == 4, "old").otherwise(F.md5("p_name")).alias("source_hash"),
        F.lit("2024-01-01").cast("date").alias("created_at"), F.date_add(F.lit("2024-01-01").cast("date"), (part_size() * 2).cast("int")).alias("expires_at"),
    )
    issues = parts(spark, sf_dir).where(k % 8 != 3).select(k.cast("string").alias("key"), F.md5("p_name").alias("source_hash"))
    return a.exception_faults(listed, issues, F.lit("2024-02-10").cast("date"), ["reason"])


@query(f"""WITH {FULL}, r AS (SELECT sku, max(observed_at) AS read_at FROM history GROUP BY sku)
SELECT p.sku, CASE WHEN p.sku::BIGINT % 11 = 0 THEN 'RETRY' WHEN p.sku::BIGINT % 8 = 0 THEN 'MISSING' WHEN read_at IS NULL OR DATE '1998-12-01' - read_at::DATE > 60 THEN 'EXPIRED' ELSE 'KEEP' END AS plan FROM products p LEFT JOIN r ON r.sku = p.sku""")
def refresh_plans(spark, sf_dir):
    """What each product's detail page is read for."""
    k = F.col("sku").cast("long")
    read = price_history(spark, sf_dir).groupBy("sku").agg(F.max("observed_at").cast("date").alias("read_at"))
    rows = products(spark, sf_dir).select("sku", F.when(k % 11 == 0, "FAILED").otherwise("DONE").alias("state"), F.when(k % 8 != 0, F.md5("name")).alias("detail_hash")).join(read, "sku", "left")
    return a.refresh_plan(rows, F.lit("1998-12-01").cast("date"), 60)


@query(f"""WITH {FULL}, d AS (SELECT sku, count(*) AS n FROM event_history WHERE id % 10 = 0 GROUP BY sku)
SELECT sku, 'name' AS field, 1 AS n FROM products WHERE sku::BIGINT % 6 = 0 AND name <> upper(name) UNION ALL SELECT sku, 'status', 1 FROM products WHERE sku::BIGINT % 7 = 0 AND status <> 'CURRENT' UNION ALL SELECT sku, 'events', n FROM d""")
def shadow_differences(spark, sf_dir):
    """What an old and a new pipeline say differently, by field, and their events as multisets."""
    k = F.col("sku").cast("long")
    old, events = products(spark, sf_dir).select("sku", "name", "status"), event_history(spark, sf_dir)
    new = old.select("sku", F.when(k % 6 == 0, F.upper("name")).otherwise(F.col("name")).alias("name"), F.when(k % 7 == 0, "CURRENT").otherwise(F.col("status")).alias("status"))
    return a.shadow_difference(old, new, ["name", "status"], events, events.where("id % 10 <> 0"))


@query("""WITH r AS (SELECT p_partkey AS k, p_size AS size, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE '中 ' || p_size END AS gold FROM part)
SELECT count(*) FILTER (k % 10 <> 0) AS rows, count(*) FILTER (k % 10 = 0) AS invalid_rows, count(*) FILTER (k % 10 <> 0 AND k % 4 = 0) AS field_exact,
count(*) FILTER (k % 10 <> 0 AND k % 4 = 2) AS number_mismatch, count(*) FILTER (k % 10 <> 0 AND k % 3 = 0 AND k % 4 <> 1) AS unit_mismatch, count(*) FILTER (k % 10 <> 0 AND k % 4 <> 3) AS target_script FROM r""")
def gold_counters(spark, sf_dir):
    """Predictions against gold texts: exact, numbers, units and script, with faults at known places."""
    k, size = part_key(), part_size().cast("string")
    case = k % 4
    predicted = F.when(case == 0, F.concat(F.lit("中 "), size)).when(case == 1, F.concat(F.lit("中 "), size, F.lit(" cm"))).when(case == 2, F.concat(F.lit("中 7 "), size)).otherwise(size)
    source = F.concat(F.lit("talla "), size, F.when(k % 3 == 0, " cm").otherwise(""))
    return a.gold_counters(parts(spark, sf_dir).select(k.cast("string").alias("key"), F.lit("spec").alias("field"), source.alias("source"), predicted.alias("prediction"), F.when(k % 10 != 0, F.concat(F.lit("中 "), size)).alias("gold")))


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN ('0x' || substr(sha256(p_partkey::VARCHAR), 1, 8))::BIGINT / 4294967295.0 < 0.1 THEN 'valid' ELSE 'train' END AS part FROM part""")
def guarded_splits(spark, sf_dir):
    """Training rows dealt by SKU, so that no product stands in both parts."""
    return a.guarded_split(parts(spark, sf_dir).select(part_sku()), "sku", ["sku"], 0.1)

"""Lineage, overlays, provenance, overrides, patches, queues, dictionaries and audits over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.evidence import category_key, issue_id
from shelfwise.functions.texts import has_markup, is_blank
from shelfwise.operators import records as r
from shelfwise.operators.upserts import counts_of, keyed_difference, rule_union
from shelfwise.plans.registry import query
from shelfwise.sources.full_catalogue import FULL, event_history, full_rows, localizations, products
from shelfwise.sources.relations import HISTORY, price_history, table, part_key, part_price, part_size, part_sku


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query(f"""WITH {FULL}, f AS (SELECT *, sku::BIGINT AS k FROM full_rows)
SELECT sku, 'H01_PRICE' AS rule FROM f WHERE current_price IS NULL OR current_price <= 0 UNION ALL SELECT sku, 'H02_PROMOTION' FROM f WHERE promotion AND original_price IS NULL
UNION ALL SELECT sku, 'H03_HTML' FROM f WHERE k % 41 = 0 UNION ALL SELECT sku, 'H04_INTERFACE' FROM f WHERE k % 43 = 0 AND k % 41 <> 0 UNION ALL SELECT sku, 'H05_IDENTITY' FROM f WHERE length(canonical_id) <> 10
UNION ALL SELECT sku, 'H08_CATEGORY' FROM f WHERE coalesce(trim(es_cat1), '') = '' OR coalesce(trim(zh_cat2), '') = ''
UNION ALL SELECT sku, 'H06_ORPHAN_PRICE' FROM (SELECT DISTINCT sku FROM history) WHERE sku NOT IN (SELECT sku FROM products WHERE status <> 'MISSING') UNION ALL SELECT sku, 'H07_ORPHAN_EVENT' FROM (SELECT DISTINCT sku FROM event_history) WHERE sku NOT IN (SELECT sku FROM products WHERE status <> 'MISSING')""")
def historical_audit(spark, sf_dir):
    """Eight rules: six of rows in one pass, two of rows without a product."""
    rows = full_rows(spark, sf_dir)
    k = F.col("sku").cast("long")
    text = F.when(k % 41 == 0, F.concat(F.lit("<b>"), "es_description", F.lit("</b>"))).when(k % 43 == 0, "Leer más").otherwise(F.col("es_description"))
    text = F.when((k % 41 == 0) & F.col("es_description").isNull(), "<br>").otherwise(text)
    found = rule_union(rows.withColumn("shown", text), "sku", {
        "H01_PRICE": F.col("current_price").isNull() | (F.col("current_price") <= 0), "H02_PROMOTION": F.col("promotion") & F.col("original_price").isNull(), "H03_HTML": has_markup(F.col("shown")), "H04_INTERFACE": F.lower(F.trim("shown")) == "leer más",
        "H05_IDENTITY": F.length("canonical_id") != 10, "H08_CATEGORY": is_blank(F.col("es_cat1")) | is_blank(F.col("zh_cat2")),
    })
    known = products(spark, sf_dir).where("status <> 'MISSING'").select("sku")
    for name, other in (("H06_ORPHAN_PRICE", price_history(spark, sf_dir)), ("H07_ORPHAN_EVENT", event_history(spark, sf_dir))):
        found = found.unionAll(other.select("sku").distinct().join(known, "sku", "left_anti").select("sku", F.lit(name).alias("rule")))
    return found


@query("""WITH v AS (SELECT l_partkey::VARCHAR AS sku, CASE WHEN l_quantity > 25 THEN l_returnflag ELSE l_linestatus END AS value, l_linenumber % 3 AS rank, l_shipdate AS moment, l_orderkey * 10 + l_linenumber AS run FROM lineitem),
c AS (SELECT p_partkey::VARCHAR AS sku, CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'O' WHEN 2 THEN 'F' ELSE 'Z' END AS value FROM part),
m AS (SELECT c.sku, v.run, v.rank, row_number() OVER (PARTITION BY c.sku ORDER BY v.rank, v.moment DESC, v.run DESC) AS n FROM c JOIN v ON c.sku = v.sku AND c.value = v.value)
SELECT c.sku, m.run AS source_run, CASE m.rank WHEN 0 THEN 'DETAIL' WHEN 1 THEN 'LISTING' WHEN 2 THEN 'IMPORT' ELSE 'UNKNOWN' END AS source FROM c LEFT JOIN m ON m.sku = c.sku AND m.n = 1""")
def field_lineage(spark, sf_dir):
    """The newest version with the current value's hash, better sources first."""
    line = table(spark, sf_dir, "lineitem")
    rank = F.col("l_linenumber") % 3
    versions = line.select(F.col("l_partkey").cast("string").alias("sku"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise(F.col("l_linestatus")).alias("value"), rank.alias("rank"), F.when(rank == 0, "DETAIL").when(rank == 1, "LISTING").otherwise("IMPORT").alias("source"), F.col("l_shipdate").alias("observed_at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("run_id"))
    current = parts(spark, sf_dir).select(part_sku(), F.when(part_key() % 4 == 0, "A").when(part_key() % 4 == 1, " O ").when(part_key() % 4 == 2, "F").otherwise("Z").alias("value"))
    return r.lineage(current, versions, "sku", "value")


@query("""WITH runs AS (SELECT o_orderkey AS run_id, o_orderdate AS committed_at FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 400),
g AS (SELECT l_partkey::VARCHAR AS sku, run_id, bool_or(l_linenumber <> 2) AS complete, committed_at FROM lineitem JOIN runs ON l_orderkey = run_id GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY committed_at DESC, run_id DESC) AS n FROM g)
SELECT p_partkey::VARCHAR AS sku, CASE WHEN complete THEN run_id END AS run_id, CASE WHEN complete THEN 'KNOWN' ELSE 'UNKNOWN' END AS state FROM part LEFT JOIN c ON c.sku = p_partkey::VARCHAR AND n = 1""")
def prior_cards(spark, sf_dir):
    """Each SKU's newest card of the last committed runs; a gap is unknown."""
    cards = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("sku"), F.col("l_orderkey").alias("run_id")).agg(F.bool_or(F.col("l_linenumber") != 2).alias("complete"))
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("committed_at"), (F.col("o_orderstatus") != "P").alias("committed"))
    return r.prior_cards(cards, runs, parts(spark, sf_dir).select(part_sku()), 400)


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_partkey % 3 = 0 AND p_size > 10 THEN 'new ' || p_name ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS cat FROM part""")
def detail_overlay(spark, sf_dir):
    base = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.col("p_type").alias("cat"))
    retry = parts(spark, sf_dir).where(part_key() % 3 == 0).select(part_sku(), F.when(part_size() > 10, F.concat(F.lit("new "), "p_name")).alias("name"), F.col("p_brand").alias("cat"))
    return r.overlay(base, retry, "sku", ["name", "cat"])


@query("""SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size % 4 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN p_name END ELSE 'own' END AS name, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 = 0 THEN p_brand WHEN p_partkey % 5 = 0 THEN '品 x' ELSE p_type END AS cat FROM part""")
def repaired_facts(spark, sf_dir):
    """Blanks from a snapshot; source fields in target script from a clean history."""
    rows = parts(spark, sf_dir).select(part_sku(), F.when(part_size() % 4 == 0, " ").otherwise("own").alias("name"), F.when(part_key() % 5 == 0, "品 x").otherwise(F.col("p_type")).alias("cat"))
    snapshot = parts(spark, sf_dir).where(part_key() % 2 == 0).select(part_sku(), F.col("p_name").alias("name"), F.col("p_brand").alias("cat"))
    blanks = r.filled_blanks(rows, snapshot, "sku", ["name"])
    return blanks.join(r.unpolluted(rows, snapshot, "sku", ["cat"]), "sku")


@query(" UNION ALL ".join(f"SELECT p_partkey::VARCHAR AS sku, '{f}' AS field, trim({c}::VARCHAR) AS value, sha256(trim({c}::VARCHAR)) AS value_hash FROM part WHERE {w}" for f, c, w in (("name", "p_name", "true"), ("cat", "p_type", "p_size % 3 <> 0"), ("spec", "p_size", "true"))))
def field_provenance(spark, sf_dir):
    """One row for each field that is not blank."""
    rows = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.when(part_size() % 3 != 0, F.col("p_type")).otherwise(" ").alias("cat"), part_size().cast("string").alias("spec"))
    return r.provenance(rows, "sku", ["name", "cat", "spec"])


@query("""SELECT p_partkey::VARCHAR AS sku, 'name' AS field, CASE WHEN p_partkey % 6 = 0 THEN 'MISSING' WHEN p_size % 7 = 0 THEN 'SOURCE_MISSING' WHEN p_partkey % 6 = 1 THEN 'APPLIED' WHEN p_partkey % 6 = 2 THEN 'REAPPROVAL_REQUIRED' ELSE 'STALE' END AS state,
  CASE WHEN p_partkey % 6 = 1 AND p_size % 7 <> 0 THEN 'target' END AS value FROM part WHERE p_partkey % 6 <> 5""")
def override_states(spark, sf_dir):
    """Approved overrides hold while the field they were made for is the same."""
    cells = parts(spark, sf_dir).where(part_key() % 6 != 0).select(part_sku(), F.lit("name").alias("field"), F.when(part_size() % 7 != 0, F.col("p_name")).alias("value"), F.lit("own").alias("field_hash"), F.lit("whole").alias("old_hash"))
    made = parts(spark, sf_dir).select(part_sku(), F.lit("name").alias("field"), F.when(part_key() % 6 == 1, "own").when(part_key() % 6 == 2, "whole").otherwise("x").alias("hash"), F.lit("target").alias("target"), F.when(part_key() % 6 == 5, "PENDING").otherwise("APPROVED").alias("status"))
    return r.override_states(cells, made)


@query("""WITH f AS (SELECT sha256('PRICE|' || p_partkey) AS id, 'new' AS detail FROM part WHERE p_partkey % 2 = 0), q AS (SELECT sha256('PRICE|' || p_partkey) AS id, CASE WHEN p_size % 2 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS status, 'old' AS detail FROM part WHERE p_partkey % 3 = 0)
SELECT coalesce(f.id, q.id) AS id, CASE WHEN q.id IS NULL THEN 'PENDING' WHEN q.status = 'PENDING' AND f.id IS NULL THEN 'RESOLVED' ELSE q.status END AS status, coalesce(f.detail, q.detail) AS detail FROM f FULL JOIN q ON f.id = q.id""")
def review_queue(spark, sf_dir):
    ids = issue_id(F.lit("PRICE"), part_key()).alias("id")
    found = parts(spark, sf_dir).where(part_key() % 2 == 0).select(ids, F.lit("new").alias("detail"))
    return r.review_queue(found.unionAll(found), parts(spark, sf_dir).where(part_key() % 3 == 0).select(ids, F.when(part_size() % 2 == 0, "APPROVED").otherwise("PENDING").alias("status"), F.lit("old").alias("detail")))


@query("""WITH p AS (SELECT l_returnflag AS kind, 'q' || (l_quantity::INT) AS term, l_linestatus AS value, l_partkey::VARCHAR AS sku, count(*) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem WHERE l_partkey % 50 = 1 GROUP BY ALL)
SELECT kind, term, value, sum(n)::BIGINT AS n, count(*) AS skus, CASE WHEN bool_or(lo <> hi) THEN 'EVIDENCE_CONFLICT' WHEN sum(n) > 1 THEN 'EVIDENCE_ACCUMULATED' ELSE 'NEW' END AS state FROM p GROUP BY kind, term, value""")
def learning_candidates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_partkey % 50 = 1").select(F.col("l_returnflag").alias("kind"), F.concat(F.lit("q"), F.col("l_quantity").cast("int")).alias("term"), F.col("l_linestatus").alias("value"), F.col("l_partkey").cast("string").alias("sku"), F.col("l_linenumber").alias("source_hash"))
    return r.learned(rows)


@query("""WITH d AS (SELECT p_type, p_brand, sum(p_size) AS s FROM part GROUP BY ALL), t AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1)
SELECT p_partkey::VARCHAR AS sku, CASE WHEN lower(p.p_type) <> 'promo' THEN CASE WHEN p_partkey % 9 = 0 THEN '手' WHEN d.s % 2 = 0 THEN '对 ' || p.p_brand WHEN p.p_type LIKE 'S%' THEN '类 ' || p.p_type ELSE p.p_type END END AS category,
  CASE WHEN lower(p.p_type) = 'promo' THEN 'NAVIGATION' WHEN p_partkey % 9 = 0 THEN 'MANUAL' WHEN d.s % 2 = 0 THEN 'PAIR' WHEN p.p_type LIKE 'S%' THEN 'CAT1' ELSE 'FALLBACK' END AS source
FROM part p JOIN d ON d.p_type = p.p_type AND d.p_brand = p.p_brand JOIN t ON t.p_type = p.p_type""")
def category_names(spark, sf_dir):
    """The first dictionary with a value in target script, by its own keys."""
    rows = parts(spark, sf_dir).select(part_sku(), F.col("p_type").alias("cat1"), F.col("p_brand").alias("cat2"))
    manual = parts(spark, sf_dir).where(part_key() % 9 == 0).select(part_sku(), F.lit("手").alias("value"))
    pairs = parts(spark, sf_dir).groupBy(F.col("p_type").alias("cat1"), F.col("p_brand").alias("cat2")).agg(F.sum("p_size").alias("s")).select("cat1", "cat2", F.when(F.col("s") % 2 == 0, F.concat(F.lit("对 "), "cat2")).otherwise("no target script").alias("value"))
    single = parts(spark, sf_dir).select(F.col("p_type").alias("cat1")).distinct().where("cat1 LIKE 'S%'").select("cat1", F.concat(F.lit("类 "), "cat1").alias("value"))
    return r.category_names(rows, [("MANUAL", manual, ["sku"]), ("PAIR", pairs, ["cat1", "cat2"]), ("CAT1", single, ["cat1"])], ["promo"])


@query("""WITH w AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN ' ' || upper(p_brand) || ' ' WHEN p_size % 3 = 1 THEN p_brand ELSE 'none ' || p_size END AS brand FROM part), b AS (SELECT DISTINCT p_brand AS brand_id FROM part)
SELECT w.brand, b.brand_id, CASE WHEN b.brand_id IS NULL THEN 'NONE' WHEN b.brand_id = w.brand THEN 'EXACT' ELSE 'NORMALISED' END AS match FROM w LEFT JOIN b ON lower(trim(w.brand)) = lower(b.brand_id)""")
def brand_rows(spark, sf_dir):
    wanted = parts(spark, sf_dir).select(F.when(part_size() % 3 == 0, F.concat(F.lit(" "), F.upper("p_brand"), F.lit(" "))).when(part_size() % 3 == 1, F.col("p_brand")).otherwise(F.concat(F.lit("none "), part_size())).alias("brand"))
    return r.brand_rows(parts(spark, sf_dir).select(F.col("p_brand").alias("brand_id")), wanted)


@query("""WITH e AS (SELECT o_custkey AS k, o_orderkey AS patch_id, l_linenumber AS seq, CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'N' THEN 'CREATED' ELSE 'REVOKED' END AS event, l_shipdate AS moment FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
s AS (SELECT patch_id, event FROM (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY moment DESC, seq DESC, event DESC) AS n FROM e) WHERE n = 1)
SELECT o_orderkey AS patch_id, coalesce(s.event, 'CREATED') AS state, concat_ws(',', CASE WHEN o_orderkey % 10 = 0 THEN 'HASH_MISMATCH' END, CASE WHEN o_orderstatus = 'P' THEN 'FIELD_NOT_ALLOWED' END, CASE WHEN coalesce(s.event, 'CREATED') <> 'APPROVED' THEN 'NOT_APPROVED' END, CASE WHEN o_orderkey % 7 = 0 THEN 'BASE_VALUE_CHANGED' END, CASE WHEN o_orderkey % 6 = 0 THEN 'BASE_COMMIT_MOVED' END) AS reasons
FROM orders LEFT JOIN s ON s.patch_id = o_orderkey""")
def patch_reasons(spark, sf_dir):
    """Patches with their latest event and why they can't be applied."""
    k, value = F.col("o_orderkey"), F.col("o_orderpriority")
    patches = table(spark, sf_dir, "orders").select(k.alias("patch_id"), F.when(F.col("o_orderstatus") == "P", "id").otherwise("name").alias("field"), value.alias("value"), F.sha2(F.when(k % 10 == 0, F.lit("x")).otherwise(value).cast("binary"), 256).alias("digest"), F.when(k % 7 == 0, "old").alias("base_value"), F.when(k % 6 == 0, "c1").otherwise("c2").alias("base_commit"))
    events = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("patch_id"), F.struct("l_linenumber", F.when(F.col("l_returnflag") == "A", "APPROVED").when(F.col("l_returnflag") == "N", "CREATED").otherwise("REVOKED").alias("e")).alias("seq"), F.when(F.col("l_returnflag") == "A", "APPROVED").when(F.col("l_returnflag") == "N", "CREATED").otherwise("REVOKED").alias("event"), F.col("l_shipdate").alias("at"))
    stated = r.patch_state(patches, events)
    reasons = r.patch_reasons({c: F.col(c) for c in ("digest", "value", "field", "state", "base_value", "base_commit")}, F.lit(None).cast("string"), F.lit("c2"), ("name", "cat"))
    return stated.select("patch_id", "state", F.array_join(reasons, ",").alias("reasons"))


@query("""WITH p AS (SELECT l_partkey AS k, CASE WHEN l_linenumber % 2 = 0 THEN 'name' ELSE 'cat' END AS field, CASE WHEN l_quantity > 45 THEN NULL ELSE l_returnflag || l_orderkey END AS value, l_orderkey * 10 + l_linenumber AS seq FROM lineitem WHERE l_orderkey % 4 = 0),
l AS (SELECT k, field, value FROM (SELECT *, row_number() OVER (PARTITION BY k, field ORDER BY seq DESC, value DESC NULLS LAST) AS n FROM p) WHERE n = 1)
SELECT p_partkey::VARCHAR AS sku, CASE WHEN n.k IS NOT NULL THEN n.value ELSE p_name END AS name, CASE WHEN c.k IS NOT NULL THEN c.value ELSE p_type END AS cat FROM part LEFT JOIN l n ON n.k = p_partkey AND n.field = 'name' LEFT JOIN l c ON c.k = p_partkey AND c.field = 'cat'""")
def applied_patches(spark, sf_dir):
    """The last patch of each field; a patch to null counts."""
    line = table(spark, sf_dir, "lineitem").where("l_orderkey % 4 = 0")
    patches = line.select(F.col("l_partkey").cast("string").alias("sku"), F.when(F.col("l_linenumber") % 2 == 0, "name").otherwise("cat").alias("field"), F.when(F.col("l_quantity") <= 45, F.concat("l_returnflag", F.col("l_orderkey").cast("string"))).alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return r.apply_patches(parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.col("p_type").alias("cat")), patches, "sku", ["name", "cat"])


@query("""SELECT p_partkey::VARCHAR AS sku, f AS field, 't ' || p_partkey AS target, CASE WHEN (f = 'name' AND p_size % 2 = 0) OR (f = 'cat' AND p_size % 5 <> 0) THEN 'FRESH' ELSE 'STALE' END AS freshness FROM part, (VALUES ('name'), ('cat')) t(f)""")
def localized_upsert(spark, sf_dir):
    """Target texts stay; a field whose source hash changed is stale."""
    rows = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.when(part_size() % 5 != 0, F.col("p_type")).alias("cat"))
    old = parts(spark, sf_dir).select(part_sku(), F.explode(F.array(F.struct(F.lit("name").alias("field"), F.when(part_size() % 2 == 0, F.col("p_name")).otherwise("before").alias("v")), F.struct(F.lit("cat").alias("field"), F.col("p_type").alias("v")))).alias("x"), F.concat(F.lit("t "), part_key()).alias("target"), F.lit("FRESH").alias("freshness"))
    return r.localized_upsert(rows, old.select("sku", "x.field", "target", "freshness", F.sha2(F.col("x.v").cast("binary"), 256).alias("source_hash")), "sku", ["name", "cat"])


@query("""WITH q AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'PENDING' ELSE 'PROCESSING' END AS status, (event_id % 5)::INT AS attempts, ts FROM events), s AS (SELECT *, status = 'PROCESSING' AND TIMESTAMP '2024-01-20 12:00:00' - ts > INTERVAL 15 MINUTE AS old FROM q)
SELECT event_id, attempts, CASE WHEN old AND attempts >= 3 THEN 'FAILED' WHEN old THEN 'PENDING' ELSE status END AS status, CASE WHEN NOT old THEN strftime(ts, '%Y-%m-%d %H:%M') END AS claimed_at FROM s""")
def stale_claims(spark, sf_dir):
    """Claims older than 15 minutes go back to the queue, or fail after three attempts."""
    queue = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "PENDING").otherwise("PROCESSING").alias("status"), (F.col("event_id") % 5).cast("int").alias("attempts"), F.col("ts").cast("timestamp").alias("claimed_at"))
    out = r.claims_after(queue, F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return out.select("event_id", "attempts", "status", F.date_format("claimed_at", "yyyy-MM-dd HH:mm").alias("claimed_at"))


@query("""WITH m AS (SELECT p_partkey::VARCHAR AS sku, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS ordinal FROM part WHERE p_size > 5)
SELECT m.ordinal, m.sku, p_name AS name, CASE WHEN p_partkey IS NOT NULL THEN 'INCLUDED' ELSE 'MISSING' END AS state FROM m LEFT JOIN part ON p_partkey::VARCHAR = m.sku AND p_size % 6 <> 0""")
def selection_export(spark, sf_dir):
    """A selection in its frozen order with today's facts and a note of the missing ones."""
    members = r.with_ordinals(parts(spark, sf_dir).where("p_size > 5").select(part_sku(), "p_retailprice", "p_partkey"), ["p_retailprice", "p_partkey"], 8).select("ordinal", "sku")
    return r.selection_export(members, parts(spark, sf_dir).where("p_size % 6 <> 0").select(part_sku(), F.col("p_name").alias("name")), ["name"])


@query("""SELECT p_partkey, 'Kit ⟦0⟧ de ⟦1⟧ pieza, ⟦2⟧ y ⟦3⟧ en ⟦4⟧' AS masked, 'MODEL,NUMBER,DIMENSION,UNIT,URL' AS kinds, 'Kit X-' || p_size || 'A de ' || p_size || ' pieza, 3x' || p_size || ' y ' || p_size || ',5 kg en https://x.example/' || p_partkey AS restored, CASE WHEN p_partkey % 2 = 0 THEN true END AS round_trip FROM part""")
def protected_texts(spark, sf_dir):
    """Tokens to placeholders and back; changed placeholders give no text."""
    text = F.concat(F.lit("Kit X-"), part_size(), F.lit("A de "), part_size(), F.lit(" pieza, 3x"), part_size(), F.lit(" y "), part_size(), F.lit(",5 kg en https://x.example/"), part_key())
    masked, tokens = r.protect(text), r.protected_tokens(text)
    broken = F.when(part_key() % 2 == 0, F.col("masked")).otherwise(F.replace("masked", F.lit("⟦1⟧"), F.lit("⟦2⟧")))
    out = parts(spark, sf_dir).select("p_partkey", text.alias("text"), masked.alias("masked"), tokens.alias("tokens"))
    return out.select("p_partkey", "masked", F.array_join(F.transform("tokens", r.token_type), ",").alias("kinds"), r.restore(F.col("masked"), F.col("tokens")).alias("restored"), (r.restore(broken, F.col("tokens")) == F.col("text")).alias("round_trip"))


@query("""WITH w AS (SELECT DISTINCT p_partkey::VARCHAR AS sku, p_type AS category, lower(p_brand) AS text, unnest(string_split_regex(lower(p_name), '[^a-z0-9]+')) AS word FROM part),
f AS (SELECT DISTINCT 'F-' || split_part(p_name, ' ', 2) AS family, split_part(p_name, ' ', 2) AS alias, min(p_type) OVER (PARTITION BY split_part(p_name, ' ', 2)) AS category, 'brand#1' AS phrase FROM part),
m AS (SELECT sku, family, coalesce(w.category = f.category, false) AS close, contains(text, phrase) AS said FROM w JOIN f ON word = alias),
s AS (SELECT sku, family, round(least(0.99, 0.72 + CASE WHEN close THEN 0.18 ELSE 0 END + CASE WHEN said THEN 0.08 ELSE 0 END)::DOUBLE, 2) AS score FROM m WHERE close OR said)
SELECT sku, max(score) AS score, arg_min(family, (-score, family)) AS family FROM s GROUP BY sku""")
def product_families(spark, sf_dir):
    rows = parts(spark, sf_dir).select(part_sku(), F.col("p_name").alias("name"), F.col("p_type").alias("category"), F.col("p_brand").alias("text"))
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    known = parts(spark, sf_dir).groupBy(word.alias("alias")).agg(F.min("p_type").alias("category")).select(F.concat(F.lit("F-"), "alias").alias("family"), "alias", "category", F.lit("brand#1").alias("phrase"))
    return r.families(rows, known)


@query(f"""WITH {FULL} SELECT count(*) AS rows, count(*) FILTER (zh_name IS NOT NULL) AS with_name, count(*) FILTER (coalesce(zh_cat2, '') <> '') AS with_cat2, count(*) FILTER (coalesce(zh_spec, '') <> '') AS with_spec, round(count(*) FILTER (coalesce(zh_spec, '') <> '')::DOUBLE / nullif(count(*), 0), 6) AS spec_rate,
  count(*) FILTER (zh_freshness_status = 'STALE') AS stale, count(*) FILTER (zh_review_status = 'BLOCKED') AS blocked FROM full_rows WHERE status = 'CURRENT'""")
def dictionary_coverage(spark, sf_dir):
    """Conditional counts and rates in one aggregate."""
    rows = full_rows(spark, sf_dir, ()).where("status = 'CURRENT'")
    some = lambda c: ~is_blank(F.col(c))
    counted = counts_of(rows, {"rows": F.lit(True), "with_name": F.col("zh_name").isNotNull(), "with_cat2": some("zh_cat2"), "with_spec": some("zh_spec"), "stale": F.col("zh_freshness_status") == "STALE", "blocked": F.col("zh_review_status") == "BLOCKED"})
    return counted.withColumn("spec_rate", F.round(F.try_divide(F.col("with_spec"), F.col("rows")), 6))


@query("""WITH m AS (SELECT p_partkey::VARCHAR AS sku, p_type, p_brand FROM part WHERE lower(p_name) LIKE '%ring%')
SELECT count(*) AS matched, (SELECT string_agg(sku, ',' ORDER BY sku) FROM (SELECT sku FROM m ORDER BY sku LIMIT 10)) AS samples, (SELECT string_agg(p_type || '=' || n, ',' ORDER BY p_type) FROM (SELECT p_type, count(*) AS n FROM m GROUP BY 1)) AS types FROM m""")
def blast_radius(spark, sf_dir):
    """What a rule would touch: a count, ten samples (the feature) and a distribution of types."""
    hit = parts(spark, sf_dir).where(F.lower("p_name").like("%ring%")).select(part_sku(), "p_type")
    sample = hit.orderBy("sku").limit(10).agg(F.array_join(F.sort_array(F.collect_list("sku")), ",").alias("samples"))
    kinds = hit.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "p_type", F.col("n").cast("string")))), ",").alias("types"))
    return hit.agg(F.count(F.lit(1)).alias("matched")).join(sample).join(kinds)


@query("""WITH a AS (SELECT p_partkey::VARCHAR AS sku, p_name AS name, p_type AS cat, p_retailprice::VARCHAR AS price FROM part WHERE p_partkey % 11 <> 0), b AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size % 9 = 0 THEN upper(p_name) ELSE p_name END AS name, p_type AS cat, (CASE WHEN p_size = 30 THEN p_retailprice + 1 ELSE p_retailprice END)::VARCHAR AS price FROM part WHERE p_partkey % 13 <> 0),
j AS (SELECT coalesce(a.sku, b.sku) AS sku, a.sku AS sa, b.sku AS sb, a.name AS na, b.name AS nb, a.price AS pa, b.price AS pb FROM a FULL JOIN b ON a.sku = b.sku)
SELECT sku, 'MISSING_RIGHT' AS field, sku AS left_value, NULL AS right_value FROM j WHERE sb IS NULL UNION ALL SELECT sku, 'MISSING_LEFT', NULL, sku FROM j WHERE sa IS NULL
UNION ALL SELECT sku, 'name', na, nb FROM j WHERE sa IS NOT NULL AND sb IS NOT NULL AND na <> nb UNION ALL SELECT sku, 'price', pa, pb FROM j WHERE sa IS NOT NULL AND sb IS NOT NULL AND pa <> pb""")
def export_reconciliation(spark, sf_dir):
    """An export against its source: keys, names and prices."""
    a = parts(spark, sf_dir).where(part_key() % 11 != 0).select(part_sku(), F.col("p_name").alias("name"), F.col("p_type").alias("cat"), part_price().alias("price"))
    b = parts(spark, sf_dir).where(part_key() % 13 != 0).select(part_sku(), F.when(part_size() % 9 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"), F.col("p_type").alias("cat"), F.when(part_size() == 30, part_price() + 1).otherwise(part_price()).alias("price"))
    return keyed_difference(a, b, "sku", ["name", "cat", "price"])


@query(f"""WITH {FULL} SELECT es.sku, CASE WHEN p_partkey % 4 = 0 THEN 'MISSING_ZH' ELSE 'IDENTITY' END AS finding FROM es JOIN part ON p_partkey::VARCHAR = es.sku WHERE p_partkey % 4 = 0 OR coalesce(upper(es_cat2), '') <> coalesce(upper((SELECT zh_cat2 FROM zh WHERE zh.sku = es.sku)), '')""")
def language_parity(spark, sf_dir):
    """ES and ZH rows of the same SKUs with the same identity fields."""
    both = localizations(spark, sf_dir).select("sku", "language", F.upper("cat2").alias("cat2"))
    found = keyed_difference(both.where("language = 'es'"), both.where("language = 'zh'"), "sku", ["cat2"])
    return found.select("sku", F.when(F.col("field") == "MISSING_RIGHT", "MISSING_ZH").when(F.col("field") == "MISSING_LEFT", "MISSING_ES").otherwise("IDENTITY").alias("finding")).distinct()


@query(f"""WITH {FULL} SELECT p.sku, p.status, l.offline_date IS NOT NULL AS offline FROM products p JOIN lifecycle l USING (sku) WHERE (p.status = 'OFFLINE') <> (l.offline_date IS NOT NULL)""")
def status_mismatches(spark, sf_dir):
    """Products whose status is not that of their lifecycle."""
    from shelfwise.sources.full_catalogue import lifecycle

    joined = products(spark, sf_dir).join(lifecycle(spark, sf_dir), "sku").withColumn("offline", F.col("offline_date").isNotNull())
    return joined.where((F.col("status") == "OFFLINE") != F.col("offline")).select("sku", "status", "offline")


@query(f"""WITH {FULL} SELECT sha256(p.sku || '|' || substr(sha256(coalesce(es_name, '')), 1, 12)) AS queue_id, p.sku FROM full_rows p WHERE status = 'CURRENT' AND coalesce(trim(zh_cat2), '') = '' AND sku::BIGINT % 5 <> 1""")
def category_backlog(spark, sf_dir):
    """Current rows without a category enter a backlog once."""
    rows = full_rows(spark, sf_dir, ()).where("status = 'CURRENT'").where(is_blank(F.col("zh_cat2")))
    entries = rows.select(issue_id(F.col("sku"), F.substring(F.sha2(F.coalesce("es_name", F.lit("")).cast("binary"), 256), 1, 12)).alias("queue_id"), "sku")
    there = entries.where(F.col("sku").cast("long") % 5 == 1).select("queue_id")
    return entries.dropDuplicates(["queue_id"]).join(there, "queue_id", "left_anti")


@query("""SELECT lower(p_type) AS key, count(*) AS n, count(DISTINCT p_brand) AS values FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""")
def dictionary_conflicts(spark, sf_dir):
    """Keys of a dictionary that are not unique after case and blanks."""
    return parts(spark, sf_dir).groupBy(category_key(F.concat(F.lit(" "), F.col("p_type"))).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_brand").alias("values")).where("values > 1")


@query("""SELECT o_custkey, max(r) + 1 AS next_revision, count(*) AS revisions FROM (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) GROUP BY o_custkey UNION ALL SELECT c_custkey, 1, 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def next_revisions(spark, sf_dir):
    """The next revision of every unit, those without one included."""
    units = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("revisions"))
    joined = units.join(n, "o_custkey", "full_outer").withColumn("revisions", F.coalesce("revisions", F.lit(0)))
    return joined.select("o_custkey", (F.col("revisions") + 1).alias("next_revision"), "revisions")


@query("""SELECT l_returnflag AS category, bool_and(l_linenumber <> 7 OR l_quantity < 50) AS complete, count(*) AS cards, count(*) = 0 AS rescan FROM lineitem GROUP BY 1""")
def listing_coverage(spark, sf_dir):
    """Coverage of each category over its pages; one without cards is to be scanned again."""
    line = table(spark, sf_dir, "lineitem")
    whole = line.groupBy(F.col("l_returnflag").alias("category")).agg(F.every((F.col("l_linenumber") != 7) | (F.col("l_quantity") < 50)).alias("complete"), F.count(F.lit(1)).alias("cards"))
    return whole.withColumn("rescan", F.col("cards") == 0)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN trim(o_orderpriority) WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS value, CASE WHEN o_orderkey % 2 = 0 THEN 'APPROVED_REVISION' WHEN o_orderkey % 3 = 0 THEN 'UNRESOLVED' ELSE 'MEMORY_EXACT' END AS chosen FROM orders""")
def resolved_fields(spark, sf_dir):
    """A field's chain of sources: the first with a value, and its name."""
    from shelfwise.operators.resolution import resolve

    k = F.col("o_orderkey")
    chain = [("MANUAL_LOCK", F.lit("  ")), ("APPROVED_REVISION", F.when(k % 2 == 0, F.col("o_orderpriority"))), ("MEMORY_EXACT", F.when(k % 3 != 0, F.col("o_orderstatus"))), ("MEMORY_NORMALISED", F.lit(None).cast("string"))]
    value, source = resolve(chain)
    return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"), F.coalesce(source, F.lit("UNRESOLVED")).alias("chosen"))

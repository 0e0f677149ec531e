"""Text and semantic operators over documents, pages, details and benchmark terms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions import residue
from shelfwise.functions.texts import badges, collapse, distinct_details, fidelity_findings, has_markup, join_badges, numbers
from shelfwise.plans.registry import query
from shelfwise.sources.relations import table

TOKENS = r"list_filter(string_split_regex(lower({0}), '[^a-z0-9à-ÿ]+'), lambda x: x <> '')"


def tokens(column):
    return F.filter(F.split(F.lower(column), "[^a-z0-9à-ÿ]+"), lambda x: x != "")


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS k, json_type(props, '$.k') IS NOT NULL AS has_k FROM events""")
def json_details(spark, sf_dir):
    value = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", value.try_cast("long").alias("k"), value.isNotNull().alias("has_k"))


@query("""SELECT p_partkey, 'Brand: ' || p_brand || '; Size: ' || p_size || ' cm; note' AS details FROM part""")
def repaired_details(spark, sf_dir):
    """Exact repeats of key/value parts go; other parts keep their order."""
    text = F.concat(F.lit(" Brand : "), F.col("p_brand"), F.lit(";Size:"), F.col("p_size").cast("string"), F.lit(" cm; Brand:"), F.col("p_brand"), F.lit(" ;note;note"))
    return table(spark, sf_dir, "part").select("p_partkey", distinct_details(text).alias("details"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'NEW | RICH' ELSE 'NEW' END AS badges, CASE WHEN s_acctbal > 5000 THEN 2 ELSE 1 END AS n FROM supplier""")
def badge_lists(spark, sf_dir):
    raw = F.concat(F.lit(" NEW | "), F.when(F.col("s_acctbal") > 5000, "RICH |").otherwise(""))
    return table(spark, sf_dir, "supplier").select("s_suppkey", join_badges(badges(raw)).alias("badges"), F.size(badges(raw)).alias("n"))


@query(f"""WITH t AS (SELECT doc_id, lang, unnest({TOKENS.format("text")}) AS term FROM documents)
SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents, count(DISTINCT lang) AS languages FROM t GROUP BY term HAVING count(DISTINCT doc_id) >= 50""")
def term_frequency(spark, sf_dir):
    """Terms of 50 documents or more."""
    return term_counts(table(spark, sf_dir, "documents"), 50)


@query(f"""WITH t AS (SELECT doc_id, lang, unnest({TOKENS.format("text")}) AS term FROM documents)
SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents, count(DISTINCT lang) AS languages FROM t GROUP BY term HAVING count(DISTINCT doc_id) >= 2""")
def term_candidates(spark, sf_dir):
    """Terms of two documents or more, as the reference proposes them."""
    return term_counts(table(spark, sf_dir, "documents"))


def term_counts(docs, least: int = 2):
    """Occurrences and documents of each term in at least so many documents; a first count per document and term combines before the exchange; null identifiers and languages are none."""
    terms = docs.select("doc_id", "lang", F.explode(tokens(F.col("text"))).alias("term"))
    each = terms.groupBy("term", "lang", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    by_language = each.groupBy("term", "lang").agg(F.sum("n").alias("n"), F.count("doc_id").alias("d"))
    return by_language.groupBy("term").agg(F.sum("n").alias("occurrences"), F.sum("d").alias("documents"), F.count("lang").alias("languages")).where(F.col("documents") >= least)


@query(f"""WITH b AS (SELECT item_id, list_distinct({TOKENS.format("text")}) AS w FROM benchmark),
p AS (SELECT a.item_id, c.item_id AS other, len(list_intersect(a.w, c.w)) / len(list_distinct(list_concat(a.w, c.w))) AS s FROM b a JOIN b c ON a.item_id <> c.item_id AND len(list_intersect(a.w, c.w)) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(s, 6) DESC, other) AS n FROM p)
SELECT item_id, other, round(s, 6) AS similarity FROM r WHERE n <= 3""")
def similar_items(spark, sf_dir):
    """Three most similar items by shared tokens."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.array_distinct(tokens(F.col("text"))).alias("w"))
    return most_similar(items, 3)


@query(f"""WITH b AS (SELECT item_id, list_distinct({TOKENS.format("text")}) AS w FROM benchmark),
c AS (SELECT * FROM b ORDER BY item_id DESC LIMIT 200),
p AS (SELECT b.item_id, c.item_id AS other, len(list_intersect(b.w, c.w)) / len(list_distinct(list_concat(b.w, c.w))) AS s FROM b JOIN c ON b.item_id <> c.item_id AND len(list_intersect(b.w, c.w)) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(s, 6) DESC, other) AS n FROM p)
SELECT item_id, other, round(s, 6) AS similarity FROM r WHERE n <= 3""")
def newest_similar_items(spark, sf_dir):
    """Three most similar of the 200 newest items: the bound is part of the question, so pairs grow with the items alone."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.array_distinct(tokens(F.col("text"))).alias("w"))
    return most_similar(items, 3, newest=200)


def most_similar(items, best: int, newest: int | None = None):
    """(item_id, other, similarity) of each item's most similar others by shared tokens (column w), of equals the first.

    Shared tokens are counted where an item's tokens meet the others' index, so
    sets do not travel with pairs. A token that all items have still pairs all of
    them: newest bounds the candidates to so many of the largest identifiers, as
    a review of changed items asks for, and each item then meets that many.
    """
    sized = items.select("item_id", "w", F.size("w").alias("n"))
    others = sized if newest is None else sized.orderBy(F.desc("item_id")).limit(newest)
    asked = sized.select("item_id", F.col("n").alias("_n"), F.explode("w").alias("t"))
    index = others.select(F.col("item_id").alias("other"), F.col("n").alias("_m"), F.explode("w").alias("t"))
    shared = asked.join(index, "t").where("item_id <> other").groupBy("item_id", "other", "_n", "_m").agg(F.count(F.lit(1)).alias("_s"))
    similarity = F.round(F.col("_s") / (F.col("_n") + F.col("_m") - F.col("_s")), 6)
    ranked = shared.select("item_id", "other", similarity.alias("similarity")).withColumn("k", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("similarity"), "other")))
    return ranked.where(F.col("k") <= best).drop("k")


@query(r"""SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS target FROM pages""")
def page_links(spark, sf_dir):
    """Link targets of captured pages, one row each."""
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("target"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_matches(html, '(?i)</?[a-z][^>]*>|&(amp|lt|gt|quot|nbsp|#\d+);') AS marked,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""")
def page_facts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"), has_markup(F.col("html")).alias("marked"), F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title")
    )


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '(\d+(?:[.,]\d+)?)')) AS n_numbers, array_to_string(list_transform(regexp_extract_all(text, '(\d+(?:[.,]\d+)?)'), lambda x: replace(x, ',', '.')), ' ') AS numbers FROM documents""")
def document_numbers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(numbers(F.col("text"))).alias("n_numbers"), F.array_join(numbers(F.col("text")), " ").alias("numbers"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'EMPTY_REQUIRED_FIELD,NUMERIC_DROPPED,UNIT_DROPPED' WHEN p_partkey % 4 = 1 THEN 'HTML_RESIDUAL' WHEN p_partkey % 4 = 2 THEN 'NULL_UNDEFINED_RESIDUAL,NUMERIC_ADDED' ELSE '' END AS findings FROM part""")
def fidelity_audit(spark, sf_dir):
    """Portable rules on renderings with planted faults."""
    size = F.concat(F.lit("size "), F.col("p_size").cast("string"), F.lit(" cm"))
    case = F.col("p_partkey") % 4
    target = F.when(case == 0, "").when(case == 1, F.concat(F.lit("<b>"), size, F.lit("</b>"))).when(case == 2, F.concat(size, F.lit(" null 777"))).otherwise(size)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(fidelity_findings(size, target), ",").alias("findings"))


@query(r"""SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS user_turns, sum(length(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS chars FROM conversations GROUP BY conv_id""")
def conversation_profile(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.count_if(F.col("role") == "user").alias("user_turns"), F.sum(F.length(collapse(F.col("text")))).alias("chars"))


@query("""SELECT l.quality, l.toxic, d.lang, count(*) AS n, min(d.n_chars) AS shortest, max(d.n_chars) AS longest FROM labels l JOIN documents d USING (doc_id) GROUP BY ALL""")
def gold_evaluation(spark, sf_dir):
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return joined.groupBy("quality", "toxic", "lang").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


def term_profiles(rows, known, least: int = 2, samples: int = 3):
    """(term, occurrences, skus, categories, samples) of the terms of at least so many SKUs that a dictionary lacks.

    rows: sku, category, text. A term counts once for each text and place; its
    categories are 'name=count', sorted; its samples are the least texts that
    hold it, kept as a bounded list in every step. known: term.
    """
    texts = rows.groupBy("sku", "category", "text").agg(F.count(F.lit(1)).alias("k"))
    each = texts.select("sku", "category", "text", "k", F.explode(tokens(F.col("text"))).alias("term")).groupBy("term", "sku", "category", "text").agg((F.count(F.lit(1)) * F.first("k")).alias("n"))
    new = each.join(known.select(F.lower("term").alias("term")).distinct(), "term", "left_anti")
    by_category = new.groupBy("term", F.coalesce("category", F.lit("")).alias("category")).agg(F.sum("n").alias("n"))
    shares = by_category.groupBy("term").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "category", F.col("n").cast("string")))), ",").alias("categories"), F.sum("n").alias("occurrences"))
    counted = new.groupBy("term", "sku").agg(F.lit(1).alias("one")).groupBy("term").agg(F.sum("one").alias("skus")).where(F.col("skus") >= least)
    first = new.select("term", "text").distinct().withColumn("k", F.row_number().over(Window.partitionBy("term").orderBy("text"))).where(F.col("k") <= samples)
    shown = first.groupBy("term").agg(F.array_join(F.array_sort(F.collect_list("text")), " || ").alias("samples"))
    return counted.join(shares, "term").join(shown, "term").select("term", "occurrences", "skus", "categories", "samples")


@query(f"""WITH r AS (SELECT DISTINCT p_partkey AS sku, p_type AS category, t FROM (SELECT p_partkey, p_type, unnest([p_name, p_brand || ' ' || p_name]) AS t FROM part)),
e AS (SELECT sku, category, t, unnest({TOKENS.format("t")}) AS term FROM r), k AS (SELECT * FROM e WHERE term NOT IN (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) FROM part WHERE p_partkey % 50 = 0)),
c AS (SELECT term, category, count(*) AS n FROM k GROUP BY ALL), s AS (SELECT term, t, row_number() OVER (PARTITION BY term ORDER BY t) AS n FROM (SELECT DISTINCT term, t FROM k))
SELECT term, sum(n)::BIGINT AS occurrences, (SELECT count(DISTINCT sku) FROM k WHERE k.term = c.term) AS skus, string_agg(category || '=' || n, ',' ORDER BY category || '=' || n) AS categories, (SELECT string_agg(t, ' || ' ORDER BY t) FROM s WHERE s.term = c.term AND s.n <= 3) AS samples FROM c GROUP BY term
HAVING (SELECT count(DISTINCT sku) FROM k WHERE k.term = c.term) >= 2""")
def profiled_terms(spark, sf_dir):
    """Terms that the dictionary lacks, with their categories and samples."""
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("category"), F.explode(F.array("p_name", F.concat_ws(" ", "p_brand", "p_name"))).alias("text"))
    return term_profiles(rows, part.where("p_partkey % 50 = 0").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("term")))


@query(r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(t, '(?i)https?://[^\s;；]+', '', 'g'), '([A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+)', 1)) AS w FROM t),
l AS (SELECT doc_id, count(*) AS n FROM w WHERE w NOT IN ('que') AND lower(w) NOT IN ('que', 'the') AND NOT regexp_matches(w, '^(?:USB(?:-[A-Z])?|LED|LCD|DIY|FSC|E27|A\d+|D\d+|XL?|[A-Z]{1,6}\d{2,}[A-Z0-9-]*|[A-Z]{2,6}|\d+(?:mg|mcg|mAh|V|W|D))$')
  AND (length(w) > 2 OR lower(w) IN ('de', 'la', 'el', 'un', 'y', 'en', 'o')) GROUP BY doc_id)
SELECT t.doc_id, coalesce(l.n, 0)::BIGINT AS ordinary, NOT regexp_matches(t, '[㐀-鿿]') AND (regexp_matches(lower(t), '[áéíóúüñ]') OR regexp_matches(' ' || lower(t) || ' ', '[^\p{L}\p{N}_](de|del|la|el|los|las|para|con|sin|una|uno|un|y|en|por|más|color|colores|tamaño|unidades|piezas|pack|set)[^\p{L}\p{N}_]')) AS untranslated FROM t LEFT JOIN l USING (doc_id)""")
def language_residue(spark, sf_dir):
    """Words of whole documents that neither an allow-list nor a technical form explains."""
    words = residue.ordinary_words(F.col("text"), F.array(F.lit("que"), F.lit("The")))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("long").alias("ordinary"), residue.is_untranslated(F.col("text")).alias("untranslated"))

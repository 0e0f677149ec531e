"""Queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, ball_clusters, decontamination, html_text, ngram_join, pieces, quality_classifier, quality_rules, repeated_spans, token_counts, token_tables, toxicity, turn_repair
from .shared import crc_rest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the public tokenizers' package, whose path all machines share."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids under merge-dropout of every whole text, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), ["doc_id"])


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(crc_rest("doc_id", 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    return scored.select("doc_id", (crc_rest("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.line_frequency(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_lines", "n_left", "kept")


OP3_SQL = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
lines AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM docs),
full_lines AS (
  SELECT doc_id, source, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
frequent AS (
  SELECT f.source, f.norm FROM full_lines f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
  GROUP BY f.source, f.norm, h.n HAVING count(DISTINCT f.doc_id) > greatest(25, 0.1 * h.n)),
removed AS (
  SELECT f.doc_id, count(*) AS n_lines,
         sum(len(list_filter(string_split_regex(f.line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS n_words
  FROM full_lines f JOIN frequent q ON f.source IS NOT DISTINCT FROM q.source AND f.norm = q.norm GROUP BY f.doc_id),
starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS k FROM words WHERE len(w) >= 8),
windows AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, array_to_string(w[k:k + 7], chr(1))) AS c FROM starts),
repeats AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - k, 8))) AS n
  FROM (SELECT doc_id, k, lead(k) OVER (PARTITION BY doc_id ORDER BY k) AS nxt FROM windows WHERE c > 1) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(m.n_lines, 0) AS n_removed_lines, len(w.w) - coalesce(m.n_words, 0) AS n_left
  FROM words w LEFT JOIN dups d USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN removed m USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       n_removed_lines::BIGINT AS n_removed_lines, n_left::BIGINT AS n_left,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_left >= 0.35 * n_words AS kept
FROM base
"""

def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnable = crc_rest("doc_id", 3) != 1
    positives = table(spark, sf_dir, "labels").where(learnable & (F.col("quality") == 1))
    classifier = quality_classifier.fit(docs, positives, docs.where(learnable).select("doc_id"))
    return quality_classifier.score(docs, classifier, ["doc_id"]).select("doc_id", (~learnable).alias("held_out"), "score", "predicted")


def op5_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_tables.digests(docs, tokenizer_file("byte_bpe_50k.json"))


def op6_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
reach AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.doc_id),
lowest AS (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(lowest.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.k, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
words AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM hits),
hit_counts AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, (coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w)) AS contaminated
FROM d LEFT JOIN hit_counts h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_rest("doc_id", 7) != 2).alias("train"))
    scored = attention_lm.score(docs, "train", tokenizer_file("piece_bpe_32k.model"), ["doc_id"])
    return scored.select("doc_id", (crc_rest("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_clusters.ball_kmeans(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).members()


def op11_sql() -> str:
    """Plain rounds of comparing every vector with every centroid, one CTE each."""
    parts = [r"""
v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) - 1)::INTEGER AS j, x AS c
  FROM v QUALIFY row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) <= 8)"""]
    for r in range(ball_clusters.ROUNDS + 1):
        parts.append(f"""
d{r} AS (
  SELECT vec_id, x, j, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v CROSS JOIN c{r}),
a{r} AS MATERIALIZED (SELECT vec_id, x, arg_min(j, d * 1000 + j) AS j, min(d) AS d FROM d{r} GROUP BY vec_id, x)""")
        parts.append(f"""
s{r} AS (SELECT j, k, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(x) AS e, generate_subscripts(x, 1) AS k FROM a{r}) GROUP BY j, k),
m{r} AS (SELECT j, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY k) AS c FROM s{r} GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT o.j, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (j))""")
    last = ball_clusters.ROUNDS
    return "WITH" + ",".join(parts) + f"""
SELECT a.vec_id, a.j AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.j)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} c ON a.j = c.j
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"), ["doc_id"])


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.report(rows, turn_repair.Repair(turn_repair.damaged(rows)))


OP13_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT) AS b
  FROM conversations),
fates AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(b, lambda x: [x, 0, 0, 0, 0, 0, 0, 0]))),
                            lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295) % 20 AS fate FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fates WHERE fate <> 0),
placed AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS c,
         regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS e
  FROM damaged),
judged AS (
  SELECT *, CASE WHEN e = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN e NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM placed),
lettered AS (SELECT *, CASE fault WHEN 'none' THEN c WHEN 'truncated' THEN upper(c) ELSE 'd' END AS l FROM judged),
convs AS (
  SELECT conv_id, string_agg(l, '' ORDER BY i) AS sig, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lettered GROUP BY conv_id),
moves AS (SELECT * FROM (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)) t(s, n, z)),
edits AS (
  SELECT s, m, z, e, p FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) t(s, m, z), (VALUES ('K', 0)) q(e, p)
  UNION ALL SELECT s, m, z, 'R', 2 FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) t(s, z), (VALUES ('s'), ('u'), ('a'), ('o')) q(m)
  UNION ALL SELECT s, m, s, 'D', 3 FROM (VALUES (0), (1), (2), (3)) t(s), (VALUES ('s'), ('u'), ('a'), ('o'), ('d')) q(m)),
dp AS (
  SELECT DISTINCT sig, 0 AS i, 0 AS s, {'cost': 0, 'audit': ''} AS best FROM convs
  UNION ALL
  SELECT dp.sig, dp.i + 1, edits.z,
         min({'cost': dp.best.cost + 2 * moves.n + edits.p + CASE WHEN edits.e <> 'D' AND substr(dp.sig, dp.i + 1, 1) <> lower(substr(dp.sig, dp.i + 1, 1)) THEN 1 ELSE 0 END,
              'audit': dp.best.audit || repeat('I', moves.n) || edits.e})
  FROM dp JOIN moves ON moves.s = dp.s JOIN edits ON edits.s = moves.z AND edits.m = lower(substr(dp.sig, dp.i + 1, 1))
  WHERE dp.i < length(dp.sig) GROUP BY dp.sig, dp.i, edits.z),
solved AS (
  SELECT sig, min({'cost': best.cost + 2 * n, 'audit': best.audit || repeat('I', n)}) AS best
  FROM dp JOIN moves USING (s) WHERE i = length(sig) AND z IN (0, 3) GROUP BY sig),
steps AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS e, generate_subscripts(string_split(best.audit, ''), 1) AS k FROM convs JOIN solved USING (sig) WHERE best.audit <> ''),
counted AS (
  SELECT conv_id, e, k, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS p FROM steps),
rowed AS (
  SELECT q.conv_id, q.e, q.k, q.p, r.role, r.text, max((q.p = 1 AND q.e = 'K' AND r.c = 's')::INTEGER) OVER (PARTITION BY q.conv_id) AS lead
  FROM counted q LEFT JOIN lettered r ON q.conv_id IS NOT DISTINCT FROM r.conv_id AND q.i = r.i AND q.e <> 'I'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (p - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t
  FROM rowed WHERE e <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(s.best.cost, 0)::BIGINT AS cost, coalesce(s.best.audit, '') AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN convs c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved s ON c.sig = s.sig LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""


QUERIES = {
    f.__name__: f
    for f in (op1_merge_dropout, op2_toxicity, op3_quality_rules, op4_quality_classifier, op5_token_tables, op6_repeated_spans, op7_ngram_join, op8_decontamination, op9_main_text, op10_attention_lm, op11_ball_kmeans, op12_token_counts, op13_turn_repair)
}
ORACLE_SQL = {"op3_quality_rules": OP3_SQL, "op7_ngram_join": OP7_SQL, "op8_decontamination": OP8_SQL, "op11_ball_kmeans": op11_sql(), "op13_turn_repair": OP13_SQL}

"""Price reviews from run evidence, presence histories, queues, dictionaries, resumed stages and published pairs over the star-schema tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.operators import entities, presence_history as ph, price_review
from shelfwise.operators.stages import Ledger, Stage
from shelfwise.operators.views import Views
from shelfwise.plans.registry import query
from shelfwise.sources.publish import Publication
from shelfwise.sources.relations import catalog, dated, part_sku, table
from shelfwise.sources.storage import shared_folder, written
from shelfwise.streaming import queue

RUNS = """seen AS (SELECT user_id::VARCHAR AS sku, ts::DATE AS day, strftime(ts, '%Y-%m-%d') || '-' || user_id % 8 AS run_id, bool_or(event_type IN ('view', 'click')) AS present FROM events GROUP BY ALL),
commits AS (SELECT DISTINCT run_id, 'c' || run_id AS commit_id, day AS committed_at, CASE WHEN day(day) % 7 = 0 THEN 'FAILED' ELSE 'COMMITTED' END AS status FROM seen),
members AS (SELECT strftime(ts, '%Y-%m-%d') || '-' || user_id % 8 AS run_id, user_id::VARCHAR AS sku, event_id, event_type,
  CASE WHEN value > 60 THEN 'true' WHEN value > 40 THEN '"1"' WHEN value > 30 THEN '1' ELSE 'false' END AS w,
  CASE WHEN value > 70 THEN '"unknown"' ELSE '{"original_price":' || (value > 35)::VARCHAR || ',"unit_price":' || (value < 25)::VARCHAR || '}' END AS f FROM events),
evidence AS (SELECT run_id, CASE WHEN run_id LIKE '%-3' THEN '[1]' ELSE '{"price_observation_invalid":{' || coalesce(string_agg('"' || sku || '":' || w, ',' ORDER BY event_id) FILTER (event_type = 'purchase'), '') ||
  '},"price_field_observation_invalid":' || CASE WHEN run_id LIKE '%-5' THEN '[]' ELSE '{' || coalesce(string_agg('"' || sku || '":' || f, ',' ORDER BY event_id) FILTER (event_type = 'error'), '') || '}' END || '}' END AS evidence FROM members GROUP BY run_id),
latest AS (SELECT sku, run_id FROM seen JOIN commits USING (run_id) WHERE present AND status = 'COMMITTED' QUALIFY row_number() OVER (PARTITION BY sku ORDER BY day DESC, committed_at DESC, commit_id DESC) = 1)"""
FLAGS = """whole AS (SELECT e.run_id, j.key AS sku, j.value::VARCHAR AS v, row_number() OVER (PARTITION BY e.run_id, j.key ORDER BY j.rowid) AS n FROM evidence e, json_each(e.evidence, '$.price_observation_invalid') j WHERE json_type(e.evidence, '$.price_observation_invalid') = 'OBJECT'),
field AS (SELECT e.run_id, j.key AS sku, j.value AS v, row_number() OVER (PARTITION BY e.run_id, j.key ORDER BY j.rowid) AS n FROM evidence e, json_each(e.evidence, '$.price_field_observation_invalid') j WHERE json_type(e.evidence, '$.price_field_observation_invalid') = 'OBJECT'),
flags AS (SELECT l.sku, l.run_id, coalesce(w.v IN ('true', '1'), false) AS invalid_price, coalesce((f.v->>'$.original_price') = 'true', false) AS invalid_original, coalesce((f.v->>'$.unit_price') = 'true', false) AS invalid_unit
  FROM latest l LEFT JOIN whole w ON w.run_id = l.run_id AND w.sku = l.sku AND w.n = 1 LEFT JOIN field f ON f.run_id = l.run_id AND f.sku = l.sku AND f.n = 1)"""


def run_relations(spark, sf_dir):
    """(observations, commits, evidence): a run for each day and eighth of the SKUs, with evidence in which SKUs repeat."""
    day = F.to_date("ts")
    run = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-"), (F.col("user_id") % 8).cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("sku"), day.alias("day"), run.alias("run_id"), "event_type", "value")
    observations = events.groupBy("sku", F.col("day").alias("observation_date"), "run_id").agg(F.when(F.bool_or(F.col("event_type").isin("view", "click")), "PRESENT").otherwise("ABSENT").alias("presence_state"))
    commits = observations.select("run_id", F.concat(F.lit("c"), "run_id").alias("commit_id"), F.col("observation_date").alias("committed_at"), F.when(F.dayofmonth("observation_date") % 7 == 0, "FAILED").otherwise("COMMITTED").alias("status")).distinct()
    whole = F.when(F.col("value") > 60, "true").when(F.col("value") > 40, '"1"').when(F.col("value") > 30, "1").otherwise("false")
    fields = F.when(F.col("value") > 70, '"unknown"').otherwise(F.concat(F.lit('{"original_price":'), (F.col("value") > 35).cast("string"), F.lit(',"unit_price":'), (F.col("value") < 25).cast("string"), F.lit("}")))
    member = lambda kind, value: F.collect_list(F.when(F.col("event_type") == kind, F.struct("event_id", F.concat(F.lit('"'), "sku", F.lit('":'), value).alias("m"))))
    joined = lambda name: F.array_join(F.transform(F.array_sort(name), lambda x: x["m"]), ",")
    texts = events.groupBy("run_id").agg(member("purchase", whole).alias("w"), member("error", fields).alias("f"))
    second = F.when(F.col("run_id").endswith("-5"), "[]").otherwise(F.concat(F.lit("{"), joined("f"), F.lit("}")))
    text = F.concat(F.lit('{"price_observation_invalid":{'), joined("w"), F.lit('},"price_field_observation_invalid":'), second, F.lit("}"))
    return observations, commits, texts.select("run_id", F.when(F.col("run_id").endswith("-3"), "[1]").otherwise(text).alias("evidence"))


@query(f"WITH {RUNS}, {FLAGS} SELECT * FROM flags")
def price_flags(spark, sf_dir):
    """Flags by the evidence of each SKU's last present run; of repeated keys the first counts."""
    return price_review.price_flags(*run_relations(spark, sf_dir))


@query(f"""WITH {RUNS}, {FLAGS} SELECT p_partkey::VARCHAR AS sku, CASE WHEN NOT coalesce(invalid_price, false) THEN p_retailprice END AS current_price, CASE WHEN NOT coalesce(invalid_price OR invalid_original, false) THEN p_retailprice + 1 END AS original_price,
  CASE WHEN NOT coalesce(invalid_price OR invalid_unit, false) THEN p_size || ' €/kg' END AS unit_price FROM part LEFT JOIN flags ON flags.sku = p_partkey::VARCHAR""")
def reviewed_prices(spark, sf_dir):
    products = table(spark, sf_dir, "part").select(part_sku(), F.col("p_retailprice").alias("current_price"), (F.col("p_retailprice") + 1).alias("original_price"), F.concat(F.col("p_size").cast("string"), F.lit(" €/kg")).alias("unit_price"))
    return price_review.reviewed_prices(products, price_review.price_flags(*run_relations(spark, sf_dir)))


#: A seed over the first days, two dated sources of which one can't see absences, committed runs after them, one month's days left out.
HISTORY = """span AS (SELECT min(ts::DATE) AS d0 FROM events),
per AS (SELECT user_id::VARCHAR AS sku, ts::DATE AS day, date_diff('day', d0, ts::DATE) AS n, user_id, bool_or(event_type = 'view') AS v, bool_or(event_type = 'error') AS e, bool_or(event_type = 'click') AS c, count(*) AS k FROM events, span GROUP BY ALL),
seed AS (SELECT sku, day, CASE WHEN v THEN '1' WHEN e THEN '0' ELSE 'UNKNOWN' END AS value FROM per WHERE user_id % 3 = 0 AND n < 5),
cells AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'b' ELSE 'a' END AS source, sku, day, CASE WHEN c THEN NULL WHEN e THEN '0' ELSE 'UNKNOWN' END AS value FROM per WHERE n < 12),
sources AS (SELECT 'a' AS source, 1 AS position, 3 AS a, 8 AS b, true AS capable UNION ALL SELECT 'b', 2, 7, 10, false),
runs AS (SELECT day, n, 'r' || n AS run_id, count(*) AS n_seen FROM per GROUP BY ALL),
usable AS (SELECT * FROM runs WHERE n > 4 AND n % 6 <> 5 AND n < 28),
owners AS (SELECT DISTINCT day, 0 AS kind, 0 AS position, 'seed' AS source, true AS absence FROM seed
  UNION ALL SELECT (d0 + i::INTEGER)::DATE, 1, position, source, capable FROM sources, span, generate_series(a, b) g(i)
  UNION ALL SELECT day, 2, 0, run_id, true FROM usable),
days AS (SELECT * FROM owners WHERE strftime(day, '%m-%d') <> '01-15' QUALIFY row_number() OVER (PARTITION BY day ORDER BY kind, position, source) = 1),
said AS (SELECT sku, day, 0 AS kind, 'seed' AS source, value FROM seed
  UNION ALL SELECT sku, c.day, 1, c.source, coalesce(c.value, '1') FROM cells c JOIN sources s USING (source), span WHERE date_diff('day', d0, c.day) BETWEEN a AND b
  UNION ALL SELECT sku, day, 2, 'r' || n, CASE WHEN v OR c THEN '1' ELSE '0' END FROM per),
chosen AS (SELECT s.* FROM said s JOIN days d ON d.day = s.day AND d.kind = s.kind AND d.source = s.source),
skus AS (SELECT sku, bool_or(seeded) AS seeded FROM (SELECT sku, true AS seeded FROM seed UNION ALL SELECT sku, false FROM chosen WHERE value = '1') GROUP BY sku),
history AS (SELECT k.sku, d.day, coalesce(c.value, CASE WHEN d.kind = 0 AND NOT k.seeded THEN 'UNKNOWN' WHEN d.absence THEN '0' ELSE 'UNKNOWN' END) AS value, d.kind FROM skus k CROSS JOIN days d LEFT JOIN chosen c ON c.sku = k.sku AND c.day = d.day)"""


def history_inputs(spark, sf_dir, torn: bool = False):
    """Seed, its capability, dated sources, their cells, runs and their observations; torn: with contradictions and a run that states too many rows."""
    events = table(spark, sf_dir, "events")
    first = events.agg(F.to_date(F.min("ts")).alias("d0"))
    per = events.join(F.broadcast(first)).groupBy(F.col("user_id").cast("string").alias("sku"), "user_id", F.to_date("ts").alias("day"), F.datediff(F.to_date("ts"), "d0").alias("n"), "d0").agg(*[F.bool_or(F.col("event_type") == k).alias(a) for k, a in (("view", "v"), ("error", "e"), ("click", "c"))])
    seed = per.where("user_id % 3 = 0 AND n < 5").select("sku", "day", F.when(F.col("v"), "1").when(F.col("e"), "0").otherwise("UNKNOWN").alias("value"))
    cells = per.where("n < 12").select(F.when(F.col("user_id") % 2 == 0, "b").otherwise("a").alias("source"), "sku", "day", F.when(F.col("c"), None).when(F.col("e"), "0").otherwise("UNKNOWN").alias("value"))
    if torn:
        cells = cells.union(cells.where("sku LIKE '%1'").withColumn("value", F.lit("0")))
    looks = F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(p).alias("position"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("absence_capable"), F.lit(True).alias("complete")) for s, p, a, b, c in (("a", 1, 3, 8, True), ("b", 2, 7, 10, False))]))
    sources = first.select("d0", looks.alias("s")).select("s.*", F.date_add("d0", F.col("s.a")).alias("first_day"), F.date_add("d0", F.col("s.b")).alias("last_day"))
    n = F.col("n")
    runs = per.groupBy("day", "n").agg(F.count(F.lit(1)).alias("observation_count")).select(F.concat(F.lit("r"), n).alias("run_id"), "day", F.when(n % 6 == 5, "FAILED").otherwise("COMMITTED").alias("status"), F.lit("PASS").alias("qa"), (n >= 28).alias("dry"), (F.col("observation_count") + (F.when(n == 20, 1).otherwise(0) if torn else 0)).alias("observation_count"))
    if torn:
        runs = runs.union(runs.where("run_id = 'r18'").withColumn("run_id", F.lit("r18b")))
    observations = per.select(F.concat(F.lit("r"), n).alias("run_id"), "sku", "day", F.when(F.col("v") | F.col("c"), "PRESENT").otherwise("ABSENT").alias("presence_state"), F.lit(True).alias("observation_complete"), F.lit(True).alias("absence_capable"))
    capable = spark.range(1).select(F.lit(True).alias("absence_capable"), F.lit(True).alias("complete"))
    return seed, capable, sources, cells, runs, observations


@query(f"WITH {HISTORY} SELECT sku, day::VARCHAR AS day, value, kind FROM history")
def presence_history(spark, sf_dir):
    """Every product on every day: what the day's source says, zero only where it could have seen the product."""
    seed, capable, sources, cells, runs, observations = history_inputs(spark, sf_dir)
    # the month of the data has one day left out by a history of its own in the tests; here the fifteenth is no day of any source
    return dated(ph.presence_history(seed, capable, sources, cells, runs.where("dayofmonth(day) <> 15"), observations)[0])


@query(f"""WITH {HISTORY}, x AS (SELECT sku, day, value FROM history)
SELECT sku, min(day) FILTER (value = '1')::VARCHAR AS first_seen, max(day) FILTER (value = '1')::VARCHAR AS last_seen, count(*) FILTER (value = '1') AS days_present, count(*) FILTER (value = 'UNKNOWN') AS days_unknown FROM x GROUP BY sku""")
def presence_spans(spark, sf_dir):
    return dated(ph.presence_spans(presence_history(spark, sf_dir).withColumn("day", F.to_date("day"))))


@query(f"""WITH {HISTORY}, x AS (SELECT sku, day, value, row_number() OVER (PARTITION BY sku ORDER BY day) AS n FROM history), y AS (SELECT *, n - row_number() OVER (PARTITION BY sku ORDER BY day) AS k FROM x WHERE value = '0')
SELECT sku, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS days FROM y GROUP BY sku, k""")
def known_absences(spark, sf_dir):
    """Runs of days on which a product is known to be absent."""
    return dated(ph.absences(presence_history(spark, sf_dir).withColumn("day", F.to_date("day"))))


@query(f"""WITH {HISTORY}, bad AS (SELECT s.day, s.sku, s.source FROM said s JOIN days d ON d.day = s.day AND d.kind = 1 AND s.kind = 1 AND d.source = s.source WHERE s.sku LIKE '%1' AND s.value <> '0')
SELECT 'HISTORY_SOURCE_PRESENCE_CONFLICT' AS code, day::VARCHAR AS day, sku, source FROM bad UNION ALL SELECT 'HISTORY_MULTIPLE_COMMITTED_RUNS', day::VARCHAR, NULL, 'r18b' FROM runs WHERE run_id = 'r18'
UNION ALL SELECT 'HISTORY_RUN_OBSERVATIONS_INCOMPLETE', day::VARCHAR, NULL, run_id FROM runs WHERE run_id = 'r20'""")
def history_faults(spark, sf_dir):
    """Sources that contradict themselves, two runs of a day, a run with other rows than it states."""
    seed, capable, sources, cells, runs, observations = history_inputs(spark, sf_dir, torn=True)
    return dated(ph.presence_history(seed, capable, sources, cells, runs.where("dayofmonth(day) <> 15"), observations)[1])


#: The queue's minutes and retries in the query; its claims last three days, as its events are hours apart.
MINUTES, RETRIES = 3 * 24 * 60, 2


def queue_actions(events):
    kind = F.col("event_type")
    action = F.when(kind == "signup", F.when(F.col("value") > 50, "REQUEUE").otherwise("INGEST")).when(kind == "view", "CLAIM").when(kind == "click", "BLOCK").when(kind == "error", "FAIL").otherwise("COMPLETE")
    return events.select(F.col("user_id").cast("string").alias("unit"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), action.alias("action"), F.concat(F.lit("e"), "event_id").alias("reason"))


@query(rf"""WITH RECURSIVE a AS (SELECT user_id::VARCHAR AS unit, ts AS tm, 'e' || event_id AS reason, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
  CASE event_type WHEN 'signup' THEN CASE WHEN value > 50 THEN 'REQUEUE' ELSE 'INGEST' END WHEN 'view' THEN 'CLAIM' WHEN 'click' THEN 'BLOCK' WHEN 'error' THEN 'FAIL' ELSE 'COMPLETE' END AS action FROM events),
s AS (SELECT unit, 0::BIGINT AS n, NULL::VARCHAR AS status, 0 AS attempts, NULL::TIMESTAMP AS claimed_at, NULL::VARCHAR AS reason FROM (SELECT DISTINCT unit FROM a)
  UNION ALL SELECT unit, n,
    CASE WHEN before IS NULL THEN CASE WHEN action = 'INGEST' THEN 'PENDING' END WHEN action = 'CLAIM' AND before IN ('PENDING', 'RETRY') THEN 'CLAIMED' WHEN before = 'CLAIMED' AND action = 'COMPLETE' THEN 'COMPLETED'
      WHEN before = 'CLAIMED' AND action = 'FAIL' THEN CASE WHEN attempts < {RETRIES} THEN 'RETRY' ELSE 'FAILED' END WHEN before = 'CLAIMED' AND action = 'BLOCK' THEN 'BLOCKED' WHEN before = 'BLOCKED' AND action = 'REQUEUE' THEN 'RETRY' ELSE before END,
    attempts + CASE WHEN before = 'CLAIMED' AND action = 'FAIL' THEN 1 ELSE 0 END,
    CASE WHEN action = 'CLAIM' AND before IN ('PENDING', 'RETRY') THEN tm WHEN before = 'CLAIMED' AND action NOT IN ('COMPLETE', 'FAIL', 'BLOCK') THEN claimed_at END,
    CASE WHEN before = 'CLAIMED' AND action IN ('FAIL', 'BLOCK') OR before = 'BLOCKED' AND action = 'REQUEUE' THEN new_reason WHEN before = 'CLAIMED' AND action = 'COMPLETE' OR before IN ('PENDING', 'RETRY') AND action = 'CLAIM' THEN NULL ELSE old_reason END
  FROM (SELECT s.unit, a.n, a.tm, a.action, s.attempts, s.claimed_at, a.reason AS new_reason,
      CASE WHEN s.status = 'CLAIMED' AND a.tm > s.claimed_at + INTERVAL {MINUTES} MINUTE THEN 'RETRY' ELSE s.status END AS before,
      CASE WHEN s.status = 'CLAIMED' AND a.tm > s.claimed_at + INTERVAL {MINUTES} MINUTE THEN '{queue.STALE}' ELSE s.reason END AS old_reason FROM s JOIN a ON a.unit = s.unit AND a.n = s.n + 1)),
last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY unit ORDER BY n DESC) = 1), late AS (SELECT max(ts) AS w FROM events)
SELECT unit, CASE WHEN status = 'CLAIMED' AND w > claimed_at + INTERVAL {MINUTES} MINUTE THEN 'RETRY' ELSE status END AS status, attempts, CASE WHEN status = 'CLAIMED' AND w > claimed_at + INTERVAL {MINUTES} MINUTE THEN '{queue.STALE}' ELSE reason END AS reason FROM last, late WHERE status IS NOT NULL""")
def queue_states(spark, sf_dir):
    """The queue after a stream of all events: one state for each unit, stale claims by timer."""
    source = table(spark, sf_dir, "events")
    # a pattern, as a stream reads a folder or what a pattern names, and the table may be one file
    events = spark.readStream.schema(source.schema).parquet(f"{sf_dir}/events.parque[t]")
    folder = f"{shared_folder(spark)}/queue-{uuid.uuid4().hex[:12]}"
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        log = queue.transitions(queue_actions(events), MINUTES, RETRIES)
        run = log.writeStream.format("parquet").option("path", f"{folder}/log").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        if kept is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return queue.latest_states(spark.read.parquet(f"{folder}/log"))


BRANDS = """brands AS (SELECT p_brand || ' ' || p_size AS brand_id, 'Name ' || p_size % 9 || ' ' || p_type AS canonical_name, p_brand || '-' || p_size % 7 || '| x' || min(p_partkey) AS aliases, CASE WHEN p_size % 4 = 0 THEN 'HUMAN' ELSE 'AUTOMATIC_REFERENCE' END AS confidence, 'UNREVIEWED' AS review_status FROM part WHERE p_size < 30 GROUP BY p_brand, p_size, p_type),
firsts AS (SELECT * FROM brands QUALIFY row_number() OVER (PARTITION BY brand_id ORDER BY canonical_name) = 1),
keyed AS (SELECT DISTINCT brand_id, trim(lower(regexp_replace(unnest([brand_id, canonical_name] || string_split(aliases, '|')), '\\s+', ' ', 'g'))) AS key FROM firsts)"""


def brand_rows(spark, sf_dir):
    """Brands of which several share a name or an alias with others, one row for each identifier."""
    size = F.col("p_size")
    grouped = table(spark, sf_dir, "part").where("p_size < 30").groupBy("p_brand", "p_size", "p_type").agg(F.min("p_partkey").alias("k"))
    rows = grouped.select(
        F.concat("p_brand", F.lit(" "), size.cast("string")).alias("brand_id"), F.concat(F.lit("Name "), (size % 9).cast("string"), F.lit(" "), "p_type").alias("canonical_name"),
        F.concat("p_brand", F.lit("-"), (size % 7).cast("string"), F.lit("| x"), F.col("k").cast("string")).alias("aliases"), F.when(size % 4 == 0, "HUMAN").otherwise(entities.AUTOMATIC).alias("confidence"), F.lit("UNREVIEWED").alias("review_status"),
    )
    first = rows.groupBy("brand_id").agg(F.min(F.struct("canonical_name", "aliases", "confidence", "review_status")).alias("r"))
    return first.select("brand_id", "r.*")


@query(f"""WITH RECURSIVE {BRANDS}, reach AS (SELECT brand_id, brand_id AS root FROM firsts UNION SELECT b.brand_id, reach.root FROM reach JOIN keyed a ON a.brand_id = reach.brand_id JOIN keyed b ON b.key = a.key)
SELECT brand_id, min(root) AS root FROM reach GROUP BY brand_id""")
def brand_classes(spark, sf_dir):
    """Brands that share an identifier, name or alias, over any number of steps."""
    rows = brand_rows(spark, sf_dir)
    keyed = rows.select("brand_id", F.explode(entities.identity_keys(F.col("brand_id"), F.col("canonical_name"), F.col("aliases"))).alias("key"))
    return entities.connected(keyed, "brand_id", "key")


@query(f"""WITH RECURSIVE {BRANDS}, reach AS (SELECT brand_id, brand_id AS root FROM firsts UNION SELECT b.brand_id, reach.root FROM reach JOIN keyed a ON a.brand_id = reach.brand_id JOIN keyed b ON b.key = a.key),
roots AS (SELECT brand_id, min(root) AS root FROM reach GROUP BY brand_id),
kept AS (SELECT f.* FROM firsts f JOIN roots r USING (brand_id) QUALIFY confidence <> 'AUTOMATIC_REFERENCE' OR row_number() OVER (PARTITION BY root ORDER BY confidence = 'AUTOMATIC_REFERENCE', brand_id) = 1),
named AS (SELECT p_brand || ' ' || p_size AS b FROM part UNION ALL SELECT upper(p_brand) || '  ' || p_size FROM part WHERE p_partkey % 3 = 0),
spelt AS (SELECT lower(regexp_replace(trim(b), '\\s+', ' ', 'g')) AS key, b, count(*) AS n FROM named GROUP BY ALL),
new AS (SELECT key, b FROM spelt QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, b) = 1)
SELECT brand_id, canonical_name, aliases, confidence, review_status FROM kept UNION ALL SELECT b, b, b, 'AUTOMATIC_REFERENCE', 'NEEDS_HUMAN_REVIEW' FROM new WHERE key NOT IN (SELECT key FROM keyed)""")
def reconciled_brands(spark, sf_dir):
    """A brand dictionary whose classes keep what persons made, with the brands that products name besides."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    named = part.select(F.concat("p_brand", F.lit(" "), size).alias("brand_id")).union(part.where("p_partkey % 3 = 0").select(F.concat(F.upper("p_brand"), F.lit("  "), size)))
    return entities.reconciled_brands(brand_rows(spark, sf_dir), named)


@query("""WITH n AS (SELECT p_partkey::VARCHAR AS sku, CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_name END AS name_es, p_type AS cat_es, 'zh ' || p_name AS name_zh, p_partkey AS k, p_size AS s FROM part WHERE p_partkey % 4 <> 0),
e AS (SELECT p_partkey::VARCHAR AS sku, p_name AS name_es, CASE WHEN p_size % 3 = 0 THEN 'old' ELSE p_type END AS cat_es, 'was ' || p_size AS name_zh, CASE WHEN p_size % 7 <> 0 THEN sha256(p_name || chr(31) || CASE WHEN p_size % 3 = 0 THEN 'old' ELSE p_type END) ELSE '' END AS source_hash,
  CASE WHEN p_size % 6 = 0 THEN '' ELSE 'MODEL_TRANSLATED' END AS translation_status, CASE WHEN p_size % 11 = 0 THEN 'HUMAN_REVIEWED' ELSE '' END AS review_status, CASE WHEN p_size % 13 = 0 THEN '1' ELSE '0' END AS locked, '2026-01-01' AS updated_at FROM part WHERE p_partkey % 5 <> 0),
o AS (SELECT p_partkey::VARCHAR AS sku, 'set ' || p_brand AS name_zh, CASE WHEN p_size % 2 = 0 THEN '1' END AS locked FROM part WHERE p_partkey % 10 = 3),
j AS (SELECT coalesce(n.sku, e.sku) AS sku, o.sku IS NOT NULL AS any_, e.sku IS NOT NULL AS known, coalesce(e.locked = '1', false) AS lk, trim(coalesce(n.name_es, '')) AS nn, trim(coalesce(n.cat_es, '')) AS nc, trim(coalesce(n.name_zh, '')) AS nz,
  coalesce(e.name_es, '') AS en, coalesce(e.cat_es, '') AS ec, coalesce(e.name_zh, '') AS ez, coalesce(e.source_hash, '') AS eh, coalesce(e.translation_status, '') AS et, coalesce(e.review_status, '') AS er, coalesce(e.locked, '') AS el, coalesce(e.updated_at, '') AS eu, o.name_zh AS oz, o.locked AS ol
  FROM n FULL JOIN e ON n.sku = e.sku LEFT JOIN o ON o.sku = coalesce(n.sku, e.sku)),
p AS (SELECT *, NOT any_ AND (lk OR er = 'HUMAN_REVIEWED') AS prot, CASE WHEN nn <> '' THEN nn ELSE en END AS v_n, CASE WHEN nc <> '' THEN nc ELSE ec END AS v_c FROM j),
q AS (SELECT *, CASE WHEN NOT prot AND oz IS NULL AND nz <> '' THEN nz ELSE ez END AS v_z, sha256(v_n || chr(31) || v_c) AS h FROM p),
r AS (SELECT *, NOT prot AND eh <> '' AND eh <> h AS changed FROM q),
t AS (SELECT *, CASE WHEN lk THEN 'LOCKED' WHEN changed THEN 'NEEDS_REVIEW' WHEN et = '' OR known AND eh = '' AND NOT prot THEN CASE WHEN v_z <> '' THEN 'LEGACY_UNVERIFIED' ELSE 'UNTRANSLATED' END ELSE et END AS ts,
  CASE WHEN lk THEN 'HUMAN_REVIEWED' WHEN changed THEN 'NEEDS_REVIEW' WHEN er <> '' THEN er ELSE 'UNREVIEWED' END AS rs, CASE WHEN ol IS NOT NULL THEN ol = '1' ELSE lk END AS nl FROM r),
u AS (SELECT sku, v_n AS name_es, v_c AS cat_es, coalesce(oz, v_z) AS name_zh, h AS source_hash, CASE WHEN any_ AND nl THEN 'LOCKED' WHEN any_ THEN 'HUMAN_REVIEWED' ELSE ts END AS translation_status, CASE WHEN any_ THEN 'HUMAN_REVIEWED' ELSE rs END AS review_status, CASE WHEN nl THEN '1' ELSE '0' END AS locked, known, en, ec, ez, eh, et, er, el, eu FROM t)
SELECT sku, name_es, cat_es, name_zh, source_hash, translation_status, review_status, locked,
  CASE WHEN known AND name_es = en AND cat_es = ec AND name_zh = ez AND source_hash = eh AND translation_status = et AND review_status = er AND locked = el THEN eu ELSE '2026-07-01' END AS updated_at FROM u""")
def product_dictionary(spark, sf_dir):
    """Records, an older dictionary and what persons have set, with a review reset by the hash of the source."""
    part, size = table(spark, sf_dir, "part"), F.col("p_size")
    new = part.where("p_partkey % 4 <> 0").select(part_sku(), F.when(size % 5 == 0, " ").otherwise(F.col("p_name")).alias("name_es"), F.col("p_type").alias("cat_es"), F.concat(F.lit("zh "), "p_name").alias("name_zh"))
    cat = F.when(size % 3 == 0, "old").otherwise(F.col("p_type"))
    old = part.where("p_partkey % 5 <> 0").select(
        part_sku(), F.col("p_name").alias("name_es"), cat.alias("cat_es"), F.concat(F.lit("was "), size.cast("string")).alias("name_zh"), F.when(size % 7 != 0, F.sha2(F.concat_ws("\x1f", "p_name", cat), 256)).alias("source_hash"),
        F.when(size % 6 != 0, "MODEL_TRANSLATED").alias("translation_status"), F.when(size % 11 == 0, "HUMAN_REVIEWED").alias("review_status"), F.when(size % 13 == 0, "1").otherwise("0").alias("locked"), F.lit("2026-01-01").alias("updated_at"),
    )
    chosen = part.where("p_partkey % 10 = 3")
    own = chosen.select(part_sku(), F.lit("name_zh").alias("field"), F.concat(F.lit("set "), "p_brand").alias("value")).union(chosen.where(size % 2 == 0).select(part_sku(), F.lit("locked"), F.lit("1")))
    return entities.product_dictionary(new, old, own, ["name_es", "cat_es"], ["name_zh"], "2026-07-01")


@query("""SELECT p_brand AS brand, count(*) AS products, count(DISTINCT l_orderkey) AS orders, 2::BIGINT AS built, 0::BIGINT AS built_again FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY p_brand""")
def resumed_stages(spark, sf_dir):
    """Two stages by their ledger, run twice: the second run builds none."""
    ledger = Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex[:12]}")
    inputs = {"part": table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), "line": table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey")}
    stages = [Stage("sold", ("part", "line"), lambda part, line: part.where("p_size > 10").join(line, F.col("l_partkey") == F.col("p_partkey"))), Stage("brands", ("sold",), lambda sold: sold.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("products"), F.countDistinct("l_orderkey").alias("orders")))]
    ledger.run("first", inputs, stages)
    built = len(ledger.ran)
    out = ledger.run("second", inputs, stages)["brands"]
    return out.select("*", F.lit(built).cast("long").alias("built"), F.lit(len(ledger.ran)).cast("long").alias("built_again"))


@query("""SELECT n_name AS nation, count(*) AS suppliers, 'two' AS edition FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def published_pair(spark, sf_dir):
    """A table and its manifest published over an older pair, read back as one."""
    folder = f"{shared_folder(spark)}/published-{uuid.uuid4().hex[:12]}"
    counts = written(table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers")), "nations")
    pair = Publication(spark, folder, "nations")
    pair.publish(counts.limit(0), {"edition": "one"})
    pair.publish(counts, {"edition": "two"})
    rows, manifest = pair.read()
    return rows.withColumn("edition", F.lit(manifest["edition"]))


@query("""SELECT (row_number() OVER (ORDER BY p_partkey::VARCHAR))::BIGINT AS ordinal, p_partkey::VARCHAR AS sku, 'cheap ones' AS selection, 1::BIGINT AS deliveries FROM part WHERE p_retailprice <= 950""")
def frozen_views(spark, sf_dir):
    """A saved view, the selection frozen from it, its delivery in the log; the view is deleted and the selection stays."""
    store = Views(spark, f"{shared_folder(spark)}/views-{uuid.uuid4().hex[:12]}")
    query_ = {"max_price": 950.0, "limit": 10}
    view = store.create("cheap", query_)
    rows = catalog(spark, sf_dir).withColumn("status", F.lit("CURRENT"))
    chosen = store.select("cheap ones", rows, query_, view_id=view)
    store.deliver("CSV", "out.csv", store.members(chosen).count(), None, chosen)
    store.delete(view)
    named = store.selections.read().where(F.col("view_id").isNull()).select("selection_id", F.col("name").alias("selection"))
    sent = store.delivered(chosen).groupBy("selection_id").agg(F.count(F.lit(1)).alias("deliveries"))
    return store.members(chosen).join(F.broadcast(named.join(sent, "selection_id"))).select("ordinal", "sku", "selection", "deliveries")

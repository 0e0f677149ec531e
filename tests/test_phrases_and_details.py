"""Phrases in texts, rules over them, details, page facts and price reviews against plain versions."""

import ast
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import audits, details, phrases, price_review, records, resolution
from shelfwise.functions import evidence
from shelfwise.plans import phrase_queries, text_queries
from shelfwise.plans.registry import ORACLE_SQL
from shelfwise.sources import pages


def plain_spans(text, terms):
    low = (text or "").lower()
    found = set()
    for t in terms:
        for at in range(len(low) - len(t) + 1):
            if low.startswith(t, at):
                sides = low[at - 1 : at] + low[at + len(t) : at + len(t) + 1]
                if not any(c.isalnum() or c == "_" for c in sides):
                    found.add((t, at, at + len(t)))
    return found


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_spans_are_all_places_with_borders(spark, block):
    rng = random.Random(block)
    terms = ["a", "a a", "b-c", "led lamp", "lamp", "é", "(x)", "_a", "名 b"]
    rows = [(k, "".join(rng.choice(["a", "b-c", " ", ", ", "led lamp", "lamps", "É", "_", "(x)", "名 b", "1"]) for _ in range(rng.randint(0, 25)))) for k in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "k long, text string")
    known = spark.createDataFrame([(t.upper() if t.isascii() else f" {t} ",) for t in terms] + [("",), (" ",), ("a",)], "phrase string")
    got = {}
    for r in phrases.spans(df, known, ["k"], block_bytes=block).collect():
        got.setdefault(r["k"], set()).add((r["phrase"], r["first"], r["last"]))
    assert got == {k: s for k, t in rows if (s := plain_spans(t, terms))}


def test_outermost_and_shielded_places(spark):
    df = spark.createDataFrame([(1, "gomas de borrar y gomas"), (2, "gomas de borrar"), (3, "led lamp led")], "k long, text string")
    places = phrases.spans(df, spark.createDataFrame([("gomas",), ("gomas de borrar",), ("led lamp",), ("lamp led",), ("led",)], "phrase string"), ["k"])
    outer = {(r["k"], r["phrase"], r["first"]) for r in phrases.outermost(places, ["k"]).collect()}
    assert outer == {(1, "gomas de borrar", 0), (1, "gomas", 18), (2, "gomas de borrar", 0), (3, "led lamp", 0), (3, "lamp led", 4)}
    shields = spark.createDataFrame([("Gomas", "gomas de borrar")], "phrase string, shield string")
    left = {(r["k"], r["first"]) for r in phrases.unshielded(places, shields, ["k"]).where("phrase = 'gomas'").collect()}
    assert left == {(1, 18)}
    dictionary = spark.createDataFrame([("gomas", "MATERIAL", "rubber", "list"), ("gomas de borrar", "PRODUCT_TYPE", "eraser", "list")], "phrase string, type string, value string, provenance string")
    facts = phrases.semantic_facts(df, dictionary, "k", ["text"], shields)
    assert {(r["k"], r["type"], r["places"]) for r in facts.collect()} == {(1, "MATERIAL", 1), (1, "PRODUCT_TYPE", 1), (2, "PRODUCT_TYPE", 1)}
    status = phrases.fact_coverage(facts, spark.createDataFrame([(1, "an Eraser")], "k long, shown string"), "k", ["shown"], {"PRODUCT_TYPE": "name"})
    assert {(r["k"], r["type"], r["status"]) for r in status.collect()} == {(1, "MATERIAL", "REVIEW_REQUIRED"), (1, "PRODUCT_TYPE", "PLACED"), (2, "PRODUCT_TYPE", "NOT_OUTPUT_REQUIRED")}


def test_places_of_a_fact_do_not_overlap(spark):
    """As the SQL splits texts at a phrase: from the left, then by borders; shields are found in the same way."""
    rows = [(1, "der der der"), (2, "Der der der der, der der"), (3, "xder der der"), (4, "der der x der der"), (5, "der der der x der der")]
    df = spark.createDataFrame(rows, "k long, text string")
    dictionary = spark.createDataFrame([("der der", "T", "v", "list")], "phrase string, type string, value string, provenance string")
    assert {r["k"]: r["places"] for r in phrases.semantic_facts(df, dictionary, "k", ["text"]).collect()} == {1: 1, 2: 3, 4: 2, 5: 2}
    shields = spark.createDataFrame([("der der", "der der x")], "phrase string, shield string")
    # in 5 the shield holds the second and third word, the place the first and second
    assert {r["k"]: r["places"] for r in phrases.semantic_facts(df, dictionary, "k", ["text"], shields).collect()} == {1: 1, 2: 3, 4: 1, 5: 2}
    every = phrases.spans(df.where("k = 1"), dictionary, ["k"])
    assert {(r["first"], r["last"]) for r in every.collect()} == {(0, 7), (4, 11)}


def test_release_rules(spark):
    rows = spark.createDataFrame([(1, "cloth", "microfibre cloth"), (2, "cloth", "cloth of microfibre"), (3, "cloth", "rag"), (4, "other", "rag"), (5, None, None)], "k long, family string, text string")
    rules = spark.createDataFrame([("need", "cloth", "REQUIRED", "cloth", None), ("never", "cloth", "FORBIDDEN", "rag", None), ("order", "cloth", "ORDER", "microfibre", "cloth"), ("with", None, "CONTEXT", "rag", "cloth")], "rule string, scope string, kind string, phrase string, other string")
    text_hash = lambda t: __import__("hashlib").sha256(t.encode()).hexdigest()
    excused = spark.createDataFrame([(3, "never", text_hash("rag")), (2, "order", text_hash("another"))], "k long, rule string, text_hash string")
    verdicts = phrases.gate(rows, rules, "k", "family", "text", excused)
    got = {(r["k"], r["rule"]): r["verdict"] for r in verdicts.collect()}
    assert got == {
        (1, "need"): "PASS", (1, "never"): "PASS", (1, "order"): "PASS", (1, "with"): "PASS", (2, "need"): "PASS", (2, "never"): "PASS", (2, "order"): "STALE_EXCEPTION", (2, "with"): "PASS",
        (3, "need"): "FAIL", (3, "never"): "EXCEPTED", (3, "order"): "PASS", (3, "with"): "FAIL", (4, "with"): "FAIL", (5, "with"): "PASS",
    }
    counters = {r["rule"]: (r["checked"], r["failed"], r["excepted"], r["stale"], r["blocked"]) for r in phrases.gate_counters(verdicts).collect()}
    assert counters == {"need": (3, 1, 0, 0, True), "never": (3, 0, 1, 0, False), "order": (3, 0, 0, 1, True), "with": (5, 2, 0, 0, True)}


def test_brands_beside_punctuation_and_families_of_two_words(spark):
    titles = spark.createDataFrame([("1", "Philips, afeitadora"), ("2", "afeitadora (Philips)"), ("3", "Philipsa"), ("4", "AT&T plan"), ("5", "black+decker black")], "sku string, title string")
    aliases = spark.createDataFrame([("philips", "P"), ("at&t", "A"), ("Black", "B"), ("black+decker", "BD"), ("pl", "short")], "alias string, brand string")
    assert {r["sku"]: r["brand"] for r in audits.title_brands(titles, aliases).collect()} == {"1": "P", "2": "P", "3": None, "4": "A", "5": "BD"}
    rows = spark.createDataFrame([("1", "LED lamp", "Light", ""), ("2", "led, lamp", "Light", "")], "sku string, name string, category string, text string")
    known = spark.createDataFrame([("F", "led lamp", "Light", "never")], "family string, alias string, category string, phrase string")
    assert [(r["sku"], r["family"]) for r in records.families(rows, known).collect()] == [("1", "F")]
    terms = spark.createDataFrame([(" ".join(["long"] * 40), "t"), ("led-lamp", "u")], "term string, target string")
    texts = spark.createDataFrame([(1, "x " + ", ".join(["Long"] * 41)), (2, "led. lamp")], "k long, text string")
    assert {(r["k"], r["target"]) for r in resolution.term_matches(texts, terms, "k", "text").collect()} == {(1, "t"), (2, "u")}


def test_ordinals_of_three_million_rows(spark):
    n = 3_000_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("x"), F.concat(F.lit("c"), "id").alias("other"))
    numbered = records.with_ordinals(rows, ["x"], 16)
    assert numbered.agg(F.countDistinct("ordinal"), F.min("ordinal"), F.max("ordinal"), F.count_if(F.col("ordinal") != F.col("x") + 1)).first()[:] == (n, 1, n, 0)


CASES = [
    ("{}", (0, 0, 0)), ("{", (0, 0, 0)), ("null", (0, 0, 0)), (None, (0, 0, 0)), ('{"price_observation_invalid":[]}', (0, 0, 0)), ('{"price_field_observation_invalid":"unknown"}', (0, 0, 0)),
    ('{"price_field_observation_invalid":{"1001":"unknown"}}', (0, 0, 0)), ('{"price_observation_invalid":{"1001":"1"}}', (0, 0, 0)), ('{"price_observation_invalid":{"1001":true}}', (1, 0, 0)), ('{"price_observation_invalid":{"1001":1}}', (1, 0, 0)),
    ('{"price_field_observation_invalid":{"1001":{"original_price":true}}}', (0, 1, 0)), ('{"price_field_observation_invalid":{"1001":{"unit_price":true}}}', (0, 0, 1)),
    ('{"price_observation_invalid":{"1001":false,"1001":true}}', (0, 0, 0)), ('{"price_observation_invalid":{"1001":true,"1001":false}}', (1, 0, 0)),
    ('{"price_field_observation_invalid":{"1001":"unknown","1001":{"unit_price":true}}}', (0, 0, 0)), ('{"price_field_observation_invalid":{"1001":{"original_price":false},"1001":{"original_price":true}}}', (0, 0, 0)),
    ('{"price_observation_invalid":{"1001":true},"price_observation_invalid":{}}', (1, 0, 0)), ('{"price_observation_invalid":{"1001":NaN}}', (0, 0, 0)),
]


def test_first_keys_decide_price_flags(spark):
    evidence_rows = spark.createDataFrame([(f"run{k}", text) for k, (text, _) in enumerate(CASES)], "run_id string, evidence string")
    flags = price_review.first_flags(price_review.flag_rows(evidence_rows)).where("key = '1001'")
    got = {}
    for r in flags.collect():
        got.setdefault(r["run_id"], set()).update(k for k, v in r["flags"].items() if v)
    for k, (text, want) in enumerate(CASES):
        assert tuple(int(n in got.get(f"run{k}", ())) for n in ("price", "original_price", "unit_price")) == want, text


def test_flags_of_an_old_run_stay_with_it(spark):
    observations = [("1001", "old", "2026-10-26", "PRESENT")]
    commits = [("old", "old", "2026-10-26", "COMMITTED"), ("repair", "repair", "2026-10-28", "COMMITTED"), ("new", "new", "2026-10-27", "COMMITTED"), ("bad", "bad", "2026-10-29", "FAILED")]
    runs = spark.createDataFrame([("old", '{"price_observation_invalid":{"1001":true}}'), ("repair", "{}"), ("new", "{}")], "run_id string, evidence string")
    products = spark.createDataFrame([("1001", 3.0, 5.0, "3 €/ud"), ("2", 1.0, None, None)], "sku string, current_price double, original_price double, unit_price string")
    done = spark.createDataFrame(commits, "commit_id string, run_id string, committed_at string, status string")
    schema = "sku string, run_id string, observation_date string, presence_state string"

    def prices(seen):
        rows = price_review.reviewed_prices(products, price_review.price_flags(spark.createDataFrame(seen, schema), done, runs)).collect()
        return {r["sku"]: tuple(r)[1:] for r in rows}

    assert prices(observations) == {"1001": (None, None, None), "2": (1.0, None, None)}
    assert prices([*observations, ("1001", "new", "2026-10-27", "PRESENT"), ("1001", "bad", "2026-10-29", "PRESENT"), ("1001", "repair", "2026-10-28", "ABSENT")])["1001"] == (3.0, 5.0, "3 €/ud")


def test_literals_are_read_as_python_reads_them():
    rng = random.Random(3)

    def value(depth=0):
        kind = rng.randint(0, 8 if depth < 3 else 5)
        if kind < 3:
            return "".join(rng.choice("ab'\"\\\n\té{}:,\x01😀") for _ in range(rng.randint(0, 6)))
        simple = [rng.randint(-50, 50), rng.choice([1.5, -2e10, 1e-7]), rng.choice([True, False, None])]
        if kind < 6:
            return simple[kind - 3]
        inner = [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return inner if kind == 6 else tuple(inner) if kind == 7 else {rng.choice("abc"): x for x in inner}

    for _ in range(500):
        own = {rng.choice(["Material", "x y", 'k"', "Peso"]): value() for _ in range(rng.randint(1, 4))}
        assert {k: v for k, v, *_ in details.Literal(repr(own)).whole()} == own == ast.literal_eval(repr(own))
    for bad in ("{", "{'a' 1}", "{'a': b}", "{'a': 1} x", "{'a': __import__('os')}", "{'a\n': 1}", "{1: 2", "{" + "'a': {" * 80 + "}" * 81):
        with pytest.raises(ValueError):
            details.Literal(bad).whole()


def test_details_of_texts(spark):
    rows = [(1, "{'Material': 'a', 'Material': [1, None]}"), (2, "Material：Goma；Peso:: 5 g | Color: x\r\nHalal Sí;nothing; Energía 5 kcal; Tema de mar"), (3, "{'broken: 1; Tamaño: 3 cm"), (4, None), (5, ""), (6, "{1: 2}")]
    got = details.structured_details(spark.createDataFrame(rows, "k long, text string"), ["k"], "text")
    found = [(r["k"], r["position"], r["key"], r["value"], r["context_key"], r["value_type"]) for r in got.orderBy("k", "position").collect()]
    assert found == [
        (1, 0, "Material", "a", "material", "TEXT"), (1, 1, "Material", json.dumps([1, None]), "material", "TEXT"), (2, 0, "Material", "Goma", "material", "TEXT"), (2, 1, "Peso", "5 g", "weight", "WEIGHT"), (2, 2, "Color", "x", "color", "TEXT"),
        (2, 3, "Halal", "Sí", "halal", "TEXT"), (2, 4, "Energía", "5 kcal", "energía", "TEXT"), (2, 5, "Tema", "de mar", "tema", "TEXT"), (3, 0, "{'broken", "1", "{'broken", "TEXT"), (3, 1, "Tamaño", "3 cm", "size", "DIMENSION"), (6, 0, "{1", "2}", "{1", "TEXT"),
    ]


def plain_repair(text, keys, generic=("tipo", "incluye")):
    """One token after another, with a look at the next."""
    pattern = re.compile(rf"^({'|'.join(re.escape(k) for k in sorted(keys, key=len, reverse=True))})(?=\s|:|$)\s*:?(.*)$", re.I)
    tokens = [" ".join(t.split(" ")).strip() for t in re.split("[;\t\n]", text)]
    tokens = [re.sub(r"\s+", " ", t).strip() for t in tokens if t.strip()]
    out = []
    while tokens:
        own = tokens.pop(0)
        hit = pattern.match(own)
        if ":" in own:
            key, value = own.split(":", 1)
            out.append(f"{key.strip()}: {value.strip()}".rstrip())
        elif not hit:
            out.append(own)
        elif (value := hit[2].strip()) and hit[1].lower() in generic:
            out.append(own)
        elif value:
            out.append(f"{hit[1].strip()}: {value}")
        elif tokens and not pattern.match(tokens[0]):
            out.append(f"{hit[1].strip()}: {tokens.pop(0)}")
        else:
            out.append(f"{hit[1].strip()}:")
    return "; ".join(out)


def test_lost_delimiters_are_found_again(spark):
    rng, keys = random.Random(2), ["Material", "Color", "Tipo", "Tipo de producto", "Peso (kg)"]
    parts = ["Material", "material", "Color rojo", "azul", "Tipo 3", "Tipo", "Tipo de producto", "Materiales", "Peso (kg)", "x: y", "Color: verde: oscuro", "", "  ", "a  b"]
    texts = ["", *("".join(rng.choice(parts) + rng.choice([";", "\t", "\n", "; "]) for _ in range(rng.randint(1, 7))) for _ in range(300))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    got = {r["k"]: r["d"] for r in df.select("k", details.repaired_pairs(F.col("text"), keys).alias("d")).collect()}
    for k, text in enumerate(texts):
        assert got[k] == plain_repair(text, keys), text


def test_page_facts_of_broken_markup(spark):
    html = "<h1>A &amp; b</h1><nav><a href='/x'>y</a></nav><table><tr><th>Key:<td>v <b>w</b><tr><td>N<td>2</table><dl><dt>T:<dd>one<dd>two</dl><script>var x='<td>'</script></p><h2>open"
    got = pages.page_facts(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "plain < text &")], "kind long, html string").withColumnRenamed("kind", "k"), ["k"])
    assert [tuple(r)[2:] for r in got.orderBy("k", "position").collect()] == [
        ("heading", "h1", "A & b", "h1[1]"), ("link", "nav", "/x", "a[1]"), ("table", "Key", "v w", "tr[1]/2"), ("table", "N", "2", "tr[2]/2"), ("list", "T", "one", "dd[1]"), ("list", "T", "two", "dd[2]"), ("heading", "h2", "open", "h2[1]"),
    ]


def test_links_and_headings_keep_what_their_sql_keeps(spark, tmp_path):
    """A reference that is cut off or not one of the three stays as it is written, in links all do."""
    duckdb = pytest.importorskip("duckdb")
    html = "<h1>a&amp;&amp</h1><h2>t = &quot;x&lt;y&gt; &amp;lt; <b>&nbsp;</b> &eacute</h2><a href=\"/x?a=1&amp;b=2\">l</a><script>'<a href=\"/no\">'</script>"
    spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "<h3> c  d </h3>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in phrase_queries.page_links_and_headings(spark, str(tmp_path)).collect())
    assert got == [(1, "heading", "a&&amp"), (1, "heading", "t = &quot;x<y> &lt; &nbsp; &eacute"), (1, "link", "/x?a=1&amp;b=2"), (3, "heading", "c d")]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert sorted(con.execute(ORACLE_SQL["page_links_and_headings"]).fetchall()) == got


def test_folds_tables_and_rules_of_evidence(spark):
    one = spark.createDataFrame([("ÀÉÎõü Ñandú Čaj é 500 GR 2,5 kg varios colores",)], "x string")
    assert one.select(evidence.family_key(F.col("x"))).first()[0] == "aeiou nandu caj e 500 gr"
    units = spark.createDataFrame([("2 €/kg, 3 €/kgs, 1 €/ud. 4 €/UD 5 €/l 6 €/lav",)], "x string")
    assert units.select(evidence.unit_price_text(F.col("x"))).first()[0] == "2 €/千克, 3 €/kgs, 1 €/件 4 €/件 5 €/升 6 €/次洗涤"
    assert units.select(evidence.unit_price_text(F.col("x"), (("l", "litre", True),))).first()[0].count("litre") == 1


def test_pages_of_a_small_file_are_walked_by_many_tasks(spark):
    plan = phrase_queries.verified_details(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan[plan.index("MapInArrow") :]


def test_term_counts_equal_sql(spark, tmp_path):
    """Null identifiers and languages are none."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["a", "B", "c", "É", "d-e", "9"]) for _ in range(rng.randint(0, 9))), rng.choice(["en", "de", None])) for k in range(80)]
    rows += [(None, "a z z", "en"), (None, "z", "xx"), (91, None, "en"), (92, "only", None), (93, "only", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(ORACLE_SQL["term_candidates"]).fetchall())
    assert sorted(tuple(r) for r in text_queries.term_candidates(spark, str(tmp_path)).collect()) == want and ("only", 2, 2, 0) in want

"""Engine operators against plain Python models."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import catalogue, commits, resolution, temporal, upserts, windows
from shelfwise.sources import files
from shelfwise.streaming import presence


def simulate(cells, threshold=3):
    out, seen, gone = [], False, 0
    for day, present in cells:
        if present:
            kind = "NEW" if not seen else "REAPPEARED" if gone else "ACTIVE"
            seen, gone = True, 0
        elif not seen or gone >= threshold:
            kind = "ABSENT"
        else:
            gone += 1
            kind = "OFFLINE" if gone == threshold else "MISSING_FIRST" if gone == 1 else "MISSING_CONTINUED"
        out.append((day, kind))
    return out


@pytest.fixture(scope="module")
def cells():
    rng = random.Random(4)
    return {f"s{k}": [(f"2026-01-{d:02d}", rng.random() < 0.5) for d in range(1, 15)] for k in range(30)}


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_replay_is_the_day_by_day_machine(spark, cells, threshold):
    rows = [(s, d, p) for s, days in cells.items() for d, p in days]
    got = temporal.replay(spark.createDataFrame(rows, "sku string, day string, present boolean"), threshold).collect()
    assert {(r.sku, r.day): r.classification for r in got} == {(s, d): k for s, days in cells.items() for d, k in simulate(days, threshold)}


def test_step_decision_table(spark):
    cases = list(itertools.product([True, False], ["ACTIVE", "MISSING", "OFFLINE"], [True, False], [0, 1, 2, 3]))
    df = spark.createDataFrame(cases, "present boolean, status string, ever boolean, missing int")
    after = temporal.step(F.col("present"), F.col("status"), F.col("ever"), F.col("missing"))
    for r in df.select("*", after["classification"].alias("k"), after["missing_count"].alias("n"), after["status"].alias("s")).collect():
        if r.present:
            assert r.k == ("NEW" if not r.ever else "REAPPEARED" if r.status in ("MISSING", "OFFLINE") else "ACTIVE") and (r.n, r.s) == (0, "ACTIVE")
        elif not r.ever or r.status == "OFFLINE":
            assert (r.k, r.n, r.s) == ("ABSENT", r.missing, r.status)
        else:
            assert r.k == ("OFFLINE" if r.missing + 1 >= 3 else "MISSING_FIRST" if r.missing == 0 else "MISSING_CONTINUED") and r.n == r.missing + 1


def test_streamed_lifecycle_equals_replay(spark, cells, tmp_path):
    rows = [(s, d, p) for s, days in cells.items() for d, p in days]
    folder = str(tmp_path / "in")
    spark.createDataFrame(rows, "sku string, day string, present boolean").coalesce(1).write.parquet(folder)
    stream = presence.lifecycle_stream(spark.readStream.schema("sku string, day string, present boolean").parquet(folder))
    run = stream.writeStream.format("memory").queryName("life").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r.sku, r.day): r.classification for r in spark.table("life").collect()}
    assert got == {(s, d): k for s, days in cells.items() for d, k in simulate(days)}


def test_catalogue_query_contract():
    q = catalogue.CatalogueQuery.of({"keyword": "  Big  Lamp ", "cat1": "b, a,a", "unknown": 1, "limit": 5})
    assert q.cat1 == ("b", "a", "a")
    assert q.canonical() == '{"cat1":["a","b"],"descending":false,"keyword":"big lamp","limit":5,"offset":0,"sort":"sku"}'
    assert q.digest() == catalogue.CatalogueQuery.of({"keyword": "big lamp", "cat1": ["a", "b"], "limit": 5}).digest()
    for bad in ({"sort": "nope"}, {"limit": 0}, {"limit": 10_001}, {"offset": -1}):
        with pytest.raises(ValueError):
            catalogue.CatalogueQuery.of(bad).checked()


def test_catalogue_filters(spark):
    rows = [("1001", "lamp", "CURRENT", 1.5, 2.0, None, None), ("1002", "LAMP 2", "OFFLINE", 3.0, None, "x", "AVAILABLE"), ("1003", "chair", "CURRENT", 5.0, 4.0, " ", "BROKEN")]
    df = spark.createDataFrame(rows, "sku string, name string, status string, current_price double, original_price double, spec string, image_status string")
    run = lambda **q: sorted(r.sku for r in catalogue.matched(df, catalogue.CatalogueQuery(**q)).collect())
    assert run(keyword="lamp") == ["1001", "1002"] and run(statuses=("CURRENT",)) == ["1001", "1003"]
    assert run(has_original_price=True) == ["1001"] and run(has_original_price=False) == ["1002", "1003"]
    assert run(missing_fields=("spec",)) == ["1001", "1003"] and run(has_image=False) == ["1001", "1003"]
    assert run(image_statuses=("no_source_url",)) == ["1001"] and run(min_price=2.0, max_price=4.0) == ["1002"]
    with pytest.raises(ValueError):
        run(promotion=True)


def test_page_puts_nulls_lowest(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 1.0)], "sku string, current_price double")
    page = lambda **q: [r.sku for r in catalogue.page(df, catalogue.CatalogueQuery(sort="current_price", **q)).collect()]
    assert page() == ["a", "c", "b"] and page(descending=True) == ["b", "c", "a"] and page(offset=1, limit=1) == ["c"]


def test_upsert_difference_and_orphans(spark):
    state = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    change = spark.createDataFrame([(2, None, 5.0), (3, "c", None)], "k int, name string, v double")
    assert sorted(map(tuple, upserts.upsert(state, change, ["k"], ["name", "v"]).collect())) == [(1, "a", 1.0), (2, "b", 5.0), (3, "c", None)]
    found = {tuple(r) for r in upserts.keyed_difference(state, change, "k", ["name", "v"]).collect()}
    assert found == {(1, "MISSING_RIGHT", "1", None), (3, "MISSING_LEFT", None, "3"), (2, "name", "b", None), (2, "v", "2.0", "5.0")}
    keys = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    assert sorted(str(r.k) for r in upserts.orphans(keys, state, "k").collect()) == ["9", "None"]
    assert upserts.insert_ignore(state, change.union(change), "k").count() == 1


def test_commits(spark, tmp_path):
    table = commits.VersionedTable(spark, f"file://{tmp_path}/t")
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert table.head() is None and table.read() is None
    first = table.commit(rows, "run-1", None)
    assert table.commit(rows, "run-1", None) == first
    with pytest.raises(commits.CommitConflict):
        table.commit(rows.limit(1), "run-1", first)
    with pytest.raises(commits.CommitConflict):
        table.commit(rows, "run-2", None)
    second = table.commit(rows.limit(1), "run-2", first)
    assert table.head().commit_id == second and table.read().count() == 1
    lost = commits.coverage_regression(rows, rows.where("v IS NULL"), ["k", "v"]).collect()
    assert [(r.column, r.before, r.after) for r in lost] == [("v", 1, 0)]


def test_resolution(spark):
    rows = spark.createDataFrame([("x", "c1", "b1"), ("x", "c1", "b2"), ("y", "c1", None)], "term string, cat string, brand string")
    rules = spark.createDataFrame([("x", "wide", None, None), ("x", "brand", None, "b1"), ("x", "one", "c1", None), ("x", "two", "c1", None)], "term string, target string, cat string, brand string")
    got = {(r.term, r.brand): (r.target, r.conflict) for r in resolution.scoped_rules(rows, rules, ["cat", "brand"], "term").collect()}
    assert got == {("x", "b1"): (None, True), ("x", "b2"): (None, True), ("y", None): (None, False)}
    text = spark.createDataFrame([(1, "A Big red lamp, big"), (2, "biggest")], "id int, text string")
    terms = spark.createDataFrame([("big red", "t1"), ("BIG", "t2"), ("", "t3")], "term string, target string")
    hits = resolution.term_matches(text, terms, "id", "text")
    assert sorted(tuple(r) for r in hits.collect()) == [(1, "BIG", "t2"), (1, "big red", "t1")]
    assert tuple(resolution.longest_match(hits, "id").first()) == (1, "big red", "t1")


def test_terms_of_any_length(spark):
    text = spark.createDataFrame([(1, "a very big old red lamp, lit"), (2, "big old"), (3, None)], "id int, text string")
    terms = spark.createDataFrame([("Very big old red lamp lit", "t6"), ("big old", "t2"), ("very old red lamp lit too", "t0")], "term string, target string")
    assert sorted(tuple(r) for r in resolution.term_matches(text, terms, "id", "text").collect()) == [(1, "Very big old red lamp lit", "t6"), (1, "big old", "t2"), (2, "big old", "t2")]
    assert resolution.term_matches(text, terms.limit(0), "id", "text").count() == 0


def test_term_counts_keep_rare_terms(spark):
    from shelfwise.plans import text_queries

    docs = spark.createDataFrame([(1, "en", "red lamp lamp"), (2, "es", "Red one"), (3, "es", None)], "doc_id long, lang string, text string")
    assert [tuple(r) for r in text_queries.term_counts(docs).collect()] == [("red", 2, 2, 2)]
    assert text_queries.term_counts(docs, 1).count() == 3


def test_windows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    assert {tuple(r) for r in windows.latest(df, ["k"], ["t", "v"], ["v"]).collect()} == {("a", "z"), ("b", None)}
    assert {tuple(r) for r in windows.top_rank(df, ["k"], [F.col("t").desc()], "v").collect()} == {("a", None, True), ("b", None, False)}


def test_presence_history_and_matrix(spark):
    facts = spark.createDataFrame([("s", "d1")], "sku string, day string")
    days = spark.createDataFrame([("d1", False), ("d2", True), ("d3", False)], "day string, complete boolean")
    long = temporal.presence_history(facts, days, facts)
    assert {(r.day, r.presence) for r in long.collect()} == {("d1", 1), ("d2", 0), ("d3", None)}
    assert tuple(temporal.presence_matrix(long, ["d1", "d2", "d3"]).first()) == ("s", 1, 0, None)


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("b", "2"), ("a", "1")], "k string, v string")
    files.write_dictionary(rows, str(tmp_path / "d"), ["k"])
    assert [tuple(r) for r in files.read_dictionary(spark, str(tmp_path / "d"), "k string, v string", ["k"]).collect()] == [("a", "1"), ("b", "2")]
    files.write_dictionary(rows.union(rows), str(tmp_path / "e"), ["k"])
    with pytest.raises(ValueError):
        files.read_dictionary(spark, str(tmp_path / "e"), "k string, v string", ["k"])


def test_plans_push_down(spark, tmp_path):
    """Filters and columns reach the scan, and the latest change needs no window."""
    spark.range(100).selectExpr("CAST(id AS STRING) AS sku", "id AS price", "'x' AS other").write.parquet(str(tmp_path / "p"))
    plan = spark.read.parquet(str(tmp_path / "p")).where("price > 50").select("sku")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,50)]" in plan and "other" not in plan.split("ReadSchema")[1]
    last = windows.latest(spark.read.parquet(str(tmp_path / "p")), ["sku"], ["price"], ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in last and "partial_max_by" in last

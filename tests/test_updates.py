"""Contracts of the update, record and commit operators that no whole-table query shows."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import evidence, texts
from shelfwise.operators import catalogue, commits, records, updates
from shelfwise.streaming import presence


def test_requests_default_to_current_products():
    q = catalogue.CatalogueQuery.request({"canonical_id": "ACT1", "date_from": "2024-01-01", "nope": 1})
    assert q.statuses == ("CURRENT",) and q.canonical_ids == ("ACT1",) and q.last_seen_from == "2024-01-01"
    assert q.digest() == catalogue.CatalogueQuery.request({"canonical_ids": "act1", "last_seen_from": "2024-01-01"}).digest()
    assert catalogue.CatalogueQuery.request(None).statuses == ("CURRENT",)
    for bad in ({"localization_status": "nope"}, {"price_change": "nope"}):
        with pytest.raises(ValueError):
            catalogue.CatalogueQuery.request(bad).checked()


def test_filters_of_days_and_unknown_fields(spark):
    df = spark.createDataFrame([("1", "CURRENT", "2024-01-30", None), ("2", "CURRENT", None, "2024-01-02")], "sku string, status string, last_seen string, last_checked string")
    now = datetime(2024, 1, 31, 1, tzinfo=timezone.utc)
    run = lambda **v: sorted(r.sku for r in catalogue.matched(df, catalogue.CatalogueQuery.request(v), now=now).collect())
    assert run(last_n_days=1) == ["1"] and run(last_n_days=29) == ["1", "2"] and run(date_to="2024-01-02") == ["2"]
    with pytest.raises(ValueError):
        run(missing_fields="nope")
    with pytest.raises(ValueError):
        run(event_types="OFFLINE")


def test_two_writers_on_one_head(spark, tmp_path):
    first, second = (commits.VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base = first.commit(rows, "run-1", None)
    store, where = first._file(f"_commits/after-{base}.json")
    store.create(where, False).close()  # the other writer is between its look at the head and its commit
    before = set(p.name for p in tmp_path.joinpath("t").iterdir())
    with pytest.raises(commits.CommitConflict):
        second.commit(rows.limit(1), "run-2", base)
    assert set(p.name for p in tmp_path.joinpath("t").iterdir()) == before  # nothing is left behind
    store.delete(where, True)
    assert second.commit(rows.limit(1), "run-2", base) == first.head().commit_id


def test_appends_and_replacements(spark, tmp_path):
    table = commits.VersionedTable(spark, f"file://{tmp_path}/t")
    write = presence.committed_sink(table)
    batches = [spark.createDataFrame([(k, str(k))], "k int, v string") for k in range(4)]
    for number, batch in enumerate(batches[:3]):
        write(batch, number)
        write(batch, number)  # a batch that runs again changes nothing
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2] and table.log().count() == 3
    table.commit(batches[3], "replace", table.head().commit_id)
    assert [r.k for r in table.read().collect()] == [3]
    assert commits.content_hash(batches[0].union(batches[1])) == commits.content_hash(batches[1].union(batches[0])) != commits.content_hash(batches[0].union(batches[0]))


def test_plan_stages_and_budget(spark):
    names = ("NEW", "DETAIL_PENDING", "IMAGE_CHANGE", "BADGE_CHANGE", "ask", "age")
    rows = spark.createDataFrame([(n, *[n == x for x in names]) for n in names] + [("both", False, True, True, True, True, True), ("two", False, False, False, True, True, False)], "sku string, " + ", ".join(f"{n} boolean" for n in names))
    plan = lambda budget: {r.sku: (r.reason, r.need_detail) for r in updates.update_plan(rows, {n: F.col(n) for n in names[:4]}, F.col("ask"), F.col("age"), budget).collect()}
    fixed = {"NEW": ("NEW", True), "DETAIL_PENDING": ("DETAIL_PENDING", True), "IMAGE_CHANGE": ("IMAGE_CHANGE", True), "BADGE_CHANGE": ("BADGE_CHANGE", False), "both": ("DETAIL_PENDING", True)}
    assert plan(0) == fixed | {"two": ("BADGE_CHANGE", False)}
    assert plan(1) == fixed | {"two": ("BADGE_CHANGE", False), "ask": ("LISTING_BASELINE_UNKNOWN", True)}
    assert plan(3) == fixed | {"two": ("LISTING_BASELINE_UNKNOWN", True), "ask": ("LISTING_BASELINE_UNKNOWN", True), "age": ("DETAIL_FRESHNESS_UNKNOWN", True)}


def test_ordinals_over_many_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"))
    assert all(r.ordinal == r.x + 1 for r in records.with_ordinals(rows, ["x"], 7).collect())
    assert records.with_ordinals(rows.where("x < 0"), ["x"], 7).count() == 0


def test_protected_tokens_round_trip(spark):
    cases = ["", None, "no tokens", "5 x 5", "1 1 1 kg 1", "see http://a.b/1?x=2 <b>8412345678901</b> AB-12 10x20x30 cm 3,5 € 7%"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    for r in df.select("t", records.restore(records.protect(F.col("t")), records.protected_tokens(F.col("t"))).alias("back")).collect():
        assert r.back == (r.t or "")
    swapped = df.where("t = '5 x 5'").select(records.restore(F.lit("⟦1⟧ x ⟦0⟧"), F.array(F.lit("5"), F.lit("6"))).alias("x"))
    assert swapped.first().x is None


def test_character_references_and_nulls(spark):
    one = lambda c, **v: spark.createDataFrame([tuple(v.values())], ", ".join(f"{k} string" for k in v)).select(c.alias("c")).first().c
    assert one(texts.official_text(F.col("x")), x="caf&#233; &#233;&#8364; &#128512; &#0;") == "café é€ 😀 &#0;"
    assert one(texts.official_text(F.col("x")), x=None) in (None, "")
    assert one(evidence.promotion_class(F.col("x")), x=None) == "CLEAN" and one(evidence.to_bool(F.col("x")), x=None) is False
    assert one(evidence.badge_state(F.col("x"), F.lit(True), F.lit(False)), x=None) == "Nuevo"


def test_entry_is_imported_before_any_session():
    """Columns are made when queries are built."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print('fine')"], cwd=repo, capture_output=True, text=True, timeout=120)
    assert run.stdout.strip() == "fine", run.stderr[-2000:]

"""Contracts of the audit operators on small rows: ties, nulls, empty tables."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import audits
from shelfwise.plans import audit_queries


def test_longest_alias_wins_and_words_stay_whole(spark):
    titles = spark.createDataFrame([("1", "Old Gizmo lamp"), ("2", "gizmos"), ("3", None), ("4", "the GIZMO"), ("5", ""), ("6", "xy old gizmo")], "sku string, title string")
    aliases = spark.createDataFrame([("gizmo", "B"), ("old gizmo", "A"), ("OLD  gizmo", "C"), ("xy", "D")], "alias string, brand string")
    assert {r.sku: r.brand for r in audits.title_brands(titles, aliases).collect()} == {"1": "A", "2": None, "3": None, "4": "B", "5": None, "6": "A"}
    assert {r.brand for r in audits.title_brands(titles, aliases.limit(0)).collect()} == {None}


def test_spans_go_once_and_longest_first(spark):
    df = spark.createDataFrame([("ab abc abc",), ("x",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(audits.without_spans(F.col("t"), ["ab", "abc"])).collect()] == ["abc", "x", None, ""]


def test_permissions(spark):
    rows = [("COLLECTION_BLOCKED", True, False), ("collection_degraded", True, True), ("COLLECTION_DEGRADED", False, False), (None, False, False), ("", False, True), ("COLLECTION_OK", False, True), ("ODD", True, False)]
    df = spark.createDataFrame(rows, "state string, override boolean, required boolean")
    assert [r[0] for r in df.select(audits.commit_allowed(F.col("state"), F.col("override"), F.col("required"))).collect()] == [False, True, False, True, False, True, False]


def test_whitelist_needs_all_hashes_and_its_window(spark):
    findings = spark.createDataFrame([("1", "name", "s", "c", "r"), ("2", "name", "s", "c", "x")], "sku string, field string, source_hash string, current_hash string, reviewed_hash string")
    day = dt.date
    entries = [("1", "name", "s", "c", "r", "CONFIRMED", day(2024, 1, 1), day(2024, 3, 31)), ("1", "name", "s", "c", "r", "CONFIRMED", day(2024, 1, 1), day(2024, 2, 1)), ("2", "name", "s", "c", "r", "CONFIRMED", day(2024, 1, 1), day(2024, 2, 1))]
    df = spark.createDataFrame(entries, "sku string, field string, source_hash string, current_hash string, reviewed_hash string, status string, reviewed_at date, expires_at date")
    run = lambda now: {r.sku: r.suppressed for r in audits.suppressed(findings, df, F.lit(now).cast("date")).collect()}
    assert run("2024-03-30") == {"1": True, "2": False} and run("2024-03-31") == {"1": False, "2": False}
    assert run("2024-03-30") == {r.sku: r.suppressed for r in audits.suppressed(findings, df.where("expires_at > '2024-03-01'"), F.lit("2024-03-30").cast("date")).collect()}


def test_faults_plans_and_tokens(spark):
    keys = spark.createDataFrame([("a",), (" a",), (None,), ("b",)], "key string")
    assert sorted(map(tuple, audits.key_faults(keys, "key").collect())) == [("", "BLANK", 1), ("a", "DUPLICATE", 2)]
    source = spark.createDataFrame([("1", "x", None), ("2", "y", " ")], "sku string, name string, spec string")
    none = spark.createDataFrame([], "sku string, field string, source_hash string")
    assert sorted((r.sku, r.field) for r in audits.translation_plan(source, none, ["name", "spec"]).collect()) == [("1", "name"), ("2", "name")]
    rows = spark.createDataFrame([("A B|c", None), ("d", "DRAFT"), (None, "APPROVED")], "aliases string, review_status string")
    assert sorted(r.token for r in audits.allowed_tokens(rows).collect()) == ["A", "A B", "B", "c"]


def test_backlog_and_reuse(spark):
    backlog = spark.createDataFrame([("1", "h", "PENDING"), ("2", "h", "PENDING"), ("3", "h", "RESOLVED")], "id string, evidence_hash string, state string")
    decisions = spark.createDataFrame([("1", "h", "ASSIGN", 1), ("1", "h", "REJECT", 2), ("2", "old", "ASSIGN", 1), ("3", "h", "REJECT", 1)], "id string, evidence_hash string, decision string, seq int")
    found = {r.id: (r.state, r.outcome) for r in audits.decided(backlog, decisions).collect()}
    assert found == {"1": ("REJECTED", "APPLIED"), "2": ("PENDING", "EVIDENCE_CHANGED"), "3": ("RESOLVED", "CLOSED")}
    cells = spark.createDataFrame([("1", "name", "a", "中"), ("2", "name", "a", "latin"), ("3", "name", None, "中")], "sku string, field string, source string, target string")
    held = spark.createDataFrame([("1", "name", "a", "FRESH"), ("2", "name", "a", "FRESH"), ("3", "name", "a", "FRESH")], "sku string, field string, snapshot string, freshness string")
    assert {r.sku: r.reused for r in audits.reusable(cells, held).collect()} == {"1": "中", "2": None, "3": None}


def test_no_part_of_a_split_is_empty(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "sku string, n int")
    parts = lambda df, ratio: sorted(r.part for r in audits.guarded_split(df, "sku", ["sku", "n"], ratio).collect())
    assert parts(rows, 0.0) == parts(rows, 2.0) == ["train", "valid"] and parts(rows.limit(0), 0.5) == []
    assert {r.sku: r.part for r in audits.guarded_split(rows, "sku", ["sku", "n"], 0.0).collect()} == {"a": "train", "b": "valid"}


def test_gold_counters_of_invalid_rows(spark):
    rows = [("1", "f", "2 cm", "中 2 cm", "中 2 cm"), ("1", "f", "2 cm", None, "x"), (None, "f", "s", "p", "g"), ("2", "f", "s", "p", " ")]
    df = spark.createDataFrame(rows, "key string, field string, source string, prediction string, gold string")
    assert audits.gold_counters(df).first().asDict() == {"rows": 2, "invalid_rows": 2, "field_exact": 1, "number_mismatch": 1, "unit_mismatch": 1, "target_script": 1}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_findings_by_sku_broadcast_no_table_of_parts(spark):
    """Rows of most SKUs are merged and prices are counted before they meet their parents, however small the files are."""
    gate = plan_of(audit_queries.master_gate(spark, "/root/testdata/sf0.001"))
    assert "lineitem" not in gate and "events" not in gate
    assert gate.count("BroadcastHashJoin") <= 2  # the price review alone
    found = plan_of(audit_queries.database_findings(spark, "/root/testdata/sf0.001"))
    assert "LeftAnti" not in found and found.index("Join") < found.index("HashAggregate")

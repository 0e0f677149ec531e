"""Price facts, events of a day and proven absences: the cases at their borders."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import changes

HISTORY = "sku string, observed_at timestamp, seq int, old_price double, new_price double, change_type string"
CURRENT = "sku string, current_price double, original_price double, badge_discount double, promoted boolean, last_valid_price double, extra string"


def at(day, hour=9):
    return dt.datetime(2024, 5, day, hour)


def facts(spark, current, history):
    rows = changes.price_facts(spark.createDataFrame(current, CURRENT), spark.createDataFrame(history, HISTORY), ["observed_at", "seq"], "2024-05-03").collect()
    return {r.sku: r for r in rows}


def test_price_facts(spark):
    history = [
        ("a", at(1), 1, None, 4.0, "NEW"), ("a", at(2), 1, 4.0, 5.0, "UP"), ("a", at(3), 1, 5.0, 4.5, "DOWN"), ("a", at(3), 2, 4.5, 4.5, "UNCHANGED"), ("a", at(4), 1, 4.5, 0.0, "DOWN"),
        ("b", at(3), 1, None, 2.0, "NEW"), ("c", at(1), 1, -1.0, 3.0, "UP"),
    ]
    current = [("a", 4.5, None, None, None, 9.0, "x"), ("b", 2.0, 2.5, -0.3, True, None, "x"), ("c", None, None, None, None, -2.0, "x"), ("d", 7.0, 8.0, -1.0, True, None, "x"), ("e", None, 3.0, -0.2, False, None, None)]
    out = facts(spark, current, history)
    a = out["a"]
    # a fall to zero is no real change; the period's last row speaks for it; the last valid price counts for extrema
    assert (a.last_price, a.price_direction, a.price_change, a.change_amount, a.change_percent, a.last_change_date) == (5.0, "DOWN", "UNCHANGED", -0.5, -0.1, "2024-05-03")
    assert (a.price_min, a.price_max, a.discount) == (4.0, 9.0, None)
    assert (out["b"].price_change, out["b"].last_price, out["b"].discount) == ("NEW", None, -0.3)
    assert (out["c"].price_direction, out["c"].price_min, out["c"].price_max) == (None, 3.0, 3.0)
    # a badge of a whole price is none, so the original price speaks; without history only own prices count
    assert (out["d"].discount, out["d"].price_min, out["d"].price_change) == (-0.125, 7.0, "UNCHANGED")
    assert (out["e"].discount, out["e"].price_min) == (None, None)
    assert facts(spark, [], history) == {} and facts(spark, current, [])["a"].price_max == 9.0


PAIRS = "sku string, known boolean, first_presence boolean, old_price double, new_price double, old_content_hash string, new_content_hash string, old_promo boolean, new_promo boolean"


def test_day_events(spark):
    rows = [
        ("up", True, False, 2.0, 3.0, "h", "h", False, True), ("same", True, None, 2.0, 2.0 + 1e-10, "h", "h", True, True), ("odd", True, False, 2.0, 0.0, "h", "h", None, None), ("high", True, False, 2.0, 100.01, "h", "h", None, None),
        ("edge", True, False, 2.0, 100.0, None, None, None, None), ("gone", True, False, 2.0, None, "x" * 20, None, True, None), ("new", None, None, None, 4.0, None, "h", None, True), ("first", True, True, 1.0, 1.0, "a", "b", None, None), ("zero", True, False, 0.0, 1.0, "a", "a", None, None),
    ]
    found = changes.day_events(spark.createDataFrame(rows, PAIRS), 100.0, {"promo": ("ON", "OFF")}).collect()
    by = {}
    for r in found:
        by.setdefault(r.sku, {})[r.event_type] = r
    assert {k: sorted(v) for k, v in by.items()} == {
        "up": ["ON", "PRICE_UP"], "odd": ["PRICE_ANOMALY"], "high": ["PRICE_ANOMALY"], "edge": ["PRICE_UP"], "gone": ["CONTENT_CHANGE", "OFF"], "new": ["FIRST_SEEN", "ON", "PRICE_NEW"], "first": ["FIRST_SEEN"], "zero": ["PRICE_UP"],
    }
    assert (by["up"]["PRICE_UP"].change_amount, by["up"]["PRICE_UP"].change_percent) == (1.0, 0.5) and by["zero"]["PRICE_UP"].change_percent is None
    assert by["new"]["PRICE_NEW"].change_amount is None and by["gone"]["CONTENT_CHANGE"].old_value == "x" * 12
    assert (by["up"]["ON"].old_value, by["up"]["ON"].new_value) == ("false", "true")
    assert changes.day_events(spark.createDataFrame([], PAIRS), 100.0, {}).count() == 0


def test_kept_extrema(spark):
    rows = spark.createDataFrame([(1.0, 3.0, 5.0), (1.0, 3.0, 0.0), (1.0, 3.0, None), (None, None, 2.0), (1.0, 3.0, 11.0)], "low double, high double, price double")
    low, high = changes.kept_extrema(F.col("low"), F.col("high"), F.col("price"), 10.0)
    assert [tuple(r) for r in rows.select(low, high).collect()] == [(1.0, 5.0), (1.0, 3.0), (1.0, 3.0), (2.0, 2.0), (1.0, 3.0)]


EVIDENCE = "sku string, complete boolean, articles array<string>, url string, original_count int, discount_count int, original_text string, discount_text string, observed_at timestamp_ntz, business_date date, price double, expected_original double"
PRODUCTS = "sku string, product_url string, status string, current_price double, original_price double, name string"


def evidence(sku="1", **other):
    row = {"sku": sku, "complete": True, "articles": [sku], "url": f"https://shop.example/{sku}", "original_count": 0, "discount_count": 0, "original_text": "", "discount_text": "", "observed_at": at(3), "business_date": dt.date(2024, 5, 3), "price": 2.0, "expected_original": 3.0}
    return tuple((row | other).values())


@pytest.mark.parametrize(
    ("other", "verdict"),
    [
        ({}, "CLEAR"), ({"complete": None}, "EVIDENCE_INCOMPLETE"), ({"articles": ["1", "2"]}, "SKU_MISMATCH"), ({"url": "https://shop.example/2"}, "URL_MISMATCH"), ({"discount_count": 1}, "NOT_CONFIRMED"), ({"original_count": None}, "NOT_CONFIRMED"), ({"original_text": "3,00"}, "NOT_CONFIRMED"),
        ({"observed_at": at(2, 22)}, "CLEAR"), ({"observed_at": at(2, 21)}, "DATE_MISMATCH"), ({"observed_at": at(3, 22)}, "DATE_MISMATCH"), ({"price": 2.01}, "CURRENT_PRICE_MISMATCH"), ({"price": float("nan")}, "CURRENT_PRICE_MISMATCH"), ({"expected_original": 3.1}, "ORIGINAL_CHANGED"), ({"expected_original": None}, "ORIGINAL_CHANGED"),
        ({"sku": "9", "articles": ["9"]}, "SKU_MISSING"), ({"sku": None}, "SKU_MISSING"), ({"sku": "2", "articles": ["2"], "url": "https://shop.example/2"}, "SKU_NOT_CURRENT"), ({"sku": "3", "articles": ["3"], "url": "https://shop.example/3", "expected_original": None}, "NO_ORIGINAL"),
    ],
)
def test_absence_verdicts(spark, other, verdict):
    products = spark.createDataFrame([("1", "https://shop.example/1", "CURRENT", 2.0, 3.0, "a"), ("2", "https://shop.example/2", "OFFLINE", 2.0, 3.0, "b"), ("3", "https://shop.example/3", "CURRENT", 2.0, None, "c")], PRODUCTS)
    rows = changes.absence_verdicts(spark.createDataFrame([evidence(**other)], EVIDENCE), products, "shop.example", "Europe/Madrid").collect()
    assert [r.verdict for r in rows] == [verdict]


def test_absences_are_applied_whole_or_not_at_all(spark):
    products = spark.createDataFrame([(k, f"https://shop.example/{k}", "CURRENT", 2.0, 3.0, "n") for k in ("1", "2")], PRODUCTS)
    verdicts = lambda *rows: changes.absence_verdicts(spark.createDataFrame(list(rows), EVIDENCE), products, "shop.example", "Europe/Madrid")
    out = changes.without_originals(products, verdicts(evidence("1")))
    assert {r.sku: (r.original_price, r.current_price) for r in out.collect()} == {"1": (None, 2.0), "2": (3.0, 2.0)} and out.columns == products.columns
    with pytest.raises(changes.AbsenceRefused, match="2: NOT_CONFIRMED"):
        changes.without_originals(products, verdicts(evidence("1"), evidence("2", original_count=1)))
    with pytest.raises(changes.AbsenceRefused, match="1: DUPLICATE_SKU"):
        changes.without_originals(products, verdicts(evidence("1"), evidence("1")))
    assert changes.without_originals(products, verdicts(evidence("1")).limit(0)).where("original_price = 3.0").count() == 2


ROWS = "sku string, canonical_id string, status string, first_seen string, last_seen string, missing_count int, name string, extra string"


def scope_faults(spark, row, prior=True, may=None, seen=("PRESENT", False, False), issue=None, times=1):
    digest = lambda v: hashlib.sha256(v.encode()).hexdigest()
    stored = ("1", "C1", "CURRENT", "a", "b", 0, "old", "x")
    rows = spark.createDataFrame([row] * times, ROWS)
    permissions = spark.createDataFrame([("1", "C1", {f: digest(v) for f, v in (may or {}).items()})], "sku string, canonical_id string, allowed map<string,string>")
    observations = spark.createDataFrame([("1", *seen)] if seen else [], "sku string, presence_state string, complete boolean, absence_capable boolean")
    issues = spark.createDataFrame([("1", *issue)] if issue else [], "sku string, level string, field_name string")
    return sorted(r.fault for r in changes.positive_scope_faults(rows, permissions, spark.createDataFrame([stored] if prior else [], ROWS), observations, issues, ["name"], ["status"]).collect())


SAME = ("1", "C1", "CURRENT", "a", "b", 0, "old", "y")


@pytest.mark.parametrize(
    ("row", "other", "faults"),
    [
        (SAME, {}, []), ((*SAME[:6], "new", "y"), {"may": {"name": "new"}}, []), ((*SAME[:6], "new", "y"), {}, ["UNAUTHORIZED_FIELD:name"]), ((*SAME[:6], "new", "y"), {"may": {"name": "newer"}}, ["VALUE_HASH_MISMATCH:name"]),
        ((*SAME[:6], None, "y"), {"may": {"name": ""}}, []), ((*SAME[:2], "OFFLINE", *SAME[3:]), {}, ["LIFECYCLE_CHANGED:status"]), (("1", "C2", *SAME[2:]), {}, ["IDENTITY_MISMATCH"]), (("1", None, *SAME[2:]), {}, ["IDENTITY_MISMATCH"]),
        (SAME, {"seen": None}, ["OBSERVATION_SCOPE_MISMATCH"]), (SAME, {"seen": ("ABSENT", False, False)}, ["NO_ABSENCE_AUTHORITY"]), (SAME, {"seen": ("PRESENT", None, False)}, ["NO_ABSENCE_AUTHORITY"]), (SAME, {"seen": ("PRESENT", False, True)}, ["NO_ABSENCE_AUTHORITY"]),
        (SAME, {"issue": ("HARD_BLOCK", "presence")}, []), (SAME, {"issue": ("HARD_BLOCK", None)}, ["QA_NOT_READY"]), (SAME, {"issue": ("FIELD_REVIEW", "name")}, []), (SAME, {"issue": ("FIELD_REVIEW", "name"), "may": {"name": "old"}}, ["QA_NOT_READY"]), (SAME, {"times": 2}, ["SKU_SCOPE_MISMATCH"]),
        (("1", "C1", "UNKNOWN", None, "", None, None, "y"), {"prior": False}, []), (("1", "C1", "UNKNOWN", None, "", 1, None, "y"), {"prior": False}, ["NEW_IDENTITY_MUST_BE_UNKNOWN"]), (SAME, {"prior": False, "may": {"name": "old"}}, ["NEW_IDENTITY_MUST_BE_UNKNOWN"]),
        (("2", "C1", *SAME[2:]), {}, ["OBSERVATION_SCOPE_MISMATCH", "SKU_SCOPE_MISMATCH", "SKU_SCOPE_MISMATCH"]),
    ],
)
def test_positive_scope(spark, row, other, faults):
    assert scope_faults(spark, row, **other) == faults

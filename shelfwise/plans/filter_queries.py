"""Every filter of the catalogue query over whole catalogue rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from shelfwise.operators.catalogue import CatalogueQuery, derived, matched, page
from shelfwise.plans.registry import query
from shelfwise.sources.full_catalogue import FULL, change_log, event_history, full_rows, lifecycle
from shelfwise.sources.relations import table

FIELDS = ("name", "cat1", "cat2", "spec", "description", "details")
SHOWN = [
    "canonical_id", "sku", "name", "current_price", "original_price", "status", "product_url", "first_seen", "last_seen", "new_badge", "promotion", "sustainable",
    *[f"es_{c}" for c in FIELDS], *[f"zh_{c}" for c in FIELDS], "zh_review_status", "zh_freshness_status", "image_status", "image_path",
    "price_change", "change_amount", "change_percent", "historical_low", "historical_high", "recent_event_type", "recent_event_at",
]
NOW = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)


def asked(spark, sf_dir, **values):
    q = CatalogueQuery.request(values)
    return matched(full_rows(spark, sf_dir), q, event_history(spark, sf_dir), change_log(spark, sf_dir), lifecycle(spark, sf_dir), NOW)


def rows_where(condition: str, columns: str = "sku, status") -> str:
    return f"WITH {FULL} SELECT {columns} FROM full_rows p WHERE {condition}"


def found(spark, sf_dir, **values):
    return asked(spark, sf_dir, **values).select("sku", "status")


@query(f"WITH {FULL} SELECT {', '.join(SHOWN)} FROM full_rows WHERE status = 'CURRENT' ORDER BY coalesce(changed_at, '') DESC, sku LIMIT 500 OFFSET 20")
def catalogue_rows(spark, sf_dir):
    """The whole row, most recent price change first."""
    q = CatalogueQuery.request({"sort": "recent_change", "descending": True, "limit": 500, "offset": 20})
    return page(asked(spark, sf_dir), q).select(*SHOWN)


@query(rows_where("status = 'CURRENT'", """sku, CASE WHEN upper(zh_freshness_status) = 'STALE' OR upper(zh_review_status) = 'STALE' THEN 'STALE' WHEN upper(zh_review_status) = 'BLOCKED' THEN 'BLOCKED'
  WHEN upper(zh_review_status) IN ('PENDING', 'REVIEW_PENDING') THEN upper(zh_review_status) WHEN coalesce(trim(zh_name), '') = '' OR coalesce(trim(zh_cat1), '') = '' OR coalesce(trim(zh_cat2), '') = '' OR coalesce(trim(zh_spec), '') = ''
  OR coalesce(trim(zh_description), '') = '' OR coalesce(trim(zh_details), '') = '' THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS localization_status,
  coalesce(image_status = 'AVAILABLE', false) AS has_image, coalesce(image_status = 'AVAILABLE' AND image_path IS NOT NULL, false) AS image_ready_for_export, last_seen AS last_confirmed_at"""))
def derived_fields(spark, sf_dir):
    return derived(asked(spark, sf_dir)).select("sku", "localization_status", "has_image", "image_ready_for_export", "last_confirmed_at")


@query(rows_where("status = 'CURRENT'", "sku, raw_price, current_price, original_price, historical_low, historical_high"))
def current_prices(spark, sf_dir):
    """Prices a review marks are not shown; the extrema keep them."""
    return asked(spark, sf_dir).select("sku", "raw_price", "current_price", "original_price", "historical_low", "historical_high")


@query(rows_where("status = 'CURRENT' AND (sku LIKE '%s_a%' OR lower(name) LIKE '%s_a%' OR lower(coalesce(name_zh, '')) LIKE '%s_a%' OR lower(coalesce(zh_name, '')) LIKE '%s_a%')"))
def filter_keyword_wildcards(spark, sf_dir):
    return found(spark, sf_dir, keyword="S_A")


@query(rows_where("status IN ('CURRENT', 'MISSING') AND canonical_id IN ('ACT0000012', 'ACT0000017', 'ACT0000133')"))
def filter_canonical_ids(spark, sf_dir):
    return found(spark, sf_dir, canonical_ids="ACT0000012, ACT0000017,ACT0000133", statuses="current,missing")


@query(rows_where("status = 'CURRENT' AND canonical_id = 'ACT0000013'"))
def filter_canonical_alias(spark, sf_dir):
    return found(spark, sf_dir, canonical_id="ACT0000013", unknown_key=1)


@query(rows_where("status = 'CURRENT' AND sku::BIGINT % 3 = 0 AND sku::BIGINT < 4500"))
def filter_long_sku_list(spark, sf_dir):
    """A list of 1,500 identifiers is joined, not written into the plan."""
    return found(spark, sf_dir, skus=tuple(str(3 * k) for k in range(1500)))


@query(rows_where("status = 'OFFLINE' OR EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.event_type = 'REAPPEARED')"))
def filter_reappeared(spark, sf_dir):
    return found(spark, sf_dir, statuses=("OFFLINE", "REAPPEARED"))


@query(rows_where("status = 'CURRENT' AND coalesce(zh_cat1, es_cat1, '') IN ('economy', 'PROMO') AND coalesce(zh_cat2, es_cat2, '') IN ('brand#1', 'Brand#2', 'brand#3')"))
def filter_categories(spark, sf_dir):
    """The ZH value where there is one, else the ES value."""
    return found(spark, sf_dir, cat1="economy,PROMO", cat2=("brand#1", "Brand#2", "brand#3"))


@query(rows_where("status = 'CURRENT' AND current_price >= 905 AND current_price <= 1200"))
def filter_prices(spark, sf_dir):
    return found(spark, sf_dir, min_price=905.0, max_price=1200.0)


@query(rows_where("status = 'CURRENT' AND original_price > current_price"))
def filter_discounted(spark, sf_dir):
    return found(spark, sf_dir, has_original_price=True)


@query(rows_where("status = 'CURRENT' AND (original_price IS NULL OR original_price <= current_price)"))
def filter_not_discounted(spark, sf_dir):
    return found(spark, sf_dir, has_original_price=False)


@query(rows_where("status = 'CURRENT' AND promotion AND NOT new_badge AND NOT sustainable"))
def filter_badges(spark, sf_dir):
    return found(spark, sf_dir, promotion=True, new_badge=False, sustainable=False)


@query(rows_where("status = 'CURRENT' AND coalesce(image_status, 'NO_SOURCE_URL') IN ('FAILED', 'NO_SOURCE_URL') AND (image_status IS NULL OR image_status <> 'AVAILABLE')"))
def filter_images(spark, sf_dir):
    return found(spark, sf_dir, image_statuses="failed,no_source_url", has_image=False)


@query(rows_where("status = 'CURRENT' AND image_status = 'AVAILABLE' AND image_path IS NOT NULL"))
def filter_image_ready(spark, sf_dir):
    return found(spark, sf_dir, image_ready_for_export=True)


@query(rows_where("status = 'CURRENT' AND (image_status IS NULL OR image_status <> 'AVAILABLE' OR image_path IS NULL)"))
def filter_image_not_ready(spark, sf_dir):
    return found(spark, sf_dir, image_ready_for_export=False)


WHOLE = " AND ".join(f"coalesce(zh_{c}, '') <> ''" for c in FIELDS)
FREE = "NOT coalesce(zh_freshness_status = 'STALE', false) AND upper(coalesce(zh_review_status, '')) NOT IN ('STALE', 'BLOCKED', 'PENDING', 'REVIEW_PENDING')"


@query(" UNION ALL ".join(
    f"SELECT sku, '{name}' AS asked FROM ({rows_where(condition, 'sku')})"
    for name, condition in (("COMPLETE", f"status = 'CURRENT' AND {FREE} AND {WHOLE}"), ("INCOMPLETE", f"status = 'CURRENT' AND {FREE} AND NOT ({WHOLE})"), ("STALE", "status = 'CURRENT' AND zh_freshness_status = 'STALE'"),
                            ("PENDING", "status = 'CURRENT' AND zh_review_status = 'PENDING'"), ("REVIEW_PENDING", "status = 'CURRENT' AND zh_review_status = 'review_pending'"), ("BLOCKED", "status = 'CURRENT' AND zh_review_status = 'BLOCKED'"))
))
def filter_localization(spark, sf_dir):
    """All six values of the filter; a stale row that is also pending is found under both."""
    whole = None
    for name in ("COMPLETE", "INCOMPLETE", "STALE", "PENDING", "REVIEW_PENDING", "BLOCKED"):
        rows = asked(spark, sf_dir, localization_status=name.lower()).select("sku", F.lit(name).alias("asked"))
        whole = rows if whole is None else whole.unionAll(rows)
    return whole


@query(rows_where("status = 'CURRENT' AND coalesce(trim(zh_spec), '') = '' AND coalesce(trim(zh_name), '') = ''"))
def filter_missing_localization(spark, sf_dir):
    return found(spark, sf_dir, missing_fields="localization,spec_zh")


@query(rows_where("status = 'CURRENT' AND coalesce(trim(coalesce(zh_description, es_description)), '') = '' AND coalesce(trim(image_status), '') = ''"))
def filter_missing_description(spark, sf_dir):
    return found(spark, sf_dir, missing_fields=("description", "image"))


@query(rows_where("status = 'CURRENT' AND price_change = 'DOWN' AND abs(coalesce(change_amount, 0)) >= 50 AND abs(coalesce(change_percent, 0)) >= 10"))
def filter_changes(spark, sf_dir):
    return found(spark, sf_dir, price_change="down", min_change_amount=50.0, min_change_percent=10.0)


@query(rows_where("status = 'CURRENT' AND coalesce(historical_low, current_price) BETWEEN 100 AND 1500 AND coalesce(historical_high, current_price) BETWEEN 1500 AND 4000"))
def filter_extrema(spark, sf_dir):
    return found(spark, sf_dir, historical_low_min=100.0, historical_low_max=1500.0, historical_high_min=1500.0, historical_high_max=4000.0)


@query(rows_where("status = 'CURRENT' AND first_seen >= '1995-01-20' AND first_seen <= '1995-06-30' AND coalesce(last_seen, last_checked) >= '2000-01-01' AND coalesce(last_seen, last_checked) <= '2001-06-30'"))
def filter_seen(spark, sf_dir):
    return found(spark, sf_dir, first_seen_from="1995-01-20", first_seen_to="1995-06-30", date_from="2000-01-01", last_seen_to="2001-06-30")


@query(rows_where("status = 'CURRENT' AND coalesce(last_seen, last_checked) >= strftime(DATE '2024-01-31' - 8400, '%Y-%m-%d')"))
def filter_last_days(spark, sf_dir):
    return found(spark, sf_dir, last_n_days=8400)


def event_filter(kinds: str) -> str:
    return rows_where(f"status IN ('CURRENT', 'MISSING', 'OFFLINE') AND ({kinds})")


EVERY = ("CURRENT", "MISSING", "OFFLINE")


@query(event_filter("EXISTS (SELECT 1 FROM change_log h WHERE h.sku = p.sku AND h.old_price IS NOT NULL AND h.new_price < h.old_price AND h.observed_at >= '2001-06-01') OR EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.event_type = 'PRICE_DOWN' AND e.occurred_at >= '2001-06-01')"))
def filter_price_down(spark, sf_dir):
    """From the price history or from an event row."""
    return found(spark, sf_dir, statuses=EVERY, event_types="price_down", event_from="2001-06-01")


@query(event_filter("EXISTS (SELECT 1 FROM change_log h WHERE h.sku = p.sku AND h.old_price IS NOT NULL AND h.new_price > h.old_price AND h.observed_at <= '1995-03-01') OR EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.event_type = 'PRICE_UP' AND e.occurred_at <= '1995-03-01')"))
def filter_price_up(spark, sf_dir):
    return found(spark, sf_dir, statuses=EVERY, event_types=("PRICE_UP",), event_to="1995-03-01")


@query(event_filter("EXISTS (SELECT 1 FROM lifecycle l WHERE l.sku = p.sku AND l.offline_date IS NOT NULL AND l.offline_date >= '2024-01-10' AND l.offline_date <= '2024-01-31')"))
def filter_offline(spark, sf_dir):
    return found(spark, sf_dir, statuses=EVERY, event_types="OFFLINE", event_from="2024-01-10", event_to="2024-01-31")


@query(event_filter("EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.event_type IN ('FIRST_SEEN', 'NEW_BADGE_ON') AND e.occurred_at <= '2024-01-02') OR EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.event_type = 'CONTENT_CHANGE' AND e.occurred_at <= '2024-01-02')"))
def filter_new(spark, sf_dir):
    """NEW is a first sight or a badge; kinds are alternatives, conditions hold of one event."""
    return found(spark, sf_dir, statuses=EVERY, event_types="NEW,CONTENT_CHANGE", event_to="2024-01-02")


@query(event_filter("EXISTS (SELECT 1 FROM event_history e WHERE e.sku = p.sku AND e.occurred_at >= '2024-01-28T12:00:00+00:00')"))
def filter_recent_events(spark, sf_dir):
    """Any event in the days before a moment."""
    return found(spark, sf_dir, statuses=EVERY, event_last_n_days=3)


@query("SELECT '" + "' AS query_hash UNION ALL SELECT '".join(CatalogueQuery.request(v).digest() for v in ({}, {"canonical_ids": ["act1"], "date_from": "2024-01-01"}, {"keyword": "big lamp", "statuses": ["missing"]})) + "' AS query_hash")
def query_hashes(spark, sf_dir):
    """Equal requests in other forms have equal hashes."""
    forms = ({"statuses": "", "bad": 1}, {"canonical_id": "ACT1", "last_seen_from": "2024-01-01"}, {"keyword": " Big   LAMP", "statuses": "MISSING"})
    return spark.createDataFrame([(CatalogueQuery.request(v).digest(),) for v in forms], "query_hash string")


@query(rows_where("status = 'CURRENT' AND sku IN (SELECT p_partkey::VARCHAR FROM part WHERE p_size = 12)", "sku, name, es_cat1, zh_cat1"))
def narrow_scan(spark, sf_dir):
    """The SKUs of another relation: a semi-join, so that none means no rows."""
    wanted = table(spark, sf_dir, "part").where("p_size = 12").select(F.col("p_partkey").cast("string").alias("sku"))
    return asked(spark, sf_dir).join(wanted, "sku", "left_semi").select("sku", "name", "es_cat1", "zh_cat1")

"""Declarative catalogue queries: filter fields to Column predicates, sort, page, canonical hash, saved selections."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, fields, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.texts import is_blank
from shelfwise.operators.windows import latest

# fixed values: the names that callers send
SORTS = ("sku", "name", "current_price", "change_amount", "change_percent", "first_seen", "last_seen", "recent_change")
DIRECTIONS = {"UP": "UP", "DOWN": "DOWN", "FLAT": "UNCHANGED"}
MISSING = {
    "category": ("zh_cat1", "es_cat1"), "spec": ("zh_spec", "es_spec"), "description": ("zh_description", "es_description"), "image": ("image_status",), "localization": ("zh_name",), "name_zh": ("zh_name",),
    "cat1_zh": ("zh_cat1",), "cat2_zh": ("zh_cat2",), "spec_zh": ("zh_spec",), "desc_zh": ("zh_description",), "details_zh": ("zh_details",),
}
LOCALIZATION = ("COMPLETE", "INCOMPLETE", "STALE", "PENDING", "REVIEW_PENDING", "BLOCKED")
ZH_FIELDS = ("zh_name", "zh_cat1", "zh_cat2", "zh_spec", "zh_description", "zh_details")
EVENT_GROUPS = {"NEW": ("FIRST_SEEN", "NEW_BADGE_ON")}
MOST_ROWS = 10_000
#: Longer lists of identifiers become a semi-join.
LONG_LIST = 500


@dataclass(frozen=True)
class CatalogueQuery:
    """All predicates are joined by AND; lists are alternatives. Unset fields filter nothing."""

    keyword: str | None = None
    canonical_id: str | None = None
    canonical_ids: tuple[str, ...] = ()
    skus: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    cat1: tuple[str, ...] = ()
    cat2: tuple[str, ...] = ()
    min_price: float | None = None
    max_price: float | None = None
    has_original_price: bool | None = None
    promotion: bool | None = None
    new_badge: bool | None = None
    sustainable: bool | None = None
    image_statuses: tuple[str, ...] = ()
    has_image: bool | None = None
    image_ready_for_export: bool | None = None
    localization_status: str | None = None
    missing_fields: tuple[str, ...] = ()
    price_change: str | None = None
    min_change_amount: float | None = None
    min_change_percent: float | None = None
    historical_low_min: float | None = None
    historical_low_max: float | None = None
    historical_high_min: float | None = None
    historical_high_max: float | None = None
    first_seen_from: str | None = None
    first_seen_to: str | None = None
    last_seen_from: str | None = None
    last_seen_to: str | None = None
    event_types: tuple[str, ...] = ()
    event_from: str | None = None
    event_to: str | None = None
    event_last_n_days: int | None = None
    date_from: str | None = None
    date_to: str | None = None
    last_n_days: int | None = None
    sort: str = "sku"
    descending: bool = False
    limit: int = 100
    offset: int = 0

    def checked(self) -> CatalogueQuery:
        if self.sort not in SORTS:
            raise ValueError(f"unknown sort key {self.sort!r}; one of {', '.join(SORTS)}")
        if not 1 <= self.limit <= MOST_ROWS or self.offset < 0:
            raise ValueError(f"limit lies between 1 and {MOST_ROWS}, offset is not negative")
        if self.localization_status and self.localization_status.upper() not in LOCALIZATION:
            raise ValueError(f"unknown localization status {self.localization_status!r}")
        if self.price_change and self.price_change.upper() not in DIRECTIONS:
            raise ValueError(f"unknown price change {self.price_change!r}")
        return self

    def folded(self) -> CatalogueQuery:
        """The same query without aliases: canonical_id, date_from and date_to."""
        return replace(
            self, canonical_id=None, date_from=None, date_to=None, canonical_ids=self.canonical_ids or ((self.canonical_id,) if self.canonical_id else ()),
            last_seen_from=self.last_seen_from or self.date_from, last_seen_to=self.last_seen_to or self.date_to,
        )

    @classmethod
    def of(cls, values: dict) -> CatalogueQuery:
        """From a mapping: comma lists become tuples, unknown keys are ignored."""
        known = {f.name: f for f in fields(cls)}
        out = {}
        for key, value in values.items():
            if key not in known or value is None:
                continue
            many = str(known[key].type).startswith("tuple")
            out[key] = tuple(x.strip() for x in value.split(",") if x.strip()) if many and isinstance(value, str) else tuple(value) if many else value
        return cls(**out)

    @classmethod
    def request(cls, values: dict | None) -> CatalogueQuery:
        """What a caller asks for: as `of`, aliases folded, and without a status the current ones."""
        found = cls.of(values or {}).folded()
        return found if found.statuses else replace(found, statuses=("CURRENT",))

    def canonical(self) -> str:
        """JSON with sorted keys, aliases folded: strings lower-cased and collapsed, lists sorted and without repeats, unset fields left out."""

        def tidy(value):
            if isinstance(value, str):
                return " ".join(value.lower().split())
            return sorted({tidy(x) for x in value}) if isinstance(value, tuple) else value

        kept = {k: tidy(v) for k, v in asdict(self.folded()).items() if v not in (None, (), "")}
        return json.dumps(kept, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

    def digest(self) -> str:
        return hashlib.sha256(self.canonical().encode()).hexdigest()


def with_price_facts(catalog: DataFrame, history: DataFrame) -> DataFrame:
    """Left joins of each SKU's latest change and of its price extrema over old and new prices."""
    order = [c for c in ("observed_at", "k1", "k2", "k3", "id") if c in history.columns]
    last = latest(history, ["sku"], order, ["old_price", "new_price", "change_type", "observed_at"])
    last = last.select(
        "sku", F.col("observed_at").alias("changed_at"), F.col("change_type").alias("price_change"), F.round(F.col("new_price") - F.col("old_price"), 4).alias("change_amount"),
        F.round(F.try_divide(100 * (F.col("new_price") - F.col("old_price")), F.when(F.col("old_price") != 0, F.col("old_price"))), 4).alias("change_percent"),
    )
    extrema = history.groupBy("sku").agg(F.least(F.min("old_price"), F.min("new_price")).alias("historical_low"), F.greatest(F.max("old_price"), F.max("new_price")).alias("historical_high"))
    return catalog.join(last, "sku", "left").join(extrema, "sku", "left")


def derived(rows: DataFrame) -> DataFrame:
    """Adds localization_status, has_image, image_ready_for_export and last_confirmed_at to full catalogue rows.

    The first that holds: STALE, BLOCKED, the review's REVIEW_PENDING or PENDING, INCOMPLETE, COMPLETE.
    """
    review, fresh = F.upper(F.coalesce("zh_review_status", F.lit(""))), F.upper(F.coalesce("zh_freshness_status", F.lit("")))
    blank = F.exists(F.array(*[is_blank(F.col(c)) for c in ZH_FIELDS]), lambda x: x)
    status = F.when((fresh == "STALE") | (review == "STALE"), "STALE").when(review == "BLOCKED", "BLOCKED").when(review.isin("REVIEW_PENDING", "PENDING"), review).when(blank, "INCOMPLETE").otherwise("COMPLETE")
    there = F.col("image_status").eqNullSafe(F.lit("AVAILABLE"))
    return rows.withColumns({"localization_status": status, "has_image": there, "image_ready_for_export": there & F.col("image_path").isNotNull() & (F.col("image_path") != ""), "last_confirmed_at": F.col("last_seen")})


def all_of(conditions: list[Column]) -> Column:
    whole = F.lit(True)
    for c in conditions:
        whole = whole & c
    return whole


def any_of(conditions: list[Column]) -> Column:
    whole = F.lit(False)
    for c in conditions:
        whole = whole | c
    return whole


def days_before(now: datetime, days: int) -> datetime:
    return now.astimezone(timezone.utc) - timedelta(days=days)


def predicate(q: CatalogueQuery, columns: list[str], now: datetime | None = None) -> Column:
    """The query's row conditions as one Column; fields whose column the relation lacks raise.

    Statuses are not among them: REAPPEARED is an event. Lists of identifiers over
    LONG_LIST are not either. `now` is the moment from which last_n_days counts.
    """
    q = q.folded()

    def need(*names: str) -> Column:
        for name in names:
            if name not in columns:
                raise ValueError(f"the relation has no column {name!r}")
        return F.coalesce(*names) if len(names) > 1 else F.col(names[0])

    def either(*names: str) -> Column:
        return need(*[n for n in names if n in columns] or names)

    def between(value: Column, low, high) -> list[Column]:
        return [value >= low] * (low is not None) + [value <= high] * (high is not None)

    def unless_null(value, condition) -> list[Column]:
        return [] if value is None else [condition(value)]

    out: list[Column] = []
    if q.keyword:
        # % and _ in the text are wildcards, as in LIKE
        term = f"%{' '.join(q.keyword.lower().split())}%"
        out.append(any_of([F.lower(F.coalesce(c, F.lit(""))).like(term) for c in ("sku", "name", "name_es", "name_zh", "es_name", "zh_name") if c in columns]))
    for values, name in ((q.canonical_ids, "canonical_id"), (q.skus, "sku")):
        if 0 < len(values) <= LONG_LIST:
            out.append(need(name).isin(*values))
    for values, plain, names in ((q.cat1, "cat1", ("zh_cat1", "es_cat1")), (q.cat2, "cat2", ("zh_cat2", "es_cat2"))):
        if values:
            out.append(F.coalesce(need(plain) if plain in columns else need(*names), F.lit("")).isin(*values))
    if (q.min_price, q.max_price) != (None, None):
        out += between(need("current_price"), q.min_price, q.max_price)
    if (q.first_seen_from, q.first_seen_to) != (None, None):
        out += between(need("first_seen"), q.first_seen_from, q.first_seen_to)
    since = None if q.last_n_days is None else days_before(now or datetime.now(timezone.utc), q.last_n_days).date().isoformat()
    if (q.last_seen_from, q.last_seen_to, since) != (None, None, None):
        seen = either("last_seen", "last_checked")
        out += between(seen, q.last_seen_from, q.last_seen_to) + between(seen, since, None)
    for low, high, name in ((q.historical_low_min, q.historical_low_max, "historical_low"), (q.historical_high_min, q.historical_high_max, "historical_high")):
        if (low, high) != (None, None):
            out += between(need(name, "current_price"), low, high)
    if q.has_original_price is not None:
        now_price, before = need("current_price"), need("original_price")
        out.append(before > now_price if q.has_original_price else before.isNull() | (before <= now_price))
    for wanted, name in ((q.promotion, "promotion"), (q.new_badge, "new_badge"), (q.sustainable, "sustainable")):
        out += unless_null(wanted, lambda w, name=name: need(name) == F.lit(w))
    if q.image_statuses:
        out.append(F.coalesce(need("image_status"), F.lit("NO_SOURCE_URL")).isin(*[s.upper() for s in q.image_statuses]))
    there = lambda: need("image_status").eqNullSafe(F.lit("AVAILABLE"))
    out += unless_null(q.has_image, lambda w: there() if w else ~there())
    ready = lambda: there() & need("image_path").isNotNull()
    out += unless_null(q.image_ready_for_export, lambda w: ready() if w else ~ready())
    if q.localization_status:
        out.append(localized_as(q.localization_status.upper(), need))
    for name in q.missing_fields:
        known = MISSING.get(name.lower())
        if known is None and name not in columns:
            raise ValueError(f"unknown field {name!r}")
        out.append(is_blank(need(*known) if known and known[0] in columns else need(name)))
    if q.price_change:
        out.append(need("price_change") == DIRECTIONS[q.price_change.upper()])
    for least, name in ((q.min_change_amount, "change_amount"), (q.min_change_percent, "change_percent")):
        out += unless_null(least, lambda w, name=name: F.abs(F.coalesce(need(name), F.lit(0.0))) >= w)
    return all_of(out)


def localized_as(wanted: str, need) -> Column:
    """Filters look at the two status columns: a stale row that is also pending is found under both."""
    review, fresh = F.upper(F.coalesce(need("zh_review_status"), F.lit(""))), F.upper(F.coalesce(need("zh_freshness_status"), F.lit("")))
    stale, held = (fresh == "STALE") | (review == "STALE"), review.isin("BLOCKED", "PENDING", "REVIEW_PENDING")
    whole = all_of([F.coalesce(need(c), F.lit("")) != "" for c in ZH_FIELDS])
    if wanted in ("COMPLETE", "INCOMPLETE"):
        return ~stale & ~held & (whole if wanted == "COMPLETE" else ~whole)
    return stale if wanted == "STALE" else review == wanted


def events_of(kinds: tuple[str, ...], low: str | None, high: str | None, events: DataFrame | None, history: DataFrame | None, lifecycle: DataFrame | None) -> DataFrame | None:
    """SKUs with an event of one of the kinds in the time; all conditions hold of one row."""

    def within(rows: DataFrame, at: str, condition: Column) -> DataFrame:
        bounds = ([F.col(at) >= low] if low else []) + ([F.col(at) <= high] if high else [])
        return rows.where(all_of([condition, *bounds])).select("sku")

    found = []
    if events is not None:
        plain = [name for kind in kinds if kind != "OFFLINE" for name in EVENT_GROUPS.get(kind, (kind,))]
        if plain or not kinds:
            found.append(within(events, "occurred_at", F.upper("event_type").isin(*plain) if kinds else F.lit(True)))
    if history is not None:
        for kind, condition in (("PRICE_DOWN", F.col("new_price") < F.col("old_price")), ("PRICE_UP", F.col("new_price") > F.col("old_price"))):
            if kind in kinds:
                found.append(within(history, "observed_at", F.col("old_price").isNotNull() & condition))
    if "OFFLINE" in kinds and lifecycle is not None:
        found.append(within(lifecycle, "offline_date", F.col("offline_date").isNotNull()))
    if not found:
        raise ValueError("the events asked for need a relation of events, price history or lifecycle states")
    whole = found[0]
    for rows in found[1:]:
        whole = whole.unionAll(rows)
    return whole


def matched(catalog: DataFrame, q: CatalogueQuery, events: DataFrame | None = None, history: DataFrame | None = None, lifecycle: DataFrame | None = None, now: datetime | None = None) -> DataFrame:
    """Rows that match, unordered.

    Event kinds are alternatives, found by one semi-join. PRICE_UP and PRICE_DOWN hold of
    price changes or of event rows, OFFLINE of the lifecycle's date, NEW of a first sight or
    a badge. A relation without a status holds current rows only. REAPPEARED among the
    statuses asks for such an event, as an alternative to the other statuses.
    """
    q = q.checked().folded()
    found = catalog.where(predicate(q, catalog.columns, now))
    for values, name in ((q.canonical_ids, "canonical_id"), (q.skus, "sku")):
        if len(values) > LONG_LIST:
            listed = catalog.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], f"{name} string")
            found = found.join(listed, name, "left_semi")
    statuses = {s.upper() for s in q.statuses}
    if "status" in catalog.columns and statuses:
        holds = F.col("status").isin(*statuses)
        if "REAPPEARED" in statuses:
            if events is None:
                raise ValueError("the status REAPPEARED needs an event relation")
            back = events.where("event_type = 'REAPPEARED'").select("sku").distinct().withColumn("_back", F.lit(True))
            found = found.join(back, "sku", "left").where(holds | F.col("_back")).drop("_back")
        else:
            found = found.where(holds)
    elif "status" not in catalog.columns and statuses and statuses != {"CURRENT"}:
        raise ValueError("the relation has no column 'status'")
    since = None if q.event_last_n_days is None else days_before(now or datetime.now(timezone.utc), q.event_last_n_days).isoformat()
    if q.event_types or q.event_from or q.event_to or since:
        low = max([x for x in (q.event_from, since) if x], default=None)
        found = found.join(events_of(tuple(k.upper() for k in q.event_types), low, q.event_to, events, history, lifecycle), "sku", "left_semi")
    return found


def natural_order(sku: str = "sku") -> list[Column]:
    """Digits as numbers before other identifiers."""
    digits = F.col(sku).rlike("^[0-9]+$")
    return [F.when(digits, 0).otherwise(1), F.when(digits, F.col(sku).try_cast("decimal(38,0)")), F.col(sku)]


def page(found: DataFrame, q: CatalogueQuery) -> DataFrame:
    """Nulls are the smallest values; SKU breaks ties."""
    key = F.coalesce("changed_at", F.lit("")) if q.sort == "recent_change" else F.coalesce("zh_name", "es_name", "name") if q.sort == "name" and "zh_name" in found.columns else F.col(q.sort)
    ordered = found.orderBy(key.desc_nulls_last() if q.descending else key.asc_nulls_first(), F.col("sku").asc())
    return ordered.offset(q.offset).limit(q.limit)


def selection(found: DataFrame, q: CatalogueQuery) -> DataFrame:
    """(query_hash, sku): frozen membership, whatever the page; its order is that of the SKU text."""
    return found.select(F.lit(q.digest()).alias("query_hash"), "sku").distinct()

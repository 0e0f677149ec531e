"""Collection metrics, calendar baselines, gates and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.evidence import is_interface_text
from shelfwise.functions.texts import has_markup, is_blank


def baselines(metrics: DataFrame, spans: tuple[int, ...] = (7, 30)) -> DataFrame:
    """(metric, day, value) to the medians of the days before each day, by calendar span, and the previous value.

    One value a day: callers reduce several runs of a day to the last before.
    """
    joined = metrics.alias("a").join(
        metrics.alias("b"), (F.col("a.metric") == F.col("b.metric")) & (F.col("b.day") < F.col("a.day")) & (F.col("b.day") >= F.date_sub(F.col("a.day"), max(spans))), "left"
    )
    medians = [F.median(F.when(F.col("b.day") >= F.date_sub(F.col("a.day"), n), F.col("b.value"))).alias(f"median_{n}") for n in spans]
    out = joined.groupBy(F.col("a.metric").alias("metric"), F.col("a.day").alias("day"), F.col("a.value").alias("value")).agg(*medians)
    return out.withColumn("previous", F.lag("value").over(Window.partitionBy("metric").orderBy("day")))


def gate(values: DataFrame, warn: float = 20.0, degraded: float = 40.0, blocked: float = 60.0) -> DataFrame:
    """Drop of the value against the 7-day median in per cent, and the state that follows."""
    drop = F.round(F.try_divide(100.0 * (F.col("median_7") - F.col("value")), F.when(F.col("median_7") != 0, F.col("median_7"))), 4)
    state = F.when(drop >= blocked, "COLLECTION_BLOCKED").when(drop >= degraded, "COLLECTION_DEGRADED").when(drop >= warn, "COLLECTION_WARN").otherwise("COLLECTION_OK")
    return values.withColumn("drop_percent", drop).withColumn("state", state)


def coverage(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Share of rows with a value in each column; no rows give no row, never a zero."""
    shares = [F.round(F.try_divide(F.count(c), F.count(F.lit(1))), 6).alias(f"{c}_coverage") for c in columns]
    return (rows.groupBy(*keys) if keys else rows.groupBy()).agg(*shares)


def long_form(wide: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(keys, metric, value) of wide metric columns."""
    return wide.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(keys, names, "metric", "value")


#: fixed values: (metric, kind, limit, level, code); kinds as in rule_findings
COLLECTION_RULES = (
    ("listing_unique", "DROP_PERCENT", 15.0, "BLOCK", "LISTING_UNIQUE_DROP"), ("listing_unique", "DROP_PERCENT", 8.0, "WARN", "LISTING_UNIQUE_DROP"),
    ("current_valid", "DROP_PERCENT", 15.0, "BLOCK", "CURRENT_VALID_DROP"), ("current_valid", "DROP_PERCENT", 8.0, "WARN", "CURRENT_VALID_DROP"),
    ("cat2_coverage", "DROP_POINTS", 10.0, "REVIEW", "CAT2_COVERAGE_DROP"), ("cat2_coverage", "DROP_POINTS", 5.0, "WARN", "CAT2_COVERAGE_DROP"),
    ("description_coverage", "DROP_POINTS", 25.0, "REVIEW", "DESCRIPTION_COVERAGE_DROP"), ("description_coverage", "DROP_POINTS", 10.0, "WARN", "DESCRIPTION_COVERAGE_DROP"),
    ("price_coverage", "BELOW", 0.98, "REVIEW", "PRICE_COVERAGE"), ("price_coverage", "BELOW", 0.995, "WARN", "PRICE_COVERAGE"),
)
DRIFT_RULES = (
    *((f"{f}_coverage", "DROP_POINTS", 10.0, "HIGH", "CATEGORY_COLLECTION_DRIFT" if f == "cat2" else "FIELD_COVERAGE_COLLAPSE") for f in ("price", "cat1", "cat2", "spec", "description", "details")),
    ("original_price_equals_current_ratio", "AT_LEAST", 0.9, "HIGH", "PRICE_SCHEMA_DRIFT"), ("ui_contamination_rate", "ABOVE", 0.0, "HIGH", "UI_CONTAMINATION_DRIFT"), ("html_contamination_rate", "ABOVE", 0.0, "HIGH", "HTML_CONTAMINATION_DRIFT"),
)


def run_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, value): counts and shares of a run's rows in one aggregate; a share without rows to share has no value.

    rows: sku, price, original_price, cat1, cat2, spec, description, details.
    current_valid counts SKUs with a price above 0; coverages and rates are
    shares of rows; the ratio of equal prices is one of rows that have both.
    """
    every, filled = F.count(F.lit(1)), lambda c: F.count_if(~is_blank(F.col(c).cast("string")))
    share = lambda part, whole=every: F.try_divide(part, whole).cast("double")
    prose = F.concat_ws("\n", "spec", "description", "details")
    both = F.col("price").isNotNull() & F.col("original_price").isNotNull()
    columns = {
        "listing_unique": F.count_distinct("sku").cast("double"), "current_valid": F.count_distinct(F.when(F.col("price") > 0, F.col("sku"))).cast("double"), "duplicate_rate": share(every - F.count_distinct("sku")),
        "price_coverage": share(F.count_if(F.col("price") > 0)), **{f"{c}_coverage": share(filled(c)) for c in ("cat1", "cat2", "spec", "description", "details")},
        "original_price_equals_current_ratio": share(F.count_if(both & (F.col("price") == F.col("original_price"))), F.count_if(both)),
        "ui_contamination_rate": share(F.count_if(is_interface_text(F.col("description")) | is_interface_text(F.col("spec")))), "html_contamination_rate": share(F.count_if(has_markup(prose))), "successful_category_count": F.count_distinct(F.when(~is_blank(F.col("cat1")), F.col("cat1"))).cast("double"),
    }
    wide = rows.groupBy(*keys).agg(*[v.alias(k) for k, v in columns.items()])
    return wide.unpivot(keys, list(columns), "metric", "value")


def rule_findings(values: DataFrame, keys: list[str], rules: tuple[tuple, ...], base: str = "median_7") -> DataFrame:
    """(keys, metric, code, level, value, base, measure) of the first rule of each code that a value breaks.

    values: keys, metric, value and the base. Kinds: DROP_PERCENT against the
    base, DROP_POINTS in points of a share (shares are up to 1 in size), BELOW,
    ABOVE and AT_LEAST the limit itself. A missing value or base breaks nothing;
    differences are compared as doubles, not rounded.
    """
    table = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.lit(m).alias("_metric"), F.lit(kind).alias("kind"), F.lit(float(limit)).alias("limit"), F.lit(level).alias("level"), F.lit(code).alias("code")) for k, (m, kind, limit, level, code) in enumerate(rules)]))
    asked = values.withColumn("_r", table).where("metric = _r._metric")
    value, old, kind = F.col("value"), F.col(base), F.col("_r.kind")
    points = F.when((F.abs(value) <= 1) & (F.abs(old) <= 1), 100 * (old - value)).otherwise(old - value)
    measure = F.when(kind == "DROP_PERCENT", F.try_divide(100 * (old - value), F.when(old > 0, old))).when(kind == "DROP_POINTS", points).otherwise(value)
    broken = F.when(kind == "BELOW", measure < F.col("_r.limit")).when(kind == "ABOVE", measure > F.col("_r.limit")).otherwise(measure >= F.col("_r.limit"))
    hits = asked.withColumn("_measure", F.round(measure, 6)).where(F.coalesce(broken, F.lit(False)))
    first = hits.groupBy(*keys, "metric", F.col("_r.code").alias("code")).agg(F.min(F.struct(F.col("_r.order").alias("order"), F.col("_r.level").alias("level"), value.alias("value"), old.alias("base"), F.col("_measure").alias("measure"))).alias("f"))
    return first.select(*keys, "metric", "code", "f.level", "f.value", "f.base", "f.measure")


def gate_states(findings: DataFrame, keys: list[str], every: DataFrame) -> DataFrame:
    """(keys, state): BLOCKED with a blocking finding, WARN with any other, else OK; `every` names all runs."""
    worst = findings.groupBy(*keys).agg(F.bool_or(F.col("level") == "BLOCK").alias("_block"))
    return every.select(*keys).distinct().join(worst, keys, "left").select(*keys, F.when(F.col("_block"), "COLLECTION_BLOCKED").when(F.col("_block").isNotNull(), "COLLECTION_WARN").otherwise("COLLECTION_OK").alias("state"))

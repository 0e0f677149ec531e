"""Presence of products over days from several sources, each only as far as it is capable of.

A source says over which days it looked, whether it could see that a product
was missing, and whether its look was complete. Each day belongs to one source:
a confirmed seed before dated sources, these before committed runs. What the
day's source says of a product counts; what it leaves out is an absence only
if it was capable and complete, else it is unknown. Nothing else makes a zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRESENT, ABSENT, UNKNOWN = "1", "0", "UNKNOWN"
SEED, DATED, COMMITTED = 0, 1, 2
#: Days that one history may have; they are broadcast.
MOST_DAYS = 40_000


class HistoryFaults(ValueError):
    """The sources contradict each other or are not whole."""


def in_months(day: Column, months: list[str]) -> Column:
    return F.date_format(day, "yyyy-MM").isin(*months) if months else F.lit(False)


def usable_runs(runs: DataFrame, after: DataFrame, last_day: str) -> DataFrame:
    """Committed, passed runs that are not dry, after the seed's last day and up to the last one."""
    cutoff = after.agg(F.coalesce(F.max("day"), F.lit("0001-01-01").cast("date")).alias("_cutoff"))
    ready = (F.col("status") == "COMMITTED") & (F.col("qa") == "PASS") & ~F.col("dry") & (F.col("observation_count") > 0)
    return runs.where(ready & (F.col("day") <= F.lit(last_day).cast("date"))).join(F.broadcast(cutoff)).where("day > _cutoff").drop("_cutoff")


def history_days(seed: DataFrame, seed_source: DataFrame, sources: DataFrame, runs: DataFrame, months: list[str], last_day: str) -> DataFrame:
    """(day, kind, source, absence): the one source of each day, and whether what it leaves out is absent.

    seed_source: absence_capable, complete, one row. sources: source, position,
    first_day, last_day, absence_capable, complete; of several for a day the
    first by position. runs: run_id, day, status, qa, dry, observation_count.
    """
    capable = F.col("absence_capable") & F.col("complete")
    named = seed.select("day").distinct().join(F.broadcast(seed_source)).select("day", F.lit(SEED).alias("kind"), F.lit(0).cast("long").alias("position"), F.lit("seed").alias("source"), capable.alias("absence"))
    looked = sources.select(F.explode(F.sequence("first_day", "last_day")).alias("day"), F.lit(DATED).alias("kind"), F.col("position").cast("long"), F.col("source").cast("string"), capable.alias("absence"))
    ran = usable_runs(runs, seed.where(~in_months(F.col("day"), months)), last_day).select("day", F.lit(COMMITTED).alias("kind"), F.lit(0).cast("long").alias("position"), F.col("run_id").cast("string").alias("source"), F.lit(True).alias("absence"))
    every = named.unionByName(looked).unionByName(ran).where(~in_months(F.col("day"), months))
    return every.groupBy("day").agg(F.min(F.struct("kind", "position", "source", "absence")).alias("own")).select("day", "own.kind", "own.source", "own.absence")


def said(seed: DataFrame, sources: DataFrame, cells: DataFrame, observations: DataFrame, days: DataFrame) -> DataFrame:
    """(sku, day, kind, source, value): what each day's own source says; cells count within their source's days, without a value they are a presence."""
    known = F.when(F.col("value").isin(PRESENT, ABSENT), F.col("value")).otherwise(UNKNOWN)
    by_seed = seed.select("sku", "day", F.lit(SEED).alias("kind"), F.lit("seed").alias("source"), known.alias("value"))
    spans = sources.select(F.col("source").alias("_source"), "first_day", "last_day")
    by_source = cells.join(spans, (F.col("source") == F.col("_source")) & F.col("day").between(F.col("first_day"), F.col("last_day")))
    by_source = by_source.select("sku", "day", F.lit(DATED).alias("kind"), F.col("source").cast("string"), F.when(F.col("value").isNull(), PRESENT).otherwise(known).alias("value"))
    by_run = observations.select("sku", "day", F.lit(COMMITTED).alias("kind"), F.col("run_id").cast("string").alias("source"), F.when(F.col("presence_state") == "PRESENT", PRESENT).otherwise(ABSENT).alias("value"))
    return by_seed.unionByName(by_source).unionByName(by_run).join(days.select("day", "kind", "source"), ["day", "kind", "source"], "left_semi")


def history_faults(values: DataFrame, runs: DataFrame, observations: DataFrame, days: DataFrame, usable: DataFrame) -> DataFrame:
    """(code, day, sku, source): values that contradict each other, days of several committed runs, runs with other observations than they state."""
    torn = values.where(F.col("kind") != COMMITTED).groupBy("day", "sku", "source").agg(F.countDistinct("value").alias("n")).where("n > 1").select(F.lit("HISTORY_SOURCE_PRESENCE_CONFLICT").alias("code"), "day", "sku", "source")
    doubled = usable.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("run_id").cast("string")).alias("source")).where("n > 1").select(F.lit("HISTORY_MULTIPLE_COMMITTED_RUNS").alias("code"), "day", F.lit(None).cast("string").alias("sku"), "source")
    whole = F.coalesce(F.col("observation_complete") & F.col("absence_capable") & F.col("presence_state").isin("PRESENT", "ABSENT"), F.lit(False))
    counted = observations.groupBy(F.col("run_id").cast("string").alias("_run")).agg(F.count(F.lit(1)).alias("_n"), F.bool_and(whole).alias("_whole"))
    own = usable.join(days.where(F.col("kind") == COMMITTED).select(F.col("source").alias("_source")), F.col("run_id").cast("string") == F.col("_source"), "left_semi")
    short = own.join(counted, F.col("run_id").cast("string") == F.col("_run"), "left").where((F.coalesce("_n", F.lit(0)) != F.col("observation_count")) | ~F.coalesce("_whole", F.lit(False)))
    short = short.select(F.lit("HISTORY_RUN_OBSERVATIONS_INCOMPLETE").alias("code"), "day", F.lit(None).cast("string").alias("sku"), F.col("run_id").cast("string").alias("source"))
    return torn.unionByName(doubled).unionByName(short)


def presence_history(seed: DataFrame, seed_source: DataFrame, sources: DataFrame, cells: DataFrame, runs: DataFrame, observations: DataFrame, months: list[str] | None = None, last_day: str = "9999-12-31") -> tuple[DataFrame, DataFrame]:
    """((sku, day, value, kind), faults): a value for every product on every day of the history.

    Products are those of the seed and those present on some day; a seed product
    whose only presence lies in excluded months is none. A day of the seed says
    nothing of products that the seed lacks.
    """
    months = months or []
    days = history_days(seed, seed_source, sources, runs, months, last_day)
    values = said(seed, sources, cells, observations, days)
    excluded = in_months(F.col("day"), months)
    per_seed = seed.groupBy("sku").agg(F.count_if(~excluded).alias("_kept"), F.count_if(excluded & (F.col("value") == PRESENT)).alias("_out"), F.count_if(~excluded & (F.col("value") == PRESENT)).alias("_in"))
    seeded = per_seed.where("_kept > 0 AND NOT (_out > 0 AND _in = 0)").select("sku", F.lit(True).alias("_seeded"))
    one = values.join(seeded, "sku", "left").where((F.col("kind") != SEED) | F.col("_seeded")).groupBy("sku", "day").agg(F.max("value").alias("value"), F.max("_seeded").alias("_seeded"))
    met = one.groupBy("sku").agg(F.max("_seeded").alias("_seeded"), F.bool_or(F.col("value") == PRESENT).alias("_met"))
    skus = seeded.select("sku").union(met.where("_met").select("sku")).distinct().join(seeded, "sku", "left")
    n_days = days.count()
    if n_days > MOST_DAYS:
        raise ValueError(f"a history of {n_days} days; at most {MOST_DAYS} are broadcast")
    calendar = days.agg(F.collect_list(F.struct("day", "kind", "absence")).alias("_days"))
    grid = skus.join(F.broadcast(calendar)).select("sku", "_seeded", F.explode("_days").alias("d")).select("sku", "_seeded", "d.*")
    filled = grid.join(one.select("sku", "day", "value"), ["sku", "day"], "left")
    missing = F.when((F.col("kind") == SEED) & F.col("_seeded").isNull(), UNKNOWN).when(F.col("absence"), ABSENT).otherwise(UNKNOWN)
    rows = filled.select("sku", "day", F.coalesce("value", missing).alias("value"), "kind")
    usable = usable_runs(runs, seed.where(~excluded), last_day).where(~excluded)
    return rows, history_faults(values, runs, observations, days, usable)


def checked(history: tuple[DataFrame, DataFrame], shown: int = 20) -> DataFrame:
    """The rows, if no source is at fault."""
    rows, faults = history
    first = faults.orderBy("code", "day", "sku").limit(shown).collect()
    if first:
        raise HistoryFaults("; ".join(f"{f['code']}: {f['day']}/{f['sku'] or f['source']}" for f in first))
    return rows


def presence_spans(rows: DataFrame) -> DataFrame:
    """(sku, first_seen, last_seen, days_present, days_unknown) of each product."""
    day = F.when(F.col("value") == PRESENT, F.col("day"))
    return rows.groupBy("sku").agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.count(day).alias("days_present"), F.count_if(F.col("value") == UNKNOWN).alias("days_unknown"))


def absences(rows: DataFrame) -> DataFrame:
    """(sku, first_day, last_day, days): runs of neighbouring days on which a product is known to be absent; an unknown day ends a run."""
    by_day = Window.partitionBy("sku").orderBy("day")
    numbered = rows.withColumn("_n", F.row_number().over(by_day)).where(F.col("value") == ABSENT).withColumn("_k", F.col("_n") - F.row_number().over(by_day))
    return numbered.groupBy("sku", "_k").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days")).drop("_k")

"""Dictionaries that are built again from records: which names are one entity, what a person has decided, what a changed source resets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.evidence import text_of, to_bool
from shelfwise.sources.storage import written

AUTOMATIC = "AUTOMATIC_REFERENCE"


def identity_key(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " ")))


def identity_keys(identifier: Column, name: Column, aliases: Column) -> Column:
    """Distinct non-blank keys of an identifier, a name and aliases between bars."""
    parts = F.concat(F.array(identifier, name), F.split(F.coalesce(aliases, F.lit("")), r"\|"))
    return F.array_distinct(F.filter(F.transform(parts, identity_key), lambda k: k != ""))


def connected(members: DataFrame, node: str, key: str) -> DataFrame:
    """(node, root): the smallest node that a node reaches through shared keys.

    Each key gives a star around its smallest node, never all pairs. Stars are
    joined by alternating large and small stars until no edge changes, which
    takes a number of rounds that grows with the logarithm of the longest chain;
    each round is a written table, and only its count and digest reach the driver.
    """
    named = members.select(F.col(node).alias("u"), F.col(key).alias("k")).where("u IS NOT NULL AND k IS NOT NULL").distinct()
    least = named.groupBy("k").agg(F.min("u").alias("v"))
    edges = written(named.join(least, "k").where("u <> v").select("u", "v").distinct(), "edges")

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        under = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(under, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(under.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small, "edges")
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    nodes = members.select(F.col(node).alias("u")).where("u IS NOT NULL").distinct()
    return nodes.join(roots, "u", "left").select(F.col("u").alias(node), F.coalesce("root", "u").alias("root"))


def reconciled_brands(existing: DataFrame, products: DataFrame) -> DataFrame:
    """(brand_id, canonical_name, aliases, confidence, review_status): known brands, and those that products name but no identity has.

    existing: brand_id, canonical_name, aliases, confidence, review_status. Rows
    of one identity, through identifier, name or aliases, however many steps
    apart, are a class: all rows that a person made stay, and automatic ones only
    where the class has none of these, the first by identifier. Blank
    identifiers go. A missing brand enters by its most frequent spelling, the
    first of equals, and waits for review.
    """
    known = existing.where(F.trim(F.coalesce("brand_id", F.lit(""))) != "").dropDuplicates(["brand_id"])
    keyed = known.select("brand_id", F.explode(identity_keys(F.col("brand_id"), F.col("canonical_name"), F.col("aliases"))).alias("key"))
    classes = connected(keyed, "brand_id", "key")
    automatic = F.coalesce(F.col("confidence") == AUTOMATIC, F.lit(False))
    first = Window.partitionBy("root").orderBy(automatic, "brand_id")
    kept = known.join(classes, "brand_id").withColumn("_n", F.row_number().over(first)).where(~automatic | (F.col("_n") == 1))
    columns = ["brand_id", "canonical_name", "aliases", "confidence", "review_status"]
    named = products.select(F.trim("brand_id").alias("brand_id"), identity_key(F.col("brand_id")).alias("key")).where("key <> ''")
    counted = named.groupBy("key", "brand_id").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.min_by("brand_id", F.struct(-F.col("n"), F.col("brand_id"))).alias("brand_id"))
    missing = counted.join(keyed.select("key").distinct(), "key", "left_anti")
    new = missing.select("brand_id", F.col("brand_id").alias("canonical_name"), F.col("brand_id").alias("aliases"), F.lit(AUTOMATIC).alias("confidence"), F.lit("NEEDS_HUMAN_REVIEW").alias("review_status"))
    return kept.select(columns).unionByName(new)


def product_dictionary(records: DataFrame, existing: DataFrame, overrides: DataFrame, raw: list[str], shown: list[str], stamp: str) -> DataFrame:
    """sku, raw and shown fields, source_hash, translation_status, review_status, locked, updated_at: one row for each known or recorded SKU.

    records and existing have sku and the fields, existing the other columns too;
    overrides: sku, field, value, the last by field wins nothing, as there is one
    of each. Raw fields follow the record where it has a value. Shown fields do
    so as well, unless a person has set that field, or, where no field has been
    set, the row is locked or reviewed as a whole. A changed hash of the raw
    fields sends an unprotected row back to review. The stamp changes only if
    something else does.
    """
    set_fields = overrides.groupBy(F.col("sku").alias("_o_sku")).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_set"))
    new = records.select(F.col("sku").alias("_n_sku"), *[F.col(f).alias(f"_n_{f}") for f in raw + shown])
    status = ["source_hash", "translation_status", "review_status", "locked", "updated_at"]
    old = existing.select(F.col("sku").alias("_e_sku"), *[text_of(F.col(f)).alias(f"_e_{f}") for f in raw + shown + status])
    joined = new.join(old, F.col("_n_sku") == F.col("_e_sku"), "full").withColumn("sku", F.coalesce("_n_sku", "_e_sku"))
    joined = joined.join(set_fields, F.col("sku") == F.col("_o_sku"), "left")
    none = F.create_map().cast("map<string,string>")
    joined = joined.withColumn("_set", F.coalesce("_set", none)).withColumn("_any", F.size("_set") > 0)
    old_locked = to_bool(F.col("_e_locked"))
    joined = joined.withColumn("_protected", ~F.col("_any") & F.coalesce(old_locked | (F.col("_e_review_status") == "HUMAN_REVIEWED"), F.lit(False)))
    own = lambda f: text_of(F.col(f"_n_{f}"))
    was = lambda f: F.coalesce(F.col(f"_e_{f}"), F.lit(""))
    fixed = lambda f: F.map_contains_key("_set", F.lit(f))
    joined = joined.withColumns({f"_v_{f}": F.when(own(f) != "", own(f)).otherwise(was(f)) for f in raw})
    joined = joined.withColumns({f"_v_{f}": F.when(~F.col("_protected") & ~fixed(f) & (own(f) != ""), own(f)).otherwise(was(f)) for f in shown})
    joined = joined.withColumn("_hash", F.sha2(F.concat_ws("\x1f", *[F.col(f"_v_{f}") for f in raw]), 256))
    free, known = ~F.col("_protected"), F.col("_e_sku").isNotNull()
    changed = free & (was("source_hash") != "") & (was("source_hash") != F.col("_hash"))
    untold = (was("translation_status") == "") | (known & (was("source_hash") == "") & free)
    first = F.when(F.col(f"_v_{shown[0]}") != "", "LEGACY_UNVERIFIED").otherwise("UNTRANSLATED")
    joined = joined.withColumn("_t", F.when(changed, "NEEDS_REVIEW").when(untold, first).otherwise(was("translation_status")))
    joined = joined.withColumn("_r", F.when(changed, "NEEDS_REVIEW").when(was("review_status") != "", was("review_status")).otherwise("UNREVIEWED"))
    locked = F.coalesce(old_locked, F.lit(False))
    joined = joined.withColumns({"_t": F.when(locked, "LOCKED").otherwise(F.col("_t")), "_r": F.when(locked, "HUMAN_REVIEWED").otherwise(F.col("_r"))})
    chosen = lambda f, value: F.coalesce(F.when(fixed(f), text_of(F.try_element_at("_set", F.lit(f)))), value)
    now_locked = F.when(fixed("locked"), to_bool(F.try_element_at("_set", F.lit("locked")))).otherwise(locked)
    translated = F.when(F.col("_any") & now_locked, "LOCKED").when(F.col("_any"), chosen("translation_status", F.lit("HUMAN_REVIEWED"))).otherwise(F.col("_t"))
    out = {f: chosen(f, F.col(f"_v_{f}")) for f in raw + shown} | {"source_hash": F.col("_hash"), "translation_status": translated, "review_status": F.when(F.col("_any"), "HUMAN_REVIEWED").otherwise(F.col("_r")), "locked": F.when(now_locked, "1").otherwise("0")}
    same = known
    for f, value in out.items():
        same = same & (value == was(f))
    return joined.select("sku", *[value.alias(f) for f, value in out.items()], F.when(same, was("updated_at")).otherwise(stamp).alias("updated_at"))

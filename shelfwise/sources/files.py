"""File sources and sinks: CSV state, keyed dictionaries, sitemaps, wide presence matrices, snapshots, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header that must match the schema; malformed rows fail."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_dictionary(spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str]) -> DataFrame:
    """A keyed CSV; a repeated key is an error."""
    rows = read_csv(spark, path, schema)
    bad = rows.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if bad:
        raise ValueError(f"repeated key in {path}: {bad[0][:-1]}")
    return rows


def write_dictionary(rows: DataFrame, path: str, keys: list[str]) -> None:
    """One file, sorted by key: dictionaries are small by nature."""
    rows.orderBy(*keys).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def sitemap_skus(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """(url, sku) of a sitemap's loc elements; one row for each SKU, the first by position."""
    located = pages.select(F.posexplode(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("at", "url"))
    found = located.withColumn("sku", F.regexp_extract("url", r"/p/(\d+)/", 1)).where("sku <> ''")
    return found.groupBy("sku").agg(F.min_by("url", "at").alias("url"))


def seed_matrix(wide: DataFrame, ids: list[str]) -> DataFrame:
    """Columns named yy.mm.dd to rows (ids, day, presence): 0, 1, or null for blanks and anything else."""
    days = [c for c in wide.columns if c not in ids]
    quoted = wide.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c.replace(".", "-")) for c in days])
    long = quoted.unpivot(ids, [c.replace(".", "-") for c in days], "label", "cell")
    value = F.trim("cell")
    return long.select(*ids, F.to_date("label", "yy-MM-dd").alias("day"), F.when(value == "1", 1).when(value == "0", 0).alias("presence"))


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Immutable evidence of one run, partitioned by date and run."""
    rows.write.mode("append").partitionBy("run_date", "run_id").parquet(path)


def read_snapshot(spark: SparkSession, path: str, run_date: str, run_id: str) -> DataFrame:
    """One run's rows: the partition columns prune the files."""
    return spark.read.parquet(path).where((F.col("run_date") == run_date) & (F.col("run_id") == run_id))


def merge_sheets(first: DataFrame, second: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Full union by key; values of the first sheet win where present."""
    a, b = first.select(key, *[F.col(c).alias(f"_a_{c}") for c in columns]), second.select(key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    return a.join(b, key, "full_outer").select(key, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns])


def first_cards(cards: DataFrame, order: list[Column]) -> DataFrame:
    """The first card of each SKU in page order."""
    return cards.withColumn("_n", F.row_number().over(Window.partitionBy("sku").orderBy(*order))).where("_n = 1").drop("_n")


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)

"""Executors without this repository on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[2]).config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider").getOrCreate()
from pyspark.sql import functions as F
from shelfwise.operators import details, phrases, price_review
from shelfwise.sources import pages
from shelfwise.streaming import queue
texts = spark.createDataFrame([(1, "Material: led lamp; Peso: 2 kg"), (2, "{'a': 1}")], "k long, text string")
done = [
    phrases.spans(texts, spark.createDataFrame([("led lamp",)], "phrase string"), ["k"]).count(),
    details.structured_details(texts, ["k"], "text").count(),
    pages.page_facts(texts.withColumn("html", F.lit("<h1>a</h1><a href='/x'>b</a>")), ["k"]).count(),
    price_review.flag_rows(spark.createDataFrame([("r", '{"price_observation_invalid":{"1":true,"1":false}}')], "run_id string, evidence string")).count(),
]
actions = texts.select(F.col("k").cast("string").alias("unit"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("at"), F.lit(1).alias("seq"), F.lit("INGEST").alias("action"), F.lit(None).cast("string").alias("reason"))
actions.write.parquet(sys.argv[2] + "/in")
stream = queue.transitions(spark.readStream.schema(actions.schema).parquet(sys.argv[2] + "/in"))
stream.writeStream.format("parquet").option("path", sys.argv[2] + "/out").option("checkpointLocation", sys.argv[2] + "/state").trigger(availableNow=True).start().awaitTermination()
done.append(queue.latest_states(spark.read.parquet(sys.argv[2] + "/out")).count())
print("DONE", done)
"""


def test_core_functions_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, REPO, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "DONE [1, 3, 4, 2, 2]" in run.stdout, run.stdout[-500:] + run.stderr[-3000:]

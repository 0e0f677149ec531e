"""Executors without this repository on their path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[2]).getOrCreate()
from pyspark.sql import functions as F
from shelfwise.llm import attention_lm, ball_clusters, decontamination, ngram_join, pieces, quality_classifier, token_counts, toxicity, turn_repair
from shelfwise.llm.queries import tokenizer_file
rows = [(k, f"plain words about topic {k % 7} and number {k} " + ("nasty slur " if k % 3 == 0 else "kind line ") * 4) for k in range(60)]
docs = spark.createDataFrame(rows, "doc_id long, text string")
labels = spark.createDataFrame([(k, int(k % 3 == 0), int(k % 3 != 0)) for k in range(60)], "doc_id long, toxic int, quality int")
model = tokenizer_file("piece_bpe_32k.model")
done = [
    pieces.encode(docs, model, ["doc_id"]).count(),
    toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"]).count(),
    quality_classifier.score(docs, quality_classifier.fit(docs, labels.where("quality = 1"), docs.select("doc_id")), ["doc_id"]).count(),
    decontamination.decontaminate(docs, docs.limit(2).withColumnRenamed("doc_id", "item_id"), ["doc_id"]).count(),
    ngram_join.near_duplicates(docs).count(),
    attention_lm.score(docs.withColumn("train", F.lit(True)), "train", model, ["doc_id"]).where("score < 0").count(),
    ball_clusters.ball_kmeans(docs.select(F.col("doc_id").alias("vec_id"), F.array(F.col("doc_id") / 7, F.lit(0.5)).alias("embedding")), length=2).members().count(),
    token_counts.count_tokens(docs, model, ["doc_id"]).where("n_tokens > 0").count(),
    turn_repair.report(docs.select(F.col("doc_id").alias("conv_id")), turn_repair.Repair(docs.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text"))).count(),
]
print("DONE", done)
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, REPO, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "DONE [60, 60, 60, 60, 60, 60, 60, 60, 60]" in run.stdout, run.stderr[-3000:]

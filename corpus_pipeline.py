"""The training-data pipeline: documents pass the stages one after another.

Every stage but the last returns the columns of documents. Edge cases are those
of the operators: a null text counts as empty, a null identifier is kept where a
stage decides by identifier, and an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontamination, ngram_join, pieces, quality_rules, repeated_spans
from shelfwise.llm.queries import table, tokenizer_file
from shelfwise.llm.shared import discard, stored, sweep

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A line goes if more of its host's documents than this hold it, however large the host is.
LINE_MOST = quality_rules.LINE_LEAST
#: Near duplicates share 80 per cent of their five-word shingles.
WORDS, PERCENT = 5, 80
#: Bytes of text that the encoding takes at once, beside what the stages before it left in the executors' memory.
TEXT_AT_ONCE = 2 << 20


def as_documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines above their host's limit go from the others."""
    judged = quality_rules.line_frequency(docs.select(*COLUMNS), with_text=True, most=LINE_MOST).where("kept")
    return as_documents(judged.drop("text").withColumnRenamed("clean_text", "text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest identifier stays."""
    groups = ngram_join.near_duplicates(docs, size=WORDS, percent=PERCENT)
    gone = stored(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near-duplicates")
    small = gone.count() <= ngram_join.BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, F.col("doc_id") == F.col("_gone"), "left_anti").select(*COLUMNS)


def repeated_span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings and passages of words that repeat anywhere go from the texts, at whole characters."""
    return as_documents(repeated_spans.remove_repeats(docs.select(*COLUMNS), with_text=True, words=repeated_spans.WORDS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more stand in benchmark windows go."""
    judged = decontamination.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return judged.where("NOT contaminated").select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids under merge-dropout, and whether they decode to the text."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), ["doc_id", "lang", "source"], text_at_once=TEXT_AT_ONCE)


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_span_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding", encoding_stage),
]
#: The merges of the encoding stage are no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
            if k:
                discard(before)
            else:
                sweep(spark)
    return docs

"""Quality rules from line frequencies across documents, in DataFrame functions only.

Lines are normalised and hashed; for each host the distinct documents that hold
a line are counted; lines above the host's limit are removed, and documents that
lose too much of their words are rejected, as are those that fail the base rules.

Edge cases: a null text is an empty one (0 words, so the base rules reject it);
a null host is a host of its own; repeated rows count as documents of their own;
an empty table gives an empty result; extra columns are kept, and where a name
clashes with one that the operator adds, the operator's column wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let

SPACES = " \t\n\u000b\u000c\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
#: A line is above the limit if over this share of its host's documents hold it, and over so many.
LINE_SHARE = 0.1
LINE_LEAST = 25
#: A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.35
#: The table of lines above limits is broadcast up to so many rows, and joined by shuffle on host and line beyond.
BROADCAST_ROWS = 200_000
#: Up to so many lines of a host travel as one array, which every line of its documents is searched in.
ARRAY_LINES = 64


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT), lambda w: w != "")


def normal_line(line: Column) -> Column:
    """Lower case, white space as single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), SPLIT, " "))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that stand at least twice in the text, the first included."""

    def covered(places: Column) -> Column:
        step = lambda p, k: F.when(k + 1 < F.size(places), F.least(F.lit(8), F.get(places, k + 1) - p)).otherwise(F.lit(8))
        return F.aggregate(F.transform(places, step), F.lit(0).cast("long"), lambda total, x: total + x)

    def twice(windows: Column) -> Column:
        pairs = F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k")))
        same = lambda ordered, x, k: (F.get(ordered, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(ordered, k + 1)["h"].eqNullSafe(x["h"]))
        places = let(F.array_sort(pairs), lambda ordered: F.array_sort(F.transform(F.filter(ordered, lambda x, k: same(ordered, x, k)), lambda x: x["k"])))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(places, covered))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 8), lambda k: F.xxhash64(*[F.get(h, k + j) for j in range(8)])))
    return F.when(F.size(words) < 8, F.lit(0).cast("long")).otherwise(let(windows, twice))


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: has_word(x))
    counted = docs.withColumns({
        "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "_rules": let(word_list(whole), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("c"), repeat_words(w).alias("r"))),
    })
    return counted.withColumns({"n_words": F.col("_rules.n"), "word_chars": F.col("_rules.c"), "n_repeat_words": F.col("_rules.r")}).drop("_rules").withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    )


def line_hashes(text: str) -> Column:
    """The distinct hashes of a text's normalised lines."""
    return F.array_distinct(F.transform(F.filter(F.split(F.col(text), "\n"), lambda x: has_word(x)), lambda x: F.xxhash64(normal_line(x))))


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", share: float = LINE_SHARE, least: int = LINE_LEAST, most: int | None = None) -> DataFrame:
    """(host, line): the hashes of the lines that stand in too many of a host's documents.

    The limit is `share` of the host's documents, `least` at the lowest and
    `most` at the highest; without `most` it rises with the host.
    """
    seen = docs.select(F.col(host).alias("_host"), F.explode(line_hashes(text)).alias("_line")).groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_docs"))
    sizes = docs.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_all"))
    often = seen.where(F.col("_docs") > (least if most is None else min(least, most)))
    limit = F.greatest(F.lit(least), share * F.col("_all"))
    limit = limit if most is None else F.least(limit, F.lit(most))
    above = often.alias("a").join(sizes.alias("b"), F.col("a._host").eqNullSafe(F.col("b._host"))).where(F.col("_docs") > limit)
    return above.select(F.col("a._host").alias("_bad_host"), "_line")


def with_bad_lines(docs: DataFrame, bad: DataFrame, text: str, host: str) -> DataFrame:
    """docs with _bad, the hashes of lines to remove: those of the host if they are few, those of the document itself otherwise."""
    sizes = bad.groupBy("_bad_host").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    fits = sizes[0] + (sizes[1] or 0) <= BROADCAST_ROWS
    if fits and (sizes[2] or 0) <= ARRAY_LINES:
        arrays = bad.groupBy("_bad_host").agg(F.collect_list("_line").alias("_bad"))
        return docs.join(F.broadcast(arrays), F.col(host).eqNullSafe(F.col("_bad_host")), "left").drop("_bad_host")
    # what a document loses follows from its host and text, so equal rows share one key
    key = F.struct(F.col(host).alias("h"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("t"))
    lines = docs.select(key.alias("_of"), F.explode(line_hashes(text)).alias("_own"))
    met = lines.join(F.broadcast(bad) if fits else bad, F.col("_of.h").eqNullSafe(F.col("_bad_host")) & (F.col("_own") == F.col("_line")))
    found = met.groupBy("_of").agg(F.collect_set("_line").alias("_bad")).select(F.col("_of.h").alias("_bad_host"), F.col("_of.t").alias("_bad_text"), "_bad")
    return docs.withColumn("_text", key["t"]).join(found, F.col(host).eqNullSafe(F.col("_bad_host")) & (F.col("_text") == F.col("_bad_text")), "left").drop("_text", "_bad_host", "_bad_text")


def line_frequency(docs: DataFrame, text: str = "text", host: str = "source", share: float = LINE_SHARE, least: int = LINE_LEAST, least_left: float = LEAST_LEFT, with_text: bool = False, most: int | None = None) -> DataFrame:
    """All columns of docs, the base rules, and n_removed_lines, n_left (words), kept; with_text: also clean_text."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_lines", "n_left", "kept", "clean_text", "_host", "_bad", "_bad_host", "_text", "_bad_text"]
    docs = docs.drop(*[c for c in added if c not in (text, host)])
    # checkpoint: computed once and of known size
    joined = with_bad_lines(docs, frequent_lines(docs, text, host, share, least, most).checkpoint(), text, host)
    whole = F.coalesce(F.col(text), F.lit(""))
    is_bad = lambda x: F.array_contains(F.col("_bad"), F.xxhash64(normal_line(x))) & (has_word(x))
    removed = F.when(F.col("_bad").isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.split(whole, "\n"), is_bad))
    lost = let(removed, lambda x: F.struct(F.size(x).cast("long").alias("lines"), F.when(F.size(x) == 0, F.lit(0).cast("long")).otherwise(F.size(word_list(F.array_join(x, " "))).cast("long")).alias("words")))
    out = base_rules(joined.withColumn("_lost", lost), text)
    out = out.withColumns({"n_removed_lines": F.col("_lost.lines"), "n_left": F.col("n_words") - F.col("_lost.words")})
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= least_left * F.col("n_words")))
    if with_text:
        left = F.array_join(F.filter(F.split(whole, "\n"), lambda x: ~is_bad(x)), "\n")
        out = out.withColumn("clean_text", F.when(F.col("n_removed_lines") == 0, F.col(text)).otherwise(left))
    return out.drop("_lost", "_bad")

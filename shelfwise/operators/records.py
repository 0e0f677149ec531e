"""Records over time and across sources: rule findings, lineage, overlays, provenance, overrides, queues, patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.evidence import has_cjk, text_of
from shelfwise.functions.identity import value_hash
from shelfwise.functions.texts import is_blank
from shelfwise.operators.phrases import spans
from shelfwise.sources.storage import written


def overlay(base: DataFrame, retry: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A later read over a snapshot: its values where it has any."""
    later = retry.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    return base.join(later, F.col(key) == F.col("_key"), "left").select(key, *[F.coalesce(f"_{f}", f).alias(f) for f in fields])


def filled_blanks(rows: DataFrame, snapshot: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Blank fields from a verified snapshot; others stay."""
    old = snapshot.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    return rows.join(old, F.col(key) == F.col("_key"), "left").select(key, *[F.when(is_blank(F.col(f)), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields])


def unpolluted(rows: DataFrame, history: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Source fields that hold target script are replaced by a history without it; nothing else is touched."""
    old = history.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    swap = lambda f: F.when(has_cjk(F.col(f)) & F.col(f"_{f}").isNotNull() & ~has_cjk(F.col(f"_{f}")), F.col(f"_{f}")).otherwise(F.col(f))
    return rows.join(old, F.col(key) == F.col("_key"), "left").select(key, *[swap(f).alias(f) for f in fields])


def lineage(current: DataFrame, versions: DataFrame, key: str, value: str) -> DataFrame:
    """(key, source_run, source): the newest version of a value equal to the current one, better sources first.

    versions: key, value, rank (of the source), source, observed_at, run_id. The match is a
    join by key and hash; the choice an aggregate.
    """
    own = current.select(key, value_hash(F.trim(F.col(value))).alias("_hash"))
    seen = versions.select(F.col(key).alias("_key"), value_hash(F.trim(F.col(value))).alias("_seen"), "rank", "source", "observed_at", "run_id")
    met = own.join(seen, (F.col(key) == F.col("_key")) & (F.col("_hash") == F.col("_seen")), "left")
    best = F.max_by(F.struct("run_id", "source"), F.when(F.col("_key").isNotNull(), F.struct(-F.col("rank"), "observed_at", "run_id")))
    return met.groupBy(key).agg(best.alias("b")).select(key, F.col("b.run_id").alias("source_run"), F.coalesce("b.source", F.lit("UNKNOWN")).alias("source"))


def prior_cards(cards: DataFrame, runs: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """(sku, run_id, state): each wanted SKU's newest card of the last `most` committed runs; none, or a run without coverage at the head: UNKNOWN."""
    # the number of runs looked back at is the feature
    last = runs.where("committed").orderBy(F.col("committed_at").desc(), F.col("run_id").desc()).limit(most)
    newest = cards.join(F.broadcast(last), "run_id").groupBy("sku").agg(F.max_by(F.struct("run_id", "complete"), F.struct("committed_at", "run_id")).alias("c"))
    state = F.when(F.col("c.complete"), "KNOWN").otherwise("UNKNOWN")
    return wanted.select("sku").distinct().join(newest, "sku", "left").select("sku", F.when(F.col("c.complete"), F.col("c.run_id")).alias("run_id"), F.coalesce(state, F.lit("UNKNOWN")).alias("state"))


def provenance(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, value, value_hash) of fields that are not blank: wide to long."""
    made = F.array(*[F.struct(F.lit(f).alias("field"), text_of(F.col(f)).alias("value")) for f in fields])
    return rows.select(key, F.explode(made).alias("f")).where(~is_blank(F.col("f.value"))).select(key, "f.field", "f.value", value_hash(F.col("f.value")).alias("value_hash"))


def override_states(cells: DataFrame, overrides: DataFrame) -> DataFrame:
    """(sku, field, state, value) of approved overrides: they hold while their field's hash is the source's.

    cells: sku, field, value, field_hash, old_hash (the aggregate hash of before). An override
    by the aggregate hash wants approval again; any other hash is stale.
    """
    own = overrides.where("status = 'APPROVED'").select("sku", "field", F.col("hash").alias("_hash"), F.col("target").alias("_target"))
    joined = own.join(cells, ["sku", "field"], "left")
    state = (
        F.when(F.col("field_hash").isNull(), "MISSING").when(is_blank(F.col("value")), "SOURCE_MISSING").when(F.col("_hash") == F.col("field_hash"), "APPLIED").when(F.col("_hash") == F.col("old_hash"), "REAPPROVAL_REQUIRED").otherwise("STALE")
    )
    return joined.select("sku", "field", state.alias("state"), F.when(state == "APPLIED", F.col("_target")).alias("value"))


def review_queue(found: DataFrame, queue: DataFrame) -> DataFrame:
    """(id, status, detail): new findings are pending, decisions stay, findings that vanished are resolved."""
    a, b = found.select("id", F.col("detail").alias("_new")).dropDuplicates(["id"]), queue.select("id", F.col("status").alias("_status"), F.col("detail").alias("_old"))
    both = a.join(b, "id", "full_outer")
    status = F.when(F.col("_status").isNull(), "PENDING").when((F.col("_status") == "PENDING") & F.col("_new").isNull(), "RESOLVED").otherwise(F.col("_status"))
    return both.select("id", status.alias("status"), F.coalesce("_new", "_old").alias("detail"))


def learned(examples: DataFrame) -> DataFrame:
    """(kind, term, value, n, skus, state): what reviews say of a term; one SKU with two source hashes is a conflict."""
    per = examples.groupBy("kind", "term", "value", "sku").agg(F.count(F.lit(1)).alias("n"), F.min("source_hash").alias("lo"), F.max("source_hash").alias("hi"))
    whole = per.groupBy("kind", "term", "value").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("skus"), F.bool_or(F.col("lo") != F.col("hi")).alias("conflict"))
    state = F.when(F.col("conflict"), "EVIDENCE_CONFLICT").when(F.col("n") > 1, "EVIDENCE_ACCUMULATED").otherwise("NEW")
    return whole.select("kind", "term", "value", "n", "skus", state.alias("state"))


def category_names(rows: DataFrame, sources: list[tuple[str, DataFrame, list[str]]], navigation: list[str]) -> DataFrame:
    """(sku, category, source): the first dictionary with a value in target script, by its own keys; navigation labels are no categories.

    sources: name, dictionary (keys and value, one row for each key), keys.
    """
    out, found = rows, []
    for n, (name, words, keys) in enumerate(sources):
        own = words.select(*[F.col(k).alias(f"_{n}_{k}") for k in keys], F.col("value").alias(f"_{n}"))
        on = F.lit(True)
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{n}_{k}"))
        out = out.join(own, on, "left")
        found.append(F.when(has_cjk(F.col(f"_{n}")), F.struct(F.col(f"_{n}").alias("v"), F.lit(name).alias("s"))))
    best = F.coalesce(*found, F.struct(F.col("cat1").alias("v"), F.lit("FALLBACK").alias("s")))
    label = F.lower(F.trim("cat1")).isin(*navigation)
    return out.withColumn("_b", best).select("sku", F.when(~label, F.col("_b.v")).alias("category"), F.when(label, "NAVIGATION").otherwise(F.col("_b.s")).alias("source"))


def brand_rows(brands: DataFrame, wanted: DataFrame) -> DataFrame:
    """(brand, brand_id, match): the exact identifier, else the one equal without case and blanks; ties take the smallest."""
    plain = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    folded = brands.groupBy(plain(F.col("brand_id")).alias("_plain")).agg(F.min("brand_id").alias("_near"))
    exact = brands.select(F.col("brand_id").alias("_exact")).distinct()
    joined = wanted.select("brand").distinct().join(exact, F.col("brand") == F.col("_exact"), "left").withColumn("_key", plain(F.col("brand"))).join(folded, F.col("_key") == F.col("_plain"), "left")
    return joined.select("brand", F.coalesce("_exact", "_near").alias("brand_id"), F.when(F.col("_exact").isNotNull(), "EXACT").when(F.col("_near").isNotNull(), "NORMALISED").otherwise("NONE").alias("match"))


def patch_state(patches: DataFrame, events: DataFrame) -> DataFrame:
    """Each patch with its latest event: created, approved, applied or revoked."""
    last = events.groupBy("patch_id").agg(F.max_by("event", F.struct("at", "seq")).alias("state"))
    return patches.join(last, "patch_id", "left").withColumn("state", F.coalesce("state", F.lit("CREATED")))


def patch_reasons(p: dict[str, Column], base_value: Column, head: Column, allowed: tuple[str, ...]) -> Column:
    """Why a patch can't be applied."""
    return F.array_compact(F.array(
        F.when(~F.coalesce(p["digest"] == value_hash(p["value"]), F.lit(False)), "HASH_MISMATCH"), F.when(~F.coalesce(p["field"].isin(*allowed), F.lit(False)), "FIELD_NOT_ALLOWED"), F.when(~p["state"].eqNullSafe(F.lit("APPROVED")), "NOT_APPROVED"),
        F.when(~p["base_value"].eqNullSafe(base_value), "BASE_VALUE_CHANGED"), F.when(~p["base_commit"].eqNullSafe(head), "BASE_COMMIT_MOVED"),
    ))


def apply_patches(rows: DataFrame, patches: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows with the values of patches (key, field, value); of several for a field the last by sequence, of equal ones the largest value. All of them or none: the caller writes one version."""
    per = patches.groupBy(key).agg(*[F.max_by("value", F.when(F.col("field") == f, F.struct("seq", "value"))).alias(f"_{f}") for f in fields], *[F.max(F.when(F.col("field") == f, F.col("seq"))).alias(f"_seq_{f}") for f in fields])
    return rows.join(per, key, "left").select(key, *[F.when(F.col(f"_seq_{f}").isNotNull(), F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields])


def localized_upsert(rows: DataFrame, old: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, target, freshness): texts stay, and a field whose source changed is stale."""
    new_hash = provenance(rows, key, fields).select(key, "field", F.col("value_hash").alias("_new"))
    joined = old.join(new_hash, [key, "field"], "left")
    return joined.select(key, "field", "target", F.when(F.col("_new").eqNullSafe(F.col("source_hash")), F.col("freshness")).otherwise("STALE").alias("freshness"))


def claims_after(queue: DataFrame, now: Column, minutes: int = 15, most: int = 3) -> DataFrame:
    """Queue entries after a look at stale claims: those older than the minutes go back, and fail after `most` attempts."""
    old = (F.col("status") == "PROCESSING") & (F.unix_micros(now) - F.unix_micros("claimed_at") > minutes * 60_000_000)
    status = F.when(old & (F.col("attempts") >= most), "FAILED").when(old, "PENDING").otherwise(F.col("status"))
    return queue.withColumns({"status": status, "claimed_at": F.when(old, None).otherwise(F.col("claimed_at"))})


def selection_export(members: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """Frozen members in their order with today's facts; members without any stay, as missing."""
    own = facts.select(F.col("sku").alias("_sku"), *columns)
    return members.join(own, F.col("sku") == F.col("_sku"), "left").select("ordinal", "sku", *columns, F.when(F.col("_sku").isNotNull(), "INCLUDED").otherwise("MISSING").alias("state"))


def with_ordinals(rows: DataFrame, order: list[str], parts: int = 64) -> DataFrame:
    """Adds ordinal, from 1 on, in the given order; rows equal in it are numbered in any order, each number once.

    Ranges are sorted apart and written once, with each row's range and its
    place in it: sizes and rows come from that table, so that both speak of the
    same ranges, whatever a second sampling or a retried task would deal out.
    """
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    table = written(ranged.withColumn("_id", F.monotonically_increasing_id()), "ordinals")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each range
    shift = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return table.withColumn("_part", part).join(F.broadcast(shift), "_part").withColumn("ordinal", F.col("_before") + place + 1).drop("_part", "_id", "_n", "_before")


def protected_tokens(text: Column) -> Column:
    """Tokens that a translation must keep, in order: addresses, markup, long numbers, models, sizes, measures, numbers."""
    kinds = [r"https?://[^\s<>]+", r"</?[A-Za-z][^>]*>", r"\b\d{8,14}\b", r"\b[A-Z]{1,5}-?\d[A-Z0-9-]*\b", r"\d+(?:[.,]\d+)?(?:\s*[x×]\s*\d+(?:[.,]\d+)?)+", r"\d+(?:[.,]\d+)?\s*(?:€|%|°C|kg|mg|ml|cl|mm|cm|mAh|GB|MB|Hz|g|l|m|V|W)(?![A-Za-z])", r"\d+(?:[.,]\d+)?"]
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(" + "|".join(kinds) + ")"), F.lit(1))


def token_type(token: Column) -> Column:
    return (
        F.when(token.rlike("^https?://"), "URL").when(token.startswith("<"), "HTML").when(token.rlike(r"^\d{13}$|^\d{8}$"), "EAN").when(token.rlike(r"^\d{9,14}$"), "SKU").when(token.rlike("^[A-Z]"), "MODEL")
        .when(token.rlike("[x×]"), "DIMENSION").when(token.contains("€"), "MONEY").when(token.rlike(r"^[\d.,]+$"), "NUMBER").otherwise("UNIT")
    )


def protect(text: Column) -> Column:
    """The text with placeholders for its tokens, numbered in order; see restore."""
    tokens = protected_tokens(text)
    state = lambda rest, out: F.struct(rest.alias("rest"), out.alias("out"))

    def step(s: Column, token: Column, n: Column) -> Column:
        at = F.position(token, s["rest"])
        return state(F.substring(s["rest"], at + F.length(token), F.length(s["rest"])), F.concat(s["out"], F.substring(s["rest"], F.lit(1), at - 1), F.lit("⟦"), n.cast("string"), F.lit("⟧")))

    numbered = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    return F.aggregate(numbered, state(F.coalesce(text, F.lit("")), F.lit("")), lambda s, x: step(s, x["t"], x["i"]), lambda s: F.concat(s["out"], s["rest"]))


def restore(text: Column, tokens: Column) -> Column:
    """Placeholders back to tokens; null where they are not exactly those of the tokens, in order."""
    held = F.regexp_extract_all(text, F.lit("⟦([0-9]+)⟧"), F.lit(1))
    wanted = F.transform(tokens, lambda t, i: i.cast("string"))
    numbered = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    back = F.aggregate(numbered, text, lambda s, x: F.replace(s, F.concat(F.lit("⟦"), x["i"].cast("string"), F.lit("⟧")), x["t"]))
    return F.when(held == wanted, back)


def families(rows: DataFrame, families: DataFrame) -> DataFrame:
    """(sku, family, score) of the best family: an alias in the name, as whole words, and more for its category and phrases.

    rows: sku, name, category, text; families: family, alias (any number of words), category, phrase.
    """
    known = families.withColumn("_alias", F.lower(F.trim("alias"))).withColumnRenamed("category", "_category").withColumnRenamed("phrase", "_phrase")
    held = spans(rows, known, ["sku"], "name", "_alias").select("sku", F.col("phrase").alias("_alias")).distinct()
    met = held.join(known, "_alias").join(rows.select("sku", "category", "text"), "sku")
    close, said = F.coalesce(F.col("category") == F.col("_category"), F.lit(False)), F.coalesce(F.contains(F.lower("text"), F.lower("_phrase")), F.lit(False))
    scored = met.withColumn("score", F.round(F.least(F.lit(0.99), 0.72 + F.when(close, 0.18).otherwise(0.0) + F.when(said, 0.08).otherwise(0.0)), 2)).where(close | said)
    return scored.groupBy("sku").agg(F.max("score").alias("score"), F.min_by("family", F.struct(-F.col("score"), "family")).alias("family"))

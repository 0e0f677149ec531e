"""Price flags out of the evidence of runs: JSON objects read with their repeated keys, in their order."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Pairs(list):
    """An object's members in order, repeated keys included."""


def members(text: str | None) -> Pairs | None:
    """The members of a JSON object, or None where the text is none."""

    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text or "", object_pairs_hook=Pairs, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, Pairs) else None


def first(pairs: Pairs, key: str):
    """The first member's value of that name; a later one does not replace it."""
    return next((v for k, v in pairs if k == key), None)


def is_set(value) -> bool:
    """true, or a number equal to 1; a text is neither."""
    return value is True or (type(value) in (int, float) and value == 1)


def flag_rows(evidence: DataFrame, run: str = "run_id", text: str = "evidence", whole: str = "price_observation_invalid", fields: str = "price_field_observation_invalid", named: tuple[str, ...] = ("original_price", "unit_price")) -> DataFrame:
    """(run, key, kind, position, flags): one row for each member of the two objects, kind 0 and 1, numbered in order.

    flags is a map: `price` for kind 0, the named fields for kind 1 (a member
    that is no object has none). A text that is no JSON object, or where a name
    holds no object, gives no rows; of a repeated name the first counts.
    """
    kinds = dict(evidence.dtypes)

    def run_batches(batches):
        for batch in batches:
            at, keys, kind, position, flags = [], [], [], [], []
            for k, own in enumerate(batch.column(text).to_pylist()):
                top = members(own)
                for number, name in enumerate((whole, fields)):
                    inner = None if top is None else first(top, name)
                    for place, (key, value) in enumerate(inner if isinstance(inner, Pairs) else ()):
                        at.append(k)
                        keys.append(key)
                        kind.append(number)
                        position.append(place)
                        flags.append([("price", is_set(value))] if number == 0 else [(n, is_set(first(value, n))) for n in named] if isinstance(value, Pairs) else [])
            runs = batch.column(run).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_pydict({run: runs, "key": pa.array(keys, pa.string()), "kind": pa.array(kind, pa.int32()), "position": pa.array(position, pa.int64()), "flags": pa.array(flags, pa.map_(pa.string(), pa.bool_()))})

    return evidence.select(run, text).mapInArrow(run_batches, f"`{run}` {kinds[run]}, key string, kind int, position long, flags map<string,boolean>")


def first_flags(rows: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, key, kind, flags): of a key's rows in a run and kind the one that stands first."""
    return rows.groupBy(run, "key", "kind").agg(F.min_by("flags", "position").alias("flags"))


def latest_present(observations: DataFrame, commits: DataFrame) -> DataFrame:
    """(sku, run_id): the last run that was committed and saw the SKU; by observation date, then commit time, then commit."""
    done = commits.where("status = 'COMMITTED'").select("run_id", "commit_id", "committed_at")
    seen = observations.where("presence_state = 'PRESENT'").join(done, "run_id")
    return seen.groupBy("sku").agg(F.max_by("run_id", F.struct("observation_date", "committed_at", "commit_id")).alias("run_id"))


def price_flags(observations: DataFrame, commits: DataFrame, evidence: DataFrame) -> DataFrame:
    """(sku, run_id, invalid_price, invalid_original, invalid_unit) by the evidence of each SKU's last run; only that run's evidence is read for it."""
    last = latest_present(observations, commits)
    asked = evidence.join(last.select("run_id").distinct(), "run_id", "left_semi")
    flat = first_flags(flag_rows(asked)).groupBy("run_id", F.col("key").alias("sku")).agg(*[F.coalesce(F.bool_or(F.try_element_at("flags", F.lit(name))), F.lit(False)).alias(out) for name, out in (("price", "invalid_price"), ("original_price", "invalid_original"), ("unit_price", "invalid_unit"))])
    columns = ["invalid_price", "invalid_original", "invalid_unit"]
    return last.join(flat, ["run_id", "sku"], "left").select("sku", "run_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in columns])


def reviewed_prices(products: DataFrame, flags: DataFrame) -> DataFrame:
    """Products without the prices that their last run could not observe: an invalid price takes all three with it."""
    own = flags.select(F.col("sku").alias("_sku"), "invalid_price", "invalid_original", "invalid_unit")
    joined = products.join(own, F.col("sku") == F.col("_sku"), "left")
    bad = {"current_price": F.col("invalid_price"), "original_price": F.col("invalid_price") | F.col("invalid_original"), "unit_price": F.col("invalid_price") | F.col("invalid_unit")}
    return joined.select(*[F.when(~F.coalesce(bad[c], F.lit(False)), F.col(c)).alias(c) if c in bad else F.col(c) for c in products.columns])

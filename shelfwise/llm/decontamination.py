"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are runs of digits, letters a-z (A-Z are lower-cased) and non-ASCII bytes.
A window is `size` consecutive words of a benchmark item; an item with fewer
words, but not none, is one window. Each document's windows are looked up by
hash, and every hit is verified on the words themselves.

The benchmark is read in blocks of at most BLOCK_BYTES of text, so what is
broadcast is bounded whatever its size; the usual benchmark is one block. Later
blocks add to the hits of the earlier ones, row by row.

Edge cases: null and empty texts have no words and no hits; an empty benchmark
hits nothing; a null item_id is listed as an empty string; repeated rows are
judged each by itself; extra columns are kept, but for the names of result
columns, where the operator's column wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Sent, stored
from .textops import ITEM_WORD, LOWER, U, Powers, slices, span_hashes, window_hashes, word_spans

SIZE = 13
#: Bytes of benchmark text in a block; its windows take over a hundred times as much in the driver and in each Python worker.
BLOCK_BYTES = 2 << 20
#: A document is contaminated if 1 / RATIO of its words or more are hit.
RATIO = 20
RESULTS = ["n_words", "hit_runs", "items", "kept_text"]


def lowered(raw: np.ndarray) -> np.ndarray:
    return LOWER[raw]


def item_windows(items: list[tuple[str, str]], size: int) -> dict[int, dict[int, dict[bytes, list[str]]]]:
    """length of window -> hash -> words -> item identifiers."""
    powers, found = Powers(), {}
    texts = pa.array([text or "" for _, text in items], pa.large_string())
    for row, raw, offsets in slices(texts):
        raw = lowered(raw)
        starts, ends, rows = word_spans(raw, offsets, ITEM_WORD)
        hashes = span_hashes(raw, starts, ends, powers)
        words = [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        counts = np.bincount(rows, minlength=len(offsets) - 1)
        first = np.cumsum(counts) - counts
        for k, (at, n) in enumerate(zip(first.tolist(), counts.tolist())):
            length = min(size, n)
            if not length:
                continue
            named = items[row + k][0] or ""
            for j, h in enumerate(window_hashes(hashes[at : at + n], length).tolist()):
                ids = found.setdefault(length, {}).setdefault(h, {}).setdefault(b" ".join(words[at + j : at + j + length]), [])
                if named not in ids:
                    ids.append(named)
    return found


def merge_runs(old: list[int], new: list[int]) -> list[int]:
    """Union of two lists first, last, first, last, ... of word indexes."""
    runs = sorted(zip(old[::2], old[1::2])) + sorted(zip(new[::2], new[1::2]))
    out: list[int] = []
    for a, b in sorted(runs):
        if out and a <= out[-1] + 1:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def scanner(shared, keep: list[str], text: str, again: bool, with_text: bool):
    """Task function over Arrow batches for one block of windows."""

    def scan(batches):
        table, powers = shared.value, Powers()
        sieves = {}
        for length, hashes in table.items():
            keys = np.sort(np.fromiter(hashes, U, len(hashes)))
            sieve = np.zeros(1 << 20, bool)
            sieve[(keys >> U(44)).astype(np.int64)] = True
            sieves[length] = (keys, sieve)
        for batch in batches:
            column = batch.column(text)
            n_rows = batch.num_rows
            counts_all = np.zeros(n_rows, np.int64)
            runs_all, items_all = [[] for _ in range(n_rows)], [set() for _ in range(n_rows)]
            texts_all: dict[int, str] = {}
            for row, raw, offsets in slices(column):
                raw = lowered(raw)
                starts, ends, rows = word_spans(raw, offsets, ITEM_WORD)
                n = len(starts)
                counts_all[row : row + len(offsets) - 1] = np.bincount(rows, minlength=len(offsets) - 1)
                if not n:
                    continue
                hashes = span_hashes(raw, starts, ends, powers)
                step = np.zeros(n + 1, np.int64)
                for length, (keys, sieve) in sieves.items():
                    windows = window_hashes(hashes, length)
                    if not len(windows):
                        continue
                    maybe = np.flatnonzero(sieve[(windows >> U(44)).astype(np.int64)] & (rows[: len(windows)] == rows[length - 1 :]))
                    at = np.searchsorted(keys, windows[maybe])
                    maybe = maybe[keys[np.minimum(at, len(keys) - 1)] == windows[maybe]]
                    for k in maybe.tolist():
                        words = b" ".join(raw[a:b].tobytes() for a, b in zip(starts[k : k + length].tolist(), ends[k : k + length].tolist()))
                        ids = table[length][int(windows[k])].get(words)
                        if ids is not None:
                            step[k] += 1
                            step[k + length] -= 1
                            items_all[row + int(rows[k])].update(ids)
                hit = np.cumsum(step[:-1]) > 0
                if not hit.any():
                    continue
                base = np.searchsorted(rows, np.arange(len(offsets)))
                for r in np.unique(rows[hit]).tolist():
                    own = hit[base[r] : base[r + 1]]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                    first, last = edge[::2], edge[1::2] - 1
                    runs_all[row + r] = np.stack([first, last], 1).ravel().tolist()
            out = {name: batch.column(name) for name in keep}
            if again:
                runs_all = [merge_runs(a, b) for a, b in zip(batch.column("hit_runs").to_pylist(), runs_all)]
                items_all = [a | set(b) for a, b in zip(items_all, batch.column("items").to_pylist())]
            if with_text:
                for k, runs in enumerate(runs_all):
                    if runs:
                        texts_all[k] = without_runs(column[k].as_py(), runs)
            out["n_words"] = pa.array(counts_all)
            out["hit_runs"] = pa.array(runs_all, pa.list_(pa.int32()))
            out["items"] = pa.array([sorted(x) for x in items_all], pa.list_(pa.string()))
            if with_text:
                out["kept_text"] = pa.array([texts_all[k] if k in texts_all else v.as_py() for k, v in enumerate(column)], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return scan


def without_runs(text: str, runs: list[int]) -> str:
    """The text without the characters from each run's first word to its last."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(lowered(raw), np.array([0, len(raw)]), ITEM_WORD)
    gone = np.zeros(len(raw), bool)
    for a, b in zip(runs[::2], runs[1::2]):
        gone[starts[a] : ends[b]] = True
    return raw[~gone].tobytes().decode()


def block_count(benchmark: DataFrame, text: str, block_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-int(size) // block_bytes))


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, with_text: bool = False) -> DataFrame:
    """Kept columns and n_words, hit_runs (word indexes), n_hit, items, contaminated; with_text: kept_text without hit spans."""
    spark = docs.sparkSession
    keep = [c for c in (docs.columns if keep is None else keep) if c not in [*RESULTS, "n_hit", "contaminated"]]
    frame = docs.select(*dict.fromkeys([*keep, text]))
    blocks = block_count(benchmark, item_text, block_bytes)
    named = list(dict.fromkeys([*keep, text])) if blocks > 1 else list(keep)
    kinds = dict(frame.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in named), "n_words long", "hit_runs array<int>", "items array<string>", *(["kept_text string"] if with_text else [])])
    for k in range(blocks):
        block = benchmark if blocks == 1 else benchmark.where(F.pmod(F.xxhash64(item_id, item_text), F.lit(blocks)) == k)
        rows = [(row[0], row[1]) for row in block.select(F.col(item_id).cast("string"), item_text).collect()]
        windows = Sent(spark, item_windows(rows, size))
        frame = frame.mapInArrow(scanner(windows, named, text, k > 0, with_text), schema)
        if blocks > 1:
            frame = stored(frame, "decontamination")
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hit_runs") - 1), F.lit(0).cast("long"), lambda total, k: total + F.when(k % 2 == 1, F.get("hit_runs", k) + 1).otherwise(-F.get("hit_runs", k)).cast("long"))
    out = frame.withColumn("n_hit", F.when(F.size("hit_runs") == 0, F.lit(0).cast("long")).otherwise(n_hit))
    extra = ["kept_text"] if with_text else []
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (RATIO * F.col("n_hit") >= F.col("n_words"))).select(*keep, "n_words", "n_hit", "hit_runs", "items", "contaminated", *extra)

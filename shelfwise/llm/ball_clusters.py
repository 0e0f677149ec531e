"""Ball k-means over integer vectors, exact at every size.

A cluster is a ball: its centroid and the distance of its farthest member. Of
two centroids further apart than twice a ball's radius, the other can't be
nearer to any member, so only centroids within that reach are neighbours. The
neighbours in order of distance cut the ball into a stable core, whose members
are nearer to the centroid than half the way to the first neighbour and stay,
and annuli: members of the r-th annulus are compared exactly with the first r
neighbours and no others. All comparisons are of whole numbers: a member at
squared distance d can reach a centroid at squared distance D only if
4 d >= D, equality included, so that ties too go to the smaller number.

Vectors travel in blocks, one row for each Arrow batch, with their members'
clusters and with sums, counts and distances by cluster. A round is one pass:
each task reads its blocks, takes the ball of a block's members of a cluster
(a part of the cluster's ball, so its neighbours are among the ball's), settles
them and writes the block anew; the sums are added by Spark and only k rows of
sums reach the driver. No row is shuffled, no cluster is gathered, and a
lost executor's blocks are read again from the last round's table.

Kept vectors have exactly `length` components, none null or not finite; a
component x becomes floor(scale * x), held to +-2**62. Distances beyond a long
are given as the largest long.

Edge cases: null vectors and those of another length go; a null identifier
counts as empty text where starts are drawn; of equal identifiers the smaller
vector comes first; with fewer kept vectors than k there are as many clusters
as vectors; an empty table gives an empty result; extra columns are kept if
named as keys, unless a result column has the name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored

K, ROUNDS, LENGTH, SCALE, SEED = 8, 10, 64, 1024, 3
#: Up to this size of components, squared distances and sums of a block are exact in doubles.
EXACT = 1 << 20
LARGEST, BOUND = (1 << 63) - 1, 1 << 62
BLOCK = "keys array<struct<{}>>, wide boolean, vectors binary, clusters binary, totals array<decimal(38,0)>"


def is_kept(column: str, length: int) -> Column:
    value = F.col(column)
    return F.coalesce((F.size(value) == length) & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    scaled = np.floor(values.astype(np.float64) * scale)
    inside = np.abs(scaled) < float(BOUND)
    return np.where(inside, np.where(inside, scaled, 0).astype(np.int64), np.where(scaled > 0, BOUND, -BOUND))


def squares(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = rows - centre
    return (gap * gap).sum(axis=-1)


def settle(x: np.ndarray, own: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each member after comparing it with the neighbours it can reach, and how many distances that took."""
    best, new, compared = squares(x, centres[own]), own.copy(), len(x)
    for ball in np.unique(own).tolist():
        inside = np.flatnonzero(own == ball)
        reach = 4 * best[inside]
        gaps = squares(centres, centres[ball])
        near = [j for j in np.argsort(gaps, kind="stable").tolist() if j != ball and gaps[j] <= reach.max()]
        annulus = np.searchsorted(gaps[near], reach, "right")
        for t, j in enumerate(near):
            rows = inside[annulus > t]
            far = squares(x[rows], centres[j])
            nearer = (far < best[rows]) | ((far == best[rows]) & (j < new[rows]))
            best[rows[nearer]], new[rows[nearer]] = far[nearer], j
            compared += len(rows)
    return new, best, compared


def numbers(vectors: np.ndarray, centres: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and centroids in a type whose arithmetic is exact for them."""
    largest = max(int(np.abs(vectors).max(initial=0)), *(abs(v) for c in centres for v in c))
    kind = np.float64 if largest <= EXACT else object
    return vectors.astype(kind), np.array(centres, dtype=kind)


def unpacked(vectors: bytes, wide: bool, length: int) -> np.ndarray:
    return np.frombuffer(vectors, np.int64 if wide else np.int16).reshape(-1, length).astype(np.int64)


def to_blocks(kept: DataFrame, keys: list[str], column: str, length: int, scale: int) -> DataFrame:
    kinds = dict(kept.dtypes)
    schema = BLOCK.format(", ".join(f"`{c}`: {kinds[c]}" for c in keys))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole(batch.column(column).flatten().to_numpy(zero_copy_only=False), scale)
            wide = bool(np.abs(x).max() >= 1 << 15)
            n = batch.num_rows
            keyed = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column("_keys"))
            packed = x.astype(np.int64 if wide else np.int16).tobytes()
            yield pa.RecordBatch.from_pydict({"keys": keyed, "wide": [wide], "vectors": [packed], "clusters": [bytes(4 * n)], "totals": pa.array([[]], pa.list_(pa.decimal128(38, 0)))})

    return kept.select(column, F.struct(*keys).alias("_keys")).mapInArrow(run, schema)


def next_round(blocks: DataFrame, centres: list[list[int]], length: int) -> DataFrame:
    """The same blocks, settled, with [count, distance, components] of each cluster's members and the distances taken."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("wide", "vectors", "clusters")}
                x, c = numbers(unpacked(row["vectors"], row["wide"], length), centres)
                new, d, compared = settle(x, np.frombuffer(row["clusters"], np.int32), c)
                totals = []
                for j in range(len(centres)):
                    member = new == j
                    totals += [int(member.sum()), int(d[member].sum()), *map(int, x[member].sum(axis=0))]
                sums = pa.array([[Decimal(v) for v in [*totals, compared]]], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_pydict({"keys": batch.column("keys").slice(k, 1), "wide": [row["wide"]], "vectors": [row["vectors"]], "clusters": [new.astype(np.int32).tobytes()], "totals": sums})

    return blocks.mapInArrow(run, blocks.schema)


def totals_of(blocks: DataFrame, k: int, length: int) -> tuple[list[list[int]], int]:
    """([count, distance, components] of each cluster, distances taken): k * (length + 2) + 1 sums, however many blocks."""
    sums = blocks.select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    by_place, width = {r["pos"]: int(r["total"]) for r in sums}, length + 2
    return [[by_place[j * width + t] for t in range(width)] for j in range(k)], by_place[k * width]


@dataclass
class Clusters:
    """centres: the final ones; blocks: vectors with their last assignment; compared: distances between vectors and centroids taken in each round."""

    blocks: DataFrame
    centres: list[list[int]]
    counts: list[int]
    inertias: list[int]
    keys: list[str]
    length: int
    compared: list[int] = field(default_factory=list)

    def members(self) -> DataFrame:
        """Keys, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row for each kept vector."""
        centres, length = self.centres, self.length
        hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
        inertias, inertia = [min(v, LARGEST) for v in self.inertias], min(sum(self.inertias), LARGEST)
        names = [c for c in self.keys if c not in ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")]
        keyed = {f.name: f.dataType.simpleString() for f in self.blocks.schema["keys"].dataType.elementType.fields}

        def run(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    x, c = numbers(unpacked(batch.column("vectors")[k].as_py(), batch.column("wide")[k].as_py(), length), centres)
                    own = np.frombuffer(batch.column("clusters")[k].as_py(), np.int32)
                    d = pa.array([min(int(v), LARGEST) for v in squares(x, c[own])], pa.int64())
                    key = batch.column("keys").slice(k, 1).flatten()
                    out = {name: pa.compute.struct_field(key, name) for name in names}
                    at = pa.array(own)
                    out |= {"cluster": at, "distance": d, "cluster_inertia": pa.array(inertias, pa.int64()).take(at), "inertia": pa.array([inertia] * len(own), pa.int64()), "centroid_sha256": pa.array(hashes).take(at)}
                    yield pa.RecordBatch.from_pydict(out)

        schema = ", ".join([*(f"`{c}` {keyed[c]}" for c in names), "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"])
        return self.blocks.select("keys", "wide", "vectors", "clusters").mapInArrow(run, schema)


def starts(kept: DataFrame, identifier: str, column: str, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of `seed:identifier`, in its order."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(identifier).cast("string"), F.lit(""))), 256)
    first = kept.select(column, drawn.alias("_drawn")).orderBy("_drawn", column).limit(k)
    return [whole(np.array(r[0]), scale).tolist() for r in first.collect()]


def ball_kmeans(vectors: DataFrame, keys: list[str] | None = None, identifier: str = "vec_id", column: str = "embedding", k: int = K, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE, seed: int = SEED) -> Clusters:
    """Clusters after `rounds` rounds of assigning vectors and moving centroids, and one more assignment."""
    keys = [identifier] if keys is None else keys
    kept = vectors.where(is_kept(column, length))
    centres = starts(kept, identifier, column, k, scale, seed)
    blocks, compared, totals = stored(to_blocks(kept, keys, column, length, scale), "balls"), [], []
    for last in [False] * rounds + [True]:
        if not centres:
            break
        settled = stored(next_round(blocks, centres, length), "balls")
        discard(blocks)
        blocks = settled
        totals, taken = totals_of(blocks, len(centres), length)
        compared.append(taken)
        if not last:
            centres = [[v // n for v in sums] if n else old for old, (n, _, *sums) in zip(centres, totals)]
    return Clusters(blocks, centres, [t[0] for t in totals], [t[1] for t in totals], keys, length, compared)

"""Jaccard self-join of documents' n-gram sets by prefix trees.

A document's set holds the 64-bit hashes of its distinct word n-grams, ordered
by hash: one global order. Documents with equal sets form a class, and one member
stands for it. Sets that may link are brought together in blocks; in a block they
are stored in a trie in global order, and each set is looked up by one traversal
that carries the overlap so far along shared prefixes and leaves a subtree when
the remaining lengths can't reach the overlap that the threshold asks for.
A subtree whose sets are all known to be in one component is left as soon as the
looked-up set is in it too: a group of near copies gives a spanning tree, not all of
its pairs. Elements are ordered by their number of sets in the block, rarest first,
and a lookup enters only branches of sets with which it shares one of the first
(1 - t) * size + 1 elements, as each linked pair does.

Blocks come from an exact condition. Two linked sets differ in at most
d = (1 - t) / t * (smaller size) elements; if the hash range is cut into d + s
segments, at least s of them are equal. Sizes fall into levels with ratio 1 / t; a
set gives the signatures of its segments at its own level and at the one below, so
partners of any two sizes meet at the smaller one's level.

Three filters come first; each counts what a set shares with others, whoever they are.

1. Of two linked sets, the first (1 - t) * size + l elements in the global order have l
   in common, for each l up to the overlap. With l a tenth of the smallest partner's
   size, sets that share fewer of their first elements have no partner. Only these
   elements of all sets travel.
2. Of the sets left, all elements are counted: at least t * size are shared by a set
   with a partner. Texts that only quote the same passages go.
3. A set that shares fewer than s of a level's signatures has no partner there. Equal
   signatures join sets in a star. A signature of over HOT sets joins only those with s
   such signatures: a partner with whom all shared signatures are that frequent has as
   many. Connected stars are the blocks.

A block of over BLOCK_TOKENS n-grams is cut into parts. Each part is one task's trie
join. Blocks hold together by single signatures and grow with the input, so sets do not
meet all parts of theirs: a set is copied to another part only if t * size of its elements
stand there in sets of earlier components, as those it shares with a partner do. The
block's largest component is the first one: a group of near copies, however large, is
not copied, and another set goes about where its partners are.

Equal signatures travel packed as numbers, and so do the counts of shared ones, which
are no more than a set's signatures. A task keeps at most HOT + 1 sets of a
signature for the exchange and settles the others itself, so a signature shared by
a third of all documents passes a bounded number of rows from each run of pairs.

Edge cases: null, empty and wordless texts have an empty set, no links and their
own identifier as component; a text of fewer words than n is one n-gram; repeated
rows are one class; rows with a null identifier take their class's smallest other
identifier, or null; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import discard, shuffle_parts, stored, sweep
from .textops import LOWER, NON_SPACE, U, Powers, mix, ragged, slices, span_hashes, window_hashes, word_spans

SIZE = 4
PERCENT = 85
BLOCK_TOKENS = 4_000_000
#: Candidates are looked up by broadcast up to so many rows, by shuffle beyond; both give the same rows.
BROADCAST_ROWS = 1_000_000
#: A signature of more sets is hot.
HOT = 64
#: Pairs of a task's sets are grouped in runs of about so many before they travel.
PAIRS_AT_ONCE = 300_000
#: Low bits of a signature that hold its level.
LEVEL_BITS = 12
PAIR = np.dtype([("sig", "<u8"), ("node", "<u8")])
TALLY = np.dtype([("node", "<u8"), ("level", "<i8"), ("k", "<i8"), ("hot", "<i8")])
#: An element of a set of a cut block, the place of the set's component in the order of the block's, and the elements a partner shares.
PLACE = np.dtype([("sig", "<u8"), ("node", "<i8"), ("order", "<i8"), ("part", "<i4"), ("need", "<i4")])
VISIT = np.dtype([("node", "<i8"), ("part", "<i4"), ("need", "<i4"), ("k", "<i8")])


def sets_of(column: pa.Array, size: int):
    """(first row, tokens, offsets): each row's distinct n-gram hashes in ascending order."""
    powers = Powers()
    for first, raw, offsets in slices(column):
        raw = LOWER[raw]
        n = len(offsets) - 1
        starts, ends, rows = word_spans(raw, offsets, NON_SPACE)
        words = span_hashes(raw, starts, ends, powers)
        windows = window_hashes(words, size)
        inside = rows[: len(windows)] == rows[size - 1 :] if len(windows) else np.zeros(0, bool)
        tokens, owner = windows[inside], rows[: len(windows)][inside]
        counts = np.bincount(rows, minlength=n)
        for r in np.flatnonzero((counts > 0) & (counts < size)).tolist():
            at = int(np.searchsorted(rows, r))
            tokens = np.append(tokens, window_hashes(words[at : at + counts[r]], int(counts[r])))
            owner = np.append(owner, r)
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        tokens, owner = tokens[new], owner[new]
        bounds = np.zeros(n + 1, np.int64)
        np.cumsum(np.bincount(owner, minlength=n), out=bounds[1:])
        yield first, tokens, bounds


def sums_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def digests_of(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent digests of each row's set; the first, with its lowest bit free, is its node number."""
    n = np.diff(bounds).astype(U)
    return mix(sums_of(mix(tokens), bounds) + n) & ~U(1), mix(sums_of(mix(tokens ^ U(0x5851F42D4C957F2D)), bounds) * U(3) + n)


def level_bounds(percent: int) -> np.ndarray:
    """Smallest set size of each level."""
    ratio, out = 100 / percent, [1]
    while out[-1] < 1 << 40:
        out.append(int(np.ceil(ratio ** len(out) - 1e-9)))
    return np.array(out, np.int64)


def level_parts(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each level: most elements in which a pair differs, equal segments then left, empty segments allowed."""
    limits = level_bounds(percent)
    most = ((100 - percent) * (np.append(limits[1:], limits[-1]) - 1)) // percent
    equal = np.maximum(4, most // 4)
    return most, equal, np.maximum(1, equal // 4)


def signatures(tokens: np.ndarray, bounds: np.ndarray, nodes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node) pairs of all sets at both of their levels, and (nodes, levels) of sets with many empty segments."""
    sizes = np.diff(bounds)
    limits = level_bounds(percent)
    all_most, all_equal, all_empty = level_parts(percent)
    own = np.searchsorted(limits, sizes, "right") - 1
    summed = np.zeros(len(tokens) + 1, U)
    np.cumsum(mix(tokens + U(0x9E6C63D0876A9A47)), out=summed[1:])
    out, bare_nodes, bare_levels = [np.empty(0, PAIR)], [np.empty(0, U)], [np.empty(0, np.int64)]
    for down in (0, 1):
        level = own - down
        rows = np.flatnonzero((sizes > 0) & (level >= 0))
        rows = rows[all_most[level[rows]] > 0]
        if not len(rows):
            continue
        levels = level[rows]
        parts = all_most[levels] + all_equal[levels]
        lengths = sizes[rows]
        flat = ragged(bounds[rows], lengths)
        owner = np.repeat(np.arange(len(rows)), lengths)
        segment = (((tokens[flat] >> U(32)) * parts.astype(U)[owner]) >> U(32)).astype(np.int64)
        first = np.cumsum(parts) - parts
        counts = np.bincount(first[owner] + segment, minlength=int(parts.sum()))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        # sums are taken over tokens, in which the chosen rows need not be adjacent
        base = np.repeat(bounds[rows] - (np.cumsum(lengths) - lengths), parts)
        value = summed[base + cuts[1:]] - summed[base + cuts[:-1]]
        set_of = np.repeat(np.arange(len(rows)), parts)
        number = ragged(np.zeros(len(rows), np.int64), parts)
        empty = counts == 0
        bare = np.bincount(set_of, empty, len(rows)) > all_empty[levels]
        use = ~empty | bare[set_of]
        key = mix(value[use] ^ mix(levels[set_of[use]].astype(U) * U(1 << 40) + number[use].astype(U) * U(4) + empty[use].astype(U)))
        pairs = np.empty(len(key), PAIR)
        pairs["sig"] = (key >> U(LEVEL_BITS) << U(LEVEL_BITS)) | levels[set_of[use]].astype(U)
        pairs["node"] = nodes[rows][set_of[use]]
        out.append(pairs)
        bare_nodes.append(nodes[rows][bare])
        bare_levels.append(levels[bare])
    return np.concatenate(out), np.concatenate(bare_nodes), np.concatenate(bare_levels)


def element_pairs(tokens: np.ndarray, bounds: np.ndarray, nodes: np.ndarray, percent: int, whole: bool) -> np.ndarray:
    """(element, node) pairs of each set's first elements, or of all."""
    sizes = np.diff(bounds)
    lengths = sizes if whole else np.minimum(sizes, sizes - -(-percent * sizes // 100) + np.maximum(1, sizes // 10))
    pairs = np.empty(int(lengths.sum()), PAIR)
    pairs["sig"] = mix(tokens[ragged(bounds[:-1], lengths)]) >> U(LEVEL_BITS) << U(LEVEL_BITS)
    pairs["node"] = np.repeat(nodes, lengths)
    return pairs


def elements_needed(percent: int, whole: bool) -> str:
    """SQL of the shared elements without which a set of n has no partner."""
    least = f"(({percent} * n + 99) div 100)"
    return least if whole else f"greatest(1, {least} div 10)"


def grouped(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs by signature, the group number of each, and each group's first place and size."""
    pairs = pairs[np.lexsort((pairs["node"], pairs["sig"]))]
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = (pairs["sig"][1:] != pairs["sig"][:-1]) | (pairs["node"][1:] != pairs["node"][:-1])
    pairs = pairs[fresh]
    new = np.ones(len(pairs), bool)
    new[1:] = pairs["sig"][1:] != pairs["sig"][:-1]
    first = np.flatnonzero(new)
    return pairs, np.cumsum(new) - 1, first, np.diff(np.append(first, len(pairs)))


def packed(pairs: np.ndarray, buckets: int, extra: int) -> pa.RecordBatch:
    """Pairs as one binary value for each bucket, beside `extra` columns of nulls."""
    bucket = (pairs["sig"] >> U(LEVEL_BITS)) % U(buckets)
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    blobs = [x.tobytes() for x in np.split(pairs[order], at[1:])] if len(used) else []
    n = len(used)
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(blobs, pa.binary()), *[pa.nulls(n, pa.int64()) for _ in range(extra)]], names=["bucket", "pairs", *NUMBERS[:extra]])


def dealt_rows(rows: np.ndarray, bucket: np.ndarray, name: str) -> pa.RecordBatch:
    """Rows as one binary value for each bucket."""
    order = np.argsort(bucket, kind="stable")
    used, at = np.unique(bucket[order], return_index=True)
    blobs = [x.tobytes() for x in np.split(rows[order], at[1:])]
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", name])


NUMBERS = ("x0", "x1", "x2", "x3")


def number_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *[pa.array(np.ascontiguousarray(c).view(np.int64) if c.dtype == U else c.astype(np.int64)) for c in columns]], names=["bucket", "pairs", *NUMBERS[: len(columns)]])


def numbers_of(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [batch.column(2 + k).drop_null().to_numpy() for k in range(n)]


def tally(nodes: np.ndarray, levels: np.ndarray, k: np.ndarray, hot: np.ndarray) -> list[np.ndarray]:
    """Sums of k and hot by node and level."""
    order = np.lexsort((levels, nodes))
    nodes, levels = nodes[order], levels[order]
    new = np.ones(len(nodes), bool)
    new[1:] = (nodes[1:] != nodes[:-1]) | (levels[1:] != levels[:-1])
    at, n = np.cumsum(new) - 1, int(new.sum())
    return [nodes[new], levels[new], np.bincount(at, k[order], n).astype(np.int64), np.bincount(at, hot[order], n).astype(np.int64)]


def distinct_sets(column: pa.Array, size: int):
    """(tokens, offsets, nodes, row of each) of each slice's different sets."""
    for first, tokens, bounds in sets_of(column, size):
        nodes, _ = digests_of(tokens, bounds)
        nodes, at = np.unique(nodes, return_index=True)
        lengths = np.diff(bounds)[at]
        yield tokens[ragged(bounds[at], lengths)], np.concatenate([[0], np.cumsum(lengths)]), nodes, first + at


def count_task(size: int, percent: int, buckets: int, kind: str):
    """Packed signatures or elements, and (node, level, shared, hot shared) of what a task settles itself."""
    huge = 1 << 40

    def keys(tokens, bounds, nodes):
        if kind == "signatures":
            return signatures(tokens, bounds, nodes, percent)
        return element_pairs(tokens, bounds, nodes, percent, kind == "all"), np.empty(0, U), np.empty(0, np.int64)

    def settled(found, bare):
        pairs, group, first, sizes = grouped(np.concatenate(found))
        stays = np.arange(len(pairs)) - first[group] > HOT
        level = (pairs["sig"] & U((1 << LEVEL_BITS) - 1)).astype(np.int64)
        ones = np.ones(int(stays.sum()))
        lone = [np.concatenate(x) for x in zip(*bare)]
        own = tally(np.concatenate([pairs["node"][stays], lone[0]]), np.concatenate([level[stays], lone[1]]), np.concatenate([ones, np.full(len(lone[0]), huge)]), np.concatenate([ones, np.zeros(len(lone[0]))]))
        if len(own[0]):
            yield number_batch(own)
        yield packed(pairs[~stays], buckets, 4)

    def run(batches):
        found, bare = [], []
        for batch in batches:
            for tokens, bounds, nodes, _ in distinct_sets(batch.column(0), size):
                pairs, *lone = keys(tokens, bounds, nodes)
                found.append(pairs)
                bare.append(lone)
                if sum(map(len, found)) > PAIRS_AT_ONCE:
                    yield from settled(found, bare)
                    found, bare = [], []
        if found:
            yield from settled(found, bare)

    return run


def tally_task(buckets: int):
    """(node, level, shared, hot shared) of the signatures that several sets have, packed by the node's bucket."""

    def run(batches):
        kept, found = [np.empty(0, PAIR)], []
        for batch in batches:
            kept += [np.frombuffer(x, PAIR) for x in batch.column(1).to_pylist() if x is not None]
            own = numbers_of(batch, 4)
            if len(own[0]):
                found.append([own[0].view(U), *own[1:]])
        pairs, group, _, sizes = grouped(np.concatenate(kept))
        several = sizes[group] > 1
        pairs, hot = pairs[several], (sizes[group] > HOT)[several]
        found.append([pairs["node"], (pairs["sig"] & U((1 << LEVEL_BITS) - 1)).astype(np.int64), np.ones(len(pairs)), hot.astype(float)])
        columns = tally(*[np.concatenate(x) for x in zip(*found)])
        rows = np.empty(len(columns[0]), TALLY)
        for name, column in zip(TALLY.names, columns):
            rows[name] = column
        if len(rows):
            yield dealt_rows(rows, (rows["node"] >> U(1)) % U(buckets), "tallies")

    return run


def candidate_task(needed: list[int]):
    """(node, mark, k) of the sets that share enough signatures at a level; mark: enough of them hot; k: the most at a level."""
    least = np.array(needed, np.int64)

    def run(batches):
        found = [np.frombuffer(x, TALLY) for batch in batches for x in batch.column(1).to_pylist()]
        if not found:
            return
        rows = np.concatenate(found)
        nodes, levels, k, hot = tally(*[rows[name] for name in TALLY.names])
        enough = k >= least[levels]
        nodes, at = np.unique(nodes[enough], return_inverse=True)
        mark = np.zeros(len(nodes), bool)
        np.logical_or.at(mark, at, (hot >= least[levels])[enough])
        most = np.zeros(len(nodes), np.int64)
        np.maximum.at(most, at, k[enough])
        if len(nodes):
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(mark.astype(np.int32)), pa.array(most)], names=["node", "mark", "k"])

    return run


def star_edges(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of pairs to pass on, edges): groups as stars; hot ones only of nodes with the mark in their lowest bit."""
    pairs, group, first, sizes = grouped(pairs)
    hot = sizes[group] > HOT
    marked = (pairs["node"] & U(1)).astype(bool)
    joins = ~hot | marked
    hub = np.full(len(sizes), -1)
    places = np.flatnonzero(joins)[::-1]
    hub[group[places]] = places  # the first that joins
    other = np.flatnonzero(joins & (hub[group] != np.arange(len(pairs))))
    ends = np.stack([pairs["node"][other] & ~U(1), pairs["node"][hub[group[other]]] & ~U(1)], 1)
    # of a hot group its hub and HOT more are enough to be hot again
    passed = ~hot | (np.arange(len(pairs)) - first[group] < HOT) | (hub[group] == np.arange(len(pairs)))
    return pairs[passed], np.unique(ends, axis=0) if len(ends) else np.zeros((0, 2), U)


def star_task(size: int, percent: int, buckets: int):
    """Packed signatures of the candidates, and the edges a task finds itself."""

    def met(found):
        pairs, edges = star_edges(np.concatenate(found))
        if len(edges):
            yield number_batch([edges[:, 0], edges[:, 1]])
        yield packed(pairs, buckets, 2)

    def run(batches):
        found = []
        for batch in batches:
            mark = batch.column(1).to_numpy(zero_copy_only=False).astype(U)
            for tokens, bounds, nodes, rows in distinct_sets(batch.column(0), size):
                found.append(signatures(tokens, bounds, nodes | mark[rows], percent)[0])
                if sum(map(len, found)) > PAIRS_AT_ONCE:
                    yield from met(found)
                    found = []
        if found:
            yield from met(found)

    return run


def meet_task(batches):
    """Edges of the stars of this partition's signatures."""
    kept, edges = [np.empty(0, PAIR)], [np.zeros((0, 2), U)]
    for batch in batches:
        kept += [np.frombuffer(x, PAIR) for x in batch.column(1).to_pylist() if x is not None]
        edges.append(np.stack([x.view(U) for x in numbers_of(batch, 2)], 1))
    edges.append(star_edges(np.concatenate(kept))[1])
    both = np.unique(np.concatenate(edges), axis=0)
    if len(both):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, k]).view(np.int64)) for k in (0, 1)], names=["a", "b"])


class Trie:
    """Sets in global order; a leaf keeps its set's tail until another set shares its path."""

    __slots__ = ("root", "sets", "percent", "index")

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        # children, leaves (set, depth), shortest, longest, a set if all below are known to be in its component
        self.root = [{}, [], 1 << 60, 0, None]
        self.index: dict[int, dict[int, list[int]]] = {}  # of prefix elements, the sets by component

    def insert(self, k: int, same) -> None:
        own, node, depth = self.sets[k], self.root, 0
        n, group = len(own), same.find(k)
        for token in self.prefix(k):
            self.index.setdefault(token, {}).setdefault(group, []).append(k)
        while True:
            node[2], node[3] = min(node[2], n), max(node[3], n)
            if node[4] is not None and not same.skip(k, node[4]):
                node[4] = None
            if depth == n:
                node[1].append((k, depth))
                return
            token = int(own[depth])
            child = node[0].get(token)
            if child is None:
                node[0][token] = (k, depth + 1)
                return
            if isinstance(child, tuple):
                other, at = child
                fresh = [{}, [], len(self.sets[other]), len(self.sets[other]), other]
                if at == len(self.sets[other]):
                    fresh[1].append((other, at))
                else:
                    fresh[0][int(self.sets[other][at])] = (other, at + 1)
                node[0][token] = child = fresh
            node, depth = child, depth + 1

    def needed(self, n: int, m: int) -> int:
        return -(-self.percent * (n + m) // (100 + self.percent))

    def one_group(self, node: list, same) -> int | None:
        """A set of the node's subtree if all of its sets are known to be in one component."""
        first = None
        for other in [*(x[0] for x in node[1]), *(x[0] if isinstance(x, tuple) else x[4] for x in node[0].values())]:
            if other is None or first is not None and same.find(other) != same.find(first):
                return None
            first = other
        return first

    def prefix(self, k: int) -> list[int]:
        """A linked pair has one of these, the rarest of a set, in common."""
        own = self.sets[k]
        return own[: len(own) - -(-self.percent * len(own) // 100) + 1].tolist()

    def linked(self, k: int, other: int) -> bool:
        a, b = self.sets[k], self.sets[other]
        return len(np.intersect1d(a, b, True)) >= self.needed(len(a), len(b))

    def branches(self, k: int, same) -> set[int]:
        """First elements of the sets that share a prefix element with k and may link it with another component."""
        out: set[int] = set()
        for token in self.prefix(k):
            groups = self.index.get(token)
            if groups is None:
                continue
            for root in [r for r in groups if same.find(r) != r]:
                members = groups.pop(root)
                into = groups.setdefault(same.find(root), members)
                if into is not members:
                    into += members
            for root, members in groups.items():
                if same.skip(k, root):
                    continue
                if self.linked(k, members[-1]):
                    same.join(k, members[-1])
                else:
                    out.update(int(self.sets[m][0]) for m in members)
        return out

    def partners(self, k: int, own: np.ndarray, same) -> None:
        """Calls same.join(k, other) for linked sets, until each component with a partner is joined."""
        n, stack = len(own), [(self.root, 0, 0, 0, False)]
        listed = own.tolist()
        branches = self.branches(k, same)
        if not branches:
            return
        while stack:
            node, depth, at, overlap, left = stack.pop()
            if left:
                node[4] = self.one_group(node, same)
                continue
            if node[4] is not None and same.skip(k, node[4]):
                continue
            for other, end in node[1]:
                if not same.skip(k, other) and overlap >= self.needed(n, end):
                    same.join(k, other)
            if node[4] is None and node is not self.root:
                stack.append((node, 0, 0, 0, True))
            shared = []
            children = node[0].items() if node is not self.root else [(t, node[0][t]) for t in branches]
            for token, child in children:
                p = bisect_left(listed, token, at)
                hit = p < n and listed[p] == token
                here, then = overlap + hit, p + hit
                if isinstance(child, tuple):
                    other, end = child
                    size = len(self.sets[other])
                    need = self.needed(n, size)
                    if here + min(n - then, size - end) < need or same.skip(k, other):
                        continue
                    tail, rest = self.sets[other][end:], own[then:]
                    if len(tail) and len(rest):
                        where = np.searchsorted(rest, tail)
                        where[where == len(rest)] = 0
                        here += int((rest[where] == tail).sum())
                    if here >= need:
                        same.join(k, other)
                elif here + min(n - then, child[3] - depth - 1) >= self.needed(n, child[2]):
                    (shared if hit else stack).append((child, depth + 1, then, here, False))
            stack += shared  # the path that the set shares comes first: it links soonest


def by_rarity(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets with their elements numbered from the block's rarest on."""
    found, counts = np.unique(np.concatenate(sets), return_counts=True)
    rank = np.empty(len(found), np.int32)
    rank[np.argsort(counts.astype(np.int32), kind="stable")] = np.arange(len(found), dtype=np.int32)
    return [np.sort(rank[np.searchsorted(found, x)]) for x in sets]


class Groups:
    """Union-find over a block's sets."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def skip(self, a: int, b: int) -> bool:
        return self.find(a) == self.find(b)

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def join_block(ids: list[int], sets: list[np.ndarray], guests: list[bool], percent: int) -> list[tuple[int, int]]:
    """Each linked set's identifier and its component's smallest; with guests, only their links with the part's own sets are looked for."""
    order = sorted(range(len(ids)), key=lambda k: (guests[k], len(sets[k]), ids[k]))
    ids, sets, guests = [ids[k] for k in order], [sets[k] for k in order], [guests[k] for k in order]
    sets = by_rarity(sets)
    trie, groups, alone = Trie(sets, percent), Groups(len(sets)), not any(guests)
    for k, own in enumerate(sets):
        if alone or guests[k]:
            trie.partners(k, own, groups)
        if not guests[k]:
            trie.insert(k, groups)
    lowest: dict[int, int] = {}
    for k, own in enumerate(ids):
        root = groups.find(k)
        lowest[root] = min(own, lowest.get(root, own))
    return [(own, lowest[groups.find(k)]) for k, own in enumerate(ids) if own != lowest[groups.find(k)]]


def block_task(percent: int):
    """Rows come sorted by block and part; each part is joined when its last row is in."""

    def run(batches):
        key, ids, sets, guests = None, [], [], []

        def finish():
            links = join_block(ids, sets, guests, percent) if len(ids) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for block, part, guest, doc, blob in zip(*columns):
                if (block, part) != key:
                    if key is not None:
                        yield from finish()
                    key, ids, sets, guests = (block, part), [], [], []
                ids.append(doc)
                sets.append(np.frombuffer(blob, "<u8"))
                guests.append(guest)
        if key is not None:
            yield from finish()

    return run


def describe_task(size: int):
    def run(batches):
        for batch in batches:
            for first, tokens, bounds in sets_of(batch.column(1), size):
                a, b = digests_of(tokens, bounds)
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(np.diff(bounds)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["doc_id", "n_shingles", "a", "b"])

    return run


def set_task(size: int):
    def run(batches):
        for batch in batches:
            for first, tokens, bounds in sets_of(batch.column(1), size):
                part = batch.slice(first, len(bounds) - 1)
                # a row with the identifier of another set's representative is not meant
                own = np.flatnonzero(digests_of(tokens, bounds)[0].view(np.int64) == part.column(4).to_numpy())
                blobs = [tokens[bounds[k] : bounds[k + 1]].astype("<u8").tobytes() for k in own.tolist()]
                part = part.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(blobs, pa.binary())], names=["doc_id", "block", "cuts", "tokens"])

    return run


def shared_counts(texts: DataFrame, task, needed: list[int]) -> DataFrame:
    """(node, mark, k) of the texts' sets that share enough with others."""
    buckets = shuffle_parts(texts.sparkSession)
    place = F.coalesce("bucket", F.pmod(F.xxhash64("x0"), F.lit(buckets)).cast("int"))
    carried = texts.mapInArrow(task, "bucket int, pairs binary, x0 long, x1 long, x2 long, x3 long")
    shared = carried.repartition(buckets, place).mapInArrow(tally_task(buckets), "bucket int, tallies binary")
    return shared.repartition(buckets, "bucket").mapInArrow(candidate_task(needed), "node long, mark int, k long")


def picked(docs: DataFrame, classes: DataFrame, counted: DataFrame, needed: str) -> DataFrame:
    """doc_id, text, n, node, mark of one document for each class that shares as much as is needed."""
    wanted = classes.join(counted, F.col("a") == F.col("node")).where(f"k >= {needed}").select("rep", "n", "node", "mark")
    wanted = stored(wanted, "candidates")
    few = wanted.count() <= BROADCAST_ROWS
    chosen = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, F.col("doc_id") == F.col("rep"))
    chosen = stored(chosen.select("doc_id", "text", "n", "node", "mark").dropDuplicates(["doc_id", "node"]), "chosen")
    discard(wanted)
    return chosen


def part_links(rows: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(a, b) of each part of each block: b is the smallest identifier that a is linked to there; rows may have a column guest."""
    guest = F.col("guest") if "guest" in rows.columns else F.lit(False).alias("guest")
    dealt = rows.select("block", "part", guest, "doc_id", "tokens").repartition(buckets, "block", "part")
    return dealt.sortWithinPartitions("block", "part").mapInArrow(block_task(percent), "a long, b long")


def place_task(percent: int, buckets: int):
    """Packed elements of the sets of cut blocks, dealt by element; blocks have elements of their own."""

    def run(batches):
        for batch in batches:
            block, part, doc, order = [batch.column(k).to_numpy() for k in range(4)]
            sets = [np.frombuffer(x, "<u8") for x in batch.column(4).to_pylist()]
            sizes = np.array([len(x) for x in sets], np.int64)
            runs = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // PAIRS_AT_ONCE, prepend=-1))
            for a, b in zip(runs.tolist(), [*runs[1:].tolist(), len(sets)]):
                at = np.repeat(np.arange(a, b), sizes[a:b])
                rows = np.empty(len(at), PLACE)
                rows["sig"] = mix(np.concatenate(sets[a:b]) ^ mix(block.view(U)[at]))
                rows["node"], rows["order"], rows["part"], rows["need"] = doc[at], order[at], part[at], -(-percent * sizes[at] // 100)
                yield dealt_rows(rows, rows["sig"] % U(buckets), "places")

    return run


def earlier_places(rows: np.ndarray):
    """(rows, parts) in portions: each row with every other part in which its element has a set of an earlier component."""
    rows = rows[np.lexsort((rows["order"], rows["part"], rows["sig"]))]
    new = np.ones(len(rows), bool)
    new[1:] = rows["sig"][1:] != rows["sig"][:-1]
    group = np.cumsum(new) - 1
    head = new.copy()
    head[1:] |= rows["part"][1:] != rows["part"][:-1]
    heads = np.flatnonzero(head)  # of each element and part the earliest
    first = np.searchsorted(group[heads], np.arange(int(new.sum())))
    many = np.diff(np.append(first, len(heads)))
    least = np.minimum.reduceat(rows["order"], np.flatnonzero(new)) if len(rows) else np.zeros(0, np.int64)
    live = np.flatnonzero((many[group] > 1) & (rows["order"] > least[group]))
    total = np.cumsum(many[group[live]])
    runs = np.flatnonzero(np.diff(total // PAIRS_AT_ONCE, prepend=-1))
    for a, b in zip(runs.tolist(), [*runs[1:].tolist(), len(live)]):
        own = np.repeat(live[a:b], many[group[live[a:b]]])
        there = heads[ragged(first[group[live[a:b]]], many[group[live[a:b]]])]
        use = (rows["part"][own] != rows["part"][there]) & (rows["order"][there] < rows["order"][own])
        yield rows[own[use]], rows["part"][there[use]]


def summed_visits(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows["part"], rows["node"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["node"][1:] != rows["node"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
    out = rows[new]
    if len(out):
        first = np.flatnonzero(new)
        out["k"], out["need"] = np.add.reduceat(rows["k"], first), np.minimum.reduceat(rows["need"], first)
    return out


def visit_task(buckets: int):
    """Elements that a set shares with sets of earlier components in each other part, of this partition's elements; packed by the node's bucket."""

    def run(batches):
        kept = [np.empty(0, PLACE)] + [np.frombuffer(x, PLACE) for batch in batches for x in batch.column(1).to_pylist()]
        for rows, parts in earlier_places(np.concatenate(kept)):
            visits = np.empty(len(rows), VISIT)
            visits["node"], visits["part"], visits["need"], visits["k"] = rows["node"], parts, rows["need"], 1
            visits = summed_visits(visits)
            if len(visits):
                yield dealt_rows(visits, mix(visits["node"].view(U)) % U(buckets), "visits")

    return run


def guest_task(batches):
    """(node, part) of the sets that share enough elements with the part's sets of earlier components."""
    rows = summed_visits(np.concatenate([np.empty(0, VISIT)] + [np.frombuffer(x, VISIT) for batch in batches for x in batch.column(1).to_pylist()]))
    rows = rows[rows["k"] >= rows["need"]]
    if len(rows):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[name])) for name in ("node", "part")], names=["_node", "_to"])


def guests_of(cut: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(_node, _to): the other parts that a set of a cut block has to visit."""
    placed = cut.select("block", "part", "doc_id", "order", "tokens").mapInArrow(place_task(percent, buckets), "bucket int, places binary")
    shared = placed.repartition(buckets, "bucket").mapInArrow(visit_task(buckets), "bucket int, visits binary")
    return shared.repartition(buckets, "bucket").mapInArrow(guest_task, "_node long, _to int")


def looked_up(table: DataFrame) -> DataFrame:
    """For a join: a stored table of few rows as a broadcast."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def across_parts(rows: DataFrame, linked: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(node, label) once the parts of cut blocks are joined with each other as well.

    First one set of each part's largest component meets those of the other parts. Components
    then stand in an order, the block's largest first. Of two linked sets of different
    components and parts, the one of the later component visits the other's part: there
    it shares enough elements with sets of earlier components. A pair inside a component
    needs no look: it is connected already.
    """
    cut = rows.where("cuts > 1")
    names = cut.select("block", "part", "doc_id")
    known = names.join(linked.withColumnRenamed("node", "_node"), F.col("doc_id") == F.col("_node"), "left").withColumn("group", F.coalesce("label", "doc_id"))
    local = known.groupBy("block", "part", "group").agg(F.count(F.lit(1)).alias("many")).groupBy("block", "part").agg(F.max_by("group", F.struct("many", "group")).alias("_head"))
    # a row for each part of a cut block, so one for many n-grams
    heads = cut.join(F.broadcast(local.select("_head").distinct()), F.col("doc_id") == F.col("_head"), "left_semi")
    found = stored(part_links(heads.withColumn("part", F.lit(0)), buckets, percent), "links")
    ends = linked.select(F.col("node").alias("a"), F.col("label").alias("b"))
    now = stored(components(ends.unionAll(found)), "links")
    known = names.join(now, F.col("doc_id") == F.col("node"), "left").withColumn("group", F.coalesce("label", "doc_id"))
    sizes = known.groupBy("block", "group").agg(F.count(F.lit(1)).alias("many"))
    ranks = sizes.groupBy("block").agg(F.max_by("group", F.struct("many", "group")).alias("largest"), F.min("group").alias("least"))
    ranks = F.broadcast(stored(ranks.withColumnRenamed("block", "_block"), "ranks"))  # a row for each cut block
    group = F.coalesce("label", "doc_id")
    order = F.when(group == F.col("largest"), F.col("least")).when(group == F.col("least"), F.col("largest")).otherwise(group)
    ordered = cut.join(looked_up(now), F.col("doc_id") == F.col("node"), "left").join(ranks, F.col("block") == F.col("_block"))
    visits = stored(guests_of(ordered.withColumn("order", order), buckets, percent), "visits")
    guests = cut.join(looked_up(visits), F.col("doc_id") == F.col("_node")).where("_to <> part")
    sweep(rows.sparkSession)
    visited = F.broadcast(guests.select(F.col("block").alias("_block"), F.col("_to").alias("_part")).distinct())
    hosts = cut.join(visited, (F.col("block") == F.col("_block")) & (F.col("part") == F.col("_part")), "left_semi")
    met = hosts.select("block", "part", F.lit(False).alias("guest"), "doc_id", "tokens").unionAll(guests.select("block", F.col("_to").alias("part"), F.lit(True).alias("guest"), "doc_id", "tokens"))
    return components(ends.unionAll(found).unionAll(part_links(met, buckets, percent)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, n_shingles, component_id of each document; identifiers are integers."""
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = stored(named.mapInArrow(describe_task(size), "doc_id long, n_shingles long, a long, b long"), "sets")
    classes = stored(sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("a", "b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")), "classes")

    buckets = shuffle_parts(spark)
    by_elements = [1]
    first = shared_counts(named.select("text"), count_task(size, percent, buckets, "first"), by_elements)
    chosen = picked(named.where(F.col("doc_id").isNotNull()), classes, first.where("k > 0"), elements_needed(percent, False))
    _, equal, empty = level_parts(percent)
    for kind, least, needed in (("all", by_elements, elements_needed(percent, True)), ("signatures", [int(x) for x in equal - empty], "0")):
        before, counted = chosen, shared_counts(chosen.select("text"), count_task(size, percent, buckets, kind), least)
        chosen = picked(before, classes, counted, needed)
        discard(before)

    place = F.coalesce("bucket", F.pmod(F.xxhash64("x0"), F.lit(buckets)).cast("int"))
    dealt = chosen.select("text", "mark").mapInArrow(star_task(size, percent, buckets), "bucket int, pairs binary, x0 long, x1 long").repartition(buckets, place)
    edges = stored(dealt.mapInArrow(meet_task, "a long, b long").distinct(), "signatures")
    labelled = components(edges).select(F.col("node").alias("_node"), F.col("label").alias("block"))
    members = chosen.join(labelled, F.col("node") == F.col("_node")).select("doc_id", "text", "block", "n", "node")
    blocks = members.groupBy("block").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("many")).where("many > 1")
    cuts = F.ceil(F.col("total") / block_tokens).cast("int")
    rows = members.join(blocks.select("block", cuts.alias("cuts")), "block").select("doc_id", "text", "block", "cuts", "node").mapInArrow(set_task(size), "doc_id long, block long, cuts int, tokens binary")
    rows = stored(rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int")), "blocks")
    linked = stored(part_links(rows, buckets, percent).select(F.col("a").alias("node"), F.col("b").alias("label")), "links")
    # their texts and edges are in the blocks now
    discard(chosen)
    discard(edges)
    if rows.where("cuts > 1").limit(1).count():
        linked = stored(across_parts(rows, linked, buckets, percent), "links")
    discard(rows)
    labels = classes.join(linked, F.col("rep") == F.col("node"), "left").select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.coalesce("label", "rep").alias("label"))
    out = sets.join(labels, (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")) & (F.col("n_shingles") > 0), "left")
    return out.select(F.col("doc_id").alias(doc_id), "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))

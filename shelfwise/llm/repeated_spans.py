"""Removal of byte strings that repeat anywhere, by hash-compared suffix sorting.

A byte goes if a string of LENGTH bytes that covers it starts at a second place,
in the same document or another. Places are the suffixes of all texts; sorting
all of them at once would move every byte many times, so suffixes are first dealt
by content: each window of LENGTH bytes is named by its least GRAM-byte hash (the
leftmost of equals), and consecutive windows that share it form a stretch of
about 1.5 LENGTH bytes. Equal windows have equal names and the same place in them.

1. Each stretch gives a row of numbers: name, 128-bit content hash, place. A name
   that occurs once is done. Equal stretches are counted, before and after the
   shuffle; a content seen twice is repeated as a whole.
2. Of the names with several contents, one stretch for each content is fetched,
   and its suffixes are sorted against those of the same name and place in it: a
   merge sort whose comparisons find the common extension by binary search over
   prefix polynomial hashes, so each takes the logarithm of LENGTH. Neighbours
   with an extension of LENGTH bytes are repeats; their bytes are compared as well.
3. A name with over HOT contents is split further: its windows' hashes are counted
   by a shuffle on name, place and 128-bit hash, which needs no group in one task.

Passages of so many words go the same way: a text is then the row of its words'
64-bit hashes, whatever white space stands between them, and a name is the least
hash of WORD_GRAM words. Both kinds of repeats are judged on the input.

Edge cases: null texts are empty; texts under LENGTH bytes lose nothing; repeated
rows are documents of their own, so longer ones repeat each other; null
identifiers are kept; an empty table gives an empty result; extra columns are
kept unless a result column has the name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, shuffle_parts, stored
from .textops import NON_SPACE, U, Powers, flat_bytes, mix, ragged, slices, span_hashes, window_hashes, word_spans

LENGTH = 400
GRAM = 32
#: Words of a passage, where words are asked for.
WORDS = 50
WORD_GRAM = 8
HOT = 2_000
#: Bytes of stretches that one sort takes.
SORT_BYTES = 2 << 20
#: A longer text is cut into overlapping pieces for naming.
PIECE = 4 << 20
NO_ID = -(1 << 63)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    n = len(raw) - GRAM + 1
    total = np.zeros(n, U)
    whole = np.ascontiguousarray(raw)
    for j in range(0, GRAM, 8):
        words = np.ndarray((n,), "<u8", whole.data, j, (1,))
        total = total * U(0x9E3779B97F4A7C15) + words
        total ^= total >> U(29)
    return mix(total)


class Bytes:
    """Texts as their bytes."""

    kind, gram = np.uint8, GRAM
    grams = staticmethod(gram_hashes)

    def parts(self, column: pa.Array):
        """(first row, units, offsets) of runs of whole rows."""
        return slices(column, PIECE)


class Words:
    """Texts as hashes of their words."""

    kind, gram = U, WORD_GRAM

    @staticmethod
    def grams(raw: np.ndarray) -> np.ndarray:
        return window_hashes(raw, WORD_GRAM)

    def parts(self, column: pa.Array):
        powers = Powers()
        for first, raw, offsets in slices(column):
            starts, ends, rows = word_spans(raw, offsets, NON_SPACE)
            bounds = np.zeros(len(offsets), np.int64)
            np.cumsum(np.bincount(rows, minlength=len(offsets) - 1), out=bounds[1:])
            yield first, span_hashes(raw, starts, ends, powers), bounds


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of `width`."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, U)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(raw: np.ndarray, offsets: np.ndarray, length: int, unit=Bytes):
    """(row, start, windows, place of the name in it, name) of each stretch; starts count from the row's."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, np.zeros(0, U)
    hashes = unit.grams(raw)
    packed = (hashes & ~U((1 << 24) - 1)) | np.arange(len(hashes), dtype=U)
    anchor = (sliding_least(packed, length - unit.gram + 1) & U((1 << 24) - 1)).astype(np.int64)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = ragged(offsets[:-1], counts)
    rows = np.repeat(np.arange(len(counts)), counts)
    anchor = anchor[starts]
    if not len(starts):
        return none, none, none, none, np.zeros(0, U)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(starts)))
    rows, starts, anchor = rows[first], starts[first], anchor[first]
    return rows, starts - offsets[rows], windows, anchor - starts, hashes[anchor]


def name_task(length: int, unit):
    def run(batches):
        import xxhash

        for batch in batches:
            column = batch.column("_text")
            for first, raw, offsets in unit.parts(column):
                n = len(offsets) - 1
                parts = [(0, raw, offsets)]
                if n == 1 and len(raw) > 2 * PIECE:
                    step = PIECE - length + 1
                    parts = [(at, raw[at : at + PIECE], None) for at in range(0, len(raw) - length + 1, step)]
                for base, piece, cuts in parts:
                    cuts = np.array([0, len(piece)]) if cuts is None else cuts
                    rows, starts, windows, place, names = stretches(piece, cuts, length, unit)
                    if not len(rows):
                        continue
                    view, at = memoryview(np.ascontiguousarray(piece)), (starts + cuts[rows])
                    ends = at + windows + length - 1
                    digest = xxhash.xxh3_128_digest
                    contents = np.frombuffer(b"".join([digest(view[a:b]) for a, b in zip(at.tolist(), ends.tolist())]), "<i8").reshape(-1, 2)
                    take = pa.array(first + rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_d").take(take), batch.column("_h").take(take), pa.array(names.view(np.int64)), pa.array(contents[:, 0]), pa.array(contents[:, 1]), pa.array(starts + base), pa.array(windows.astype(np.int32)), pa.array(place.astype(np.int32))],
                        names=["_d", "_h", "name", "c1", "c2", "start", "windows", "place"],
                    )

    return run


STRETCH = "_d long, _h long, name long, c1 long, c2 long, start long, windows int, place int"


def fetch_task(length: int, unit):
    """Bytes of wanted stretches' units: one row each."""

    def run(batches):
        for batch in batches:
            keys = list(zip(batch.column("_d").to_pylist(), batch.column("_h").to_pylist()))
            wanted, rows = batch.column("wanted").to_pylist(), []
            for first, raw, offsets in unit.parts(batch.column("_text")):
                data = memoryview(np.ascontiguousarray(raw))
                for k, start in enumerate(offsets[:-1].tolist(), first):
                    for w in wanted[k]:
                        a = start + w["start"]
                        rows.append((*keys[k], w["name"], w["start"], w["windows"], w["place"], w["once"], w["hot"], bytes(data[a : a + w["windows"] + length - 1])))
                        if len(rows) == 5_000:
                            yield fetched(rows)
                            rows = []
            if rows:
                yield fetched(rows)

    return run


FETCHED = "_d long, _h long, name long, start long, windows int, place int, once boolean, hot boolean, bytes binary"


def fetched(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=[x.split()[0] for x in FETCHED.split(", ")])


class Suffixes:
    """Suffixes of a buffer, compared by prefix polynomial hashes over up to `length` bytes."""

    def __init__(self, raw: np.ndarray, length: int, powers: Powers):
        self.raw, self.length = raw, length
        powers.grow(len(raw) + 1)
        self.down = powers.down
        self.total = np.zeros(len(raw) + 1, U)
        np.cumsum((raw.astype(U) + U(1)) * powers.up[: len(raw)], out=self.total[1:])

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes at p and q, at most `length`."""
        base_p, base_q, down_p, down_q = self.total[p], self.total[q], self.down[p], self.down[q]
        low, high = np.zeros(len(p), np.int64), np.full(len(p), self.length, np.int64)
        # most suffixes compared share all or little: look at the whole first
        same = (self.total[p + self.length] - base_p) * down_p == (self.total[q + self.length] - base_q) * down_q
        low[same] = self.length
        open_ = np.flatnonzero(~same)
        high[open_] -= 1
        while len(open_):
            middle = (low[open_] + high[open_] + 1) >> 1
            equal = (self.total[p[open_] + middle] - base_p[open_]) * down_p[open_] == (self.total[q[open_] + middle] - base_q[open_]) * down_q[open_]
            low[open_] = np.where(equal, middle, low[open_])
            high[open_] = np.where(equal, high[open_], middle - 1)
            open_ = open_[low[open_] < high[open_]]
        return low

    def before(self, p: np.ndarray, q: np.ndarray, ties: bool) -> np.ndarray:
        """Whether the suffix at p sorts before that at q; equal ones give `ties`."""
        shared = self.common(p, q)
        differ = shared < self.length
        out = np.full(len(p), ties)
        d = np.flatnonzero(differ)
        out[d] = self.raw[p[d] + shared[d]] < self.raw[q[d] + shared[d]]
        return out

    def sort(self, places: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places sorted by bucket, then as suffixes: a merge sort of all buckets at once."""
        order = np.argsort(bucket, kind="stable")
        places, bucket = places[order], bucket[order]
        n = len(places)
        new = np.ones(n, bool)
        new[1:] = bucket[1:] != bucket[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, n))
        start_of, size_of = np.repeat(first, sizes), np.repeat(sizes, sizes)
        run, most = 1, int(sizes.max(initial=0))
        while run < most:
            live = np.flatnonzero(size_of > run)
            inner = live - start_of[live]
            pair = start_of[live] + inner // (2 * run) * (2 * run)
            left = inner // run % 2 == 0
            end = start_of[live] + size_of[live]
            low = np.where(left, np.minimum(pair + run, end), pair)
            high = np.where(left, np.minimum(pair + 2 * run, end), pair + run)
            low0 = low.copy()
            # place of each element in the other run of its pair, by binary search
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                # an equal element of the left run comes first
                ahead = np.empty(len(open_), bool)
                for is_left in (True, False):
                    which = np.flatnonzero(left[open_] == is_left)
                    ahead[which] = self.before(places[middle[which]], places[live[open_[which]]], not is_left)
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            own = np.where(left, live - pair, live - (pair + run))
            to = pair + own + (low - low0)
            merged = places.copy()
            merged[to] = places[live]
            places = merged
            run *= 2
        return places, bucket


def repeated_places(raw: np.ndarray, places: np.ndarray, bucket: np.ndarray, piece: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Places whose first `length` bytes stand at another place of the same bucket, verified. piece: of each byte."""
    suffixes = Suffixes(raw, length, powers)
    places, bucket = suffixes.sort(places, bucket)
    near = np.flatnonzero(bucket[1:] == bucket[:-1])
    near = near[suffixes.common(places[near], places[near + 1]) == length]
    if not len(near):
        return np.zeros(0, np.int64)
    p, q = places[near], places[near + 1]
    order = np.lexsort((p, piece[q], piece[p]))
    p, q, near = p[order], q[order], near[order]
    cut = np.ones(len(p), bool)
    cut[1:] = (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
    firsts = np.flatnonzero(cut)
    lasts = np.append(firsts[1:], len(p)) - 1
    wrong = []
    for a, b in zip(firsts.tolist(), lasts.tolist()):
        size = int(p[b] - p[a]) + length
        if not np.array_equal(raw[p[a] : p[a] + size], raw[q[a] : q[a] + size]):
            wrong.append(bucket[near[a : b + 1]])
    out = np.unique(np.concatenate([p, q]))
    if wrong:  # hashes collided: judge those buckets by their bytes
        bad = np.unique(np.concatenate(wrong))
        out = np.setdiff1d(out, places[np.isin(bucket, bad)])
        again = []
        for k in bad.tolist():
            seen: dict[bytes, list[int]] = {}
            for at in places[bucket == k].tolist():
                seen.setdefault(raw[at : at + length].tobytes(), []).append(at)
            again += [at for own in seen.values() if len(own) > 1 for at in own]
        out = np.union1d(out, np.array(again, np.int64))
    return out


SPANS = ["_d", "_h", "a", "b"]


def sort_task(length: int, unit):
    """Rows come sorted by name; whole names are gathered up to SORT_BYTES and sorted together."""

    def run(batches):
        powers = Powers()
        held: list[tuple] = []
        group: list[tuple] = []
        known: set[tuple] = set()
        size = 0

        def finish(rows):
            lengths = np.array([len(r[8]) for r in rows], np.int64) // np.dtype(unit.kind).itemsize
            base = np.cumsum(lengths) - lengths
            raw = np.frombuffer(b"".join([r[8] for r in rows]), unit.kind)
            windows, place = np.array([r[4] for r in rows], np.int64), np.array([r[5] for r in rows], np.int64)
            _, name = np.unique(np.array([r[2] for r in rows]), return_inverse=True)
            inner = ragged(np.zeros(len(rows), np.int64), windows)
            of = np.repeat(np.arange(len(rows)), windows)
            # equal windows have their name's gram at the same distance
            bucket = name[of] * (length + 1) + (place[of] - inner)
            found = repeated_places(raw, base[of] + inner, bucket, np.repeat(np.arange(len(rows)), lengths), length, powers)
            own = np.searchsorted(base, found, "right") - 1
            start = found - base[own] + np.array([r[3] for r in rows], np.int64)[own]
            cut = np.ones(len(found), bool)
            cut[1:] = (own[1:] != own[:-1]) | (start[1:] > start[:-1] + 1)
            first = np.flatnonzero(cut)
            last = np.append(first[1:], len(found)) - 1
            keep = np.array([rows[k][6] for k in own[first].tolist()], bool) if len(first) else np.zeros(0, bool)
            first, last = first[keep], last[keep]
            if len(first):
                who = own[first].tolist()
                yield pa.RecordBatch.from_arrays([pa.array([rows[k][0] for k in who], pa.int64()), pa.array([rows[k][1] for k in who], pa.int64()), pa.array(start[first]), pa.array(start[last] + length)], names=SPANS)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if group and group[-1][2] != row[2]:
                    if len(group) > 1:
                        held += group
                    else:
                        size -= len(group[0][8])
                    group = []
                    if size > SORT_BYTES and held:
                        yield from finish(held)
                        held, size = [], 0
                if not group:
                    known = set()
                if (row[0], row[1], row[3]) not in known:  # a stretch may be fetched from equal rows: once is enough
                    known.add((row[0], row[1], row[3]))
                    group.append(row)
                    size += len(row[8])
        if len(group) > 1:
            held += group
        if held:
            yield from finish(held)

    return run


def window_task(length: int, unit):
    """Each window of a hot name's stretches as numbers."""

    def run(batches):
        powers = Powers()
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                raw = np.frombuffer(row[8], unit.kind)
                at = np.arange(row[4])
                suffixes = Suffixes(raw, length, powers)
                one = mix((suffixes.total[at + length] - suffixes.total[at]) * suffixes.down[at])
                other = Suffixes(np.ascontiguousarray(raw ^ unit.kind(0x5A)), length, powers)
                two = mix((other.total[at + length] - other.total[at]) * other.down[at] + U(1))
                n = row[4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]] * n, pa.int64()), pa.array([row[1]] * n, pa.int64()), pa.array([row[2]] * n, pa.int64()), pa.array((row[5] - at).astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(row[3] + at), pa.array([row[6]] * n, pa.bool_())],
                    names=["_d", "_h", "name", "place", "w1", "w2", "a", "once"],
                )

    return run


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def without(data: bytes, spans: list[list[int]], whole_characters: bool) -> bytes:
    """The rest of the bytes; whole_characters: spans shrink to characters that lie inside them."""
    parts, at = [], 0
    for a, b in spans:
        if whole_characters:
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                b -= 1
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def passages(raw: np.ndarray, own: list[list[int]]) -> list[tuple[int, int]]:
    """Bytes of a text's spans of words."""
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]), NON_SPACE)
    return [(int(starts[a]), int(ends[b - 1])) for a, b in own]


def remove_task(keep: list[str], text: str, with_text: bool, words: bool):
    def run(batches):
        for batch in batches:
            raw, offsets = flat_bytes(batch.column("_text"))
            spans = batch.column("spans").to_pylist()
            n_bytes, n_removed, n_spans, digests, texts, n_words = np.diff(offsets), [], [], [], [], []
            for k, both in enumerate(spans):
                data = raw[offsets[k] : offsets[k + 1]].tobytes()
                own = merged([(s["a"], s["b"]) for s in both if not s["words"]]) if both else []
                n_removed.append(sum(b - a for a, b in own))
                n_spans.append(len(own))
                digests.append(hashlib.sha256(without(data, own, False) if own else data).hexdigest())
                of_words = merged([(s["a"], s["b"]) for s in both if s["words"]]) if both else []
                n_words.append(sum(b - a for a, b in of_words))
                if with_text:
                    gone = merged([*map(tuple, own), *passages(raw[offsets[k] : offsets[k + 1]], of_words)]) if of_words else own
                    texts.append(without(data, gone, True).decode())
            out = {c: batch.column(c) for c in keep if c != text or not with_text}
            out |= {"n_bytes": pa.array(n_bytes), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            if words:
                out["n_passage_words"] = pa.array(n_words, pa.int64())
            if with_text:
                out[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return run


def repeated_spans(keyed: DataFrame, length: int = LENGTH, hot: int = HOT, unit=Bytes) -> tuple[DataFrame, list[DataFrame]]:
    """(_d, _h, a, b): spans of units that repeat in the documents keyed by (_d, _h), with text _text; and the stored tables that they are read from."""
    spark, unit = keyed.sparkSession, unit()
    found = stored(keyed.mapInArrow(name_task(length, unit), STRETCH), "stretches")
    names = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("c1").alias("low"), F.max("c1").alias("high"), F.min("c2").alias("low2"), F.max("c2").alias("high2")).where("n > 1")
    # stored, so that the join can deal one name's rows over several tasks
    names = stored(names.select(F.col("name").alias("_name"), ((F.col("low") != F.col("high")) | (F.col("low2") != F.col("high2"))).alias("mixed")), "names")
    shared = stored(found.join(names, F.col("name") == F.col("_name")).drop("_name"), "shared")
    contents = shared.groupBy("name", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_d", "_h", "start", "windows", "place", "mixed")).alias("one"))
    contents = stored(contents.select("name", "c1", "c2", "n", "one.*"), "contents")
    twice = contents.where("n > 1").select(F.col("name").alias("_n"), F.col("c1").alias("_c1"), F.col("c2").alias("_c2"))
    whole = shared.join(twice, (F.col("name") == F.col("_n")) & (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")), "left_semi")
    whole = whole.select("_d", "_h", F.col("start").alias("a"), (F.col("start") + F.col("windows") + length - 1).alias("b"))
    discard(found)

    mixed = contents.where("mixed")
    many = mixed.groupBy("name").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot).select(F.col("name").alias("_n"), F.lit(True).alias("hot"))
    wanted = mixed.join(many, F.col("name") == F.col("_n"), "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = wanted.groupBy("_d", "_h").agg(F.collect_list(F.struct("name", "start", "windows", "place", (F.col("n") == 1).alias("once"), "hot")).alias("wanted"))
    wanted = stored(wanted.select(F.col("_d").alias("_wd"), F.col("_h").alias("_wh"), "wanted"), "wanted")
    holders = keyed.join(wanted.hint("shuffle_merge"), (F.col("_d") == F.col("_wd")) & (F.col("_h") == F.col("_wh")))
    pieces = stored(holders.select("_d", "_h", "_text", "wanted").mapInArrow(fetch_task(length, unit), FETCHED), "pieces")
    discard(wanted)
    held = [names, shared, contents, pieces]
    parts = shuffle_parts(spark)
    cool = pieces.where(~F.col("hot")).repartition(parts, "name").sortWithinPartitions("name")
    sorted_spans = cool.mapInArrow(sort_task(length, unit), "_d long, _h long, a long, b long")
    spans = whole.unionByName(sorted_spans)
    if many.limit(1).count():
        windows = stored(pieces.where("hot").dropDuplicates(["_d", "_h", "name", "start"]).mapInArrow(window_task(length, unit), "_d long, _h long, name long, place int, w1 long, w2 long, a long, once boolean"), "windows")
        held.append(windows)
        key = ["name", "place", "w1", "w2"]
        again = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*[F.col(c).alias(f"_{c}") for c in key])
        hits = windows.where("once").join(again, [F.col(c) == F.col(f"_{c}") for c in key], "left_semi")
        spans = spans.unionByName(hits.select("_d", "_h", "a", (F.col("a") + length).alias("b")))
    return spans, held


def runs_of(spans: DataFrame, length: int, words: bool) -> DataFrame:
    """Spans of at least `length` units whose starts are closer than that overlap: one for each such stretch of a text is enough."""
    return spans.groupBy("_d", "_h", F.floor(F.col("a") / length)).agg(F.min("a").alias("a"), F.max("b").alias("b")).select("_d", "_h", "a", "b", F.lit(words).alias("words"))


def remove_repeats(docs: DataFrame, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False, hot: int = HOT, words: int | None = None) -> DataFrame:
    """Kept columns, n_bytes, n_removed, n_spans, kept_sha256 of repeated byte strings; with_text: text without the spans, cut at whole characters.

    words: passages of so many words that repeat are found as well; n_passage_words counts their words, and they go from the text.
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["n_passage_words"] if words else [])]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in results]
    keyed = docs.select(*keep, F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("_d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    texts = keyed.select("_d", "_h", "_text")
    of_words = None
    if words:
        if words < WORD_GRAM:
            raise ValueError(f"passages have {WORD_GRAM} words at least")
        found, held = repeated_spans(texts, words, hot, Words)
        of_words = stored(runs_of(found, words, True), "passages")
        for table in held:
            discard(table)
    found, _ = repeated_spans(texts, length, hot)
    runs = runs_of(found, length, False)
    if words:
        runs = runs.unionByName(of_words)
    own = stored(runs.groupBy("_d", "_h").agg(F.collect_set(F.struct("a", "b", "words")).alias("spans")), "spans")
    own = own.select(F.col("_d").alias("_sd"), F.col("_h").alias("_sh"), "spans")
    joined = keyed.join(own.hint("shuffle_merge"), (F.col("_d") == F.col("_sd")) & (F.col("_h") == F.col("_sh")), "left")
    kinds = dict(docs.dtypes)
    columns = [c for c in keep if c != text or not with_text]
    counted = ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", *(["n_passage_words long"] if words else [])]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), *counted, *([f"`{text}` string"] if with_text else [])])
    return joined.select(*columns, "_text", "spans").mapInArrow(remove_task(columns, text, with_text, bool(words)), schema)

"""SentencePiece encoding with seeded merge-dropout, and decoding.

A byte-pair model's merges are applied from an agenda: the pair with the best
score first, the leftmost of equals. Each candidate merge is skipped with
probability `dropout`, decided by a hash keyed by the seed, the chunk's text, the
candidate's place in the chunk and the occurrence, a 64-bit hash of the
document's key and the chunk's position. The same seed gives the same ids on
any cluster; other seeds, and other places of the same word, give others; every
one decodes to the text.

Every occurrence decides its own candidates. The library's segmentation of each
distinct chunk and the candidates met on the way are computed once per batch; an
occurrence that skips none of them has that segmentation, any other takes the
agenda itself. The agenda is processed for all such chunks at once: in each
round every chunk's best remaining candidate is applied. A chunk is a run
of spaces with what follows up to the next space; no piece reaches across such
a boundary. Chunks of over LONG characters take a heap instead.

Edge cases: null and empty texts have no ids and decode to an empty text; a
character that the model writes for a space is spelt in byte pieces, as are
characters that are no piece; repeated rows get equal ids; an empty table gives
an empty result; extra columns are kept unless a result column has the name.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Sent
from .textops import U, gather_lists, mix, ragged, slices, space_chunks

DROPOUT = 0.1
SEED = 20240229
#: Bytes of text that a task encodes at once.
TEXT_AT_ONCE = 4 << 20
LONG = 48
NONE = np.int32(2**31 - 1)
MARK = 0x2581


class Model:
    """A byte-pair model as arrays: characters, pair table, ranks, piece bytes, byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [k for k in range(size) if not (sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k) or sp.is_unused(k))]
        text = {k: sp.id_to_piece(k) for k in plain}
        ids = {v: k for k, v in text.items()}
        self.size = size
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        extra = sorted({c for p in text.values() for c in p if c not in ids})
        symbols = ids | {c: size + k for k, c in enumerate(extra)}
        self.symbols = size + len(extra)
        self.chars = np.full(0x110000, -1, np.int32)
        for c, k in symbols.items():
            if len(c) == 1:
                self.chars[ord(c)] = k
        order = sorted(plain, key=lambda k: (-sp.get_score(k), k))
        rank = np.full(size, NONE, np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.piece_of_rank = np.array(order, np.int32)
        keys, ranks = [], []
        for k in plain:
            p = text[k]
            for cut in range(1, len(p)):
                a, b = symbols.get(p[:cut]), symbols.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.symbols + b)
                    ranks.append(int(rank[k]))
        self.build(np.array(keys, np.int64), np.array(ranks, np.int32))
        spelt = [text[k].replace(chr(MARK), " ").encode() if k in text else b"" for k in range(size)]
        for b, k in enumerate(self.byte_ids.tolist()):
            spelt[k] = bytes([b])
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_at = np.concatenate([[0], np.cumsum([len(x) for x in spelt])]).astype(np.int64)

    def build(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing with linear steps; filled in rounds."""
        self.shift = 64 - max(10, int(len(keys) * 3).bit_length())
        slots = 1 << (64 - self.shift)
        self.slot_keys = np.full(slots, -1, np.int64)
        self.slot_ranks = np.full(slots, NONE, np.int32)
        at, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            free = self.slot_keys[at[left]] == -1
            first = np.unique(at[left[free]], return_index=True)[1]
            put = left[free][first]
            self.slot_keys[at[put]] = keys[put]
            self.slot_ranks[at[put]] = ranks[put]
            left = left[self.slot_keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & (slots - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U) * U(0x9E3779B97F4A7C15)) >> U(self.shift)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair of symbols makes, NONE where it makes none."""
        keys = a.astype(np.int64) * self.symbols + b
        keys[(a < 0) | (b < 0)] = -2
        at, out = self.slot(keys), np.full(len(keys), NONE, np.int32)
        left = np.arange(len(keys))
        while len(left):
            there = self.slot_keys[at[left]]
            same = there == keys[left]
            out[left[same]] = self.slot_ranks[at[left[same]]]
            left = left[~same & (there != -1)]
            at[left] = (at[left] + 1) & (len(self.slot_keys) - 1)
        return out


def skipped(key: np.ndarray, a, b, c, threshold: int) -> np.ndarray:
    """Whether candidates that join places a..b and b..c are skipped."""
    place = (np.asarray(a, np.uint64) << U(42)) ^ (np.asarray(b, np.uint64) << U(21)) ^ np.asarray(c, np.uint64)
    return mix(mix(key ^ (place * U(0x2545F4914F6CDD1D))) + U(0x632BE59BD9B4E019)) < U(threshold)


def merged(model: Model, cps: np.ndarray, key: np.ndarray, threshold: int, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Agenda for chunks of one length: (symbols, which places still begin a symbol). met: takes the candidates as (row, a, b, c)."""
    n, length = cps.shape
    sym = model.chars[cps]
    alive = np.ones((n, length), bool)
    if length == 1:
        return sym, alive
    width = length + 1  # one more place, for the end
    nxt = np.tile(np.minimum(np.arange(1, width + 1), length).astype(np.int32), (n, 1))
    prv = np.tile(np.arange(-1, length, dtype=np.int32), (n, 1))
    prio = np.full((n, length), NONE, np.int32)
    first = model.ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, length - 1)
    if threshold:
        at = np.nonzero(first != NONE)
        gone = skipped(key[at[0]], at[1], at[1] + 1, at[1] + 2, threshold)
        first[at[0][gone], at[1][gone]] = NONE
    if met is not None:
        r, a = np.nonzero(first != NONE)
        met.append((r, a, a + 1, a + 2))
    prio[:, :-1] = first
    rows = np.arange(n)
    while True:
        own = prio[rows]
        k = own.argmin(1)
        best = own[np.arange(len(rows)), k]
        go = best != NONE
        if not go.any():
            break
        rows, k, best = rows[go], k[go], best[go]
        m = nxt[rows, k]
        e = nxt[rows, m]
        sym[rows, k] = model.piece_of_rank[best]
        alive[rows, m] = False
        prio[rows, m] = NONE
        nxt[rows, k] = e
        prv[rows, e] = k
        prio[rows, k] = NONE
        right = np.flatnonzero(e < length)
        left = np.flatnonzero(prv[rows, k] >= 0)
        for which, is_right in ((right, True), (left, False)):
            r = rows[which]
            a = k[which] if is_right else prv[r, k[which]]
            b = nxt[r, a]
            rank = model.ranks(sym[r, a], sym[r, b])
            if threshold:
                at = np.flatnonzero(rank != NONE)
                gone = skipped(key[r[at]], a[at], b[at], nxt[r[at], b[at]], threshold)
                rank[at[gone]] = NONE
            if met is not None:
                at = np.flatnonzero(rank != NONE)
                met.append((r[at], a[at], b[at], nxt[r[at], b[at]]))
            prio[r, a] = rank
    return sym, alive


def merged_long(model: Model, cps: np.ndarray, key: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """The same agenda for one long chunk, with a heap."""
    n = len(cps)
    sym = model.chars[cps].astype(np.int64)
    first = model.ranks(sym[:-1], sym[1:])
    keys = np.array([key], U)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    sym, alive = sym.tolist(), [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int, b: int, rank: int) -> None:
        if rank != NONE and not (threshold and skipped(keys, [a], [b], [nxt[b]], threshold)[0]):
            heapq.heappush(heap, (rank, a, b, nxt[b]))

    for a, rank in enumerate(first.tolist()):
        offer(a, a + 1, rank)
    while heap:
        rank, a, b, end = heapq.heappop(heap)
        if not alive[a] or nxt[a] != b or not (b < n and alive[b]) or nxt[b] != end:
            continue
        sym[a] = int(model.piece_of_rank[rank])
        alive[b] = False
        nxt[a] = end
        if end < n:
            prv[end] = a
            offer(a, end, int(model.ranks(np.array([sym[a]]), np.array([sym[end]]))[0]))
        if prv[a] >= 0:
            p = prv[a]
            offer(p, a, int(model.ranks(np.array([sym[p]]), np.array([sym[a]]))[0]))
    return np.array(sym), np.array(alive)


def laid_out(chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(characters, starts, lengths, hashes) of chunks."""
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    cps = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    cps = np.where(cps == 0x20, MARK, np.where(cps == MARK, 0x110000 - 1, cps))  # a literal mark is spelt in bytes below
    weights = mix(np.arange(1, int(lengths.max(initial=1)) + 1, dtype=np.uint64))
    places = ragged(np.zeros(len(lengths), np.int64), lengths)
    sums = np.zeros(len(cps) + 1, U)
    np.cumsum(mix(cps.astype(U) + U(7)) * weights[places], out=sums[1:])
    return cps, starts, lengths, sums[starts + lengths] - sums[starts]


def keys_of(text_hash: np.ndarray, variant: np.ndarray, seed: int) -> np.ndarray:
    return mix(text_hash ^ mix(variant.astype(U) + U(seed * 0x9E3779B97F4A7C15 % (1 << 64))))


def encode_chunks(model: Model, chunks: list[str], which: np.ndarray, variant: np.ndarray, seed: int, dropout: float, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of chunks[which] under each one's variant. met: takes the candidates of chunks of up to LONG characters."""
    if not len(which):
        return np.zeros(1, np.int64), np.zeros(0, np.int32)
    cps, starts, lengths, text_hash = laid_out(chunks)
    threshold = int(dropout * 2**64) if dropout else 0
    key = keys_of(text_hash[which], variant, seed)
    own_lengths = lengths[which]
    out_sym, out_cp, out_row = [], [], []
    for length in np.unique(own_lengths).tolist():
        rows = np.flatnonzero(own_lengths == length)
        for part in np.array_split(rows, max(1, -(-len(rows) * max(length, 1) // 500_000))):
            at = starts[which[part]]
            if length <= LONG:
                grid = cps[at[:, None] + np.arange(length)]
                own_met = None if met is None else []
                sym, alive = merged(model, grid, key[part], threshold, own_met)
                if own_met:
                    met += [(part[r], a, b, c) for r, a, b, c in own_met]
                r, c = np.nonzero(alive)
                out_sym.append(sym[r, c].astype(np.int64))
                out_cp.append(grid[r, c])
                out_row.append(part[r])
            else:
                for row, a in zip(part.tolist(), at.tolist()):
                    own = cps[a : a + length]
                    sym, alive = merged_long(model, own, int(key[row]), threshold)
                    out_sym.append(sym[alive])
                    out_cp.append(own[alive])
                    out_row.append(np.full(int(alive.sum()), row))
    sym, cp, row = map(np.concatenate, (out_sym, out_cp, out_row))
    order = np.argsort(row, kind="stable")
    sym, cp, row = sym[order], cp[order], row[order]
    strange = (sym < 0) | (sym >= model.size)
    if strange.any():
        cp = np.where(cp == 0x110000 - 1, MARK, cp)
        sizes = np.where(strange, 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF), 1)
        whole = np.repeat(sym, sizes)
        spelt = np.frombuffer("".join(map(chr, cp[strange].tolist())).encode(), np.uint8)
        whole[np.repeat(strange, sizes)] = model.byte_ids[spelt]
        sym, row = whole, np.repeat(row, sizes)
    offsets = np.zeros(len(which) + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=len(which)), out=offsets[1:])
    return offsets, sym.astype(np.int32)


def space_runs(text: str) -> list[str]:
    """A leading space and the text, cut before each run of spaces."""
    return re.findall(r" *[^ ]+| +", " " + text) if text else []


def skips_any(chunks: list[str], codes: np.ndarray, variant: np.ndarray, met: list, seed: int, dropout: float) -> np.ndarray:
    """Whether an occurrence skips a candidate that its chunk meets without dropout; always True for chunks of over LONG characters."""
    _, _, lengths, text_hash = laid_out(chunks)
    out = lengths[codes] > LONG
    if not met:
        return out
    row, a, b, c = (np.concatenate(x) for x in zip(*met))
    order = np.argsort(row, kind="stable")
    a, b, c = a[order], b[order], c[order]
    counts = np.bincount(row, minlength=len(chunks))
    starts = np.cumsum(counts) - counts
    key = keys_of(text_hash[codes], variant, seed)
    for lo in range(0, len(codes), 100_000):
        own = codes[lo : lo + 100_000]
        at = ragged(starts[own], counts[own])
        who = np.repeat(np.arange(lo, lo + len(own)), counts[own])
        out[who[skipped(key[who], a[at], b[at], c[at], int(dropout * 2**64))]] = True
    return out


def encode_column(model: Model, column: pa.Array, doc_keys: np.ndarray, seed: int = SEED, dropout: float = DROPOUT) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of a column's texts."""
    offsets, codes, chunks = space_chunks(column, space_runs, True)
    if not len(codes):
        return offsets, np.zeros(0, np.int32)
    met: list | None = [] if dropout else None
    every = np.arange(len(chunks))
    unit_offsets, units = encode_chunks(model, chunks, every, np.zeros(len(chunks), U), seed, 0, met)
    if not dropout:
        return gather_lists(offsets, codes, unit_offsets, units)
    place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
    variant = mix(np.repeat(doc_keys.astype(U), np.diff(offsets)) + place.astype(U) * U(0xD1342543DE82EF95))
    own = np.flatnonzero(skips_any(chunks, codes, variant, met, seed, dropout))
    own_offsets, own_units = encode_chunks(model, chunks, codes[own], variant[own], seed, dropout)
    codes = codes.copy()
    codes[own] = len(chunks) + np.arange(len(own))
    return gather_lists(offsets, codes, np.concatenate([unit_offsets, unit_offsets[-1] + own_offsets[1:]]), np.concatenate([units, own_units]))


def decode_arrays(model: Model, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the rows' texts: the pieces' bytes without the space put in front."""
    lengths = np.diff(model.spelt_at)[ids]
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    raw = model.spelt[ragged(model.spelt_at[ids], lengths)]
    bounds = total[offsets]
    filled = np.diff(bounds) > 0
    keep = np.ones(len(raw), bool)
    keep[bounds[:-1][filled]] = False
    return bounds - np.concatenate([[0], np.cumsum(filled)]), raw[keep]


def equal_rows(a_offsets: np.ndarray, a: np.ndarray, b_offsets: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = np.diff(a_offsets) == np.diff(b_offsets)
    if same.all():
        wrong = np.concatenate([[0], np.cumsum(a != b)])
        return wrong[a_offsets[1:]] == wrong[a_offsets[:-1]]
    return np.array([np.array_equal(a[p:q], b[r:s]) for p, q, r, s in zip(a_offsets, a_offsets[1:], b_offsets, b_offsets[1:])], bool)


def encode(docs: DataFrame, model_path: str, keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, dropout: float = DROPOUT, text_at_once: int = TEXT_AT_ONCE) -> DataFrame:
    """Kept columns and ids, n_ids, lossless (whether decoding the ids gives the text's bytes); text_at_once bounds a task's memory, the ids are the same."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "n_ids", "lossless")]
    shared = Sent(docs.sparkSession, Model(model_path))

    def run(batches):
        model = shared.value
        for batch in batches:
            for first, raw, raw_offsets in slices(batch.column(text), text_at_once):
                part = batch.slice(first, len(raw_offsets) - 1)
                offsets, ids = encode_column(model, part.column(text), part.column("_key").to_numpy(), seed, dropout)
                same = equal_rows(*decode_arrays(model, offsets, ids), raw_offsets, raw)
                out = {c: part.column(c) for c in keep}
                out |= {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)), "n_ids": pa.array(np.diff(offsets)), "lossless": pa.array(same)}
                yield pa.RecordBatch.from_pydict(out)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ids array<int>, n_ids long, lossless boolean"])
    key = F.xxhash64(F.col(doc_id).cast("string")).alias("_key")
    return docs.select(*dict.fromkeys([*keep, text]), key).mapInArrow(run, schema)


def decode(coded: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and the text that the ids spell; bytes that are no UTF-8 become U+FFFD; null ids give an empty text."""
    keep = [c for c in coded.columns if c != into]
    shared = Sent(coded.sparkSession, Model(model_path))

    def run(batches):
        model = shared.value
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            flat = np.array([i for own in lists if own for i in own], np.int64)
            bounds, raw = decode_arrays(model, np.concatenate([[0], np.cumsum([len(own or ()) for own in lists])]).astype(np.int64), flat)
            data = raw.tobytes()
            texts = [data[a:b].decode(errors="replace") for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {into: pa.array(texts, pa.string())})

    kinds = dict(coded.dtypes)
    return coded.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"`{into}` string"]))

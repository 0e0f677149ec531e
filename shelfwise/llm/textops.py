"""Vectorised text helpers used inside tasks: whole Arrow batches become numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(31))
    x = x * U(0x7FB5D329728EA185)
    x = x ^ (x >> U(27))
    x = x * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


def byte_table(chosen) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chosen)] = True
    return table


#: Words of the contracts: anything but space, tab, LF, VT, FF, CR.
NON_SPACE = byte_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})
#: Item words: digits, a-z and bytes beyond ASCII, after lower-casing A-Z.
ITEM_WORD = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if where is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = 1 << 20):
    """(first row, bytes, offsets) of runs of whole rows, of about `limit` bytes or one longer row."""
    raw, offsets = flat_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", BASE), ("down", INVERSE)):
                table = np.full(size, base, U)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of word bytes; runs end with their row."""
    inside = is_word[raw]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    powers.grow(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U)
    np.cumsum((raw.astype(U) + U(1)) * powers.up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * powers.down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for j in range(size):
        total = total * U(BASE) + words[j : j + n]
    return mix(total + U(size))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, ... of each span, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


#: Two white-space characters in a row, or one at either end.
ODD_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}|^\s|\s$"


def space_chunks(column: pa.Array, odd_chunks, spaced_first: bool) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Cut texts at single spaces: (row offsets into codes, codes, distinct chunks).

    A chunk begins with its space; spaced_first: each row's first chunk gets one
    too. Rows with runs of white space, or with some at an end, are cut by
    odd_chunks(text) instead. Empty rows have no chunk.
    """
    column = column.fill_null("") if column.null_count else column
    odd = pc.match_substring_regex(column, ODD_SPACES).to_numpy(zero_copy_only=False)
    parts = pc.split_pattern(pc.if_else(pa.array(odd), "", column), " ")
    counts = np.diff(parts.offsets.to_numpy()).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes, values = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    row_of = np.repeat(np.arange(len(column)), counts)
    inner = np.ones(len(codes), np.int64)
    if not spaced_first:
        inner[(np.cumsum(counts) - counts)[counts > 0]] = 0
    codes = codes * 2 + inner
    empty = pc.equal(column, "").to_numpy(zero_copy_only=False) | odd
    if empty.any():
        stay = ~empty[row_of]
        codes = codes[stay]
        counts[empty] = 0
    seen = np.zeros(2 * len(values) + 2, bool)
    seen[codes] = True
    used = np.flatnonzero(seen)
    codes = (np.cumsum(seen) - 1)[codes]
    chunks = [" " + values[k >> 1] if k & 1 else values[k >> 1] for k in used.tolist()]
    if odd.any():
        known = {c: k for k, c in enumerate(chunks)}
        rows = np.flatnonzero(odd)
        lists = [odd_chunks(t) for t in column.take(pa.array(rows)).to_pylist()]
        for own in lists:
            for c in own:
                if c not in known:
                    known[c] = len(chunks)
                    chunks.append(c)
        plain, plain_counts = codes, counts.copy()
        counts[rows] = [len(own) for own in lists]
        codes = np.empty(int(counts.sum()), np.int64)
        starts = np.cumsum(counts) - counts
        codes[ragged(starts, plain_counts)] = plain
        if sum(map(len, lists)):
            codes[ragged(starts[rows], counts[rows])] = [known[c] for own in lists for c in own]
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return offsets, codes, chunks


def gather_lists(offsets: np.ndarray, codes: np.ndarray, unit_offsets: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of chunk codes to rows of the chunks' units: (row offsets, units)."""
    lengths = np.diff(unit_offsets)[codes]
    total = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=total[1:])
    return total[offsets], units[ragged(unit_offsets[:-1][codes], lengths)]

"""Token ids in sorted-string-table shards, written and read on Spark tasks.

A shard holds documents in ascending key order: blocks of entries whose keys
share their prefix with the entry before, each block compressed with zstd; a
sparse index with one entry per block; a Bloom filter over all keys; and a
footer. `lookup` finds keys by Bloom filter and binary search of the index and
reads only the blocks that can hold them.

    shard  := block* index bloom footer
    block  := zstd( entry* ),  entry := varint shared, varint rest, varint size, key rest, value
    index  := ( u32 key length, first key, u64 offset, u32 length, u32 entries )*
    footer := u64 index at, u64 bloom at, u64 entries, u64 ids, u32 blocks, u32 id width, u32 hashes, magic

A value is a document's ids as little-endian unsigned integers of `id width`
bytes. A key is 00 for null, else 01 and the identifier: 8 big-endian bytes with
the sign bit flipped, or the UTF-8 text, so byte order is the identifiers' order.

Edge cases: a null text is empty and has only the end id; repeated identifiers
keep all their rows; null identifiers come first; an empty table writes no shard
and reads as an empty result; columns other than the two named are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh_dir, shuffle_parts
from .textops import ragged, slices, space_chunks

BLOCK_BYTES = 256 << 10
BITS_PER_KEY = 10
HASHES = 7
MAGIC = b"SSTIDS01"
FOOTER = "<QQQQIII8s"
FOOTER_SIZE = struct.calcsize(FOOTER)
#: Bytes of text, and distinct chunks of it, that a task encodes at once.
TEXT_AT_ONCE = 4 << 20
CHUNKS_AT_ONCE = 50_000
JOINED = 500
#: Chunks whose ids a process keeps.
REMEMBERED = 400_000


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def key_bytes(value) -> bytes:
    if value is None:
        return b"\0"
    return b"\1" + (struct.pack(">Q", value + (1 << 63)) if isinstance(value, int) else str(value).encode())


def key_value(key: bytes, whole: bool):
    if key == b"\0":
        return None
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if whole else key[1:].decode()


def bloom_places(key: bytes, bits: int) -> list[int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + k * b) % bits for k in range(HASHES)]


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard under a name of its own and renames it when complete."""

    def __init__(self, uri: str, width: int):
        import zstandard

        self.fs, self.path = file_system(uri)
        self.width, self.packer = width, zstandard.ZstdCompressor(level=1)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.at = self.entries = self.ids = 0
        self.block, self.block_size, self.block_entries, self.first, self.last = [], 0, 0, b"", b""
        self.index: list[bytes] = []
        self.keys: list[bytes] = []
        self.blocks = 0

    def add(self, key: bytes, value: bytes) -> None:
        if not self.block:
            self.first, self.last = key, b""
        shared = 0
        for a, b in zip(key, self.last):
            if a != b:
                break
            shared += 1
        head = varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:]
        self.block += [head, value]
        self.block_size += len(head) + len(value)
        self.block_entries += 1
        self.last = key
        self.keys.append(key)
        self.entries += 1
        self.ids += len(value) // self.width
        if self.block_size >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = self.packer.compress(b"".join(self.block))
            self.index.append(struct.pack("<I", len(self.first)) + self.first + struct.pack("<QII", self.at, len(data), self.block_entries))
            self.out.write(data)
            self.at += len(data)
            self.blocks += 1
            self.block, self.block_size, self.block_entries = [], 0, 0

    def close(self) -> None:
        self.flush()
        bits = max(64, len(self.keys) * BITS_PER_KEY)
        bloom = np.zeros(bits, bool)
        for key in self.keys:
            bloom[bloom_places(key, bits)] = True
        index = b"".join(self.index)
        packed = struct.pack("<Q", bits) + np.packbits(bloom).tobytes()
        self.out.write(index + packed + struct.pack(FOOTER, self.at, self.at + len(index), self.entries, self.ids, self.blocks, self.width, HASHES, MAGIC))
        self.out.close()
        self.fs.move(self.temporary, self.path)


class ShardReader:
    """Reads a shard: all entries in order, or those of given keys."""

    def __init__(self, uri: str):
        import zstandard

        self.fs, self.path = file_system(uri)
        self.file, self.unpacker = self.fs.open_input_file(self.path), zstandard.ZstdDecompressor()
        size = self.file.size()
        index_at, bloom_at, self.entries, self.ids, blocks, self.width, _, magic = struct.unpack(FOOTER, self.file.read_at(FOOTER_SIZE, size - FOOTER_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token table")
        tail = self.file.read_at(size - FOOTER_SIZE - index_at, index_at)
        at, self.blocks = 0, []
        for _ in range(blocks):
            n = struct.unpack_from("<I", tail, at)[0]
            first = tail[at + 4 : at + 4 + n]
            self.blocks.append((first, *struct.unpack_from("<QII", tail, at + 4 + n)))
            at += 4 + n + 16
        packed = tail[bloom_at - index_at :]
        self.bits = struct.unpack_from("<Q", packed)[0]
        self.bloom = np.frombuffer(packed, np.uint8, offset=8)

    def block(self, k: int):
        _, offset, length, entries = self.blocks[k]
        data = self.unpacker.decompress(self.file.read_at(length, offset))
        at, key = 0, b""
        for _ in range(entries):
            shared, at = read_varint(data, at)
            rest, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, data[at : at + size]
            at += size

    def __iter__(self):
        for k in range(len(self.blocks)):
            yield from self.block(k)

    def get(self, key: bytes) -> list[bytes]:
        """All values of a key; [] after one look at the Bloom filter for most absent keys."""
        from bisect import bisect_left

        if not all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in bloom_places(key, self.bits)):
            return []
        firsts = [b[0] for b in self.blocks]
        k, found = max(0, bisect_left(firsts, key) - 1), []
        while k < len(firsts) and firsts[k] <= key:
            found += [value for own, value in self.block(k) if own == key]
            k += 1
        return found

    def array(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, f"<u{self.width}").astype("<u4")


def safe_cuts(text: str) -> list[str]:
    """Pieces of a text cut where a space stands between two characters that are none."""
    return re.split(r"(?<=\S)(?= \S)", text) if text else []


class ChunkEncoder:
    """Ids of distinct chunks. Chunks that begin with their space and end without one are encoded
    many in one string, and told apart by their tokens' bytes: an encoding costs as much as its text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        sizes = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(sizes.values()) + 1, np.int64)
        for token, k in sizes.items():
            self.bytes_of[k] = len(token)  # one character stands for one byte

        self.places: dict[str, int] = {}
        self.starts, self.lengths, self.units = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def known(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, ids): where each chunk's ids stand; up to REMEMBERED chunks are kept for the next texts."""
        at = np.fromiter((self.places.get(c, -1) for c in chunks), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        fresh = [chunks[k] for k in new.tolist()]
        offsets, ids = self(fresh)
        at[new] = len(self.starts) + np.arange(len(new))
        starts = np.concatenate([self.starts, len(self.units) + offsets[:-1]])
        lengths, units = np.concatenate([self.lengths, np.diff(offsets)]), np.concatenate([self.units, ids])
        if len(starts) <= REMEMBERED:
            self.places.update(zip(fresh, at[new].tolist()))
            self.starts, self.lengths, self.units = starts, lengths, units
        return starts[at], lengths[at], units

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the chunks, in order."""
        joins = np.fromiter((c[:1] == " " and len(c) > 1 and not (c[1].isspace() or c[-1].isspace()) for c in chunks), bool, len(chunks))
        lengths, found = np.zeros(len(chunks), np.int64), []
        together, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
        for lo in range(0, len(together), CHUNKS_AT_ONCE):
            own = [chunks[k] for k in together[lo : lo + CHUNKS_AT_ONCE].tolist()]
            texts = ["".join(own[k : k + JOINED]) for k in range(0, len(own), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.cumsum(np.fromiter((len(c.encode()) for c in own), np.int64, len(own)))
            at = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends, "left") + 1
            lengths[together[lo : lo + CHUNKS_AT_ONCE]] = np.diff(at, prepend=0)
            found.append(ids)
        first = np.concatenate([*found, np.zeros(0, np.uint32)])
        found = []
        for lo in range(0, len(alone), CHUNKS_AT_ONCE):
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast([chunks[k] for k in alone[lo : lo + CHUNKS_AT_ONCE].tolist()], add_special_tokens=False)]
            lengths[alone[lo : lo + CHUNKS_AT_ONCE]] = list(map(len, encoded))
            found += [np.array([i for ids in encoded for i in ids], np.uint32)]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(int(offsets[-1]), np.uint32)
        for which, part in ((together, first), (alone, np.concatenate([*found, np.zeros(0, np.uint32)]))):
            ids[ragged(offsets[which], lengths[which])] = part
        return offsets, ids


def process_encoder(path: str) -> ChunkEncoder:
    """This Python process's encoder for a vocabulary: tasks that follow in it find its frequent chunks known."""
    import sys
    from types import ModuleType

    held = sys.modules.setdefault("_token_table_encoders", ModuleType("_token_table_encoders"))
    if path not in vars(held):
        setattr(held, path, ChunkEncoder(path))
    return getattr(held, path)


def encode_column(encoder: ChunkEncoder, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of a column's texts, each followed by the end id.

    The byte-level pattern never joins characters across a space that follows
    another character, so each distinct chunk is encoded once per batch.
    """
    offsets, codes, chunks = space_chunks(column, safe_cuts, False)
    starts, lengths, units = encoder.known(chunks)
    total = np.concatenate([[0], np.cumsum(lengths[codes])])
    inner, ids = total[offsets], units[ragged(starts[codes], lengths[codes])]
    n = len(column)
    out = np.full(len(ids) + n, end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[inner[1:] + np.arange(n)] = False
    out[keep] = ids
    return inner + np.arange(n + 1), out


def shard_task(tokenizer_path: str, folder: str, end_id: int, width: int):
    """Writes the partition's rows, which come in key order, as one shard; yields its manifest row."""

    def write(batches):
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = process_encoder(tokenizer_path)
        part, writer = TaskContext.get().partitionId(), None
        uri = f"{folder}/shard-{part:06d}.sst"
        for batch in batches:
            if not batch.num_rows:
                continue
            writer = writer or ShardWriter(uri, width)
            for first, _, rows in slices(batch.column(1), TEXT_AT_ONCE):
                n = len(rows) - 1
                offsets, ids = encode_column(encoder, batch.column(1).slice(first, n), end_id)
                raw, cuts = ids.astype(f"<u{width}").tobytes(), (offsets * width).tolist()
                for key, a, b in zip(batch.column(0).slice(first, n).to_pylist(), cuts, cuts[1:]):
                    writer.add(key_bytes(key), raw[a:b])
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [uri], "docs": [writer.entries], "ids": [writer.ids]})

    return write


def write_tables(docs: DataFrame, tokenizer_path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, width: int = 2, shards: int | None = None) -> list[tuple[int, str, int, int]]:
    """Writes shards in ascending key order; returns (part, path, documents, ids) of each, a row per shard.

    width: bytes of an id, 2 for vocabularies of up to 65,536 ids; a vocabulary
    that does not fit is refused. Documents of one identifier stand in the order
    of a hash of their texts, so their places do not depend on the shuffle.
    """
    ids = process_encoder(tokenizer_path).tokenizer.get_vocab_size()
    if max(ids, end_id + 1) > 1 << 8 * width:
        raise ValueError(f"{ids} ids do not fit in {width} bytes")
    file_system(folder)[0].create_dir(file_system(folder)[1], recursive=True)
    shards = shards or shuffle_parts(docs.sparkSession)
    ordered = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t")).repartitionByRange(shards, F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), F.xxhash64("t"))
    manifest = ordered.mapInArrow(shard_task(tokenizer_path, folder, end_id, width), "part long, path string, docs long, ids long")
    return sorted((r.part, r.path, r.docs, r.ids) for r in manifest.collect())


def read_task(whole: bool):
    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, rows = ShardReader(path), []
                for key, value in reader:
                    ids = reader.array(value)
                    rows.append((key_value(key, whole), start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                    if len(rows) == 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        rows = []
                if rows:
                    key_type = pa.int64() if whole else pa.string()
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), *(pa.array(x, pa.int64()) for x in columns[1:])], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_digests(spark: SparkSession, manifest: list[tuple[int, str, int, int]], whole: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards."""
    starts, total = [], 0
    for _, path, _, ids in manifest:
        starts.append((path, total))
        total += ids
    shards = spark.createDataFrame(starts, "path string, start long")
    if starts:
        shards = shards.repartitionByRange(min(len(starts), 4096), "start")
    kind = "long" if whole else "string"
    return shards.mapInArrow(read_task(whole), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, manifest: list[tuple[int, str, int, int]], keys: list, text_keys: bool = False) -> DataFrame:
    """(key, ids) for a stated list of identifiers; shards are searched in parallel."""
    shards = spark.createDataFrame([(m[1],) for m in manifest], "path string").repartition(max(1, min(len(manifest), 4096)), "path")

    def find(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = ShardReader(path)
                rows = [(k, reader.array(v).astype(np.int32).tolist()) for k in keys for v in reader.get(key_bytes(k))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.int32()))], names=["key", "ids"])

    return shards.mapInArrow(find, f"key {'string' if text_keys else 'long'}, ids array<int>")


def digests(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    spark = docs.sparkSession
    manifest = write_tables(docs, tokenizer_path, fresh_dir(spark, "token-tables"), doc_id, text, end_id)
    return read_digests(spark, manifest, dict(docs.dtypes)[doc_id] != "string")

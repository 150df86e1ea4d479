"""Token ids in sorted-string-table shards.

A shard holds documents in ascending order of their key in blocks, then a sparse
index (first key and place of each block), a Bloom filter of all keys, and a
footer of fixed size. In a block, a key is stored as the number of bytes that it
shares with the key before it and the rest; the block is compressed. Each of
these sections ends with a newline, which the reader skips: so Spark's own text
writer, with its commit protocol, writes shards to any file system it knows, and
a task that is lost or runs twice leaves no half-written shard.

Layout of the footer (little-endian, FOOTER_SIZE bytes before the last newline):
index offset, index length, filter offset, filter length, documents, ids
(unsigned 64-bit each), bytes per id (32-bit), CRC-32 of index and filter
(32-bit), first key (9 bytes, right-padded), magic (7 bytes).
"""

from __future__ import annotations

import bisect
import hashlib
import io
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samewise.llm.common import mapped, new_path
from samewise.llm.pretokens import library_table

MAGIC = b"SWSST1\0"
_FOOTER = struct.Struct("<6QII9s7s")
FOOTER_SIZE = _FOOTER.size
BLOCK_BYTES = 1 << 16
BITS_PER_KEY, PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    """Bytes that sort as the numbers do, null first."""
    return b"" if doc_id is None else b"\x01" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key else None


def _number(value: int) -> bytes:
    out = bytearray()
    while value >= 0x80:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _read_number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        if byte < 0x80:
            return value, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    b |= 1
    return [(a + i * b) % bits for i in range(PROBES)]


def write_shard(entries: Iterable[tuple[bytes, np.ndarray]], width: int, block_bytes: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The sections of one shard; entries come in ascending order of their keys, equal keys allowed."""
    packer, kind = zstandard.ZstdCompressor(level=1), f"<u{width}"
    at, docs, ids, first, before = 0, 0, 0, None, b""
    block, index, keys = bytearray(), [], []
    block_key = b""

    def section(data: bytes) -> bytes:
        nonlocal at
        at += len(data) + 1
        return data

    for key, values in entries:
        if not block:
            block_key, before = key, b""
        first = key if first is None else first
        shared = next((i for i, (x, y) in enumerate(zip(before, key, strict=False)) if x != y), min(len(before), len(key)))
        block += _number(shared) + _number(len(key) - shared) + key[shared:] + _number(len(values)) + values.astype(kind).tobytes()
        before, docs, ids = key, docs + 1, ids + len(values)
        keys.append(key)
        if len(block) >= block_bytes:
            data = packer.compress(bytes(block))
            index.append((block_key, at, len(data)))
            yield section(data)
            block = bytearray()
    if docs == 0:
        return
    if block:
        data = packer.compress(bytes(block))
        index.append((block_key, at, len(data)))
        yield section(data)
    listing = b"".join(_number(len(k)) + k + _number(place) + _number(size) for k, place, size in index)
    bits = max(64, BITS_PER_KEY * docs)
    places = np.fromiter((p for k in keys for p in _probes(k, bits)), np.int64, docs * PROBES)
    flags = np.zeros(bits, np.uint8)
    flags[places] = 1
    bloom = np.packbits(flags).tobytes()
    index_at, index_size = at, len(listing)
    yield section(listing)
    bloom_at = at
    yield section(bloom)
    yield section(_FOOTER.pack(index_at, index_size, bloom_at, len(bloom), docs, ids, width, zlib.crc32(bloom, zlib.crc32(listing)), first.ljust(9, b"\0"), MAGIC))


class Shard:
    """A reader of one shard: its bytes, or a file object that can seek, of which it reads footer, index and filter, then single blocks."""

    def __init__(self, data: bytes | BinaryIO):
        self.file = io.BytesIO(data) if isinstance(data, bytes) else data
        footer = self._read(self.file.seek(0, io.SEEK_END) - FOOTER_SIZE - 1, FOOTER_SIZE)
        if len(footer) < FOOTER_SIZE:
            raise ValueError("not a shard")
        index_at, index_size, bloom_at, bloom_size, self.docs, self.ids, self.width, crc, _, magic = _FOOTER.unpack(footer)
        if magic != MAGIC:
            raise ValueError("not a shard")
        listing, self.bloom = self._read(index_at, index_size), self._read(bloom_at, bloom_size)
        if zlib.crc32(self.bloom, zlib.crc32(listing)) != crc:
            raise ValueError("the shard's index is damaged")
        self.bits = max(64, BITS_PER_KEY * self.docs)
        self.first_keys: list[bytes] = []
        self.places: list[tuple[int, int]] = []
        at = 0
        while at < len(listing):
            size, at = _read_number(listing, at)
            self.first_keys.append(listing[at : at + size])
            place, at = _read_number(listing, at + size)
            length, at = _read_number(listing, at)
            self.places.append((place, length))

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(max(0, at))
        return self.file.read(size)

    def _block(self, number: int) -> Iterator[tuple[bytes, np.ndarray]]:
        place, length = self.places[number]
        data, at, key = zstandard.ZstdDecompressor().decompress(self._read(place, length)), 0, b""
        while at < len(data):
            shared, at = _read_number(data, at)
            rest, at = _read_number(data, at)
            key = key[:shared] + data[at : at + rest]
            count, at = _read_number(data, at + rest)
            yield key, np.frombuffer(data, f"<u{self.width}", count, at)
            at += count * self.width

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for number in range(len(self.places)):
            yield from self._block(number)

    def may_have(self, key: bytes) -> bool:
        return all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in _probes(key, self.bits))

    def get(self, key: bytes) -> np.ndarray | None:
        """The ids of the first document with this key."""
        if not self.may_have(key):
            return None
        for number in range(max(0, bisect.bisect_left(self.first_keys, key) - 1), len(self.places)):
            if self.first_keys[number] > key:
                return None
            for held, values in self._block(number):
                if held == key:
                    return values
        return None


def write_token_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None) -> None:
    """Encode each text (null: empty) with the tokenizers library, append ``end_id``, write shards below ``path``.

    Shards follow one another in ascending doc_id order (null first; rows with
    equal doc_ids by a hash of the text), as a range partitioning with a sort inside deals
    them; the rows of one shard are streamed.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = ordered.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def entries(batches):
        table = library_table(tokenizer_path)
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            keys = map(key_of, batch.column(0).to_pylist())
            yield from zip(keys, (np.concatenate([ids, tail]) for ids in table.encode(batch.column(1).to_pylist())), strict=True)

    def work(width, batches):
        for part in write_shard(entries(batches), width):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["section"])

    sections = mapped(ordered, partial(work, 2 if _most_id(tokenizer_path, end_id) < 1 << 16 else 4), "section binary")
    sections.select(F.col("section").cast("string")).write.option("lineSep", "\n").text(path)


def _most_id(tokenizer_path: str, end_id: int | None) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True) - 1, end_id or 0)


def read_token_shards(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the shards below ``path``, read back from them.

    Returns doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    and, if asked for, the ids. Where a shard starts is a running sum over the
    shards' footers, one row per shard.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > FOOTER_SIZE)

    def field(offset: int, size: int):
        return F.expr(f"substring(content, cast(length - {FOOTER_SIZE} + {offset} as int), {size})")

    footers = files.select("path", field(40, 8).alias("ids"), field(56, 9).alias("first_key"))
    footers = footers.select("path", F.conv(_reversed_hex("ids"), 16, 10).cast("long").alias("ids"), "first_key")
    before = F.coalesce(F.sum("ids").over(W.orderBy("first_key", "path").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = footers.select("path", before.alias("shard_start"))

    def work(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                at, rows = 0, []
                for key, values in Shard(data.as_py()):
                    wide = values.astype("<u4")
                    rows.append((path, id_of(key), at, len(values), zlib.crc32(wide.tobytes()), wide.tolist() if with_ids else None))
                    at += len(values)
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
                yield pa.RecordBatch.from_arrays(columns[: 5 + with_ids], names=["path", "doc_id", "local", "n_tokens", "ids_crc32", "ids"][: 5 + with_ids])

    schema = "path string, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = mapped(files.select("path", "content"), work, schema)
    out = rows.join(starts, "path").withColumn("start", F.col("shard_start") + F.col("local"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)


def _reversed_hex(name: str):
    """Hex digits of eight little-endian bytes, the highest byte first."""
    return F.concat(*[F.hex(F.expr(f"substring({name}, {i}, 1)")) for i in range(8, 0, -1)])


def token_shards(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, path: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` (to the shared folder if no path is given) and return their documents as read back."""
    path = path or new_path(docs.sparkSession, "token-shards")
    write_token_shards(docs, path, tokenizer_path, end_id)
    return read_token_shards(docs.sparkSession, path)

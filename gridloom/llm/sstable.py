"""Sorted-string-table shards of token ids: prefix-compressed blocks, a sparse block index, a Bloom filter and a footer.

A shard holds documents in ascending order of their key:

    block*   entries (shared, rest, value length as varints; rest of the key; value), every RESTART-th with its whole
             key; then the offsets of those entries and their number as 32-bit integers; all compressed with zstd
    index    for each block: last key length (16-bit), last key, offset (64-bit), stored length (32-bit)
    filter   bits of a Bloom filter over all keys
    footer   offsets and lengths of index and filter, bits a key, documents, tokens, bytes an id, magic

All integers are little-endian. A key is 0 for a null identifier or 1 and the identifier as a big-endian integer with
its sign bit turned over, then 4 bytes that count rows of equal identifier; so keys sort as identifiers do.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, new_dir, ship_package, tidied

RESTART, BLOCK_BYTES, SHARD_BYTES, BITS_A_KEY, MAGIC = 16, 1 << 16, 1 << 27, 10, b"GLSST001"
FOOTER = struct.Struct("<QQQQIQQI8s")


def key_of(doc_id: int | None, nth: int = 0) -> bytes:
    return (b"\0" + bytes(8) if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))) + struct.pack(">I", nth)


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:9])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bits(key: bytes, n_bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * b) % n_bits for i in range(7)]


class Writer:
    """Writes one shard to an open binary file; keys must come in ascending order."""

    def __init__(self, sink, id_bytes: int) -> None:
        import zstandard

        self.sink, self.id_bytes, self.pack = sink, id_bytes, zstandard.ZstdCompressor(level=1).compress
        self.block, self.restarts, self.in_block, self.last = bytearray(), [], 0, b""
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[bytes] = []
        self.at = self.n_docs = self.n_tokens = 0

    def add(self, key: bytes, value: bytes) -> None:
        if self.n_docs and key <= self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.in_block % RESTART:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.restarts.append(len(self.block))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last, self.in_block = key, self.in_block + 1
        self.hashes.append(key)
        self.n_docs += 1
        self.n_tokens += len(value) // self.id_bytes
        if len(self.block) >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        if self.in_block:
            raw = bytes(self.block) + struct.pack(f"<{len(self.restarts)}II", *self.restarts, len(self.restarts))
            stored = self.pack(raw)
            self.sink.write(stored)
            self.index.append((self.last, self.at, len(stored)))
            self.at += len(stored)
            self.block, self.restarts, self.in_block = bytearray(), [], 0

    def close(self) -> None:
        self._end_block()
        index = b"".join(struct.pack("<H", len(k)) + k + struct.pack("<QI", at, n) for k, at, n in self.index)
        n_bits = max(64, self.n_docs * BITS_A_KEY + 7 & ~7)
        bits = np.zeros(n_bits, np.uint8)
        for key in self.hashes:
            bits[_bits(key[:9], n_bits)] = 1
        bloom = np.packbits(bits).tobytes()
        self.sink.write(index + bloom + FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), BITS_A_KEY, self.n_docs, self.n_tokens, self.id_bytes, MAGIC))


class Reader:
    """Reads one shard from a seekable binary file: get() by binary search, or all entries in order."""

    def __init__(self, source) -> None:
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - FOOTER.size)
        at, n, bloom_at, bloom_n, _, self.n_docs, self.n_tokens, self.id_bytes, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        source.seek(at)
        raw, i, self.keys, self.blocks = source.read(n), 0, [], []
        while i < len(raw):
            k = struct.unpack_from("<H", raw, i)[0]
            self.keys.append(raw[i + 2 : i + 2 + k])
            self.blocks.append(struct.unpack_from("<QI", raw, i + 2 + k))
            i += 14 + k
        source.seek(bloom_at)
        self.bloom = np.frombuffer(source.read(bloom_n), np.uint8)
        self.dtype = np.dtype(f"<u{self.id_bytes}")

    def _block(self, i: int) -> tuple[bytes, int, list[int]]:
        at, n = self.blocks[i]
        self.source.seek(at)
        raw = self.unpack(self.source.read(n))
        count = struct.unpack_from("<I", raw, len(raw) - 4)[0]
        end = len(raw) - 4 - 4 * count
        return raw, end, list(struct.unpack_from(f"<{count}I", raw, end))

    @staticmethod
    def _entries(raw: bytes, at: int, end: int) -> Iterator[tuple[bytes, bytes]]:
        key = b""
        while at < end:
            shared, at = _read_varint(raw, at)
            rest, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            key = key[:shared] + raw[at : at + rest]
            at += rest
            yield key, raw[at : at + size]
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.blocks)):
            raw, end, _ = self._block(i)
            yield from self._entries(raw, 0, end)

    def may_hold(self, key: bytes) -> bool:
        n_bits = len(self.bloom) * 8
        return all(self.bloom[b >> 3] >> (7 - (b & 7)) & 1 for b in _bits(key[:9], n_bits))

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        """The ids of a document, or None."""
        key = key_of(doc_id, nth)
        if not self.may_hold(key):
            return None
        i = bisect.bisect_left(self.keys, key)
        if i == len(self.keys):
            return None
        raw, end, restarts = self._block(i)
        first = lambda r: next(self._entries(raw, r, end))[0]  # noqa: E731  an entry at a restart has its whole key
        j = max(0, bisect.bisect_right(restarts, key, key=first) - 1)
        for found, value in self._entries(raw, restarts[j], end):
            if found >= key:
                return np.frombuffer(value, self.dtype) if found == key else None
        return None


def _open(path: str, mode: str):
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path)
    if mode == "r":
        return where.open_input_file(name)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    return where.open_output_stream(name)


def write_shards(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encodes every whole text (null: empty), appends end_id, writes shards below path; returns the manifest.

    The manifest has a row for each shard: path, first_key, last_key, n_docs, n_tokens. Documents are dealt to tasks by
    ranges of their identifier; one task holds a block and its shard's keys in memory. A task that runs again writes new
    files, and only files named in the manifest count. Rows of equal identifier are kept all, ordered by text; a null
    identifier comes first. Other columns play no part. An empty table gives an empty manifest.
    """
    ship_package(docs.sparkSession)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import sstable as S
        from gridloom.llm.tokenize import encoder

        tok = encoder(tokenizer)
        end, names = np.array([end_id], tok.dtype).tobytes(), ["path", "first_key", "last_key", "n_docs", "n_tokens"]
        writer, name, first, last_id, nth = None, "", b"", object(), 0
        done = []

        def close() -> None:
            writer.close()
            writer.sink.close()
            done.append((name, first, writer.last, writer.n_docs, writer.n_tokens))

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, len(keys), 2000):
                for k, raw in zip(keys[i : i + 2000], tok.encode(texts[i : i + 2000]), strict=True):
                    nth, last_id = (nth + 1 if k == last_id else 0), k
                    if writer is not None and writer.at >= S.SHARD_BYTES:
                        close()
                        writer = None
                    if writer is None:
                        name, first = f"{path}/shard-{uuid.uuid4().hex}.sst", S.key_of(k, nth)
                        writer = S.Writer(S._open(name, "w"), tok.dtype.itemsize)
                    writer.add(S.key_of(k, nth), raw + end)
        if writer is not None:
            close()
        if done:
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    ranged = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text")).repartitionByRange("key").sortWithinPartitions("key", "text")
    return durable(ranged.mapInArrow(tidied(write), "path string, first_key binary, last_key binary, n_docs long, n_tokens long"), "shards-manifest")


def read_shards(spark: SparkSession, manifest: DataFrame, id_name: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every document of the shards: id, start (ids of all documents before it), n_tokens, ids_crc32, and with_ids its ids.

    The manifest's few numbers a shard (128 MB of compressed ids each) are summed up on the driver.
    """
    shards, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: bytes(r["first_key"])):
        shards.append((r["path"], start))
        start += r["n_tokens"]
    tasks = spark.createDataFrame(shards, "path string, base long").repartition(max(1, min(len(shards), 10_000)))

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import sstable as S
        from gridloom.llm.tokenize import crc32_of

        def batch_of(rows: list):
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)][: 5 if with_ids else 4]
            return pa.record_batch(made, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(made)])

        for batch in batches:
            for name, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with S._open(name, "r") as source:
                    reader = S.Reader(source)
                    for key, value in reader:
                        ids = np.frombuffer(value, reader.dtype)
                        rows.append((S.id_of(key), at, len(ids), crc32_of(ids), ids.astype(np.int32) if with_ids else None))
                        at += len(ids)
                        if len(rows) == 1000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return tasks.mapInArrow(tidied(read), schema).withColumnRenamed("key", id_name)


def encode_to_shards(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """write_shards() to path (a new shared folder) and read_shards() of what it wrote."""
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, tokenizer, path or new_dir(spark, "shards"), id_col, text_col, end_id), id_col)

"""Token ids in sorted-string-table shards.

Documents are dealt by ranges of their id, sorted, encoded and written as one file per range, so that files and
entries are in ascending order of id.  A file is

    blocks of entries | block index | Bloom filter | footer

An entry is: varint of key bytes shared with the entry before (0 for a block's first), varint of further key
bytes, varint of value bytes, the further key bytes, the value.  A key is a zero byte for a null id, or a one
byte and the id as eight big-endian bytes with the sign turned, and then four bytes that number rows of the same
id.  A value is the document's token ids, little-endian, 16 bits each where the vocabulary allows, else 32,
with the end id last.  A block is closed at :data:`BLOCK` bytes.  The index has, per block, its first key,
offset and length; the Bloom filter has ten bits and seven probes per id.  The footer holds offsets, counts and
a magic word.

Look-ups ask the filter, search the index by bisection and read one block.  Shards are written under a
temporary name and renamed, and their content depends only on the input, so a task that runs twice does no harm.

Null and empty texts are documents of the end id alone.  Rows of one id are kept all, in order of text.  An empty
table gives no rows.  Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import checkpoint
from kerbline.llm.tokens import Encoder, default_path, slices

BLOCK = 1 << 16
END_ID = 0
MAGIC = b"KSST0001"
#: index offset, Bloom offset, entries, ids, bytes per id, magic
FOOTER = struct.Struct("<QQQQQ8s")
_INDEX = struct.Struct("<QQH")
_PROBES, _BITS = 7, 10
#: Shards whose bounds are broadcast for look-ups.
SHARDS_SENT = 200_000
MANIFEST = "shard long, path string, first_id long, last_id long, n_docs long, n_ids long, n_bytes long"


def key_of(doc_id: int | None, number: int = 0) -> bytes:
    return (b"\0" if doc_id is None else b"\1" + (doc_id + (1 << 63)).to_bytes(8, "big")) + number.to_bytes(4, "big")


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else int.from_bytes(key[1:9], "big") - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[at] & 127) << shift
        at += 1
        if b[at - 1] < 128:
            return n, at
        shift += 7


def _probes(doc_id: int | None, bits: int) -> list[int]:
    h = zlib.crc32(key_of(doc_id)), zlib.crc32(key_of(doc_id), 0x5BD1E995) | 1
    return [(h[0] + k * h[1]) % bits for k in range(_PROBES)]


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Writer:
    """Writes one shard from entries in ascending order of id."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.at = self.ids = self.number = 0
        self.block, self.index, self.before, self.doc_ids, self.last = bytearray(), [], b"", [], None

    def add(self, doc_id: int | None, value: bytes) -> None:
        self.number = self.number + 1 if self.doc_ids and self.last == doc_id else 0
        key, shared = key_of(doc_id, self.number), 0
        if self.block:
            while shared < min(len(key), len(self.before)) and key[shared] == self.before[shared]:
                shared += 1
        else:
            self.index.append((key, self.at))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.before, self.last = key, doc_id
        self.doc_ids.append(doc_id)
        self.ids += len(value) // self.width
        if len(self.block) >= BLOCK:
            self._close_block()

    def _close_block(self) -> None:
        if self.block:
            self.stream.write(bytes(self.block))
            self.at += len(self.block)
            self.block = bytearray()

    def finish(self) -> int:
        self._close_block()
        ends = [at for _, at in self.index[1:]] + [self.at]
        index = b"".join(_INDEX.pack(at, end - at, len(key)) + key for (key, at), end in zip(self.index, ends))
        bits = max(64, _BITS * len(self.doc_ids)) + 7 & ~7
        bloom = np.zeros(bits, np.uint8)
        for d in self.doc_ids:
            bloom[_probes(d, bits)] = 1
        packed = np.packbits(bloom).tobytes()
        self.stream.write(index + packed + FOOTER.pack(self.at, self.at + len(index), len(self.doc_ids), self.ids, self.width, MAGIC))
        return self.at + len(index) + len(packed) + FOOTER.size


class Reader:
    """Reads one shard: all entries in order, or one id by bisection."""

    def __init__(self, file, size: int):
        self.file = file
        self.index_at, self.bloom_at, self.n_docs, self.n_ids, width, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        tail = self._at(self.index_at, size - FOOTER.size - self.index_at)
        self.bloom = np.frombuffer(tail[self.bloom_at - self.index_at :], np.uint8)
        self.keys, self.places, at = [], [], 0
        while at < self.bloom_at - self.index_at:
            offset, length, n = _INDEX.unpack_from(tail, at)
            at += _INDEX.size + n
            self.keys.append(tail[at - n : at])
            self.places.append((offset, length))

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def _entries(self, place):
        block, at, key = self._at(*place), 0, b""
        while at < len(block):
            shared, at = _read_varint(block, at)
            further, at = _read_varint(block, at)
            size, at = _read_varint(block, at)
            key = key[:shared] + block[at : at + further]
            at += further + size
            yield key, np.frombuffer(block, self.dtype, size // self.dtype.itemsize, at - size)

    def __iter__(self):
        for place in self.places:
            for key, ids in self._entries(place):
                yield id_of(key), ids

    def may_have(self, doc_id: int | None) -> bool:
        return all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in _probes(doc_id, 8 * len(self.bloom)))

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The token ids of every row with this id."""
        out, low, high = [], key_of(doc_id), key_of(doc_id, (1 << 32) - 1)
        if not self.may_have(doc_id):
            return out
        for k in range(max(0, bisect.bisect_right(self.keys, low) - 1), len(self.places)):
            if self.keys[k] > high:
                break
            out += [ids for key, ids in self._entries(self.places[k]) if low <= key <= high]
        return out


def open_shard(path: str):
    """A Reader, and the file to close."""
    system, at = _filesystem(path)
    file = system.open_input_file(at)
    return Reader(file, file.size()), file


def write(docs: DataFrame, folder: str, path: str | None = None, shards: int | None = None, end_id: int = END_ID) -> DataFrame:
    """Encodes and writes ``docs``; returns the manifest, a row per shard that has documents.

    ``folder`` is a URI that executors can reach.  ``shards`` defaults to the number of input partitions, so that
    files grow in number, not in size.
    """
    path = path or default_path()
    shards = shards or max(1, docs.rdd.getNumPartitions())

    def write_shard(batches):
        import pyarrow as pa

        encoder, task = Encoder.get(path), TaskContext.get()
        end = np.array([end_id], encoder.dtype).tobytes()
        shard, system = task.partitionId(), None
        writer, first = None, None
        for batch in batches:
            for piece in slices(batch):
                if not piece.num_rows:
                    continue
                if writer is None:
                    system, at = _filesystem(f"{folder}/shard-{shard:06d}.sst")
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    temporary = f"{at}.{task.taskAttemptId()}"
                    stream = system.open_output_stream(temporary)
                    writer, first = Writer(stream, encoder.dtype.itemsize), piece.column(0)[0].as_py()
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1).to_pylist())):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            size = writer.finish()
            stream.close()
            system.move(temporary, at)
            row = [shard, f"{folder}/shard-{shard:06d}.sst", first, writer.last, len(writer.doc_ids), writer.ids, size]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if k == 1 else pa.int64()) for k, x in enumerate(row)], [c.split()[0] for c in MANIFEST.split(", ")])

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return checkpoint(dealt.mapInArrow(write_shard, MANIFEST))


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: the ids of all shards before (a window over the shards only)."""
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards, one task per few shards."""

    def read_shards(batches):
        import pyarrow as pa

        for batch in batches:
            for shard_path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, file = open_shard(shard_path)
                rows = []
                for doc_id, ids in reader:
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                file.close()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return starts(manifest).select("path", "start", "shard").repartition(n, "shard").select("path", "start").mapInArrow(read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _bounds(manifest: DataFrame) -> tuple[np.ndarray, list[int], list[int]]:
    """Paths, first and last id of the shards in order; a null id stands before all others."""
    low = -(1 << 63)
    rows = sorted((r["shard"], r["path"], low if r["first_id"] is None else r["first_id"], low if r["last_id"] is None else r["last_id"]) for r in manifest.select("shard", "path", "first_id", "last_id").collect())
    return np.array([r[1] for r in rows], object), [r[2] for r in rows], [r[3] for r in rows]


def lookup(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """For ids (column doc_id): doc_id, ids (array), by filter, bisection and one block read; unknown ids give no row.

    The shards' bounds, some hundred bytes a shard, travel to the tasks up to :data:`SHARDS_SENT` shards; each id finds
    its shards by bisection, also where rows of one id lie in two.  Beyond it, ids and bounds are joined by range.
    """
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"))
    if manifest.count() <= SHARDS_SENT:
        sent = keys.sparkSession.sparkContext.broadcast(_bounds(manifest))

        def place(batches):
            import pyarrow as pa

            paths, first, last = sent.value
            for batch in batches:
                ids, out = batch.column(0).to_pylist(), []
                for d in ids:
                    at = -(1 << 63) if d is None else d
                    out += [(d, x) for x in paths[bisect.bisect_left(last, at) : bisect.bisect_right(first, at)]]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())], ["doc_id", "path"])

        rows = asked.mapInArrow(place, "doc_id long, path string")
    else:
        null_too = (F.col("doc_id").isNull() & F.col("first_id").isNull()) | (F.col("first_id").isNull() & (F.col("doc_id") <= F.col("last_id")))
        rows = asked.join(manifest.select("path", "first_id", "last_id"), F.col("doc_id").between(F.col("first_id"), F.col("last_id")) | null_too).select("doc_id", "path")

    def find(batches):
        import pyarrow as pa

        for batch in batches:
            by_path: dict[str, list] = {}
            for doc_id, shard_path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_path.setdefault(shard_path, []).append(doc_id)
            for shard_path, ids in by_path.items():
                reader, file = open_shard(shard_path)
                found = [(d, x.tolist()) for d in ids for x in reader.get(d)]
                file.close()
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return rows.repartition("path").mapInArrow(find, "doc_id long, ids array<long>")

"""Length-delimited binary records of token ids.

A record is framed as: length of the payload (8 bytes), masked checksum of those 8 bytes (4), payload, masked checksum of
the payload (4). The payload is a flag byte (1 if the id is present), the document's id (8), the number of ids (4) and the
ids as 2 or 4 bytes each; all numbers are little-endian. Checksums are CRC-32, rotated and shifted by a constant as record
formats do, so that a checksum of data that holds checksums stays useful. Beside each shard NAME.rec stands NAME.idx, 16
bytes a record: its offset in the shard and its whole length. A reader that shuffles takes the index and seeks.

Documents are range-sorted by id, so shards in order of (part, chunk) hold ascending ids. Each task attempt writes files of
its own name through the shared file system, and the manifest, a table that Spark commits, lists those of the attempt that
counted: a lost executor leaves files that no manifest names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaframe.llm.common import shared_dir, table
from vistaframe.llm.tokens import encoder

#: Fixed values of the frame: the mask's constant, and the layouts of header and payload.
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<BqI")
TAIL = struct.Struct("<I")
INDEX_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8")])
#: A shard is closed when it holds so many bytes.
SHARD_BYTES = 64 << 20
READ_BYTES = 4 << 20

MANIFEST = "part int, chunk int, name string, records long, tokens long, bytes long"
RECORD = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = PAYLOAD.pack(doc_id is not None, doc_id or 0, len(ids)) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked(length)) + payload + TAIL.pack(masked(payload))


def unframe(data: memoryview | bytes) -> tuple[int | None, np.ndarray]:
    """The id and token ids of one whole frame; raises ValueError if a checksum or length doesn't fit."""
    length, check = HEAD.unpack_from(data)
    if masked(bytes(data[:8])) != check or len(data) != HEAD.size + length + TAIL.size:
        raise ValueError("a record's length is damaged")
    payload = bytes(data[HEAD.size : HEAD.size + length])
    if masked(payload) != TAIL.unpack_from(data, HEAD.size + length)[0]:
        raise ValueError("a record's payload is damaged")
    present, doc_id, n = PAYLOAD.unpack_from(payload)
    width = (length - PAYLOAD.size) // n if n else 4
    return (doc_id if present else None), np.frombuffer(payload, f"<u{width}", n, PAYLOAD.size).astype("<u4")


def frames(stream, size: int) -> Iterator[memoryview]:
    """The whole frames of an open shard, read in blocks."""
    buffer, at, done = b"", 0, 0
    while True:
        need = HEAD.size
        if len(buffer) - at >= need:
            need += HEAD.unpack_from(buffer, at)[0] + TAIL.size
        if len(buffer) - at >= need > HEAD.size:
            yield memoryview(buffer)[at : at + need]
            at += need
            continue
        if done >= size:
            if len(buffer) != at:
                raise ValueError("a shard ends inside a record")
            return
        block = stream.read(max(READ_BYTES, need))
        if not block:
            raise ValueError("a shard is shorter than its manifest says")
        buffer, at, done = buffer[at:] + block, 0, done + len(block)


def file_system(base: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(base)


class Shards:
    """Writes the frames of one task to shards of bounded size; rows() has a manifest row for each."""

    def __init__(self, base: str, part: int, attempt: int, limit: int) -> None:
        self.system, self.folder = file_system(base)
        self.part, self.attempt, self.limit = part, attempt, limit
        self.done: list[dict] = []
        self.out = None

    def add(self, framed: bytes, tokens: int) -> None:
        if self.out is None:
            name = f"part-{self.part:06d}-{len(self.done):05d}-{self.attempt}"
            self.out, self.lengths = self.system.open_output_stream(f"{self.folder}/{name}.rec"), []
            self.done.append({"part": self.part, "chunk": len(self.done), "name": name, "records": 0, "tokens": 0, "bytes": 0})
        self.out.write(framed)
        self.lengths.append(len(framed))
        row = self.done[-1]
        row.update(records=row["records"] + 1, tokens=row["tokens"] + tokens, bytes=row["bytes"] + len(framed))
        if row["bytes"] >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            index = np.zeros(len(self.lengths), INDEX_ENTRY)
            index["length"] = self.lengths
            index["offset"][1:] = np.cumsum(self.lengths[:-1])
            with self.system.open_output_stream(f"{self.folder}/{self.done[-1]['name']}.idx") as out:
                out.write(index.tobytes())


def write_records(docs: DataFrame, base: str, vocabulary: str, end_id: int, drops_space: bool = False, width: int = 4, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes a record for each row of docs (doc_id, text) under base and returns the manifest, one row a shard.

    Rows stand in ascending order of doc_id, null first, ties by text. A null or empty text is a record of end_id alone.
    No rows make an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    made, folder = file_system(base)
    made.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, drops_space).ids
        task = TaskContext.get()
        shards = Shards(base, task.partitionId(), task.taskAttemptId(), shard_bytes)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py()), end])
                shards.add(frame(doc_id, ids, width), len(ids))
        shards.close()
        yield pa.RecordBatch.from_pylist(shards.done, schema=pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("name", pa.string()), *[(c, pa.int64()) for c in ("records", "tokens", "bytes")]]))

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{base}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{base}/manifest")


def read_records(manifest: DataFrame, base: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each record, read back from the shards with every checksum checked; start counts the ids of all records before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                with system.open_input_stream(f"{folder}/{name}.rec") as stream:
                    for whole in frames(stream, size):
                        doc_id, ids = unframe(whole)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("name", "bytes").join(shard_starts(manifest), "name")
    tasks = min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return shards.repartition(max(1, tasks), "name").mapInArrow(read, RECORD)


def read_shuffled(manifest: DataFrame, base: str, seed: int) -> DataFrame:
    """Every record in an order drawn from seed, by the offset index: (place, doc_id, ids). Each record is sought and read alone."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{folder}/{name}.idx") as stream:
                    index = np.frombuffer(stream.read(), INDEX_ENTRY)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(index), pa.string()), pa.array(index["offset"].astype("i8")), pa.array(index["length"].astype("i8"))], ["name", "offset", "length"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(base)
        for batch in batches:
            out = []
            for name, offset, length, place in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                with system.open_input_file(f"{folder}/{name}.rec") as f:
                    doc_id, ids = unframe(f.read_at(length, offset))
                out.append({"place": place, "doc_id": doc_id, "ids": ids.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    listed = manifest.select("name").mapInArrow(entries, "name string, offset long, length long")
    drawn = listed.withColumn("place", F.xxhash64(F.lit(seed), "name", "offset"))
    return drawn.repartitionByRange("place").sortWithinPartitions("place").mapInArrow(fetch, "place long, doc_id long, ids array<long>")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """name and start (ids before the shard): sums inside each part, then over the parts, of which there are as many as tasks wrote."""
    chunks = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(parts), F.lit(0)).alias("base"))
    return manifest.withColumn("inside", F.coalesce(F.sum("tokens").over(chunks), F.lit(0))).join(bases, "part").select("name", (F.col("base") + F.col("inside")).alias("start"))


#: The production parameters of the query.
VOCABULARY, END_ID, WIDTH = "word_bpe_49k.json", 1, 2


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as records of word_bpe_49k ids and returns what the files hold: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    base = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    manifest = write_records(table(spark, sf_dir, "documents"), base, public_tokenizers.path(VOCABULARY), END_ID, drops_space=True, width=WIDTH)
    return read_records(manifest, base)


QUERIES = {"op8_token_records": op8_token_records}
ORACLES: dict[str, str] = {}

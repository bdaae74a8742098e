"""Telephony audio as media columns: mu-law, A-law and ADPCM to 16-bit PCM, resampled.

Media are WAV files of one channel at 8 kHz. Expanding mu-law or A-law is one lookup for each sample. ADPCM is decoded
block by block, as each block carries its own start; numpy steps through the samples of all blocks of a batch at once.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import table, written

# WAV format tags, and the ADPCM index steps of the IMA recommendation.
TAGS = {"pcm": 1, "alaw": 6, "mulaw": 7, "adpcm": 17}
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
RATE, RATE_OUT = 8000, 16000
#: A payload is a positive multiple of this; it is also the data of one ADPCM block.
UNIT = 192
BLOCK = UNIT + 4
#: ADPCM blocks that are decoded at once.
BLOCKS_AT_ONCE = 8192


def step_sizes() -> np.ndarray:
    """The 89 ADPCM step sizes: each about a tenth above the one before, as the recommendation rounds them."""
    # Fixed values of the IMA recommendation.
    text = """7 8 9 10 11 12 13 14 16 17 19 21 23 25 28 31 34 37 41 45 50 55 60 66 73 80 88 97 107 118 130 143 157 173 190
    209 230 253 279 307 337 371 408 449 494 544 598 658 724 796 876 963 1060 1166 1282 1411 1552 1707 1878 2066 2272 2499
    2749 3024 3327 3660 4026 4428 4871 5358 5894 6484 7132 7845 8630 9493 10442 11487 12635 13899 15289 16818 18500 20350
    22385 24623 27086 29794 32767"""
    return np.array(text.split(), np.int32)


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    level = (((code & 0x0F) << 3) + 0x84) << ((code & 0x70) >> 4)
    return np.where(code & 0x80, 0x84 - level, level - 0x84).astype("<i2")


def alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    segment = (code & 0x70) >> 4
    level = ((code & 0x0F) << 4) + np.where(segment == 0, 8, 0x108)
    level = np.where(segment > 1, level << np.maximum(segment - 1, 0), level)
    return np.where(code & 0x80, level, -level).astype("<i2")


TABLES = {"mulaw": mulaw_table(), "alaw": alaw_table()}
STEPS = step_sizes()


def wav(codec: str, data: bytes) -> bytes:
    """A WAV file of 8-bit samples (mulaw, alaw) or of whole ADPCM blocks."""
    if codec == "adpcm":
        form = struct.pack("<HHIIHHHH", TAGS[codec], 1, RATE, RATE * BLOCK // (2 * UNIT + 1), BLOCK, 4, 2, 2 * UNIT + 1)
    else:
        form = struct.pack("<HHIIHHH", TAGS[codec], 1, RATE, RATE, 1, 8, 0)
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse_wav(media: bytes) -> tuple[str, memoryview]:
    """Codec and data of a WAV file; raises ValueError if it isn't one of ours."""
    view, at, codec = memoryview(media), 12, None
    if bytes(view[:4]) != b"RIFF" or bytes(view[8:12]) != b"WAVE":
        raise ValueError("not a WAV file")
    while at + 8 <= len(view):
        name, size = bytes(view[at : at + 4]), struct.unpack_from("<I", view, at + 4)[0]
        if name == b"fmt ":
            tag = struct.unpack_from("<H", view, at + 8)[0]
            codec = next((k for k, v in TAGS.items() if v == tag), None)
        elif name == b"data" and codec:
            return codec, view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples in this WAV file")


#: Bytes of payloads or files that are worked on at a time.
PART_BYTES = 1 << 20


def store(codec: str, payload: bytes) -> bytes:
    """The payload as the samples of a WAV file. In ADPCM each UNIT of it is the data of a block that starts at level 0 with the smallest step."""
    if codec == "adpcm":
        blocks = np.zeros((len(payload) // UNIT, BLOCK), np.uint8)
        blocks[:, 4:] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
        return wav(codec, blocks.tobytes())
    return wav(codec, payload)


def read_payload(codec: str, data: memoryview) -> bytes:
    if codec == "adpcm":
        return np.frombuffer(data, np.uint8).reshape(-1, BLOCK)[:, 4:].tobytes()
    return bytes(data)


def decode_blocks(blocks: np.ndarray) -> np.ndarray:
    """PCM of ADPCM blocks, one a row: the block's own first level and two samples a byte, low half first. All rows step together."""
    level = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), 88)
    halves = np.empty((len(blocks), 2 * (blocks.shape[1] - 4)), np.uint8)
    halves[:, ::2], halves[:, 1::2] = blocks[:, 4:] & 15, blocks[:, 4:] >> 4
    halves = np.ascontiguousarray(halves.T)
    out = np.empty((len(halves) + 1, len(blocks)), "<i2")
    out[0] = level
    for k, code in enumerate(halves):
        step = STEPS[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        level = np.clip(level + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX_STEP[code & 7], 0, 88)
        out[k + 1] = level
    return np.ascontiguousarray(out.T)


def decode(media: list[bytes]) -> list[np.ndarray]:
    """16-bit PCM at the rate of the media. The ADPCM blocks of all files are decoded together."""
    parsed = [parse_wav(m) for m in media]
    out: list[np.ndarray | None] = [TABLES[c][np.frombuffer(d, np.uint8)] if c != "adpcm" else None for c, d in parsed]
    owners = [k for k, (c, _) in enumerate(parsed) if c == "adpcm"]
    if owners:
        blocks = np.concatenate([np.frombuffer(parsed[k][1], np.uint8).reshape(-1, BLOCK) for k in owners])
        pcm = np.concatenate([decode_blocks(blocks[at : at + BLOCKS_AT_ONCE]) for at in range(0, len(blocks), BLOCKS_AT_ONCE)])
        at = 0
        for k in owners:
            n = len(parsed[k][1]) // BLOCK
            out[k] = pcm[at : at + n].reshape(-1)
            at += n
    return out


def resample_double(pcm: np.ndarray) -> np.ndarray:
    """Twice the rate: every sample, and the mean of it and its successor (the last again), rounded down."""
    out = np.empty(2 * len(pcm), "<i2")
    out[::2] = pcm
    after = np.append(pcm[1:], pcm[-1:])
    out[1::2] = (pcm.astype(np.int32) + after) >> 1
    return out


def feature(codec: str, pcm: np.ndarray) -> str:
    """What a sample of sound shows, as text in whole numbers: equal media, equal features."""
    wide = pcm.astype(np.int64)
    zero = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"{codec};samples={len(pcm)};peak={int(np.abs(wide).max())};power={int((wide * wide).mean())};crossings={zero};pcm={zlib.crc32(pcm.tobytes()):08x}"


def parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about PART_BYTES of a column; what is decoded at a time is some ten times that."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    turn = np.flatnonzero(np.diff((np.cumsum(size) - size) // PART_BYTES)) + 1
    for start, end in zip([0, *turn], [*turn, batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def store_payloads(docs: DataFrame, codec: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, media): each text as UTF-8, padded with spaces to a positive multiple of UNIT, in a WAV file.

    A null text is an empty one. Without a codec, the CRC of the payload picks mu-law, A-law or ADPCM. Other columns are
    not read; rows that are repeated give repeated media.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("mulaw", "alaw", "adpcm")
        for batch in batches:
            for part in parts(batch, 1):
                texts = [x or b"" for x in part.column(1).to_pylist()]
                payloads = [t + b" " * (max(1, -(-len(t) // UNIT)) * UNIT - len(t)) for t in texts]
                media = [store(codec or names[zlib.crc32(p) % 3], p) for p in payloads]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def decoded(media: DataFrame) -> DataFrame:
    """(doc_id, codec, pcm): 16-bit little-endian PCM at RATE_OUT of every media file. A null file gives null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1):
                files = part.column(1).to_pylist()
                sounds = iter(decode([f for f in files if f is not None]))
                pcm = [None if f is None else resample_double(next(sounds)).tobytes() for f in files]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f and parse_wav(f)[0] for f in files], pa.string()), pa.array(pcm, pa.binary())], ["doc_id", "codec", "pcm"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, codec string, pcm binary")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(media: DataFrame) -> DataFrame:
    """What the stored files hold when they are read: payload, checksums and a feature of the resampled PCM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 2):
                files = part.column(2).to_pylist()
                sounds = decode(files)
                payloads = [read_payload(*parse_wav(f)) for f in files]
                columns = [
                    part.column(0), part.column(1), pa.array([len(p) for p in payloads], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
                    pa.array([zlib.crc32(p[-16:]) for p in payloads], pa.int64()), pa.array([len(f) for f in files], pa.int64()), pa.array([hashlib.sha256(f).hexdigest() for f in files]),
                    pa.array([feature(parse_wav(f)[0], resample_double(x)) for f, x in zip(files, sounds, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in DIGEST.split(", ")])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, DIGEST)


def op6_telephony_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents as telephony media in a table of the shared folder, and what is read back from it; see store_payloads() and
    digests(). The PCM is decoded and resampled there too and ends in the feature; decoded() returns it for storing."""
    return digests(written(store_payloads(table(spark, sf_dir, "documents")), compression="zstd"))


QUERIES = {"op6_telephony_audio": op6_telephony_audio}
ORACLES: dict[str, str] = {}

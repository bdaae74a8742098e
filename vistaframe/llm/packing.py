"""Best-fit packing of token sequences by sweeps over counts, in place of sweeps over range-sorted pieces.

Pieces and gaps are integers up to the capacity, so the order that a sweep runs through is held as counts: how many pieces
have each length, how many open sequences each gap. Going down the lengths, each step gives all pieces of one length to
their successors, the smallest gaps that hold them; pieces that want the same gap are told apart by their rank among their
length, the gaps shrink, and the next step follows. A step is written down as runs (pieces of ranks r to r + n go to
sequences s to s + n at one offset), so its cost follows the capacity, at most 2,048 counts, and not the number of pieces.
Spark makes the counts, ranks every piece within its length by sums over slots, and looks its run up. No piece reaches the
driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaframe.llm.common import table, written
from vistaframe.llm.tokens import encoder

CAPACITY = 2048
#: Slots that the pieces of one length are dealt to, so that no task ranks a whole length.
SLOTS = 256

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, slot int"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities from the end, what is left over comes first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each row of docs (doc_id, text). A null or empty text is a piece of end_id alone; other columns are not read."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        end, slot = np.array([end_id], "<u4"), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py()), end])
                for piece, (at, length) in enumerate(cut(len(ids), capacity)):
                    slot = (slot + 1) % SLOTS
                    rows.append((doc_id, piece, at, length, zlib.crc32(ids[at : at + length].tobytes()), slot))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "slot"])

    return docs.select("doc_id", "text").mapInArrow(tokenize, PIECE)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs (length, rank, n, sequence, offset) that place counts[length] pieces of each length, largest first, by best fit."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # of each size: (first sequence, how many)
    runs, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left, gap = 0, counts[length], length
        while left:
            while gap < capacity and not gaps[gap]:
                gap += 1
            each = gap // length
            if gaps[gap]:
                first, many = gaps[gap].pop()
            else:  # no gap holds it: new sequences
                first, many, gap = opened, -(-left // (capacity // length)), capacity
                each, opened = capacity // length, opened + many
            full = min(many, left // each)
            fills = [(first, full, each)] * (full > 0) + ([(first + full, 1, left - full * each)] if full < many and full * each < left else [])
            for sequence, n, take in fills:
                for k in range(take):
                    runs.append((length, rank, n, sequence, capacity - gap + k * length))
                    rank, left = rank + n, left - n
                gaps[gap - take * length].append((sequence, n))
            if rest := many - sum(n for _, n, _ in fills):
                gaps[gap].append((first + many - rest, rest))
    return np.array(runs, "i8").reshape(-1, 5)


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds rank, from 0 within each length: inside a slot by a window, plus the slots before it."""
    slots = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("_n"))
    before = totals.select("length", "slot", F.coalesce(F.sum("_n").over(slots), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return pieces.withColumn("_inside", inside).join(before, ["length", "slot"]).withColumn("rank", F.col("_before") + F.col("_inside"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and offset of every piece. pieces: what pieces_of() returns, as a table that gives the same rows when read again.

    Pieces of equal length are interchangeable, so ties and repeated rows fall anywhere among their ranks. Lengths run
    from 1 to capacity. No pieces give no rows.
    """
    runs = sweep({r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}, capacity)
    starts = runs[:, 0] << 40 | runs[:, 1]
    order = np.argsort(starts)
    starts, runs = starts[order], runs[order]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            run = runs[np.searchsorted(starts, length << 40 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PACKED)


#: The production parameters of the query.
VOCABULARY, END_ID = "byte_bpe_50k.json", 0


def packed_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(written(pieces_of(docs, public_tokenizers.path(VOCABULARY), END_ID)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2,048 byte_bpe_50k ids: a row for each piece, see pack()."""
    return packed_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
ORACLES: dict[str, str] = {}

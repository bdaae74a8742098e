"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one entry from each of several full-dimensional codebooks. Codebooks are fitted on a bounded sample:
residual k-means first, then rounds of beam-search encoding and least-squares refitting of all entries together. Every
vector of the table is encoded by beam search, and its approximate norm is stored with its code. A query makes one lookup
table of its products with all entries; a candidate's score is the sum of its entries' products. The best by that score in
each block of the index are scored again on their original vectors, in double precision, and so is every other candidate
that its quantisation error could lift among them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import ship, table, written

#: Codebooks and entries of each; vectors of the training sample; refitting rounds.
BOOKS, ENTRIES, SAMPLE, ROUNDS = 8, 128, 8192, 2
BEAM = 8
#: Vectors in a block of the index, and queries in a block of queries.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Candidates of a block that are scored exactly for each query, whatever their errors.
RERANK = 64
#: Blocks whose bests are merged in one round.
MERGED = 64


@dataclass
class Codebooks:
    books: np.ndarray  # BOOKS x ENTRIES x dimensions

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared norms of their sums, by beam search for the smallest residual."""
        m, k, d = self.books.shape
        flat = self.books.reshape(m * k, d)
        gram = flat @ flat.T
        codes, norms = np.empty((len(x), m), np.int64), np.empty(len(x))
        for at in range(0, len(x), 1024):
            part = x[at : at + 1024]
            n = len(part)
            products = part @ flat.T
            # Of each beam: its entries (as rows of flat) and |sum|^2 - 2 x.sum.
            chosen = np.zeros((n, 1, 0), np.int64)
            cost = np.zeros((n, 1))
            for book in range(m):
                rows = slice(book * k, (book + 1) * k)
                cross = gram[rows][:, chosen].sum(axis=3) if book else np.zeros((k, n, 1))
                new = cost[:, :, None] + (np.diag(gram)[rows] - 2 * products[:, rows])[:, None, :] + 2 * cross.transpose(1, 2, 0)
                width = min(beam, new.shape[1] * k)
                best = np.argpartition(new.reshape(n, -1), width - 1, axis=1)[:, :width]
                cost = np.take_along_axis(new.reshape(n, -1), best, 1)
                chosen = np.concatenate([np.take_along_axis(chosen, (best // k)[:, :, None], 1), (best % k + book * k)[:, :, None]], axis=2)
            chosen = np.take_along_axis(chosen, cost.argmin(axis=1)[:, None, None], 1)[:, 0]
            codes[at : at + n] = chosen
            norms[at : at + n] = cost.min(axis=1) + 2 * np.take_along_axis(products, chosen, 1).sum(axis=1)
        return codes, norms

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return self.books.reshape(-1, self.books.shape[2])[codes].sum(axis=1)


def fit(x: np.ndarray, books: int = BOOKS, entries: int = ENTRIES, rounds: int = ROUNDS, seed: int = 7) -> Codebooks:
    """Codebooks for the rows of x. With fewer rows than entries some entries repeat."""
    random = np.random.default_rng(seed)
    residual, made = x.copy(), []
    for _ in range(books):
        centres = residual[random.choice(len(residual), entries, replace=len(residual) < entries)]
        for _ in range(6):
            near = np.argmin((centres**2).sum(1) - 2 * residual @ centres.T, axis=1)
            n = np.bincount(near, minlength=entries)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, residual)
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        residual = residual - centres[np.argmin((centres**2).sum(1) - 2 * residual @ centres.T, axis=1)]
        made.append(centres)
    found = Codebooks(np.stack(made))
    for _ in range(rounds):
        codes, _ = found.encode(x)
        # Least squares for all entries at once: counts of entries that occur together, lightly damped.
        used = np.zeros((len(x), books * entries), np.float32)
        used[np.arange(len(x))[:, None], codes] = 1
        normal = (used.T @ used).astype(np.float64) + 0.1 * np.eye(books * entries)
        found = Codebooks(np.linalg.solve(normal, used.T.astype(np.float64) @ x + 0.1 * found.books.reshape(-1, x.shape[1])).reshape(found.books.shape))
    return found


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector as doubles) of the rows that take part: not null, not zero, and nothing null or not finite in them."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(finite & F.exists(vector, lambda x: x != 0)).select("vec_id", vector.alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.array([np.asarray(v.values) for v in column], np.float64)


def top(scores: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n largest scores; of equal ones the first columns."""
    if len(scores) <= n:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    above = np.flatnonzero(scores > edge)
    return np.concatenate([above, np.flatnonzero(scores == edge)[: n - len(above)]])


def build_index(vectors: DataFrame, books: Codebooks, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each block: block (from 0), ids, vectors, codes, norms and errors (lengths of what codes leave) as bytes. Rows are dealt to blocks in turn, so no id or value fills one."""

    def encode(ids: np.ndarray, x: np.ndarray) -> list[bytes]:
        codes, norms = books.encode(x)
        errors = np.linalg.norm(x - books.decode(codes), axis=1)
        return [a.tobytes() for a in (ids, x, codes.astype("<u2"), norms.astype("<f8"), errors.astype("<f8"))]

    return blocks_of(vectors, block_rows, books.books.shape[2], encode, ["ids", "vectors", "codes", "norms", "errors"])


def blocks_of(vectors: DataFrame, size: int, dims: int, encode, names: list[str]) -> DataFrame:
    """Rows (vec_id, vector) dealt in turn to partitions of about size rows, each made one row of bytes with its number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"))
            rows.append(matrix(batch.column(1)).reshape(batch.num_rows, dims))
        if ids and sum(map(len, ids)):
            all_ids, x = np.concatenate(ids), np.concatenate(rows)
            order = np.argsort(all_ids, kind="stable")
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.array([b], pa.binary()) for b in encode(all_ids[order], x[order])]], ["block", *names])

    dealt = vectors.select("vec_id", "vector").repartition(max(1, -(-vectors.count() // size)))
    return dealt.mapInArrow(run, "block long, " + ", ".join(f"{n} binary" for n in names))


def search(index: DataFrame, queries: DataFrame, books: Codebooks, k: int, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query (vec_id, vector) by inner product, without itself.

    Every block of queries is copied to every block of the index, which gives one row with its best for each query. The
    rerank best by lookup scores are scored exactly; the k-th of them is a floor, and all whose lookup score plus the most
    that their error can add (its length times the query's) reaches the floor are scored exactly too, so a block's best k
    are exact. Blocks' bests are merged in rounds of MERGED. Ties in the exact score go to smaller ids. A query id that several rows carry is answered for each; candidates that are
    repeated rows are found as often. index and queries: written tables.
    """
    dims = books.books.shape[2]
    flat = books.books.reshape(-1, dims)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, vectors, codes, errors, asked, query_ids, q in zip(*(batch.column(c) for c in range(8)), strict=True):
                ids, query_ids = np.frombuffer(ids.as_py(), "<i8"), np.frombuffer(query_ids.as_py(), "<i8")
                x, q = np.frombuffer(vectors.as_py(), "<f8").reshape(-1, dims), np.frombuffer(q.as_py(), "<f8").reshape(-1, dims)
                codes = np.frombuffer(codes.as_py(), "<u2").reshape(len(ids), -1)
                errors, lengths = np.frombuffer(errors.as_py(), "<f8"), np.linalg.norm(q, axis=1)
                tables = (flat @ q.T).astype(np.float32)  # a column for each query
                # What single precision can lose in a sum of entries.
                lost = 2e-7 * (codes.shape[1] + 1) ** 2 * np.abs(tables).max(axis=0)
                out_ids, out_scores = [], []
                for at in range(0, len(query_ids), 64):
                    lookup = np.ascontiguousarray(tables[:, at : at + 64])
                    approximate = np.zeros((len(ids), lookup.shape[1]), np.float32)
                    for book in range(codes.shape[1]):
                        approximate += lookup[codes[:, book]]
                    approximate = np.ascontiguousarray(approximate.T)
                    for j, query_id in enumerate(query_ids[at : at + 64]):
                        approximate[j, ids == query_id] = -np.inf
                        found = top(approximate[j], rerank)
                        found = found[ids[found] != query_id]
                        exact = (x[found] * q[at + j]).sum(axis=1)
                        floor = np.partition(exact, len(exact) - k)[len(exact) - k] if len(exact) >= k else -np.inf
                        below = approximate[j] + (errors * lengths[at + j] * (1 + 1e-9) + lost[at + j]) < floor
                        found = np.flatnonzero(~below & (ids != query_id))
                        exact = (x[found] * q[at + j]).sum(axis=1)
                        best = np.lexsort((ids[found], -exact))[:k]
                        out_ids.append(ids[found][best])
                        out_scores.append(-exact[best])
                ends = np.concatenate([[0], np.cumsum([len(o) for o in out_ids])]).astype("i4")
                structs = pa.StructArray.from_arrays([pa.array(np.concatenate(out_scores)), pa.array(np.concatenate(out_ids))], ["minus", "vec_id"])
                n = len(query_ids)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * n, pa.int64()), pa.array(asked.as_py() * BLOCK_QUERIES * 2 + np.arange(n)), pa.array(query_ids), pa.ListArray.from_arrays(ends, structs)], ["block", "query", "query_id", "best"])

    asked = blocks_of(queries, BLOCK_QUERIES, dims, lambda ids, x: [ids.tobytes(), x.tobytes()], ["query_ids", "queries"])
    blocks = (index.agg(F.max("block")).first()[0] or 0) + 1
    copies = asked.withColumnRenamed("block", "asked").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = index.join(copies, "block").select("block", "ids", "vectors", "codes", "errors", "asked", "query_ids", "queries")
    bests = written(pairs.mapInArrow(score, "block long, query long, query_id long, best array<struct<minus: double, vec_id: long>>"))
    while blocks > 1:
        blocks = -(-blocks // MERGED)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
        bests = bests.groupBy("query", "query_id", F.floor(F.col("block") / MERGED).alias("block")).agg(merged.alias("best"))
    ranked = bests.select("query_id", F.posexplode("best").alias("at", "found"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.vec_id").alias("vec_id"), (-F.col("found.minus")).alias("score"))


def op9_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every embedding whose vec_id is divisible by 20, among all others; see search()."""
    ship(spark)
    vectors = usable(table(spark, sf_dir, "embeddings"))
    # The codebooks' sample: bounded, by hash.
    sample = matrix_of(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE))
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.where(F.size("vector") == sample.shape[1])
    books = fit(sample)
    return search(written(build_index(vectors, books)), vectors.where(F.col("vec_id") % 20 == 0), books, k=20)


def matrix_of(vectors: DataFrame) -> np.ndarray:
    """A bounded number of vectors in the driver; those of the most frequent length."""
    rows = [r["vector"] for r in vectors.select("vector").collect()]
    lengths = [len(r) for r in rows]
    most = max(sorted(set(lengths)), key=lengths.count, default=0)
    return np.array([r for r in rows if len(r) == most], np.float64)


QUERIES = {"op9_additive_quantisation": op9_additive_quantisation}
ORACLES: dict[str, str] = {}

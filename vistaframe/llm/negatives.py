"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. In a cluster whose anchors lie within an angle t of its centre, a row at angle a from the
centre and of length m gives an anchor of length n at most n m cos(max(0, a - t)). By m cos(max(0, a - t)) all rows are sorted
once for each cluster; every anchor walks its cluster's list, and is done when nothing further on can enter its answer.

The walk goes by rounds: each takes the next chunk of the lists, GROWTH times as long as the one before, for the anchors that
are not done yet. Only the rows of chunks that are walked are fetched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaframe.llm.common import Scratch, ship, table, written
from vistaframe.operators.places import with_places

#: Clusters, and the anchors (by hash of the id) that their centres are fitted on. Every anchor and row is in the lists.
CLUSTERS, SAMPLE = 32, 4096
#: Length of a list's first chunk, and how much longer each next one is.
FIRST, GROWTH = 4096, 4
#: Rows of a list, and anchors, that are scored against each other at a time.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 256
#: What rounding can add to a cosine, and to an angle.
SLACK, ANGLE_SLACK = 1e-9, 1e-6


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components as floor(256 x): label and vector not null, nothing in the vector
    null or not finite. A row without a vec_id is nobody's other row and takes no part. Rows that repeat stand for themselves."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    whole = F.transform(vector, lambda x: F.floor(x * 256).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("vector"))


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows; a shorter one is filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors: in double precision where its whole numbers hold them, else in 64 bits."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if largest < 2**53 else a @ b.T


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and vectors of length one (a zero vector stays zero)."""
    x = x.astype(np.float64)
    lengths = np.sqrt((x * x).sum(axis=1))
    return lengths, x / np.where(lengths > 0, lengths, 1)[:, None]


def centres_of(x: np.ndarray, clusters: int) -> np.ndarray:
    """Centres of length one by spherical k-means from spread starts; fewer where there are fewer rows."""
    _, unit = directions(x)
    clusters = max(1, min(clusters, len(unit)))
    centres = unit[:1].copy()
    nearest = unit @ centres[0]
    while len(centres) < clusters:
        centres = np.vstack([centres, unit[nearest.argmin()]])
        nearest = np.maximum(nearest, unit @ centres[-1])
    for _ in range(10):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, unit)
        length = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(length[:, None] > 0, sums / np.where(length > 0, length, 1)[:, None], centres)
    return centres


def angles(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centres.T, -1, 1))


class Lists:
    """Rows, anchors with their clusters, and each cluster's list, as tables.

    rows (row, vec_id, label, vector); anchors (row, vec_id, label, vector, cluster, length); entries (cluster, place, chunk, row);
    tops: the largest bound of each (cluster, chunk), a few numbers a cluster, which the driver holds.
    """

    def __init__(self, rows: DataFrame, every: int, scratch: Scratch, clusters: int = CLUSTERS, first: int = FIRST, growth: int = GROWTH) -> None:
        self.scratch, self.dims = scratch, 0
        self.rows = scratch.written(rows.withColumn("row", F.monotonically_increasing_id()))
        asked = self.rows.where(F.col("vec_id") % every == 0)
        dims = self.dims = self.rows.agg(F.max(F.size("vector"))).first()[0] or 0
        sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).select("vector").toArrow()
        if not sample.num_rows or not dims:
            self.tops, centres = {}, np.zeros((1, dims))
        else:
            centres = centres_of(matrix(sample.column(0).combine_chunks(), dims), clusters)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths, unit = directions(matrix(batch.column("vector"), dims))
                off = angles(unit, centres)
                cluster = off.argmin(axis=1)
                reach = np.where(lengths > 0, off[np.arange(len(off)), cluster], 0.0) if len(off) else lengths
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster, pa.int32()), pa.array(lengths), pa.array(reach)], [*batch.schema.names, "cluster", "length", "reach"])

        self.anchors = scratch.written(asked.select("row", "vec_id", "label", "vector").mapInArrow(assign, "row long, vec_id long, label long, vector array<long>, cluster int, length double, reach double"))
        widest = np.full(len(centres), -1.0)
        for r in self.anchors.groupBy("cluster").agg(F.max("reach").alias("reach")).collect():
            widest[r["cluster"]] = r["reach"] + ANGLE_SLACK
        used = np.flatnonzero(widest >= 0)

        def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths, unit = directions(matrix(batch.column("vector"), dims))
                apart = np.clip(angles(unit, centres[used]) - widest[used], 0, np.pi)
                minus = -(lengths[:, None] * np.minimum(np.cos(apart) + SLACK, 1 + SLACK))
                row = batch.column("row").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(used, len(row)), pa.int32()), pa.array(np.repeat(row, len(used))), pa.array(minus.ravel())], ["cluster", "row", "minus"])

        unsorted = self.rows.select("row", "vector").mapInArrow(bounds, "cluster int, row long, minus double")
        placed = with_places(unsorted, "cluster", ["minus", "row"], "place")
        chunk = F.when(F.col("place") < first, 0).otherwise(1 + F.floor(F.log(F.col("place") / first) / np.log(growth) + 1e-12)).cast("int")
        self.entries = scratch.written(placed.withColumn("chunk", chunk).repartitionByRange("chunk", "cluster", "place").sortWithinPartitions("chunk", "cluster", "place"))
        self.tops = {(r["cluster"], r["chunk"]): -r["low"] for r in self.entries.groupBy("cluster", "chunk").agg(F.min("minus").alias("low")).collect()}
        self.chunks = 1 + max((c for _, c in self.tops), default=-1)

    def best(self, windows: DataFrame, k: int) -> DataFrame:
        """(row, window, rank, vec_id, score): the first k entries for each of windows (row of an anchor, window, same, low, high).

        An entry suits a window if it has another vec_id than the anchor, the anchor's label (same) or another one, and a score
        from low to high. Order: score from high to low, then vec_id. A window is done when its k-th score is above, or its
        low end above all, that the rest of the list can reach.
        """
        keep = self.scratch.written
        open_windows, found = keep(windows), None
        for chunk in range(self.chunks):
            if open_windows.isEmpty():
                break
            asked = self.anchors.join(open_windows.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("window", "same", "low", "high"))).alias("windows")), "row")
            scored = self._scored(asked, chunk, k)
            rank = F.row_number().over(Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id", "entry"))
            found = keep((scored if found is None else found.drop("rank").union(scored)).withColumn("rank", rank).where(F.col("rank") <= k))
            tops = [(c, float(t)) for (c, at), t in self.tops.items() if at == chunk + 1]
            if not tops:
                break
            ahead = self.anchors.sparkSession.createDataFrame(tops, "cluster int, top double")
            most = self.anchors.join(F.broadcast(ahead), "cluster").select("row", (F.col("length") * F.col("top")).alias("most"))
            last = found.where(F.col("rank") == k).select("row", "window", F.col("score").alias("last"))
            left = open_windows.join(most, "row").join(last, ["row", "window"], "left").where((F.col("low") <= F.col("most")) & (F.col("last").isNull() | (F.col("last") <= F.col("most"))))
            open_windows = keep(left.select(*windows.columns))
        if found is None:
            return windows.sparkSession.createDataFrame([], "row long, window long, rank int, vec_id long, score long")
        return found.select("row", "window", "rank", "vec_id", "score")

    def _scored(self, asked: DataFrame, chunk: int, k: int) -> DataFrame:
        """(row, window, score, vec_id, entry): each block's first k for each window, blocks of entries against blocks of anchors."""
        dims = self.dims
        sizes = {r["cluster"]: r["count"] for r in asked.groupBy("cluster").count().collect()}
        parts = F.element_at(F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, -(-n // BLOCK_ANCHORS))]), F.col("cluster"))
        members = asked.withColumn("part", F.pmod(F.xxhash64("row"), parts))
        anchors = members.groupBy("cluster", "part").agg(F.collect_list(F.struct("row", "vec_id", "label", "vector", "windows")).alias("anchors"))
        entries = self.entries.where(F.col("chunk") == chunk).withColumn("block", F.floor(F.col("place") / BLOCK_ROWS)).select("cluster", "block", "row")
        entries = entries.join(F.broadcast(anchors.select("cluster").distinct()), "cluster", "left_semi")
        blocks = entries.join(self.rows, "row").groupBy("cluster", "block").agg(F.collect_list(F.struct("row", "vec_id", "label", "vector")).alias("rows"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    members, rows = batch.column("anchors").slice(at, 1).flatten(), batch.column("rows").slice(at, 1).flatten()
                    ids, labels, entry = (rows.field(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label", "row"))
                    order = np.lexsort((entry, ids))
                    ids, labels, entry = ids[order], labels[order], entry[order]
                    scores = products(matrix(members.field("vector"), dims), matrix(rows.field("vector"), dims)[order])
                    out = []
                    for score, own, own_id, own_label, windows in zip(scores, *(members.field(n).to_pylist() for n in ("row", "vec_id", "label", "windows")), strict=True):
                        same, other = labels == own_label, ids != own_id
                        for w in windows:
                            fit = np.flatnonzero((same if w["same"] else ~same) & other & (score >= w["low"]) & (score <= w["high"]))
                            if len(fit) > k:
                                edge = np.partition(score[fit], len(fit) - k)[len(fit) - k]
                                above, ties = fit[score[fit] > edge], fit[score[fit] == edge]
                                fit = np.concatenate([above, ties[: k - len(above)]])
                            out += [(own, w["window"], int(score[j]), int(ids[j]), int(entry[j])) for j in fit]
                    names = ["row", "window", "score", "vec_id", "entry"]
                    yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(5)], names)

        return blocks.join(anchors, "cluster").select("rows", "anchors").mapInArrow(run, "row long, window long, score long, vec_id long, entry long")


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, **lists) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from vectors (vec_id, label, embedding).

    For each anchor (vec_id divisible by `every`) its first `positives` other rows of the same label, and for each of these the
    first `negatives` rows of other labels whose score lies from least to most per cent of the positive's. Rows are those of
    usable(). A pair of an anchor and a positive without such rows gives none; an anchor whose id repeats is answered for each
    of its rows; a repeated row is found as often; a zero vector scores 0 with all. A vector that is shorter than others counts
    as filled up with zeros. Scores are exact while they fit in 64 bits. No rows give none.
    """
    scratch = Scratch()
    spark = vectors.sparkSession
    ship(spark)
    try:
        walked = Lists(usable(vectors), every, scratch, **lists)
        edge = 2**62
        first = walked.anchors.select("row", F.lit(0).cast("long").alias("window"), F.lit(True).alias("same"), F.lit(-edge).alias("low"), F.lit(edge).alias("high"))
        near = scratch.written(walked.best(first, positives).select("row", F.col("rank").cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
        p = F.col("positive_score")
        share = lambda percent, up: F.expr(f"({percent} * positive_score {'+ pmod(-' if up else '- pmod('}{percent} * positive_score, 100)) div 100")
        windows = near.where(p >= 0).select("row", "window", F.lit(False).alias("same"), share(least, True).alias("low"), share(most, False).alias("high"))
        hard = walked.best(windows, negatives)
        rows = hard.select("row", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(near, ["row", "window"])
        rows = rows.join(walked.anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        return written(rows.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    finally:
        scratch.drop()


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose vec_id is divisible by 50; see hard_negatives()."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLES = {
    "op11_hard_negatives": """
WITH e AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row AS other, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.vec_id)::INT AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""
}

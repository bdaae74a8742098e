"""Repeated passages by De Bruijn compaction over words.

Every window of WINDOW words is an edge from its first WINDOW - 1 words to its last. The graph is never written edge by edge:
each text's edges are cut into paths where their seed changes (the run of SEED words with the smallest hash in the window,
the first of equal ones), so equal windows are found under the same seed at the same place. A path is known by its seed and the
hash of all its words, 64 bits each. Then

1. seeds that stand in one place only are left out: nothing there repeats;
2. a path whose words occur twice repeats whole;
3. a seed with several different paths may hide windows that they share: their edges are counted one by one;
4. paths that always follow each other are joined to longer ones: the link from one to its only successor doesn't branch where
   both occur equally often, which a join of paths with their successors tells. Joined paths are what a text gets back;
5. at their coordinates in the texts the words of the joined paths are hashed again (BLAKE2), and these must agree too.

Which seeds stand twice, and which have several paths, the tasks learn from two bitmaps of fixed size, which only save work:
what they let through by chance is dropped by the exact joins after them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistaframe.llm.common import Scratch, ship, table, written
from vistaframe.llm.words import STEP, mixed, text_lists, word_hashes

#: Words of a window and of a seed.
WINDOW, SEED = 35, 8
#: Windows that are cut together.
SLICE = 1 << 20
#: Bits of a bitmap: 8 MB whatever the input.
BITS = 1 << 26
#: A seed with more different paths than this has its edges counted by Spark's aggregation, others inside a task.
LIGHT = 4096
#: Paths that a task remembers to have sent.
HELD = 500_000

#: Sets of hashes that are tried until none collides.
TRIES = 4

BYTES = np.arange(256, dtype=np.uint8)
BASE = STEP | 1
PLACE_BITS = np.uint64(24)


def powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


@dataclass
class Spans:
    """Hashes of any spans of a run of word hashes."""

    sums: np.ndarray
    back: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray) -> Spans:
        n = len(words)
        return cls(np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(n, BASE), dtype=np.uint64)]), powers(n, pow(BASE, -1, 1 << 64)))

    def hashes(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[starts + lengths] - self.sums[starts]) * self.back[starts] + np.asarray(lengths).astype(np.uint64) * np.uint64(STEP))


@dataclass
class Paths:
    """Paths of some texts: whose text, from which window of it, how many windows, seed, hash of the words, and of the next path's words (0: none follows)."""

    owner: np.ndarray
    start: np.ndarray
    n: np.ndarray
    seed: np.ndarray
    content: np.ndarray
    following: np.ndarray
    first: np.ndarray
    spans: Spans

    def edges(self, chosen: np.ndarray) -> np.ndarray:
        """Hashes of the windows of the chosen paths, one after the other."""
        n = self.n[chosen]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.spans.hashes(np.repeat(self.first[chosen], n) + place, WINDOW).view(np.int64)


def cut(texts: list[bytes], salt: int = 0) -> Iterator[Paths]:
    """The paths of texts. A long run of words is cut in slices; a path that two slices share is two."""
    words, counts, _ = word_hashes(texts, fold=BYTES)
    words = mixed(words ^ np.uint64(salt)) if salt else words
    owner, first = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
    for low in range(0, len(words) - WINDOW + 1, SLICE):
        part, own = words[low : low + SLICE + WINDOW - 1], owner[low : low + SLICE + WINDOW - 1]
        k = len(part) - WINDOW + 1
        inside = own[:k] == own[WINDOW - 1 :]
        if not inside.any():
            continue
        spans = Spans.of(part)
        seeds = spans.hashes(np.arange(len(part) - SEED + 1), SEED)
        least, width = seeds >> PLACE_BITS << PLACE_BITS | np.arange(len(seeds), dtype=np.uint64), 1
        while 2 * width <= WINDOW - SEED + 1:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        rest = WINDOW - SEED + 1 - width
        at = (np.minimum(least[:k], least[rest : rest + k]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
        starts, marks = np.flatnonzero(begins), np.flatnonzero(np.append(begins | ~inside, True))
        n = marks[np.searchsorted(marks, starts) + 1] - starts
        content = spans.hashes(starts, n + WINDOW - 1)
        following = np.where(np.append(starts[1:], -1) == starts + n, np.append(content[1:], np.uint64(0)), np.uint64(0))
        owners = own[starts]
        yield Paths(owners, starts + low - first[owners], n, seeds[at[starts]].view(np.int64), content.view(np.int64), following.view(np.int64), starts, spans)


def marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (64-bit) have their bit."""
    bit = values.view(np.uint64) & np.uint64(BITS - 1)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(bits: DataFrame) -> np.ndarray:
    """A bitmap of the numbers in bits (bit, below BITS): words of 64 bits are put together by Spark, BITS / 64 of them at most come here."""
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("set"))
    found = words.toArrow()
    out = np.zeros(BITS >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return out


def arrow(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


class Graph:
    """Tables of the texts (key, tail, text; no nulls) on the way from seeds to what repeats. key and tail name a text by its hashes."""

    def __init__(self, texts: DataFrame, scratch: Scratch, salt: int = 0) -> None:
        self.texts, self.scratch, self.salt = texts, scratch, salt
        self.context = texts.sparkSession.sparkContext

    def repeated_seeds(self) -> np.ndarray:
        """A bitmap of the seeds that stand in two places or more."""
        salt = self.salt

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, texts in text_lists(batch, 0):
                    for paths in cut(texts, salt):
                        bit, n = np.unique(paths.seed & (BITS - 1), return_counts=True)
                        yield arrow(["bit", "n"], bit.astype(np.int32), n.astype(np.int32))

        seen = self.texts.select("text").mapInArrow(run, "bit int, n int")
        return bitmap(seen.groupBy("bit").agg(F.sum("n").alias("n")).where("n > 1"))

    def paths(self, seeds: np.ndarray) -> DataFrame:
        """(key, tail, start, n, seed, content, following) of the paths whose seed is marked."""
        salt, bits = self.salt, self.context.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, tail = (batch.column(c).to_numpy() for c in ("key", "tail"))
                for low, _, texts in text_lists(batch, 2):
                    for p in cut(texts, salt):
                        m = marked(bits.value, p.seed)
                        at = p.owner[m] + low
                        yield arrow(["key", "tail", "start", "n", "seed", "content", "following"], key[at], tail[at], p.start[m].astype(np.int32), p.n[m].astype(np.int8), p.seed[m], p.content[m], p.following[m])

        return self.texts.select("key", "tail", "text").mapInArrow(run, "key long, tail int, start int, n tinyint, seed long, content long, following long")

    def edges(self, seeds: np.ndarray) -> DataFrame:
        """(seed, content, edges): the windows of paths whose seed is marked; a task sends a path again only when it has sent many others."""
        salt, bits = self.salt, self.context.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent: set[int] = set()
            for batch in batches:
                for _, _, texts in text_lists(batch, 0):
                    for p in cut(texts, salt):
                        chosen = np.flatnonzero(marked(bits.value, p.seed))
                        chosen = chosen[np.sort(np.unique(p.content[chosen], return_index=True)[1])]
                        new = [c not in sent for c in p.content[chosen].tolist()]
                        chosen = chosen[np.array(new, bool)]
                        sent.update(p.content[chosen].tolist())
                        ends = np.concatenate([[0], np.cumsum(p.n[chosen])]).astype(np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(p.seed[chosen]), pa.array(p.content[chosen]), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.edges(chosen)))], ["seed", "content", "edges"])
                        if len(sent) > HELD:
                            sent.clear()

        return self.texts.select("text").mapInArrow(run, "seed long, content long, edges array<long>")

    def repeats(self) -> tuple[DataFrame, DataFrame]:
        """The paths under seeds that stand twice, and of these the different ones that repeat: (seed, content, mask, whole, inner). Bit k of
        mask: the k-th window repeats; whole: the path occurs twice; inner: it always follows the same path, which always precedes it."""
        keep = self.scratch.written
        paths = keep(self.paths(self.repeated_seeds()))
        different = keep(paths.groupBy("seed", "content").agg(F.count(F.lit(1)).alias("often"), F.first("n").alias("n"), F.min("following").alias("_low"), F.max("following").alias("_high")).select("seed", "content", "often", "n", F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(0).alias("following")))
        open_seeds = keep(different.groupBy("seed").agg(F.count(F.lit(1)).alias("paths"), F.max("often").alias("most")).where("paths > 1").select("seed", "paths"))
        windows = self.edges(bitmap(open_seeds.select(F.expr(f"seed & {BITS - 1}L").alias("bit")).distinct()))
        known = different.join(open_seeds, "seed").select("seed", "content", "often", "paths")
        windows = keep(windows.groupBy("seed", "content").agg(F.first("edges").alias("edges")).join(known, ["seed", "content"]))
        shared = light_masks(windows.where(F.col("paths") <= LIGHT)).union(heavy_masks(windows.where(F.col("paths") > LIGHT)))
        whole = different.where("often > 1").select("seed", "content", F.expr("shiftleft(1L, CAST(n AS INT)) - 1").alias("mask"), "often", "following")
        joined = whole.where("following <> 0").select(F.col("following").alias("content"), F.col("often").alias("_often"))
        # A path that follows several is nobody's inner one: it is more frequent than each of them.
        linked = whole.join(joined.groupBy("content").agg(F.max("_often").alias("_often")), "content", "left").select("seed", "content", "mask", F.lit(True).alias("whole"), F.coalesce(F.col("_often") == F.col("often"), F.lit(False)).alias("inner"))
        return paths, linked.union(shared.where("mask <> 0").select("seed", "content", "mask", F.lit(False), F.lit(False)))


def light_masks(windows: DataFrame) -> DataFrame:
    """(seed, content, mask) of the paths that occur once in windows (seed, content, edges, often, paths): a seed's paths are put side by side in a task, LIGHT of them at most."""

    def masks(rows: pa.Table) -> pa.RecordBatch:
        seed, content, often = (rows.column(c).to_numpy() for c in ("seed", "content", "often"))
        edges = rows.column("edges").combine_chunks()
        sizes = edges.value_lengths().to_numpy()
        owner, edge = np.repeat(np.arange(len(seed)), sizes), edges.flatten().to_numpy()
        order = np.lexsort((edge, seed[owner]))
        s, e = seed[owner][order], edge[order]
        group = np.cumsum(np.concatenate([[0], (s[1:] != s[:-1]) | (e[1:] != e[:-1])])) if len(s) else np.zeros(0, np.int64)
        total = np.bincount(group, often[owner][order])[group] if len(s) else np.zeros(0)
        place = (np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order]
        bit = np.where(total > 1, np.left_shift(1, place), 0)
        mask = np.zeros(len(seed), np.int64)
        np.add.at(mask, owner[order], bit)
        once = often == 1
        return arrow(["seed", "content", "mask"], seed[once], content[once], mask[once])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if rows.num_rows:
                seed = rows.column("seed").to_numpy()
                whole = int(np.searchsorted(seed, seed[-1]))
                yield masks(rows.slice(0, whole))
                held = rows.slice(whole)
        if held is not None:
            yield masks(held)

    return windows.select("seed", "content", "edges", "often").repartition("seed").sortWithinPartitions("seed").mapInArrow(run, "seed long, content long, mask long")


def heavy_masks(windows: DataFrame) -> DataFrame:
    """The same as light_masks() where a seed has so many paths that no task should hold them: edges are counted by partial aggregation."""
    each = windows.select("seed", "content", "often", F.posexplode("edges").alias("place", "edge"))
    repeated = each.groupBy("seed", "edge").agg(F.sum("often").alias("_n")).where("_n > 1").select("seed", "edge")
    return each.where("often = 1").join(repeated, ["seed", "edge"]).groupBy("seed", "content").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("mask"))


def spans_of(paths: list[dict]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """From a text's paths (start, mask, whole, inner, content) in order: spans of words [from, to) to remove, and its joined paths (first content, from, to)."""
    spans, joined, ready = [], [], -1
    for p in paths:
        start, mask = p["start"], p["mask"]
        if p["whole"]:
            end = start + mask.bit_length()
            if p["inner"] and start == ready:
                joined[-1] = (*joined[-1][:2], end + WINDOW - 1)
            else:
                joined.append((p["content"], start, end + WINDOW - 1))
            ready, runs = end, [(start, end)]
        else:
            ready, runs = -1, [(start + k, start + k + 1) for k in range(mask.bit_length()) if mask >> k & 1]
        for low, high in runs:
            if spans and low <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], high + WINDOW - 1))
            else:
                spans.append((low, high + WINDOW - 1))
    return spans, joined


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    kept, at = [], 0
    for low, high in spans:
        kept += words[at:low]
        at = high
    return kept + words[at:]


def without_repeats(documents: DataFrame) -> DataFrame:
    """documents with their text less the words of repeated windows, and with words (how many it had) and removed (how many went).

    A word is a run of anything but ASCII white space, a window WINDOW words of one text. Repeated: its words also start
    elsewhere, in the same text too; a row that repeats is a place of its own. Words that stay are joined by one space; a null
    text stays null, texts shorter than a window lose none. No rows give none. A text is split whole in a task.
    """
    found = _applied(documents, lambda kept: pa.array(kept, pa.binary()).cast(pa.string()))
    text = {"text": F.when(~F.col("absent"), F.col("made")).alias("text")}
    return found.select(*[text.get(c, F.col(f"row.`{c}`")) for c in documents.columns], "words", "removed")


def repeated_passages(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of documents (doc_id, text): without_repeats() with the hash of what stays."""
    found = _applied(documents.select("doc_id", "text"), lambda kept: pa.array([hashlib.sha256(k).hexdigest() for k in kept]))
    return found.select("row.doc_id", F.col("words").alias("n_words"), F.col("removed").alias("n_removed"), F.col("made").alias("kept_sha256"))


def _applied(documents: DataFrame, made: Callable[[list[bytes]], pa.Array]) -> DataFrame:
    """(row, absent, words, removed, made, joined): row without text, whether text is null, and what `made` makes of the words that stay."""
    spark = documents.sparkSession
    ship(spark)
    body = F.coalesce("text", F.lit(""))
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    rows = documents.select(F.struct(*others, F.lit(None).cast("string").alias("text")).alias("row"), F.col("text").isNull().alias("absent"), F.xxhash64(body).alias("key"), F.hash(body).alias("tail"), body.cast("binary").alias("text"))
    for salt in range(TRIES):
        scratch = Scratch()
        try:
            paths, repeated = Graph(rows, scratch, salt).repeats()
            found = paths.select("key", "tail", "start", "seed", "content").join(repeated, ["seed", "content"])
            by_text = found.groupBy("key", "tail").agg(F.array_sort(F.collect_set(F.struct("start", "mask", "whole", "inner", "content"))).alias("paths"))
            result = written(_removed(rows.join(by_text, ["key", "tail"], "left").select("row", "absent", "text", "paths"), made))
            certificates = result.select(F.explode("joined").alias("j")).groupBy("j.content", "j.words", "j.digest").agg(F.count(F.lit(1)).alias("n"))
            # A joined path whose words stand nowhere again was a collision of hashes: take others.
            if certificates.where("n = 1").isEmpty():
                return result
        finally:
            scratch.drop()
    raise RuntimeError(f"hashes collided {TRIES} times")


def _removed(rows: DataFrame, made: Callable[[list[bytes]], pa.Array]) -> DataFrame:
    """rows (row, absent, text, paths) as _applied() returns them; joined: digests of the words of each joined path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("content", pa.int64()), ("words", pa.int32()), ("digest", pa.binary())]))
        for batch in batches:
            for low, high, texts in text_lists(batch, 2):
                part, n_words, removed, kept, joined = batch.slice(low, high - low), [], [], [], []
                for data, paths in zip(texts, part.column("paths").to_pylist(), strict=True):
                    words = data.split()
                    spans, whole = spans_of(paths or [])
                    n_words.append(len(words))
                    removed.append(sum(b - a for a, b in spans))
                    kept.append(b" ".join(kept_words(words, spans)))
                    joined.append([{"content": c, "words": b - a, "digest": hashlib.blake2b(b" ".join(words[a:b]), digest_size=16).digest()} for c, a, b in whole])
                columns = [part.column("row"), part.column("absent"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), made(kept), pa.array(joined, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "absent", "words", "removed", "made", "joined"])

    schema = rows.select("row", "absent", F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("removed"), F.lit("").alias("made")).schema
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    certificate = T.StructType([T.StructField("content", T.LongType()), T.StructField("words", T.IntegerType()), T.StructField("digest", T.BinaryType())])
    return rows.mapInArrow(run, schema.add("joined", T.ArrayType(certificate)))


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in repeated windows of 35 words in all documents; see repeated_passages()."""
    return repeated_passages(table(spark, sf_dir, "documents"))


QUERIES = {"op12_repeated_passages": op12_repeated_passages}
ORACLES = {
    "op12_repeated_passages": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d),
k AS (SELECT row, pos, sha256(array_to_string(words[pos:pos + 34], ' ')) AS edge FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS pos FROM d)),
r AS (SELECT row, pos FROM k WHERE edge IN (SELECT edge FROM k GROUP BY edge HAVING count(*) > 1)),
c AS (SELECT w.row, w.pos, word, max(r.pos) OVER (PARTITION BY w.row ORDER BY w.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM w LEFT JOIN r ON r.row = w.row AND r.pos = w.pos),
t AS (SELECT row, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (row)
"""
}

"""Spelling variants by an index of grams of variable length.

Two words are near if one inserted, deleted or replaced code point makes one the other. Words of a length class (the shorter
word's length) are cut into grams of SHORTEST to longest(class) code points: at each place the gram is extended while it is
heavy (frequent in the dictionary), and a gram that an earlier one covers is left out. One edit can affect only grams at its
place and the few after it that a longer gram could newly cover, so every word has a bound on the grams it can lose. Near
words share all but these; hence they share one of the (bound + 1) rarest grams of either, at the same place or one further.
Only these enter the index. Candidates of a list are verified where they meet.

A class's grams are at most half its words long, so a word always keeps a gram: none falls out of the index.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import Scratch, ship, table, written

#: Code points of a word at least, occurrences at least, and how much more frequent a form is.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: Shortest gram, and the longest of any class.
SHORTEST, LONGEST = 2, 6
#: A gram is heavy from a share of 1 / HEAVY of all places, so there are at most HEAVY heavy grams of each length.
HEAVY = 1 << 14
#: One run in so many (by crc32) loses a code point.
MISPRINT = 31
#: Words counted in a task before the counts are passed on.
HELD = 200_000

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
#: Lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def observed_words(texts: DataFrame) -> DataFrame:
    """(word, n): how often each word of LEAST_LENGTH code points or more occurs in texts (doc_id, text), n LEAST_COUNT or more.

    Runs are lower-cased A to Z only. A run whose crc32 with its document's id MISPRINT divides loses the code point at
    crc32 % length. Null texts have none; a null id reads as empty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counts() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                prefix = f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode()
                start = zlib.crc32(prefix)
                for run, n in Counter(RUN.findall(text.as_buffer().to_pybytes().translate(LOWER).decode())).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % MISPRINT == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    seen[run] += n
                if len(seen) > HELD:
                    yield counts()
        yield counts()

    return texts.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def longest(length: int) -> int:
    """The longest gram of the class of words of this length: half of it, so that one edit leaves a gram of every word."""
    return max(SHORTEST, min(LONGEST, length // 2))


def heavy_grams(words: DataFrame, share: int = HEAVY) -> frozenset[str]:
    """The grams of SHORTEST to LONGEST - 1 code points that at least one in `share` places of that length holds: (LONGEST - SHORTEST) * share at most, whatever the words."""
    grams = words.select(F.explode(F.sequence(F.lit(SHORTEST), F.lit(LONGEST - 1))).alias("size"), "word")
    placed = grams.select("size", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - F.col("size") + 1), lambda at: F.substring("word", at, F.col("size")))).alias("gram"))
    counts = placed.groupBy("size", "gram").agg(F.count(F.lit(1)).alias("n"))
    most = placed.groupBy("size").agg(F.count(F.lit(1)).alias("total"))
    return frozenset(r["gram"] for r in counts.join(F.broadcast(most), "size").where(F.col("n") * share >= F.col("total")).select("gram").collect())


def grams(word: str, heavy: frozenset[str], most: int) -> list[tuple[int, str]]:
    """The grams (place, gram) of a word: at each place the shortest that isn't heavy, of `most` code points at most and cut at the word's end; none that an earlier one covers."""
    out, reach = [], 0
    for at in range(len(word) - SHORTEST + 1):
        end = at + SHORTEST
        while end < len(word) and end - at < most and word[at:end] in heavy:
            end += 1
        if end > reach:
            out.append((at, word[at:end]))
            reach = end
    return out


def can_lose(found: list[tuple[int, str]], length: int, most: int) -> int:
    """How many of a word's grams one edit can affect at most.

    An edit at place i (of 0 to length) affects grams that hold it, one cut at the word's end if i is there, and grams after it
    that end within `most` of i, which a new gram at or before i could cover. Others start and end as before, as where a
    gram ends depends only on what it holds.
    """
    spans = [(at, at + len(gram)) for at, gram in found]
    return max(sum(1 for a, e in spans if a <= i < e or i == e == length or (a > i and e <= i + most)) for i in range(length + 1))


def letters(word: str) -> int:
    """A bit for each code point that a word holds (of 64 by remainder). An edit takes away one and adds one at most."""
    bits = 0
    for c in set(word):
        bits |= 1 << (ord(c) & 63)
    return bits - (bits >> 63 << 64)


def index_rows(words: DataFrame, heavy: frozenset[str]) -> DataFrame:
    """(class, word, n, letters, grams, keep): for each word its grams as a word of its own length's class, and as the longer one of the class below; keep is its bound and one."""
    known = words.sparkSession.sparkContext.broadcast(heavy)

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                held = letters(word)
                for size in (len(word), len(word) - 1):
                    if size >= LEAST_LENGTH:
                        found = grams(word, known.value, longest(size))
                        for column, value in zip(out, (size, word, n, held, [{"at": a, "gram": g} for a, g in found], can_lose(found, len(word), longest(size)) + 1), strict=True):
                            column.append(value)
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("gram", pa.string())])), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["class", "word", "n", "letters", "grams", "keep"])

    return words.select("word", "n").mapInArrow(decompose, "class int, word string, n long, letters long, grams array<struct<at: int, gram: string>>, keep int")


def near_words(words: DataFrame, scratch: Scratch, share: int = HEAVY) -> DataFrame:
    """(a, b, n_a, n_b): each pair of near words of words (word, n; words distinct, LEAST_LENGTH or longer) once, a the shorter one, or the smaller.

    A list is the words of a class that have a gram at a place among their rarest. The shorter words of a list, and the equally
    long ones, meet the others. A list with many words is split by Spark's handling of skewed joins; pairs are verified, first by
    the letters they hold, before they are shuffled.
    """
    rows = scratch.written(index_rows(words, heavy_grams(words, share)))
    each = rows.select("class", "word", "n", "letters", "keep", F.explode("grams").alias("g")).select("class", "word", "n", "letters", "keep", "g.at", "g.gram")
    often = each.groupBy("class", "gram").agg(F.count(F.lit(1)).alias("often"))
    ordered = each.join(often, ["class", "gram"]).groupBy("class", "word", "n", "letters", "keep").agg(F.slice(F.array_sort(F.collect_list(F.struct("often", "gram", "at"))), 1, F.col("keep")).alias("kept"))
    lists = scratch.written(ordered.select("class", "word", "n", "letters", F.explode("kept").alias("g")).select("class", "word", "n", "letters", "g.gram", "g.at"))
    longer = F.char_length("word") > F.col("class")
    # A gram of the longer word stands at the same place in the shorter one, or one earlier.
    places = F.explode(F.when(longer, F.array(F.col("at"), F.col("at") - 1)).otherwise(F.array("at"))).alias("at")
    left = lists.where(~longer).select("class", "gram", "at", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("letters").alias("_a"))
    right = lists.select("class", "gram", places, F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("letters").alias("_b"), longer.alias("_longer"))
    few = F.bit_count(F.col("_a").bitwiseXOR(F.col("_b"))) <= 2
    met = left.join(right, ["class", "gram", "at"]).where(few & (F.col("_longer") | (F.col("a") < F.col("b")))).where(F.levenshtein("a", "b", 1) == 1)
    return met.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for every word of forms (word, form): the last word that following forms reaches. Forms grow RATIO times each, so a few rounds end it."""
    at = scratch.written(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = scratch.written(at.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        at = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return at


def spelling_variants(texts: DataFrame, share: int = HEAVY) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word that texts (doc_id, text) hold; see observed_words().

    A word's form is its most frequent near word (the smallest in code-point order of equal ones) if that is RATIO times as
    frequent as itself, else null with form_n null. root: the last word on following forms, the word itself without one.
    n_near: how many words are near. No texts give no rows.
    """
    scratch = Scratch()
    ship(texts.sparkSession)
    try:
        words = scratch.written(observed_words(texts))
        pairs = near_words(words, scratch, share)
        both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
        best = pairs.select(both.alias("p")).groupBy("p.word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("p.near_n")).alias("minus"), F.col("p.near").alias("near"))).alias("best"))
        rows = words.join(best, "word", "left")
        fits = -F.col("best.minus") >= RATIO * F.col("n")
        rows = scratch.written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")))
        found = rows.join(roots(rows.where("form IS NOT NULL"), scratch), "word", "left")
        return written(found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    finally:
        scratch.drop()


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents; see spelling_variants()."""
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {"op13_spelling_variants": op13_spelling_variants}
ORACLES: dict[str, str] = {}

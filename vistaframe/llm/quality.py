"""Quality: a linear-chain conditional random field labels every line of a text good or bad.

A line's features are shares (of symbols, bars, capitals, repeated words and others) held against fixed edges, with those of
the line before and the line after. Weights are trained in numpy on labelled documents, whose lines carry the document's
label. Forward-backward gives each line's marginal; their mean, weighted by the lines' lengths, is the document's quality,
which a logistic fitted on the sample turns into a probability. All texts of a block step through their lines together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import held_out, ship, table
from vistaframe.llm.labelled import platt, sample, sigmoid
from vistaframe.llm.words import hash_block, text_lists

#: Bytes of text whose features are made together.
BLOCK_BYTES = 1 << 20
ITERATIONS, RATE, PRIOR = 150, 0.2, 1e-3
#: Score from which a text is predicted good.
PREDICTED = 0.3
SHARE_EDGES = np.array([0.001, 0.01, 0.03, 0.1, 0.25, 0.5], np.float32)
COUNT_EDGES = np.array([1, 2, 4, 8, 16, 64], np.float32)


def _flags(test) -> np.ndarray:
    return np.array([bool(test(c)) for c in range(256)])


#: Kinds of bytes that are counted.
KINDS = [
    _flags(lambda c: chr(c) in "*%&$#~^=+<>{}[]\\_@" and c < 128),
    _flags(lambda c: c == ord("|")),
    _flags(lambda c: c == ord("!")),
    _flags(lambda c: 48 <= c <= 57),
    _flags(lambda c: 65 <= c <= 90),
    _flags(lambda c: 97 <= c <= 122),
    _flags(lambda c: chr(c) in ".,;:?'\"()" and c < 128),
]
#: Features of a line: shares first, then counts.
SHARES, COUNTS = 10, 2
FEATURES = 1 + SHARES * len(SHARE_EDGES) + COUNTS * len(COUNT_EDGES)


def _block_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and counts of the lines data[start:end] (columns), and a hash of each line's words."""
    size = np.maximum(ends - starts, 1).astype(np.float32)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int32)
        np.cumsum(flags, out=sums[1:])
        return (sums[ends] - sums[starts]).astype(np.float32)

    kinds = [count(k[data]) for k in KINDS]
    letters = np.maximum(kinds[4] + kinds[5], 1)
    word_at, words, _ = hash_block(data)
    line = np.searchsorted(starts, word_at, "right") - 1
    n = np.bincount(line, minlength=len(starts)).astype(np.float32)
    order = np.lexsort((words, line))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(starts)).astype(np.float32)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (line[1:] == line[:-1])
    doubled = np.bincount(line[same], minlength=len(starts)).astype(np.float32)
    hashes = np.zeros(len(starts), np.uint64)
    np.add.at(hashes, line, words)
    many = np.maximum(n, 1)
    shares = [kinds[0] / size, kinds[1] / size, kinds[2] / size, kinds[3] / size, kinds[4] / letters, kinds[6] / size, 1 - distinct / many, doubled / many, np.zeros_like(n)]
    return np.stack([*shares, np.minimum(size / many / 40, 1), n, ends - starts], axis=1).astype(np.float32), hashes


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary features of all lines of the texts, their lengths in bytes (1 at least), and how many lines each text has (1 at least)."""
    counts, made, hashes, lengths = [], [], [], []
    lines = [t.split(b"\n") for t in texts]
    counts = np.array([len(x) for x in lines])
    flat = [x for own in lines for x in own]
    at = 0
    while at < len(flat):
        end, size = at, 0
        while end < len(flat) and (size < BLOCK_BYTES or end == at):
            size += len(flat[end]) + 1
            end += 1
        sizes = np.array([len(x) for x in flat[at:end]])
        starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
        raw, hashed = _block_features(np.frombuffer(b"\n".join(flat[at:end]), np.uint8), starts, starts + sizes)
        made.append(raw)
        hashes.append(hashed)
        lengths.append(np.maximum(sizes, 1))
        at = end
    raw, hashed, length = np.concatenate(made), np.concatenate(hashes), np.concatenate(lengths)
    # Whether the same words stood in an earlier line of the text.
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((np.arange(len(hashed)), hashed, owner))
    again = np.zeros(len(hashed), bool)
    again[order[1:]] = (hashed[order][1:] == hashed[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    raw[:, 8] = again & (hashed != 0)
    binary = [np.ones((len(raw), 1), np.float32), (raw[:, :SHARES, None] > SHARE_EDGES).reshape(len(raw), -1), (raw[:, SHARES:, None] > COUNT_EDGES).reshape(len(raw), -1)]
    return np.concatenate(binary, axis=1).astype(np.float32), length, counts


def neighbours(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values of the line before and of the line after within each text, zero at its ends."""
    first = np.zeros(len(values), bool)
    first[np.cumsum(counts)[:-1]] = True
    first[0] = True
    before, after = np.zeros_like(values), np.zeros_like(values)
    before[1:] = values[:-1]
    before[first] = 0
    after[:-1] = values[1:]
    after[:-1][first[1:]] = 0
    return before, after


def forward_backward(potential: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of state 1 of every line, and each text's expected moves (texts, 2, 2). potential: log-odds of good against bad."""
    starts = np.concatenate([[0], np.cumsum(counts[:-1])])
    order = np.argsort(-counts, kind="stable")
    starts, sizes = starts[order], counts[order]
    psi = np.stack([np.ones(len(potential)), np.exp(np.clip(potential, -30, 30))], axis=1)
    psi /= psi.sum(axis=1, keepdims=True)
    step = np.exp(moves)
    forward, backward = np.empty_like(psi), np.empty_like(psi)
    active = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), "left")  # texts of more than t lines
    state = np.ones((len(sizes), 2))
    for t in range(sizes[0]):
        at = starts[: active[t]] + t
        now = psi[at] if t == 0 else (state[: active[t]] @ step) * psi[at]
        now /= now.sum(axis=1, keepdims=True)
        state = now
        forward[at] = now
    expected = np.zeros((len(sizes), 2, 2))
    state = np.ones((len(sizes), 2))
    for t in range(sizes[0] - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        backward[at] = state[:n]
        if t:
            arrive = psi[at] * state[:n]
            pair = forward[at - 1][:, :, None] * step * arrive[:, None, :]
            expected[:n] += pair / pair.sum(axis=(1, 2), keepdims=True)
            now = arrive @ step.T
            state[:n] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    back = np.empty_like(expected)
    back[order] = expected
    return both[:, 1] / both.sum(axis=1), back


@dataclass
class Field:
    weights: np.ndarray  # of the line, the one before, the one after
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def potential(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        own = features @ self.weights.T
        return own[:, 0] + neighbours(own[:, 1], counts)[0] + neighbours(own[:, 2], counts)[1]

    def quality(self, texts: list[bytes]) -> np.ndarray:
        """The lines' marginals, weighted by length, as log-odds of each text."""
        features, length, counts = line_features(texts)
        good, _ = forward_backward(self.potential(features, counts), counts, self.moves)
        first = np.concatenate([[0], np.cumsum(counts[:-1])])
        mean = np.clip(np.add.reduceat(good * length, first) / np.add.reduceat(length, first), 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def score(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.quality(texts) + self.shift)


def train(documents: list[tuple[bytes, int, str | None]]) -> Field:
    """A field for (text, label, language). Without labels of both kinds it scores all texts alike."""
    field = Field(np.zeros((3, FEATURES), np.float64), np.zeros((2, 2)))
    y = np.array([v for _, v, _ in documents], np.float64)
    if len(set(y.tolist())) < 2:
        field.slope, field.shift = 0.0, float(np.clip(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), -4, 4))
        return field
    features, _, counts = line_features([t for t, _, _ in documents])
    before, after = neighbours(features, counts)
    owner = np.repeat(np.arange(len(y)), counts)
    # Texts count alike, however many lines they have, and both labels count alike.
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    of_line = (weight / counts)[owner]
    totals = [np.full_like(field.weights, 1e-8), np.full_like(field.moves, 1e-8)]
    seen = np.zeros((len(y), 2, 2))
    seen[np.arange(len(y)), y.astype(int), y.astype(int)] = counts - 1
    for k in range(ITERATIONS):
        good, expected = forward_backward(field.potential(features, counts), counts, field.moves)
        error = (y[owner] - good) * of_line
        up = np.stack([error @ features, error @ before, error @ after]) - PRIOR * field.weights
        up_moves = ((seen - expected) * (weight / counts)[:, None, None]).sum(axis=0) - PRIOR * field.moves
        for own, total, gradient in ((field.weights, totals[0], up), (field.moves, totals[1], up_moves)):
            total += gradient**2
            own += RATE * gradient / np.sqrt(total)
    field.slope, field.shift = platt(field.quality([t for t, _, _ in documents]), y)
    return field


def scores(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """(kept, score) of docs: a struct of the columns keep, and the score of the whole text; a null text is an empty one, a single empty line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in text_lists(batch, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(field.score(texts), pa.float64())], ["kept", "score"])

    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").cast("binary"))
    return plain.mapInArrow(run, plain.select("kept", F.lit(0.0).alias("score")).schema)


def field_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Field:
    ship(spark)
    return train(sample(docs, table(spark, sf_dir, "labels"), "quality", folds=5, fold=0))


def good_documents(docs: DataFrame, field: Field) -> DataFrame:
    """docs without the rows whose score is below PREDICTED."""
    return scores(docs, field, docs.columns).where(F.col("score") >= PREDICTED).select(*[F.col(f"kept.`{c}`").alias(c) for c in docs.columns])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text of documents: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = scores(docs, field_of(spark, docs, sf_dir), ["doc_id"])
    doc_id = F.col("kept.doc_id")
    return scored.select(doc_id, held_out(doc_id, 5, 0).alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}

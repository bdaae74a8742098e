"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of rows of one hashed table: of the word and of its first bytes, so compounds of a word are
near it. Filters of several widths run over the words, their largest responses over the whole text (max pooling) go through
one linear layer. Rows of words of the sample start from the log-odds of the texts that hold them; others stay zero.
Training goes through the pooled windows only. Rows are stored in single precision, and sums and products are in double, so
that machines agree. Settings were chosen by folds of the labelled documents outside the held-out fold. Thresholds are calibrated by language on a fifth of the sample that the weights don't see; the language is no
input of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import held_out, ship, table
from vistaframe.llm.labelled import sample, sigmoid
from vistaframe.llm.words import IS_LETTER, text_lists, word_hashes

ROWS, DIMS = 1 << 20, 8
PREFIXES = (4, 6, 7, 8)
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE = 5, 16, 0.08
#: Standard errors of a row's log-odds beyond which it starts above zero.
SURE = 1.5
#: Documents that hold a word before its row is learnt.
LEAST_HELD = 1
#: Labelled documents that the network learns from, at most.
SAMPLE = 6000
#: Words that go through the filters at a time; windows of neighbouring parts overlap.
PART_WORDS = 1 << 15
#: Score from which a text is predicted toxic; and the least positives of a language that set a threshold of its own.
PREDICTED, LEAST_POSITIVES = 0.7, 20


def word_rows(texts: list[bytes]) -> list[np.ndarray]:
    """For each text an array (words, 1 + prefixes) of table rows."""
    whole, counts, parts = word_hashes(texts, PREFIXES, IS_LETTER)
    rows = np.stack([(h >> np.uint64(44)).astype(np.int32) for h in (whole, *parts)], axis=1)
    return np.split(rows, np.cumsum(counts)[:-1])


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]  # of each width: (width * DIMS, FILTERS)
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]
    threshold: float

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest responses and the windows' first words they come from; windows may reach over both ends, where words are zero."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float64)
        where = np.zeros(len(WIDTHS) * FILTERS, np.int64)
        edge = max(WIDTHS) - 1
        for at in range(0, max(1, len(rows)), PART_WORDS):
            first = max(0, at - edge)
            part = rows[first : at + PART_WORDS]
            left, right = edge * (at == 0), edge * (at + PART_WORDS >= len(rows))
            words = np.zeros((left + len(part) + right, DIMS), np.float64)
            words[left : left + len(part)] = self.table[part].sum(axis=1)
            for k, width in enumerate(WIDTHS):
                n = len(words) - width + 1
                response = words[:n] @ self.filters[k][:DIMS]
                for j in range(1, width):
                    response += words[j : j + n] @ self.filters[k][j * DIMS : (j + 1) * DIMS]
                top = response.argmax(axis=0)
                found = np.maximum(response[top, np.arange(FILTERS)] + self.biases[k], 0)
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                better = found > best[own]
                best[own] = np.where(better, found, best[own])
                where[own] = np.where(better, top + first - left, where[own])
        return best, where

    def score(self, rows: np.ndarray) -> float:
        return float(sigmoid(np.array(self.pooled(rows)[0] @ self.out + self.out_bias)))


def new_network(random: np.random.Generator) -> Network:
    n = len(WIDTHS) * FILTERS
    return Network(np.zeros((ROWS, DIMS), np.float32), [random.normal(0, 0.5, (w * DIMS, FILTERS)).astype(np.float64) for w in WIDTHS], [np.full(FILTERS, 0.1, np.float64) for _ in WIDTHS], random.normal(0, 0.5, n).astype(np.float64), -1.0, {}, PREDICTED)


def train(documents: list[tuple[bytes, int, str | None]], seed: int = 5) -> Network:
    """A network for (text, label, language). Without labels of both kinds, it scores all texts alike."""
    random = np.random.default_rng(seed)
    net = new_network(random)
    rows = word_rows([t for t, _, _ in documents]) if documents else []
    y = np.array([v for _, v, _ in documents], np.float64)
    if len(set(y.tolist())) < 2:
        net.out[:] = 0
        net.out_bias = float(np.clip(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), -4, 4))
        return net
    calibration = np.arange(len(y)) % 5 == 4
    if len(set(y[~calibration].tolist())) < 2:
        calibration[:] = False
    # Table rows that LEAST_HELD documents of the training part hold.
    held = np.zeros((2, ROWS), np.float64)
    for k in np.flatnonzero(~calibration):
        held[int(y[k]), np.unique(rows[k])] += 1
    usable = held.sum(axis=0) >= LEAST_HELD
    # Pooling finds nothing in zeros: rows that toxic texts hold far more often start with how surely they do.
    sizes = [float((y[~calibration] == v).sum()) for v in (0, 1)]
    odds = np.log((held[1] + 0.5) / (sizes[1] + 1)) - np.log((held[0] + 0.5) / (sizes[0] + 1))
    surely = odds / np.sqrt(1 / (held[1] + 0.5) + 1 / (held[0] + 0.5))
    net.table[usable, 0] = np.clip(surely[usable] - SURE, 0, 4) / 4
    totals = {"table": np.full(ROWS, 1e-4, np.float64), "filters": [np.full_like(f, 1e-2) for f in net.filters], "biases": [np.full_like(b, 1e-2) for b in net.biases], "out": np.full_like(net.out, 1e-2), "out_bias": 1e-2}
    weight = np.where(y > 0, min(8.0, float((y == 0).sum() / max(1, y.sum()))) ** 0.5, 1.0)
    edge = max(WIDTHS) - 1
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 0.01
        order = random.permutation(np.flatnonzero(~calibration))
        for start in range(0, len(order), BATCH):
            grads = [np.zeros_like(f) for f in net.filters], [np.zeros_like(b) for b in net.biases], np.zeros_like(net.out)
            bias_grad, touched, values = 0.0, [], []
            for k in order[start : start + BATCH]:
                best, where = net.pooled(rows[k])
                error = float((sigmoid(np.array(best @ net.out + net.out_bias)) - y[k]) * weight[k])
                grads[2][:] += error * best
                bias_grad += error
                back = error * net.out * (best > 0)
                padded = np.concatenate([np.full((edge, rows[k].shape[1]), -1, np.int32), rows[k], np.full((edge, rows[k].shape[1]), -1, np.int32)])
                for i, width in enumerate(WIDTHS):
                    for j in np.flatnonzero(back[i * FILTERS : (i + 1) * FILTERS]):
                        g = back[i * FILTERS + j]
                        at = where[i * FILTERS + j] + edge
                        window = padded[at : at + width]
                        known = window[:, 0] >= 0
                        words = np.where(known[:, None], net.table[window].sum(axis=1), 0)
                        grads[0][i][:, j] += g * words.reshape(-1)
                        grads[1][i][j] += g
                        touched.append(window[known].reshape(-1))
                        values.append(np.repeat(g * net.filters[i][:, j].reshape(width, DIMS)[known], window.shape[1], axis=0))
            for own, total, grad in [*zip(net.filters, totals["filters"], grads[0], strict=True), *zip(net.biases, totals["biases"], grads[1], strict=True), (net.out, totals["out"], grads[2])]:
                total += grad**2
                own -= rate * (grad / np.sqrt(total) + 1e-4 * own)
            totals["out_bias"] += bias_grad**2
            net.out_bias -= rate * bias_grad / totals["out_bias"] ** 0.5
            if touched and len(ids := np.concatenate(touched)):
                ids, inverse = np.unique(ids, return_inverse=True)
                grad = np.zeros((len(ids), DIMS), np.float64)
                np.add.at(grad, inverse, np.concatenate(values))
                grad[~usable[ids]] = 0
                totals["table"][ids] += (grad**2).mean(axis=1)
                net.table[ids] -= rate * grad / np.sqrt(totals["table"][ids])[:, None]
    calibrate(net, [(net.score(rows[k]), int(y[k]), documents[k][2]) for k in np.flatnonzero(calibration)])
    return net


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The middle of the scores between which the F1 measure is best."""
    order = np.argsort(-scores)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(np.argmax(f1))
    below = scores[order[k + 1]] if k + 1 < len(y) else 0.0
    return float(np.clip((scores[order[k]] + below) / 2, 0.5, 0.9))


def calibrate(net: Network, scored: list[tuple[float, int, str | None]]) -> None:
    """Sets the threshold of all languages, and of each that has positives enough."""
    s, y = np.array([x[0] for x in scored]), np.array([x[1] for x in scored])
    if y.sum() >= LEAST_POSITIVES:
        net.threshold = best_threshold(s, y)
    for lang in sorted({x[2] for x in scored if x[2] is not None}):
        own = np.array([x[2] == lang for x in scored])
        if y[own].sum() >= LEAST_POSITIVES:
            net.thresholds[lang] = best_threshold(s[own], y[own])


def packed(net: Network) -> dict:
    """The network with its used table rows only, for the executors: as large as the bounded sample's vocabulary."""
    used = np.flatnonzero(net.table.any(axis=1)).astype(np.int32)
    return {"used": used, "values": net.table[used], "rest": (net.filters, net.biases, net.out, net.out_bias, net.thresholds, net.threshold)}


def unpacked(data: dict) -> Network:
    full = np.zeros((ROWS, DIMS), np.float32)
    full[data["used"]] = data["values"]
    return Network(full, *data["rest"])


def scores(docs: DataFrame, net: Network, keep: list[str]) -> DataFrame:
    """(kept, score) of docs: a struct of the columns keep, and the score of the whole text; a null text is an empty one, which has a score too."""
    sent = docs.sparkSession.sparkContext.broadcast(packed(net))
    own: dict[str, Network] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = own.setdefault("net", unpacked(sent.value))
        for batch in batches:
            for start, end, texts in text_lists(batch, 1):
                found = pa.array([model.score(r) for r in word_rows(texts)], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), found], ["kept", "score"])

    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("text").cast("binary"))
    return plain.mapInArrow(run, plain.select("kept", F.lit(0.0).alias("score")).schema)


def network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network:
    ship(spark)
    return train(sample(docs, table(spark, sf_dir, "labels"), "toxic", folds=3, fold=1, size=SAMPLE))


def without_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """docs without the rows whose score reaches the threshold of their language (column lang, if there is one), or else that of all."""
    limit = F.lit(net.threshold)
    if "lang" in docs.columns:
        for lang, own in net.thresholds.items():
            limit = F.when(F.col("kept.lang") == lang, own).otherwise(limit)
    return scores(docs, net, docs.columns).where(F.col("score") < limit).select(*[F.col(f"kept.`{c}`").alias(c) for c in docs.columns])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of documents: doc_id, held_out, score, predicted, and by_language, the prediction at the language's own threshold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = network(spark, docs, sf_dir)
    limit = F.lit(net.threshold)
    for lang, own in net.thresholds.items():
        limit = F.when(F.col("kept.lang") == lang, own).otherwise(limit)
    scored = scores(docs, net, ["doc_id", "lang"])
    doc_id, score = F.col("kept.doc_id"), F.col("score")
    return scored.select(doc_id, held_out(doc_id, 3, 1).alias("held_out"), "score", (score >= PREDICTED).cast("int").alias("predicted"), (score >= limit).cast("int").alias("by_language"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}

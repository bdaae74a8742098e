"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed together; a longer text is cut at white space.
BLOCK_BYTES = 1 << 20
SPACES = [9, 10, 11, 12, 13, 32]

IS_WORD = np.ones(256, bool)
IS_WORD[SPACES] = False
#: ASCII letters and digits and all that isn't ASCII.
IS_LETTER = np.array([c > 127 or chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_random = np.random.default_rng(20240611)
#: A random number for each byte, and the multiplier for each place in a word.
BYTE_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = 0x9E3779B97F4A7C15
PLACE_VALUE = np.multiply.accumulate(np.full(4096, STEP, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes (the public splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place_values(n: int) -> np.ndarray:
    return PLACE_VALUE if n <= len(PLACE_VALUE) else np.multiply.accumulate(np.full(n, STEP, np.uint64))


def hash_block(data: np.ndarray, prefixes: tuple[int, ...] = (), is_word: np.ndarray = IS_WORD, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Starts and hashes of the words in a run of bytes, and hashes of their first k bytes for each k of prefixes."""
    inside = is_word[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64), [np.zeros(0, np.uint64) for _ in prefixes]
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    value = BYTE_VALUE[fold[data[inside]]] * place_values(int(lengths.max()))[place]
    whole = mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))
    parts = [mixed(np.add.reduceat(np.where(place < k, value, np.uint64(0)), first) + np.uint64(k << 32)) for k in prefixes]
    return starts, whole, parts


def word_hashes(texts: list[bytes], prefixes: tuple[int, ...] = (), is_word: np.ndarray = IS_WORD, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes of all words of the texts in order, how many words each text has, and the hashes of the words' first k bytes for each k of prefixes.

    Words are runs of the bytes of is_word, by default of anything but ASCII white space; A-Z count as a-z, or
    as another fold of bytes says.
    """
    counts = np.zeros(len(texts), np.int64)
    found, parts = [], []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size + len(texts[end]) <= BLOCK_BYTES or end == at):
            size += len(texts[end]) + 1
            end += 1
        for k, block in _cut(texts, at, end):
            data = np.frombuffer(block, np.uint8)
            starts, whole, part = hash_block(data, prefixes, is_word, fold)
            if k is None:
                bounds = np.cumsum([len(t) + 1 for t in texts[at:end]])
                counts[at:end] = np.diff(np.searchsorted(starts, bounds), prepend=0)
            else:
                counts[k] += len(whole)
            found.append(whole)
            parts.append(part)
        at = end
    join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.uint64)
    return join(found), counts, [join([p[i] for p in parts]) for i in range(len(prefixes))]


def _cut(texts: list[bytes], at: int, end: int) -> Iterator[tuple[int | None, bytes]]:
    """The texts joined, or one long text (its number) in blocks that end between words."""
    if end - at > 1 or len(texts[at]) <= 2 * BLOCK_BYTES:
        yield None, b"\n".join(texts[at:end])
        return
    text, start = texts[at], 0
    while start < len(text):
        stop = start + BLOCK_BYTES
        while stop < len(text) and IS_WORD[text[stop]]:
            stop += 1
        yield at, text[start:stop]
        start = stop


def text_lists(batch: pa.RecordBatch, column: int, limit: int = 4 * BLOCK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(from row, to row, texts as bytes; null as empty) of a batch, about limit bytes at a time."""
    texts, first, size = [], 0, 0
    for k, value in enumerate(batch.column(column)):
        texts.append(value.as_py() or b"")
        size += len(texts[-1])
        if size >= limit:
            yield first, k + 1, texts
            texts, first, size = [], k + 1, 0
    if texts:
        yield first, batch.num_rows, texts


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of each text as sorted signed hashes: with fewer words the whole sequence is one, without words there are none."""
    words, counts, _ = word_hashes(texts)
    total = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        total += words[j : j + len(total)] * np.uint64((2 * j + 3) * STEP & 0xFFFFFFFFFFFFFFFF)
    total = mixed(total).view(np.int64)
    out, at = [], 0
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(total[at : at + n - k + 1]))
        elif n:
            own = sum(int(w) * ((2 * j + 3) * STEP) for j, w in enumerate(words[at : at + n])) + n
            out.append(mixed(np.array([own & 0xFFFFFFFFFFFFFFFF], np.uint64)).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += n
    return out

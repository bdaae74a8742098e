"""Classifiers, audio and neighbour search: held-out accuracy, round trips and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from vistaframe.llm import audio, labelled, neighbours, quality, toxicity
from vistaframe.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string"
ODD = ["", None, "   \n\t ", "one", "Ünï çode  ", "x" * 5000, "\n" * 300, "w " * 40_000]


def frame(spark, texts):
    return spark.createDataFrame([(k, t, None, "s", len(t or ""), "z", "y") for k, t in enumerate(texts)], DOCS)


def auc(score, y):
    """The share of pairs of a positive and a negative that the score puts in order; ties count half."""
    _, place, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def held_out_rows(spark, query, label):
    rows = query(spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    own = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return rows, np.array([x[0] for x in own]), np.array([x[2] for x in own])


def test_toxicity_on_the_held_out_fold(spark):
    rows, score, y = held_out_rows(spark, toxicity.op4_toxicity, "toxic")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert auc(score, y) > 0.9


def test_quality_on_the_held_out_fold(spark):
    rows, score, y = held_out_rows(spark, quality.op5_quality, "quality")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert auc(score, y) > 0.9


def test_odd_texts_have_scores(spark):
    random_words = random.Random(1)
    good = [("fine words here. " * random_words.randrange(1, 9)).encode() for _ in range(30)]
    bad = [b"### $$$ fine *** idiot %%% " * random_words.randrange(1, 9) for _ in range(30)]
    documents = [(t, 0, None) for t in good] + [(t, 1, None) for t in bad]
    net = toxicity.train(documents)
    field = quality.train([(t, 1 - v, None) for t, v, _ in documents])
    for scores, keeps, model in ((toxicity.scores, toxicity.without_toxic, net), (quality.scores, quality.good_documents, field)):
        out = scores(frame(spark, ODD), model, ["doc_id"]).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
        assert len({r["score"] for r in out if r["kept"]["doc_id"] in (0, 1)}) == 1
        assert scores(frame(spark, []), model, ["doc_id"]).count() == 0
        kept = keeps(frame(spark, [*ODD, "fine words here. " * 5, "### $$$ idiot %%% " * 9]), model)
        assert kept.columns == frame(spark, []).columns
        assert {len(ODD), len(ODD) + 1} & {r["doc_id"] for r in kept.collect()} == {len(ODD)}
    assert toxicity.train([]).score(toxicity.word_rows([b"x"])[0]) == 0.5
    assert 0 < quality.train([(b"a", 1, None)]).score([b"", b"a\nb"])[0] < 1


def test_thresholds_are_calibrated_by_language():
    numbers = np.random.default_rng(4)
    y = np.tile([0, 0, 0, 1], 60)
    lang = np.repeat(["aa", "bb", "cc"], 80)
    # Positives of bb score lower than those of aa; cc has too few to have a threshold of its own.
    scores = np.where(y == 1, np.where(lang == "bb", 0.62, 0.85), 0.3) + 0.02 * numbers.random(240)
    y[lang == "cc"] = [1] * 5 + [0] * 75
    net = toxicity.new_network(numbers)
    toxicity.calibrate(net, [(float(s), int(v), str(g)) for s, v, g in zip(scores, y, lang, strict=True)])
    assert set(net.thresholds) == {"aa", "bb"}
    for g in ("aa", "bb"):
        own = lang == g
        assert ((scores[own] >= net.thresholds[g]) == (y[own] == 1)).all()
    net = toxicity.new_network(numbers)
    toxicity.calibrate(net, [(0.9, 1, None), (0.1, 0, None)])
    assert (net.thresholds, net.threshold) == ({}, toxicity.PREDICTED)


def test_pooling_over_parts_is_pooling_over_the_whole(monkeypatch):
    random_numbers = np.random.default_rng(3)
    net = toxicity.new_network(random_numbers)
    net.table[:] = random_numbers.normal(size=net.table.shape)
    rows = toxicity.word_rows([b" ".join(b"w%d" % k for k in range(300))])[0]
    whole = net.pooled(rows)[0]
    monkeypatch.setattr(toxicity, "PART_WORDS", 17)
    assert np.allclose(net.pooled(rows)[0], whole, atol=1e-5)


def test_forward_backward_equals_enumeration():
    random_numbers = np.random.default_rng(0)
    counts = np.array([1, 4, 2, 5])
    e, moves = random_numbers.normal(size=counts.sum()), random_numbers.normal(size=(2, 2))
    good, expected = quality.forward_backward(e, counts, moves)
    at = 0
    for d, n in enumerate(counts):
        total, marginal, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(e[at + k] * y[k] for k in range(n)) + sum(moves[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            marginal += w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                pairs[a, b] += w
        assert np.allclose(good[at : at + n], marginal / total)
        assert np.allclose(expected[d], pairs / total)
        at += n


def test_platt_separates():
    z = np.linspace(-2, 2, 40)
    a, b = labelled.platt(z, (z > 0.3).astype(float))
    assert a > 1 and labelled.sigmoid(np.array([a * 2 + b]))[0] > 0.9


# Audio


@pytest.mark.parametrize("codec", ["mulaw", "alaw", "adpcm", None])
def test_media_hold_the_text(spark, codec):
    texts = [*ODD, "exact" + "y" * 187]
    rows = {r["doc_id"]: r for r in audio.digests(written(audio.store_payloads(frame(spark, texts), codec))).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))
        r = rows[k]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert rows[0]["media_sha256"] == rows[1]["media_sha256"] and rows[0]["feature"] == rows[1]["feature"]
    assert audio.digests(audio.store_payloads(frame(spark, []), codec)).count() == 0


def test_stored_sounds_are_what_the_files_hold(spark, monkeypatch):
    texts = [*ODD, *ODD, "one", "one"]
    monkeypatch.setattr(audio, "PART_BYTES", 500)
    media = written(audio.store_payloads(frame(spark, texts)))
    files = {(r["doc_id"]): bytes(r["media"]) for r in media.collect()}
    sounds = {r["doc_id"]: bytes(r["pcm"]) for r in written(audio.decoded(media)).collect()}
    assert len(sounds) == len(texts)
    for k, f in files.items():
        assert sounds[k] == audio.resample_double(audio.decode([f])[0]).tobytes()
    none = spark.createDataFrame([(1, None)], "doc_id long, media binary")
    assert [tuple(r) for r in audio.decoded(none).collect()] == [(1, None, None)]


def test_decoders_on_known_values():
    assert audio.TABLES["mulaw"][[0, 127, 128, 255]].tolist() == [-32124, 0, 32124, 0]
    assert audio.TABLES["alaw"][[0x2A, 0xAA, 0xD5, 0x55]].tolist() == [-32256, 32256, 8, -8]
    assert (np.diff(np.sort(audio.TABLES["mulaw"].astype(int))) >= 0).all() and len(audio.STEPS) == 89

    def plain(block):
        level, index, out = int(np.frombuffer(block[:2], "<i2")[0]), block[2], []
        out.append(level)
        for byte in block[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(audio.STEPS[index])
                change = step >> 3
                for bit, part in ((4, step), (2, step >> 1), (1, step >> 2)):
                    change += part if code & bit else 0
                level = max(-32768, min(32767, level - change if code & 8 else level + change))
                index = max(0, min(88, index + int(audio.INDEX_STEP[code & 7])))
                out.append(level)
        return out

    blocks = np.random.default_rng(1).integers(0, 256, (5, audio.BLOCK), dtype=np.uint8)
    blocks[:, 2] %= 89
    assert audio.decode_blocks(blocks).tolist() == [plain(bytes(b)) for b in blocks]
    assert audio.resample_double(np.array([0, 4, -3], "<i2")).tolist() == [0, 2, 4, 0, -3, -3]


# Neighbours


def test_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows += [(1000 + k, rows[0][1]) for k in range(90)] + [(2000, None), (2001, [0.0] * 64), (2002, [float("nan")] * 64), (2003, [None] * 64), (2020, [float("inf")] + [0.0] * 63)]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    books = neighbours.fit(neighbours.matrix_of(vectors), rounds=1)
    index = written(neighbours.build_index(vectors, books, 150))
    found = neighbours.search(index, vectors.where("vec_id % 20 = 0"), books, 20).collect()
    usable = {k: np.array(v, np.float64) for k, v in rows if k < 2000}
    hits = total = 0
    for q in [k for k in usable if k % 20 == 0]:
        got = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        scores = {k: float((v * usable[q]).sum()) for k, v in usable.items() if k != q}
        want = sorted(scores, key=lambda k: (-scores[k], k))[:20]
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-12 for r in got)
        assert [r["vec_id"] for r in got] == sorted((r["vec_id"] for r in got), key=lambda k: (-scores[k], k))
        hits += len(set(want) & {r["vec_id"] for r in got})
        total += 20
    assert hits / total > 0.95


def test_encoding_comes_near_and_norms_are_its_own():
    x = np.random.default_rng(2).normal(size=(600, 16))
    books = neighbours.fit(x, books=4, entries=32, rounds=2)
    codes, norms = books.encode(x)
    y = books.decode(codes)
    assert np.allclose(norms, (y**2).sum(axis=1))
    assert ((x - y) ** 2).sum() < 0.5 * (x**2).sum()
    greedy = books.decode(books.encode(x, beam=1)[0])
    assert ((x - y) ** 2).sum() <= ((x - greedy) ** 2).sum()


def recalls(spark, path):
    """The share of its 20 nearest that the query finds, for each of its queries, by brute force over the whole table."""
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ids, x = np.array([k for k, _ in rows]), np.array([v for _, v in rows], np.float64)
    found = {}
    for r in neighbours.op9_additive_quantisation(spark, path).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares = []
    for at in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[at]).sum(axis=1)
        scores[at] = -np.inf
        shares.append(len(found[ids[at]] & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    return np.array(shares)


def test_recall_of_the_query_on_a_whole_table(spark):
    shares = recalls(spark, "/root/testdata/sf0.1")
    assert shares.mean() >= 0.9 and shares.min() >= 0.9, (shares.mean(), shares.min())


def test_recall_among_near_copies(spark, tmp_path):
    random_numbers = np.random.default_rng(5)
    x = random_numbers.normal(size=(3000, 64))
    x[::3] = x[0] + 1e-3 * random_numbers.normal(size=(1000, 64))
    spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    shares = recalls(spark, str(tmp_path))
    assert shares.mean() >= 0.9 and shares.min() >= 0.9, (shares.mean(), shares.min())

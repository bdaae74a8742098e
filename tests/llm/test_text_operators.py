"""Mixing, packing, records, shingle joins, licenses and revisits on small tables, against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vistaframe.llm import jaccard, licenses, mixing, packing, records, revisits
from vistaframe.llm.common import shared_dir, written
from vistaframe.operators.graph import components
from vistaframe.llm.tokens import Encoder
from vistaframe.llm.words import shingles

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, _text string"


def frame(spark, texts, **more):
    rows = [(k, t, None, more.get("sources", ["a"] * len(texts))[k], len(t or ""), "x", "y") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = ["", None, "   \n\t ", "one", "a b c d e f g", "a b c d e f g", "Ünï çode  ", "x" * 5000, "w " * 30_000]


# Tokens


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60) | st.text(alphabet="ab'.,! \n\t é́ΣS1\x1c", max_size=40))
def test_ids_are_the_librarys(name, drops, text):
    e = ENCODERS.setdefault(name, Encoder(public_tokenizers.path(name), drops))
    assert e.ids(text).tolist() == e.known.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_are_the_librarys_where_parts_differ(name, drops):
    e = ENCODERS.setdefault(name, Encoder(public_tokenizers.path(name), drops))
    marks = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endof", "|>"]
    letters = [f"{c}{m}" for c in "HJTWYa" for m in ("\u030c", "\u0331", "\u030a", "\u0308", "\u3099\u030c", "\u05b0\u0331\u030c")]
    texts = [f"{a}{t}{b}" for t in marks + letters for a, b in (("", ""), ("foo\n\n", ""), ("A b \t", "\n x"), ("a\u00a0", " B."))]
    for t in texts:
        assert e.ids(t).tolist() == e.known.library.encode(t, add_special_tokens=False).ids, ascii(t)


ENCODERS: dict[str, Encoder] = {}


# Mixing


def brute_targets(sizes, cycle=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % cycle + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if total and weight[s] * left / total > 3 * sizes[s]]
        if not over:
            return target | {s: weight[s] * left / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)


def test_mix_meets_targets(spark):
    rnd = random.Random(3)
    sources = ["hot"] * 300 + [rnd.choice(["b", "c", "d", None, "tiny"]) for _ in range(100)]
    docs = frame(spark, ["w " * rnd.randrange(0, 40) for _ in sources], sources=sources)
    rows = mixing.mix(docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want, taken = brute_targets(sizes), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["source"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == +taken


def test_mix_with_clashing_columns_and_repeated_rows(spark):
    rows = [(k % 40, "a b c d " * (1 + k % 40 % 5), ["p", "q", None][k % 40 % 3], k, "mine", 7) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` int, _key string, taken int")
    sized = docs.withColumn("size", mixing.word_count(docs["text"]))
    taken = mixing.mix(sized)
    assert taken.columns == ["doc_id", "text", "source", "a.b", "_key", "size", "source_size", "target", "taken"]
    got = taken.collect()
    assert {r["_key"] for r in got} == {"mine"} and sorted(r["a.b"] for r in got) == list(range(80))
    words = Counter()
    for r in got:
        words[r["source"]] += r["taken"]
    assert all(abs(words[r["source"]] - r["target"]) <= 1 for r in got)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    mixed = Counter()
    for r in out.collect():
        assert r["_key"] == "mine" and r["taken"] == 7
        mixed[r["source"]] += len(r["text"].split())
    # Two equal rows at a cut share its words, rounded down.
    assert all(0 <= words[s] - mixed[s] <= 1 for s in words)


def test_mix_of_nothing_and_of_odd_rows(spark):
    docs = frame(spark, ODD)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0).selectExpr("doc_id", "source", "0L AS size")).count() == 0
    assert all(r["size"] or not r["taken"] for r in mixing.mix(docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("size"))).collect())
    assert mixing.mix(frame(spark, ["", None]).selectExpr("doc_id", "source", "0L AS size")).agg({"taken": "sum"}).first()[0] == 0


# Packing


def check_packing(spark, docs, texts):
    rows = packing.packed_documents(docs).collect()
    e = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for k, t in enumerate(texts):
        ids = [*e.known.library.encode(t or "", add_special_tokens=False).ids, 0]
        want |= {(k, p): (at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())) for p, (at, n) in enumerate(packing.cut(len(ids), 2048))}
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    inside = defaultdict(list)
    for r in rows:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in inside.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    return len(inside), sum(r["length"] for r in rows)


def test_packing(spark):
    rnd = random.Random(5)
    texts = [*ODD, *["word " * rnd.randrange(1, 900) for _ in range(200)], *["same length"] * 90]
    sequences, total = check_packing(spark, frame(spark, texts), texts)
    assert sequences <= 1.03 * total / 2048 + 1
    assert packing.packed_documents(frame(spark, [])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=12))
def test_sweep_places_every_piece_once(counts):
    runs = packing.sweep(counts, 50)
    seen, fill = Counter(), defaultdict(list)
    for length, rank, n, sequence, offset in runs.tolist():
        assert n > 0
        for k in range(n):
            seen[length, rank + k] += 1
            fill[sequence + k].append((offset, length))
    assert seen == Counter({(length, r): 1 for length, n in counts.items() for r in range(n)})
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 50
    total = sum(k * n for k, n in counts.items())
    assert len(fill) <= max(1, 11 / 9 * -(-total // 50) + 6 / 9) or len(fill) <= 2 * total / 50 + 1


# Records


def test_records_round_trip(spark):
    texts = [*ODD, *[f"text {k} and more" for k in range(60)]]
    docs = frame(spark, texts).repartition(5).unionByName(frame(spark, ["no id"]).selectExpr("CAST(NULL AS LONG) AS doc_id", *frame(spark, []).columns[1:]))
    base = f"{shared_dir(spark)}/records-test"
    manifest = records.write_records(docs, base, public_tokenizers.path("word_bpe_49k.json"), 1, drops_space=True, width=2, shard_bytes=2000)
    rows = records.read_records(manifest, base).collect()
    library = Encoder(public_tokenizers.path("word_bpe_49k.json"), True).known.library
    want = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in [*enumerate(texts), (None, "no id")]}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in rows} == {k: (len(v), zlib.crc32(v.tobytes())) for k, v in want.items()}
    at = 0
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"])):
        assert r["start"] == at
        at += r["n_tokens"]
    shuffled = records.read_shuffled(manifest, base, seed=3).collect()
    assert {r["doc_id"]: r["ids"] for r in shuffled} == {k: v.tolist() for k, v in want.items()}
    assert [r["doc_id"] for r in shuffled] != sorted((r["doc_id"] for r in shuffled), key=lambda x: (x is not None, x))


def test_records_notice_damage():
    whole = bytearray(records.frame(7, np.arange(20, dtype="<u4"), 2))
    assert records.unframe(bytes(whole))[0] == 7
    for at in (0, 9, 30, len(whole) - 1):
        bad = bytearray(whole)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(bytes(bad))


# Shingle joins


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        w = ["".join(c.lower() if c.isascii() else c for c in x) for x in (t or "").replace("\x0b", " ").replace("\x0c", " ").split()]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            m = len(a & sets[j])
            if m and 100 * m >= percent * (len(a) + len(sets[j]) - m):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def near_texts(seed, copies=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    common = [word() for _ in range(60)]
    texts = [*ODD, *ODD]
    for n in (6, 7, 9, 12, 20, 45, 120, 400):
        base = [word() for _ in range(n)]
        texts.append(" ".join(base))
        for _ in range(copies // 4):
            own = list(base)
            for _ in range(rnd.randrange(0, max(2, n // 20))):
                own[rnd.randrange(n)] = word()
            texts.append(" ".join(own[rnd.randrange(2) :]))
        texts += [" ".join(common + [word() for _ in range(n)]) for _ in range(8)]
    big = [word() for _ in range(150)]
    for _ in range(copies):
        own = list(big)
        for _ in range(rnd.randrange(0, 5)):
            own[rnd.randrange(150)] = word()
        texts.append(" ".join(own))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    texts = near_texts(k)
    rows = jaccard.near_duplicates(frame(spark, texts).repartition(7), k, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts, k, percent)
    kept = jaccard.one_of_each(frame(spark, texts), k, percent)
    assert kept.columns == frame(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in brute_components(texts, k, percent).values()}


@pytest.mark.parametrize("light_up_to", [0, 40, 10_000])
def test_any_boundary_gives_the_same_links(spark, monkeypatch, light_up_to):
    texts = near_texts(11, 24)
    monkeypatch.setattr(jaccard, "boundary", lambda firsts: light_up_to)
    monkeypatch.setattr(jaccard, "COMBINED", 500)
    monkeypatch.setattr(jaccard, "SENT_IDS", 0)
    rows = jaccard.near_duplicates(frame(spark, texts), 4, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute_components(texts, 4, 85)


def family_texts(seed):
    """Copies with edits around two bases that are near each other, so that families have members at every distance and visit each other."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(3))
    base = [word() for _ in range(160)]
    other = list(base)
    for k in rnd.sample(range(160), 9):
        other[k] = word()
    pool = [(k, word()) for k in range(0, 160, 4) for _ in (0, 1)]
    texts = []
    for b in (base, other):
        for _ in range(45):
            own = list(b)
            for k, w in rnd.sample(pool, rnd.randrange(0, 9)):
                own[k] = w
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize(("sets", "turns", "matches"), [(512, 3, 1 << 22), (7, 1, 40), (3, 3, 1)])
def test_families_of_any_block_size_give_the_same_links(spark, monkeypatch, sets, turns, matches):
    texts = family_texts(sets)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard, "TURNS", turns)
    monkeypatch.setattr(jaccard, "MATCHES", matches)
    rows = jaccard.near_duplicates(frame(spark, texts), 5, 80).collect()
    want = brute_components(texts, 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert 2 < len({c for _, c in want.values()}) < len(texts)


def test_repeated_rows_and_ids_of_near_duplicates(spark):
    text = " ".join(f"w{k}" for k in range(40))
    near, far = text.replace("w39", "other"), " ".join(f"x{k}" for k in range(40))
    docs = spark.createDataFrame([(3, text, 1), (5, near, 2), (5, far, 3), (3, text, 4), (7, "", 5), (7, "", 6), (None, text, 7)], "doc_id long, text string, `a.b` int")
    rows = jaccard.near_duplicates(docs, 5, 80).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (3, 3), (3, 3), (5, 3), (5, 5), (7, 7), (7, 7)]
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or 0, r["a.b"]) for r in kept.collect())
    assert [i for i, _ in ids] == [0, 3, 5, 7, 7] and (5, 3) in ids and (0, 7) in ids


def test_near_duplicates_of_nothing_and_without_ids(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    none = frame(spark, ["a b c d e f", "a b c d e f"]).selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    assert [r["component_id"] for r in jaccard.near_duplicates(none).collect()] == [None, None]


def test_shingles_of_long_texts_are_those_of_the_whole(monkeypatch):
    from vistaframe.llm import words

    text = " ".join(f"w{k}" for k in range(3000)).encode()
    whole = shingles([text, b"x"], 4)[0]
    monkeypatch.setattr(words, "BLOCK_BYTES", 700)
    assert np.array_equal(shingles([text], 4)[0], whole)


def test_components(spark):
    edges = written(spark.createDataFrame([(k, k + 1) for k in range(50, 90)] + [(3, 90), (100, 101), (7, 7)], "a long, b long"))
    found = {r["id"]: r["component"] for r in components(edges).collect()}
    assert found == {**{k: 3 for k in [3, *range(50, 91)]}, 100: 100, 101: 100}


# Licenses


def test_licenses(spark):
    texts = [*ODD, "Released under the MIT License.", "x UNDER the, mit license under the MIT license", "Licensed under the Apache License, Version 2.0 cc by-nc", "work licensed under the GNU General Public License, version 3", "undera the mit license", "w " * 200 + "released under MIT license"]
    found = {r["doc_id"]: r for r in licenses.scan(frame(spark, texts)).collect()}
    got = [(found[k]["n_base"], found[k]["first_word"], found[k]["last_word"], found[k]["base_labels"], found[k]["labels"]) for k in range(len(ODD), len(texts))]
    assert got == [(1, 1, 1, "mit", "mit"), (2, 1, 5, "mit", "mit"), (2, 3, 8, "apache-2,cc-by-nc", "apache-2,cc-by-nc"), (0, None, None, "", "gpl-3"), (0, None, None, "", ""), (0, None, None, "", "mit")]
    assert [found[k]["n_words"] for k in range(5)] == [0, 0, 0, 1, 7]
    assert licenses.scan(frame(spark, [])).count() == 0


def test_license_filters_drop_candidates(spark):
    """Only blocks with one of a template's rarest pairs are candidates; the positional filter drops more before they are counted."""
    F = licenses.F
    rnd = random.Random(12)
    texts = []
    for _ in range(120):
        words = licenses.template_words(rnd.choice(licenses.TEMPLATES)[1])
        cut = rnd.randrange(len(words))
        texts.append(" ".join(words[cut : cut + rnd.randrange(2, 60)] + [rnd.choice(words) for _ in range(5)]))
    pairs = {p for _, t in licenses.TEMPLATES for p in licenses.template_pairs(t)}
    rows = []
    for k, t in enumerate(texts):
        words = licenses.template_words(t)
        rows.append((str(k), [(i, f"{a} {b}") for i, (a, b) in enumerate(zip(words, words[1:], strict=False)) if f"{a} {b}" in pairs]))
    held = spark.createDataFrame(rows, "row string, held array<struct<at: int, pair: string>>")
    sharing = set()
    for k, places in rows:
        for t, (_, text) in enumerate(licenses.TEMPLATES):
            own, n = set(licenses.template_pairs(text)), len(licenses.template_words(text))
            sharing |= {(k, t, b) for at, pair in places if pair in own for b in (at // n, at // n - 1) if b >= 0}
    got = licenses.candidates(held, licenses.TEMPLATES, 80)
    candidates = {(r["row"], r["template"], r["block"]) for r in got.select("row", "template", "block").collect()}
    assert candidates < sharing and len(candidates) < 0.6 * len(sharing)
    assert licenses.matches(held, licenses.TEMPLATES, 80).where(F.col("contained") >= 0.8).count() > 5


def plain_labels(text):
    """Labels and score by sets of pairs in every block, without filters."""
    words = licenses.template_words(text or "")
    labels, best = set(), 0.0
    for label, template in licenses.TEMPLATES:
        n, pairs = len(licenses.template_words(template)), set(licenses.template_pairs(template))
        for start in range(0, max(1, len(words)), n):
            held = {f"{a} {b}" for a, b in zip(words[start : start + 2 * n], words[start + 1 : start + 2 * n + 1], strict=False)} & pairs
            if 100 * len(held) >= 80 * len(pairs):
                labels.add(label)
                best = max(best, len(held) / len(pairs))
    return labels, best


def test_license_texts_and_what_only_looks_like_them(spark):
    rnd = random.Random(2)
    whole = [t for _, t in licenses.TEMPLATES if len(t) > 200]
    spoilt = lambda t, every: " ".join("other" if k % every == 3 else w for k, w in enumerate(t.split()))
    filler = lambda n: " ".join(rnd.choice(["the", "of", "software", "license", "x"]) for _ in range(n))
    texts = [f"{filler(rnd.randrange(300))} {t} {filler(50)}" for t in whole] + [spoilt(t, e) for t in whole for e in (6, 12, 25)] + [filler(2000)]
    texts += ["Released under the Apache License", "we released the song under a new license", "released in 2020 under the terms of the GPL license"] * 2
    found = sorted(licenses.scan(frame(spark, texts)).collect(), key=lambda r: r["doc_id"])
    for text, r in zip(texts, found, strict=True):
        labels, best = plain_labels(text)
        assert r["labels"] == ",".join(sorted(labels | set(filter(None, r["base_labels"].split(","))))), text
        assert r["score"] == (1.0 if r["n_base"] else best)
    assert [r["labels"] for r in found[: len(whole)]] == [label for label, t in licenses.TEMPLATES if len(t) > 200]
    assert {r["labels"] for r in found[-6:]} == {""}


# Revisits


def test_revisits(spark):
    schema = "capture_id long, url string, captured_at long, kind string, headers map<string,string>, digest string, _inside int"
    rows = [
        (1, "http://www.A.org/p/?utm_source=x#f", 10, "response", {"etag": "e1", "content-type": "t", "date": "10"}, "d1", 0),
        (2, "https://a.org/p", 200_000, "revisit", {"etag": "e1", "date": "20", "content-type": "no"}, None, 0),
        (3, "https://a.org/p?b=2&a=1", 300, "response", {"last-modified": "m"}, "d3", 0),
        (4, "https://a.org:443/p?a=1&b=2", 400, "revisit", {"last-modified": "other"}, None, 0),
        (5, "https://a.org/p", 10, "revisit", {}, None, 0),
        (6, "https://a.org/q", 10, "response", {}, "d6", 0),
        (7, "https://a.org/q", 11, "revisit", {"vary": "v"}, None, 0),
        (8, None, 11, "revisit", {}, None, 0),
        (9, "https://a.org/p", None, "revisit", {}, None, 0),
    ]
    got = {r["capture_id"]: (r["state"], r["response_id"], r["digest"], r["headers"]) for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema), 1000).collect()}
    assert got == {
        2: ("resolved", 1, "d1", {"etag": "e1", "content-type": "t", "date": "20"}), 4: ("mismatch", 3, None, None), 5: ("missing", None, None, None),
        7: ("unverified", 6, "d6", {"vary": "v"}), 8: ("missing", None, None, None), 9: ("missing", None, None, None),
    }
    assert revisits.resolve_revisits(spark.createDataFrame([], schema)).count() == 0

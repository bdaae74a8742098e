"""Hard negatives, repeated passages and spelling variants on small tables, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vistaframe.llm import negatives, repeats, spellings
from vistaframe.llm.common import Scratch

# Hard negatives


def brute_negatives(rows):
    """rows: (vec_id, label, embedding) as given."""
    used = []
    for vec_id, label, x in rows:
        if vec_id is None or label is None or x is None or any(v is None or v != v or abs(v) == float("inf") for v in x):
            continue
        used.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(256 * v // 1) for v in x]))
    out = []
    for a in used:
        if a[0] % 50 == 0:
            score = lambda r, a=a: sum(p * q for p, q in zip(a[2], r[2], strict=False))
            others = sorted(((-score(r), r[0], r[1]) for r in used if r[0] != a[0]), key=lambda r: r[:2])
            for s, positive, _ in [r for r in others if r[2] == a[1]][:5]:
                fit = [r for r in others if r[2] != a[1] and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
                out += [(a[0], positive, k, n, -s, -m) for k, (m, n, _) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, row string, cluster int"


def got_negatives(spark, rows, **more):
    df = spark.createDataFrame([(v, e, k, "x", 1) for v, k, e in rows], VECTORS)
    return sorted(map(tuple, negatives.hard_negatives(df, **more).collect()))


def test_hard_negatives_on_odd_rows(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.randrange(4), [rnd.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(5)]) for k in range(400)]
    rows += [(1000 + k, rnd.randrange(4), [rnd.gauss(0, 1) + 1 for _ in range(5)]) for k in range(300)]
    rows += rows[60:64] + [rows[100]]  # repeated rows, one of them an anchor
    rows += [(2000, 1, [0.0] * 5), (2001, None, [1.0] * 5), (2002, 1, None), (2003, 2, [1.0, None, 0.0, 0.0, 0.0]), (2004, 2, [float("nan")] * 5), (2005, 3, [float("inf")] * 5), (None, 1, [1.0] * 5)]
    rows += [(2050, 2, [1.0, 0.5]), (2051, 3, []), (2100, 9, [])]  # shorter ones are filled up
    want = brute_negatives(rows)
    assert len(want) > 100
    assert got_negatives(spark, rows, first=40, growth=2, clusters=5) == want


def test_hard_negatives_of_nothing(spark):
    assert got_negatives(spark, []) == []
    assert got_negatives(spark, [(3, 1, [1.0])]) == []
    assert got_negatives(spark, [(50, 1, [1.0])]) == []
    assert got_negatives(spark, [(50, 1, [])]) == []


def test_a_walk_ends_before_the_list_does(spark):
    """Anchors whose own lengths' direction holds the best rows read a part of their list only."""
    rnd = random.Random(6)
    rows = []
    for k in range(1200):
        c = k % 6
        x = [rnd.gauss(0, 0.02) for _ in range(8)]
        x[c] += 1 + (k % 50 == 0)
        rows.append((k, c % 2 if rnd.random() < 0.7 else 5 + c % 2, x))
    df = spark.createDataFrame([(v, e, k, "x", 1) for v, k, e in rows], VECTORS)
    scratch = Scratch()
    walked = negatives.Lists(negatives.usable(df), 50, scratch, clusters=6, first=100, growth=2)
    seen = []
    scored = walked._scored
    walked._scored = lambda asked, chunk, k: seen.append(chunk) or scored(asked, chunk, k)
    window = walked.anchors.selectExpr("row", "0L AS window", "true AS same", "-1000000000L AS low", "1000000000L AS high")
    assert walked.best(window, 5).count() == 5 * walked.anchors.count()
    assert max(seen) < walked.chunks - 1
    scratch.drop()


# Spelling variants


def brute_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = defaultdict(set)
    for w in counts:
        for at in range(len(w) + 1):
            for other in {w[:at] + w[at + 1 :]} | {w[:at] + c + w[at + d :] for c in "abcdefgàé÷" for d in (0, 1)}:
                if other != w and other in counts:
                    near[w].add(other)
                    near[other].add(w)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


DOCS = "doc_id long, text string, word string, n int"


def got_variants(spark, docs, **more):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], DOCS)
    rows = [tuple(r) for r in spellings.spelling_variants(df, **more).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("share", [spellings.HEAVY, 20])
def test_variants_equal_brute_force(spark, share):
    rnd = random.Random(11)
    stems = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(6, 18))) for _ in range(40)] + ["abababab", "aaaaaaa", "aaaaaaaa", "bàaéàaab", "caéàaab÷"]
    docs = []
    for k in range(300):
        words = []
        for _ in range(60):
            w = rnd.choice(stems[: 1 + k % len(stems)])
            while rnd.random() < 0.25:
                at = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:at] + rnd.choice("abcdefgàé÷") + w[at:], w[:at] + w[at + 1 :], w[:at] + rnd.choice("abcdefgà") + w[at + 1 :]])
            words.append(rnd.choice([w, w, w.title(), w.upper()]))
        docs.append((k, rnd.choice([" ", "-", "1", "\n", "Ā"]).join(words)))
    docs += [(None, docs[0][1]), (5, None), (6, ""), (7, "Ünïçödé " * 3), docs[9], docs[9], (8, "x" * 100_000)]
    want = brute_variants(docs)
    assert len({w[2] for w in want}) < len(want)
    assert got_variants(spark, docs, share=share) == want


def test_variants_of_nothing(spark):
    assert got_variants(spark, []) == set()
    assert got_variants(spark, [(1, None), (2, ""), (3, "short words only")]) == set()


WORDS = st.text("ab", min_size=7, max_size=16)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(0, 16), st.sampled_from("abc"), st.integers(0, 2), st.sets(st.text("ab", min_size=2, max_size=5), max_size=40))
def test_no_edit_takes_more_grams_than_the_bound(word, at, letter, kind, chosen):
    """Whatever the dictionary is, as long as it is closed under prefixes."""
    heavy = frozenset(g[:k] for g in chosen for k in range(2, len(g) + 1))
    other = [word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]][kind]
    if len(other) < 7 or other == word or abs(len(other) - len(word)) > 1:
        return
    most = spellings.longest(min(len(word), len(other)))
    for a, b in ((word, other), (other, word)):
        found, there = spellings.grams(a, heavy, most), set(spellings.grams(b, heavy, most))
        shift = len(b) - len(a)
        kept = sum((p, g) in there or (p + shift, g) in there for p, g in found)
        bound = spellings.can_lose(found, len(a), most)
        assert len(found) - kept <= bound < len(found)


# Repeated passages


def brute_repeats(texts):
    split = [(t or "").encode().split() for t in texts]
    places = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    out = []
    for w in split:
        gone = set()
        for k in range(len(w) - 34):
            if places[tuple(w[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def passages(rnd, letters, n):
    """Texts with copies, near copies, shared passages and passages that repeat in one text."""
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 4)))
    shared = [[word() for _ in range(rnd.randrange(20, 120))] for _ in range(6)]
    texts = []
    for k in range(n):
        w = []
        for _ in range(rnd.randrange(1, 5)):
            w += rnd.choice(shared)[rnd.randrange(10) :] if rnd.random() < 0.6 else [word() for _ in range(rnd.randrange(60))]
        if texts and rnd.random() < 0.4:
            w = (rnd.choice(texts) or "").split()
            if w and rnd.random() < 0.7:
                w[rnd.randrange(len(w))] = word()
        texts.append(rnd.choice([" ", "\n", "\t \x0b", "  "]).join(w))
    return [*texts, None, "", " \n ", "a " * 34, "b " * 35, "c " * 36, "d " * 400, "é ü x y " * 40, "Same Case " * 20, "same case " * 17]


ROWS = "doc_id long, text string, `a.b` int, key string, words int"


@pytest.mark.parametrize(("letters", "light", "part"), [("abcdefghijklmno", repeats.LIGHT, repeats.SLICE), ("ab", 2, 50), ("abcdefghijklmno", 0, 1000)])
def test_repeats_equal_brute_force(spark, monkeypatch, letters, light, part):
    monkeypatch.setattr(repeats, "LIGHT", light)
    texts = passages(random.Random(len(letters) + light), letters, 250)
    df = spark.createDataFrame([(k, t, k, "x", 3) for k, t in enumerate(texts)], ROWS).repartition(5)
    want = brute_repeats(texts)
    assert 1000 < sum(w[1] for w in want) < sum(w[0] for w in want)
    got = {r["doc_id"]: r for r in repeats.repeated_passages(df).collect()}
    assert [(got[k]["n_words"], got[k]["n_removed"], got[k]["kept_sha256"]) for k in range(len(texts))] == [(n, m, hashlib.sha256(k).hexdigest()) for n, m, k in want]
    if light:
        return
    out = repeats.without_repeats(df)
    assert out.columns == [*df.columns[:-1], "words", "words", "removed"]
    rows = {r[0]: r for r in out.collect()}
    assert all(rows[k][1] == (None if t is None else w[2].decode()) and rows[k][2:] == (k, "x", 3, w[0], w[1]) for k, (t, w) in enumerate(zip(texts, want, strict=True)))


def test_slices_of_long_texts_agree(monkeypatch):
    texts = [t.encode() for t in passages(random.Random(1), "abc", 40) if t]
    whole = [c for p in repeats.cut(texts) for c in p.edges(np.arange(len(p.n))).tolist()]
    monkeypatch.setattr(repeats, "SLICE", 64)
    assert [c for p in repeats.cut(texts) for c in p.edges(np.arange(len(p.n))).tolist()] == whole
    monkeypatch.setattr(repeats, "WINDOW", 35)
    assert len(whole) == sum(max(0, len(t.split()) - 34) for t in texts)


def test_rows_that_repeat_and_no_rows(spark):
    text = " ".join(map(str, range(40)))
    df = spark.createDataFrame([(1, text, 1, "", 1), (1, text, 1, "", 1), (None, None, None, None, None)], ROWS)
    assert sorted(r["n_removed"] for r in repeats.repeated_passages(df).collect()) == [0, 40, 40]
    assert repeats.repeated_passages(df.limit(0)).collect() == []


def test_paths_that_follow_each_other_are_joined(spark):
    """Copies give a text one joined path, whatever its length; a branch in one of them splits it."""
    words = [str(k) for k in range(900)]
    texts = [" ".join(words), " ".join(words), " ".join(words[:500])]
    scratch = Scratch()
    df = spark.createDataFrame([(k, t, 1, "", 1) for k, t in enumerate(texts)], ROWS)
    rows = repeats._applied(df, lambda kept: repeats.pa.array([len(k) for k in kept]).cast("string")).collect()
    joined = {r["row"]["doc_id"]: len(r["joined"]) for r in rows}
    assert joined[0] == joined[1] <= 4 and joined[2] <= 2
    scratch.drop()

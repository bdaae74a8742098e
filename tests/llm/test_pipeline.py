"""All stages of the corpus pipeline on the smallest tables, each against a plain version of what it is to do."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from test_text_operators import brute_components, brute_targets

import corpus_pipeline
from vistaframe.llm import packing, quality, toxicity
from vistaframe.llm.common import table, written
from vistaframe.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


def plain_toxicity(spark, rows):
    net = toxicity.network(spark, table(spark, SF, "documents"), SF)
    score = {r["doc_id"]: net.score(toxicity.word_rows([(r["text"] or "").encode()])[0]) for r in rows}
    return {r["doc_id"] for r in rows if score[r["doc_id"]] < net.thresholds.get(r["lang"], net.threshold)}


def plain_quality(spark, rows, docs):
    field = quality.field_of(spark, docs, SF)
    return {r["doc_id"] for r in rows if field.score([(r["text"] or "").encode()])[0] >= quality.PREDICTED}


def check_mix(before, after):
    words = lambda t: (t or "").split()
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(words(r["text"]))
    texts, taken = {r["doc_id"]: words(r["text"]) for r in before}, Counter()
    for r in after:
        own = words(r["text"])
        assert own and own == texts[r["doc_id"]][: len(own)] and r["n_chars"] == len(r["text"])
        taken[r["source"]] += len(own)
    want = brute_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3


def check_pieces(before, after):
    library = Encoder(public_tokenizers.path(packing.VOCABULARY)).known.library
    want = Counter()
    for r in before:
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        for k, (at, n) in enumerate(packing.cut(len(ids), packing.CAPACITY)):
            want[r["doc_id"], k, at, n, zlib.crc32(ids[at : at + n].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after) == want
    inside = defaultdict(list)
    for r in after:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in inside.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY


def test_every_stage_does_what_a_plain_version_does(spark):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, docs.collect()
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]

    after = written(stages["toxicity"](spark, docs, SF))
    assert after.columns == columns and ids(after) == plain_toxicity(spark, rows) and 0 < after.count() < len(rows)
    docs, rows = after, after.collect()
    after = written(stages["quality"](spark, docs, SF))
    assert after.columns == columns and ids(after) == plain_quality(spark, rows, docs) and 0 < after.count() < len(rows)
    docs, rows = after, after.collect()
    after = written(stages["near_duplicates"](spark, docs, SF))
    found = brute_components([r["text"] for r in rows], 5, 80)
    groups = defaultdict(list)
    for k, (n, c) in found.items():
        groups[c if n else ("empty", k)].append(rows[k]["doc_id"])
    assert after.columns == columns and ids(after) == {min(g) for g in groups.values()}
    docs, rows = after, after.collect()
    after = written(stages["mixing"](spark, docs, SF))
    assert after.columns == columns
    check_mix(rows, after.collect())
    docs, rows = after, after.collect()
    check_pieces(rows, stages["packing"](spark, docs, SF).collect())

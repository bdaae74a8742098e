"""License scans with DataFrame functions only: an exact set-similarity join of text blocks with license templates.

A template is the set of its pairs of successive words. Blocks are windows of twice the template's length that start every
length, so a copy of it stands in one whole. A block matches where it holds at least the share THRESHOLD_PERCENT of the pairs.
Pairs are ordered by how many documents hold them, over all documents, rarest first. Only the first |T| - need + 1 pairs of a
template are looked up (prefix filter: a matching block holds one of them). A block that holds one goes on where it holds `need`
known pairs at all (length filter), and `need` of them from the first one that both share on (positional filter). What is left
is counted in full.

One pass over the texts finds words, places of the phrases and places of template pairs; all else works on those places, of
which ordinary text has few. Templates are a bounded parameter, so their index is a small literal table; documents are never
grouped whole or broadcast.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vistaframe.llm.common import table, written
from vistaframe.operators.quantiles import let

# The base phrases and their labels, and the templates: notices as their publishers give them, the text of the
# MIT license, and the first two clauses of the BSD licenses, which all of them share.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = [
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution."""),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike License"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("mit", "Released under the MIT License"),
    ("mit", "Released under MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of a lower-cased text.
LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD_PERCENT = 80


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lowered. The kelvin sign is the one other character that lower() makes an ASCII letter."""
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ufffd"))), F.lit(LOWER_WORD), F.lit(0))


def template_words(text: str) -> list[str]:
    return re.findall(LOWER_WORD, text.lower())


def template_pairs(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def needed(pairs: list[str], percent: int) -> int:
    return -(-len(pairs) * percent // 100)


def literal(spark: SparkSession, rows: list[dict], kinds: str) -> DataFrame:
    """A small table of constants, as a literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kinds}>>")))


def candidates(held: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """(row, template, block, first, and the template's label, length, need, size, ranks) of the blocks that hold one of a template's first pairs.

    held: row, held (array of at, pair), a row once. ranks: the template's pairs as their places in the order of all pairs, first: the
    first of them that the block holds; order: map from pair to place. All are bounded by the templates.
    """
    spark = held.sparkSession
    placed = held.select("row", F.explode("held").alias("h")).select("row", "h.*")
    counts = placed.select("row", "pair").distinct().groupBy("pair").count()  # the templates' pairs at most
    often = {r["pair"]: r["count"] for r in counts.collect()}
    own = [template_pairs(text) for _, text in templates]
    order = {p: k for k, p in enumerate(sorted({p for pairs in own for p in pairs}, key=lambda p: (often.get(p, 0), p)))}
    known = [
        {"template": k, "label": label, "length": len(template_words(text)), "need": needed(pairs, percent), "size": len(pairs), "ranks": sorted(order[p] for p in pairs)}
        for k, ((label, text), pairs) in enumerate(zip(templates, own, strict=True))
    ]
    names = sorted(order, key=order.get)
    probes = [{"template": t["template"], "length": t["length"], "rank": r, "pair": names[r]} for t in known for r in t["ranks"][: t["size"] - t["need"] + 1]]
    probe = literal(spark, probes, "template: int, length: int, rank: int, pair: string")
    block = F.floor(F.col("at") / F.col("length"))
    hits = placed.join(F.broadcast(probe), "pair").select("row", "template", "rank", F.explode(F.array(block, block - 1)).alias("block")).where("block >= 0")
    first = hits.groupBy("row", "template", "block").agg(F.min("rank").alias("first"))
    index = literal(spark, known, "template: int, label: string, length: int, need: int, size: int, ranks: array<int>")
    places = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return first.join(F.broadcast(index), "template").withColumn("order", places)


def matches(held: DataFrame, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """(row, found, contained): labels of the templates that a block of the row matches, and the largest share. held: row, held (array of at, pair), a row once."""
    met = candidates(held, templates, percent).join(held, "row")
    start = F.col("block") * F.col("length")
    inside = F.filter("held", lambda h: (h["at"] >= start) & (h["at"] < start + 2 * F.col("length")))
    ranks = F.array_distinct(F.transform(inside, lambda h: F.element_at("order", h["pair"])))
    long_enough = lambda r: F.size(r) >= F.col("need")
    left = lambda r: F.size(F.filter(r, lambda x: x >= F.col("first"))) >= F.col("need")
    both = let(ranks, lambda r: F.when(long_enough(r) & left(r), F.size(F.array_intersect(r, F.col("ranks")))))
    found = met.withColumn("both", both).where(F.col("both") >= F.col("need"))
    return found.groupBy("row").agg(F.collect_set("label").alias("found"), F.max(F.col("both") / F.col("size")).alias("contained"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """License labels of every row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    templates: (label, text) of two words or more each. n_base counts all places of the phrases, overlapping ones too;
    first_word and last_word are null and the labels empty strings where there is nothing. score is the largest share of a
    template found that reaches the threshold, 1 where a phrase stands, else 0. A null text is an empty one. Repeated rows
    give repeated results; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    vocabulary = sorted({w for _, t in templates for w in template_words(t)} | {w for p in phrases for w in p.split()})
    pairs = sorted({p for _, t in templates for p in template_pairs(t)})
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    worded = docs.select("doc_id", row.alias("row"), words_of(text).alias("words"))
    # Places of words of the templates and phrases; what follows looks at these places only.
    known = F.filter(F.sequence(F.lit(0), F.greatest(F.size("words"), F.lit(1)) - 1), lambda i: F.get("words", i).isin(vocabulary))
    worded = worded.withColumn("known", known)

    def places_of(phrase: str) -> Column:
        words = phrase.split()

        def starts(i: Column) -> Column:
            found = F.get("words", i) == words[0]
            for k, word in enumerate(words[1:], 1):
                found = found & (F.get("words", i + k) == word)
            return F.coalesce(found, F.lit(False))

        return F.filter("known", starts)

    at = F.array(*[F.struct(places_of(p).alias("at"), F.lit(label).alias("label")) for p, label in phrases.items()])
    pair_at = lambda i: F.concat_ws(" ", F.get("words", i), F.get("words", i + 1))
    held = F.filter(F.transform(F.filter("known", lambda i: F.coalesce(F.get("words", i + 1).isin(vocabulary), F.lit(False))), lambda i: F.struct(i.alias("at"), pair_at(i).alias("pair"))), lambda x: x["pair"].isin(pairs))
    rows = written(worded.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), at.alias("base"), held.alias("held")))
    found = matches(rows.where(F.size("held") > 0).dropDuplicates(["row"]).select("row", "held"), templates, percent)

    base = F.filter("base", lambda b: F.size(b["at"]) > 0)
    rows = rows.select("doc_id", "row", "n_words", F.flatten(F.transform(base, lambda b: b["at"])).alias("at"), F.transform(base, lambda b: b["label"]).alias("base"))
    joined = rows.join(found, "row", "left")
    return joined.select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("at") > 0, F.lit(1.0)).otherwise(F.coalesce("contained", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans every text of documents; see scan()."""
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op7_license_scan": op7_license_scan}
_templates = ", ".join(f"({k}, '{label}', {len(template_words(t))}, [{', '.join(repr(p) for p in template_pairs(t))}])" for k, (label, t) in enumerate(TEMPLATES))
_places = " UNION ALL ".join(
    f"SELECT k, '{label}' AS label, unnest(list_filter(range(len(w)), lambda i: {' AND '.join(f'w[i + {j + 1}] = {part!r}' for j, part in enumerate(phrase.split()))})) AS i FROM worded" for phrase, label in PHRASES.items()
)
ORACLES = {
    "op7_license_scan": rf"""
WITH worded AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
base AS ({_places}),
per_base AS (SELECT k, count(*) AS n_base, min(i)::BIGINT AS first_word, max(i)::BIGINT AS last_word, list_sort(list(DISTINCT label)) AS base FROM base GROUP BY k),
templates(template, label, length, t) AS (VALUES {_templates}),
tokens AS (SELECT template, label, length, len(t) AS size, unnest(t) AS g FROM templates),
grams AS (SELECT k, i, w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(len(w) - 1)) AS i FROM worded)),
met AS (SELECT k, template, label, size, g, unnest([i // length, i // length - 1]) AS block FROM grams JOIN tokens USING (g)),
blocks AS (SELECT k, label, size, count(DISTINCT g) AS shared FROM met WHERE block >= 0 GROUP BY k, template, label, size, block),
per_found AS (SELECT k, list(DISTINCT label) AS found, max(shared / size::DOUBLE) AS c FROM blocks WHERE 100 * shared >= {THRESHOLD_PERCENT} * size GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(array_to_string(base, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM worded LEFT JOIN per_base USING (k) LEFT JOIN per_found USING (k)"""
}

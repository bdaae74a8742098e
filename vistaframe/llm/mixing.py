"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within a source the key orders the documents, and its leading hex digits cut that
order into ranges of equal width. The running sum of words inside a range plus the sums of the ranges before it is the
document's place in its source, so no task sees more than one range and no source has to fit in one task. Each source is
then cut at its budget, whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vistaframe.llm.common import table, word_count, written

#: Hex digits of the key that name a range: 16 ** 3 ranges in each source.
RANGE_DIGITS = 3
#: A source is repeated at most so often.
MAX_EPOCHS = 3
#: Sources whose cuts are sent to all executors (about 100 bytes each); with more of them texts and cuts are joined by shuffle.
SENT_SOURCES = 1 << 16


def source_targets(sizes: DataFrame, cycle: int = 3, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds weight and target to (source, source_size), one row for each source.

    Sources in code point order, null last, weigh 1 to `cycle`, repeating, and share the total size by weight. A target
    stops at max_epochs times its source's size; what it leaves is shared again by weight until none is above. In order
    of cap over weight the capped sources are a prefix, so that fixed point is found with running sums. The table has a
    row for each source, not for each document, and is the one thing here that is ordered in a single task.
    """
    cap = F.col("source_size") * max_epochs
    numbered = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("_cap") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = lambda x: F.sum(x).over(everything) - F.coalesce(F.sum(x).over(before), F.lit(0))
    capped_sum = lambda x: F.sum(F.when(F.col("_capped"), x).otherwise(0)).over(everything)
    total = F.sum("source_size").over(everything)
    ranked = (
        sizes.withColumn("weight", (F.row_number().over(numbered) - 1) % cycle + 1)
        .withColumn("_cap", cap)
        .withColumn("_free", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double"))
        .withColumn("_free_weight", rest(F.col("weight")))
        .withColumn("_capped", F.col("weight") * F.col("_free") > F.col("_cap").cast("double") * F.col("_free_weight"))
    )
    left = (total - capped_sum(F.col("_cap"))).cast("double")
    weights = F.sum("weight").over(everything) - capped_sum(F.col("weight"))
    shared = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("weight") * left / F.nullif(weights, F.lit(0)))
    return ranked.select("source", "source_size", "weight", shared.alias("target"))


def placed_rows(sized: DataFrame) -> DataFrame:
    """row (all columns of sized), size, key, of_source, source_size, target, whole and part of every row of sized.

    whole is how many epochs of its source the mix takes in full, part how many words of the row it takes beside those.
    """
    held = sized.select(F.struct(*[F.col(f"`{c}`") for c in sized.columns]).alias("row"), F.col("doc_id").alias("id"), F.col("size").cast("long").alias("size"), "source", mix_key().alias("key"), of_source(F.col("source")).alias("of_source"))
    held = held.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    ranges = held.groupBy("of_source", "range").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    sizes = ranges.groupBy("of_source").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sizes.select("source", "source_size")).select(of_source(F.col("source")).alias("of_source"), "source_size", "target")
    earlier = Window.partitionBy("of_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("of_source", "range", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")).join(targets, "of_source")
    inside = Window.partitionBy("of_source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = held.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["of_source", "range"])
    budget = F.round("target").cast("long")
    whole = F.coalesce(F.floor(budget / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - whole * F.col("source_size") - F.col("start") - F.col("inside")))
    return placed.select("row", "size", "key", "of_source", "source_size", "target", whole.alias("whole"), part.alias("part"))


def mix_key() -> Column:
    """The hash-random key of a row by its doc_id and size."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")).cast("binary"))


def of_source(source: Column) -> Column:
    """A text for each source that also names the null source."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(sized: DataFrame) -> DataFrame:
    """Adds source_size, target and taken to rows that have doc_id, source and size; columns of these names are replaced.

    taken is how many words of the row the mix takes: size for each whole epoch of its source, then in key order what is
    left of the budget, so the row at the cut gives only its first words. Other columns pass through, whatever their names.
    A null source is a source of its own; rows of size 0 take nothing; repeated rows are separate rows with tied keys, of
    which any may come first. No rows in, no rows out.
    """
    added = ["source_size", "target", "taken"]
    taken = (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken")
    return placed_rows(sized).select(*[F.col(f"row.`{c}`").alias(c) for c in sized.columns if c not in added], "source_size", "target", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of docs (doc_id, text, source and others), each as often as it is taken.

    The cut of each source is found on sizes alone: a key, the words that its row gives, and the whole epochs. Then one
    pass over docs decides every row by its own key, so texts are never shuffled. The row at a source's cut keeps its
    first words only, with n_chars to match where docs has it. Rows repeated with their doc_id and size that lie at the cut
    share its words evenly, rounded down. A row without words is in no mix. Other columns pass through, whatever their names.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    placed = written(placed_rows(sized).select("key", "of_source", "whole", "part"))
    cuts = placed.groupBy("of_source").agg(F.first("whole").alias("whole"), F.max(F.when(F.col("part") > 0, F.col("key"))).alias("cut"))
    at_cut = placed.join(cuts.select("of_source", F.col("cut").alias("key")), ["of_source", "key"])
    shares = at_cut.groupBy("of_source").agg(F.floor(F.sum("part") / F.count(F.lit(1))).cast("long").alias("share"))
    cuts = written(cuts.join(shares, "of_source", "left"))
    if cuts.count() <= SENT_SOURCES:
        cuts = F.broadcast(cuts)

    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", of_source(F.col("source")).alias("of_source"), word_count(F.col("text")).alias("size"))
    part = F.when(mix_key() < F.col("cut"), F.col("size")).when(mix_key() == F.col("cut"), F.col("share")).otherwise(0)
    takes = held.join(cuts, "of_source").withColumn("taken", F.col("whole") * F.col("size") + part).where("taken > 0")
    rows = takes.select("row", "size", "taken", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("epoch"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    # Pieces that end with a word each; only rows at a cut are split.
    pieces = F.split(F.col("row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(words == F.col("size"), F.col("row.text")).otherwise(F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), ""))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents; see mix(). Returns doc_id, source, size, source_size, target and taken."""
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mix(sized).select("doc_id", "source", "size", "source_size", "target", "taken")


SIZED_SQL = r"""
sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}
)"""
TARGETS_SQL = """
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sizes),
freed AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE AS free, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free_weight
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
marked AS (SELECT *, weight * free > cap::DOUBLE * free_weight AS capped FROM freed),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight *
    (sum(source_size) OVER () - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE
    / (sum(weight) OVER () - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ())::DOUBLE END AS target
  FROM marked
)"""
TAKES_SQL = """
placed AS (
  SELECT s.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '') || ':' || s.size::VARCHAR), s.doc_id NULLS FIRST, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
takes AS (
  SELECT *, (CASE WHEN source_size > 0 THEN (budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - place)) ELSE 0 END)::BIGINT AS taken
  FROM placed
)"""

QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLES = {
    "op2_mix_sources": f"WITH {SIZED_SQL.format(docs='documents')},{TARGETS_SQL},{TAKES_SQL}\nSELECT doc_id, source, size, source_size, target, taken FROM takes",
}

"""N-gram Jaccard join: exact, size-aware, heavy-light.

Sets that are equal are one class and are handled once. For a set x of n shingles a partner misses at most
d = n - ceil(t * n) of them, so in any one order of all shingles two partners share one of their first d + 1, and l of
their first d + l.

1. Thinning. In hash order each class posts its first d + l shingles, l about a tenth of n. Shingles that only one
   class posts cannot be shared; a class left with fewer than l others has no partner and is done. Tasks combine their own
   postings first, so a shingle that a third of all documents hold arrives once from each task.
2. Ordering. The classes that are left are counted shingle by shingle and put into order of frequency. Most drop out
   again, as more than d of their shingles are their own.
3. Families. Near copies gather around the set whose shingles are the most frequent, their leader. How far each is from its
   leader is known exactly, so only leaders and single sets go on, and how many shingles two leaders share tells whether
   their families can hold partners.
4. Heavy and light. Sets of up to B shingles enumerate the pairs, a fixed-size subset, among their first d + 2 shingles
   and meet where a pair is equal. Larger sets are scanned along the inverted lists of their first d + 1; sets a little
   smaller than B take part there too. B is where the summed cost of both is least: subsets enumerated for sets below it,
   list entries scanned for those above. Leaders of families are scanned along longer prefixes, by what their families need.
5. Linking. Inside a family, and with sets of families near it, sets are compared as their differences from the leader, in
   blocks of bounded size: two sets are apart by both differences less what those share. The sets close to the leader are
   one component already and not compared with each other. A group of near copies posts no lists, its pairs are never rows,
   and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vistaframe.llm.common import Scratch, ship, table, written
from vistaframe.llm.words import mixed, shingles, text_lists
from vistaframe.operators.graph import components

#: Postings that a task combines at a time.
COMBINED = 1 << 21
#: Ids of at most so many classes are sent to all executors (40 bytes each); beyond it the texts are shuffled to them.
SENT_IDS = 1 << 19
#: Turns in which families gather, and shingles that a set names in each: they decide the cost, not the result.
TURNS = 3
NAMED = 4
#: Sets and differing shingles of a block that is compared with another, about.
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 17
#: Common shingles counted at a time.
MATCHES = 1 << 22


def least(n: int | np.ndarray, percent: int):
    """The fewest of its n shingles that a set shares with a partner."""
    return -(-n * percent // 100)


def least_col(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("long")


def prints(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """128 bits that name a set."""
    both = [(int(np.add.reduce(x)), int(np.add.reduce(mixed(x.view(np.uint64))).astype(np.uint64).view(np.int64))) for x in sets]
    return [a for a, _ in both], [b for _, b in both]


def set_prints(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, print_a, print_b of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in text_lists(batch, 1):
                sets = shingles(texts, k)
                a, b = prints(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array([len(x) for x in sets], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["doc_id", "n", "print_a", "print_b"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n long, print_a long, print_b long")


def postings(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, print_a, many): the first shingles of each set in hash order, combined in each task.

    many = 0: a posting of one class. many > 0 with a token: more classes than one post it in this task. many > 0 without
    a token: so many shingles of the class are posted by others in the same task.
    """

    def combined(tokens: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.diff(token, prepend=token[:1] - 1) != 0
        new[0] = True
        distinct = new | (np.diff(owner, prepend=owner[:1] - 1) != 0)
        token, owner, new = token[distinct], owner[distinct], new[distinct]
        run = np.cumsum(new) - 1
        shared = np.bincount(run) > 1
        mine = shared[run]
        holders, held = np.unique(owner[mine], return_counts=True)
        keep = new
        out_token = np.concatenate([token[keep], np.zeros(len(holders), "i8")])
        absent = np.concatenate([np.zeros(int(keep.sum()), bool), np.ones(len(holders), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(out_token, pa.int64(), mask=absent), pa.array(np.concatenate([owner[keep], holders])), pa.array(np.concatenate([mine[keep].astype("i4"), held.astype("i4")]))], ["token", "print_a", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, size = [], [], 0
        for batch in batches:
            for _, _, texts in text_lists(batch, 0):
                sets = [x for x in shingles(texts, k) if len(x)]
                for x, name in zip(sets, prints(sets)[0], strict=True):
                    first = x[: len(x) - least(len(x), percent) + 1 + len(x) // 10]
                    tokens.append(first)
                    owners.append(np.full(len(first), name, "i8"))
                    size += len(first)
                if size >= COMBINED:
                    yield from combined(tokens, owners)
                    tokens, owners, size = [], [], 0
        if size:
            yield from combined(tokens, owners)

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "token long, print_a long, many int")


def may_link(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """rep of the classes that thinning leaves."""
    posted = postings(docs, k, percent)
    token = Window.partitionBy("token")
    seen = posted.where("token IS NOT NULL").select("print_a", "many", F.min("print_a").over(token).alias("lo"), F.max("print_a").over(token).alias("hi"), F.max("many").over(token).alias("most"))
    shared = seen.where("many = 0 AND (most > 0 OR lo <> hi)").select("print_a", F.lit(1).alias("held"))
    own = posted.where("token IS NULL").select("print_a", F.col("many").alias("held"))
    held = shared.union(own).groupBy("print_a").agg(F.sum("held").alias("held"))
    enough = F.col("held") > F.floor(least_col(F.col("n"), percent) / 10)
    return classes.join(held, "print_a").where(enough).select("rep")


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, n, shingles) of the wanted classes (rep, doc_id, print_a, print_b), each from the document that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in text_lists(batch, 0, 1 << 20):
                sets = shingles(texts, k)
                want = [batch.column(c).slice(start, end - start).to_numpy() for c in (2, 3)]
                right = np.flatnonzero(np.all(np.array(prints(sets)) == np.array(want), axis=0))
                sets = [sets[i] for i in right]
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype("i4"), pa.array(np.concatenate(sets) if sets else np.zeros(0, "i8")))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(start, end - start).take(pa.array(right)), pa.array([len(x) for x in sets], pa.int64()), lists], ["rep", "n", "shingles"])

    wanted = wanted.select("doc_id", "rep", "print_a", "print_b")
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    return docs.select("doc_id", F.col("text").cast("binary")).join(wanted, "doc_id").select("text", "rep", "print_a", "print_b").mapInArrow(run, "rep long, n long, shingles array<long>")


def ordered_shingles(sets: DataFrame, reach: Column) -> DataFrame:
    """(rep, n, own, ordered, all): how many shingles no other of these sets has, and the others as (df, token), rarest first.

    ordered goes as far as the first `reach` shingles, own ones first; all is the whole list. Sets of which more than reach
    are their own drop out.
    """
    rows = sets.select("rep", "n", F.explode("shingles").alias("token"))
    df = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = rows.join(df, "token").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("all"))
    room = reach.cast("int") - F.col("own")
    return lists.withColumn("own", (F.col("n") - F.size("all")).cast("int")).where(room > 0).select("rep", "n", "own", F.slice("all", F.lit(1), room).alias("ordered"), "all")


def boundary(firsts: DataFrame) -> int:
    """The largest size of light sets. Costs are summed in bins of sizes that grow by a twentieth; only the bins come to the driver."""
    size = F.size("ordered")
    light = (size * (size - 1) / 2).cast("double")
    heavy = F.aggregate("ordered", F.lit(0.0), lambda s, x: s + x["df"])
    step = F.floor(F.log(F.col("n")) / F.log(F.lit(1.05)))
    bins = firsts.groupBy(step.alias("bin")).agg(F.max("n").alias("n"), F.sum(light).alias("light"), F.sum(heavy).alias("heavy")).orderBy("bin").collect()
    costs = [(0, sum(b["heavy"] for b in bins))]
    for k, b in enumerate(bins):
        costs.append((b["n"], sum(x["light"] for x in bins[: k + 1]) + sum(x["heavy"] for x in bins if x["n"] >= 0.8 * b["n"])))
    return min(costs, key=lambda c: c[1])[0]


def lists_of(firsts: DataFrame, light_up_to: int, percent: int) -> DataFrame:
    """(key, rep, n, rest, small): where light sets meet (a pair of shingles) and where heavy ones are listed (a shingle).

    ordered reaches one shingle beyond the prefix that partners share one of. rest is how many of the set's n shingles stand
    at or after the shingle, in order: partners share no more than the smaller rest where they first meet (positional
    filter). small: rest allows the set to be the smaller of a pair.
    """
    light = firsts.where(F.col("n") <= light_up_to).select("rep", "n", "own", "ordered", F.posexplode("ordered").alias("at", "one"))
    pairs = light.select("rep", "n", "own", "at", "one", F.explode(F.slice("ordered", F.col("at") + 2, F.size("ordered"))).alias("two"))
    pairs = pairs.select(F.xxhash64(F.lit(2), "one.token", "two.token").alias("key"), "rep", "n", "own", "at")
    heavy = firsts.where(F.col("n") >= least(light_up_to + 1, percent))
    reach = F.col("n") - least_col(F.col("n"), percent) + 1 - F.col("own")
    singles = heavy.where(reach > 0).select("rep", "n", "own", F.posexplode(F.slice("ordered", F.lit(1), reach.cast("int"))).alias("at", "one"))
    entries = pairs.union(singles.select(F.xxhash64(F.lit(1), "one.token").alias("key"), "rep", "n", "own", "at"))
    placed = entries.select("key", "rep", "n", (F.col("n") - F.col("own") - F.col("at")).alias("rest"))
    return placed.withColumn("small", F.col("rest") * (100 + percent) >= F.col("n") * 2 * percent)


def meetings(entries: DataFrame) -> DataFrame:
    """The entries of lists that hold more than one set, one of them small."""
    met = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bool_or("small").alias("any")).where("m > 1 AND any").select("key")
    return entries.join(met, "key")


def prefixed(rows: DataFrame, prefix: str, key: str) -> DataFrame:
    return rows.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in rows.columns if c != key])


def strict_pairs(firsts: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """(a, b) of sets that may be similar: they meet in a list, and sizes and places allow it."""
    reach = F.col("n") - least_col(F.col("n"), percent) + 2 - F.col("own")
    firsts = firsts.where(reach > 0).select("rep", "n", "own", F.slice("ordered", F.lit(1), reach.cast("int")).alias("ordered"))
    entries = tables.written(meetings(lists_of(firsts, boundary(firsts), percent)))
    smaller, larger = prefixed(entries.where("small"), "s_", "key"), prefixed(entries, "l_", "key")
    share = F.least("s_rest", "l_rest") * (100 + percent) >= (F.col("s_n") + F.col("l_n")) * percent
    met = smaller.join(larger, "key").where((F.struct("s_n", "s_rep") < F.struct("l_n", "l_rep")) & share)
    return met.select(F.col("s_rep").alias("a"), F.col("l_rep").alias("b")).distinct()


def family_pairs(firsts: DataFrame, alone: DataFrame, percent: int, widest: float) -> DataFrame:
    """(a, b), a the leader of a family and b any other set that leads itself, whose families may hold similar sets.

    Sets x of family a and y of b differ from a and b by r_a + r_b at most beyond what they may differ from each other
    (reach, see families()), so a and b share (u_a + u_b) / 2 shingles, u = n - r, and one of their first n - u / (1 + widest)
    + 1. widest: the largest r / n.
    """
    entries = firsts.join(alone.drop("n"), "rep").withColumn("u", F.col("n") * (100 + percent) - F.col("reach"))
    far = wide_reach(F.col("n"), F.col("u"), percent, widest) - F.col("own")
    listed = entries.where(far > 0).select("rep", "n", "own", "u", "leads", F.posexplode(F.slice("ordered", F.lit(1), far.cast("int"))).alias("at", "one"))
    listed = listed.select(F.col("one.token").alias("token"), "rep", "u", "leads", (F.col("n") - F.col("own") - F.col("at")).alias("rest"))
    one, two = prefixed(listed.where("leads").drop("leads"), "a_", "token"), prefixed(listed, "b_", "token")
    share = F.least("a_rest", "b_rest") * 2 * (100 + percent) >= F.col("a_u") + F.col("b_u")
    once = (F.col("a_rep") < F.col("b_rep")) | ((F.col("a_rep") > F.col("b_rep")) & ~F.col("b_leads"))
    return one.join(two, "token").where(share & once).select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct()


def wide_reach(n: Column, u: Column, percent: int, widest: float) -> Column:
    return n - F.ceil(u / ((1 + widest) * (100 + percent)) - 1e-6) + 1


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds n_a, n_b and apart, the number of shingles that only one of them has, to pairs (a, b)."""
    one = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("_one"))
    two = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("_two"))
    joined = pairs.join(one, "a").join(two, "b")
    return joined.withColumn("apart", F.col("n_a") + F.col("n_b") - 2 * F.size(F.array_intersect("_one", "_two"))).drop("_one", "_two")


def similar(apart: Column, n_a: Column, n_b: Column, percent: int, times: int = 1) -> Column:
    """Whether sets are similar by what only one of them has, or differ by no more than `times` what similar sets may."""
    return (100 + percent) * apart <= times * (100 - percent) * (n_a + n_b)


def families(candidates: DataFrame, sets: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """(rep, leader, n, apart, core, reach) of the sets that a leader takes in; the others lead themselves.

    In each turn a set names a few of its shared shingles with its size class as keys; of all sets at a key the one whose
    shingles are the most frequent is the head. A set joins the best head that differs from it by no more than twice
    what similar sets may, unless that head joins another. core: similar to the leader itself. reach is 100 + percent times
    the set's distance from its leader plus the largest distance of a similar set: (100 + p) apart + (100 - p) n.
    """
    found = None
    for turn in range(TURNS):
        free = candidates if found is None else candidates.join(found.select("rep"), "rep", "left_anti")
        named = free.select("rep", "score", F.floor(F.log(F.col("n")) / F.log(F.lit(1.5))).alias("_size"), F.explode(F.slice("low", turn * NAMED + 1, NAMED)).alias("_low"))
        keyed = named.select(F.xxhash64("_low", "_size").alias("key"), "rep", "score")
        heads = keyed.groupBy("key").agg(F.max(F.struct("score", "rep")).alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
        pairs = keyed.join(heads.select("key", "head"), "key").where("rep <> head.rep").groupBy(F.col("head.rep").alias("a"), F.col("rep").alias("b")).agg(F.first("head.score").alias("score"))
        if found is not None:
            pairs = pairs.join(found.select(F.col("leader").alias("b")).distinct(), "b", "left_anti")
        measured = differences(pairs, sets).withColumn("reach", (100 + percent) * F.col("apart") + (100 - percent) * F.col("n_b"))
        near = tables.written(measured.where(similar(F.col("apart"), F.col("n_a"), F.col("n_b"), percent, 2) & (F.col("reach") * 10 <= 8 * (100 + percent) * F.col("n_a"))))
        roots = near.join(near.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        best = roots.groupBy("b").agg(F.max_by(F.struct("a", "n_a", "n_b", "apart", "reach"), F.struct("score", "a")).alias("to")).select("b", "to.*")
        core = similar(F.col("apart"), F.col("n_a"), F.col("n_b"), percent)
        joined = best.select(F.col("b").alias("rep"), F.col("a").alias("leader"), F.col("n_b").alias("n"), "apart", core.alias("core"), "reach")
        found = tables.written(joined if found is None else found.union(joined))
    return found


def linked_in_block(percent: int):
    """For applyInArrow: of a block of sets outside the core (side 0) and one of any sets (side 1) of a family, links that join the same sets as all links between the sides do.

    The sets come as their differences from the leader. Two of them are apart by the sum of both less twice what is common.
    """

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        side, rep, n, core = (block.column(c).to_numpy() for c in ("side", "rep", "n", "core"))
        lists = block.column("differs").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        tokens, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(rep)), size)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        place = np.zeros(len(rep), np.int64)
        place[left], place[right] = np.arange(len(left)), np.arange(len(right))
        on_left = side[owner] == 0
        order = np.argsort(tokens[~on_left], kind="stable")
        there, there_at = tokens[~on_left][order], place[owner[~on_left][order]]
        here, here_at = tokens[on_left], place[owner[on_left]]
        begin, end = np.searchsorted(there, here, "left"), np.searchsorted(there, here, "right")
        common = np.zeros(len(left) * len(right), np.int64)
        bounds = np.concatenate([[0], np.cumsum(end - begin)])
        at = 0
        while at < len(here):
            stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + MATCHES, "right")) - 1)
            many = (end - begin)[at:stop]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            common += np.bincount(np.repeat(here_at[at:stop], many) * len(right) + there_at[np.repeat(begin[at:stop], many) + within], minlength=len(common))
            at = stop
        apart = size[left][:, None] + size[right][None, :] - 2 * common.reshape(len(left), len(right))
        linked = ((100 + percent) * apart <= (100 - percent) * (n[left][:, None] + n[right][None, :])) & (rep[left][:, None] != rep[right][None, :])
        # The core is one component already; the rest are joined by passing on the smallest rep.
        to_core = linked & core[right][None, :]
        a, b = [rep[left][to_core.any(1)]], [rep[right][to_core.argmax(1)][to_core.any(1)]] if len(right) else [rep[:0]]
        loose = linked[:, ~core[right]]
        mine, theirs = rep[left].copy(), rep[right][~core[right]].copy()
        most = np.iinfo(np.int64).max
        while loose.any():
            new = np.minimum(mine, np.where(loose, theirs[None, :], most).min(1))
            after = np.minimum(theirs, np.where(loose, new[:, None], most).min(0))
            if np.array_equal(new, mine) and np.array_equal(after, theirs):
                break
            mine, theirs = new, after
        a, b = np.concatenate([*a, rep[left], rep[right][~core[right]]]), np.concatenate([*b, mine, theirs])
        return pa.table({"a": a[a != b], "b": b[a != b]})

    return run


def links_inside(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sets of a family, other than those of its core. rows: (family, rep, n, core, differs), written.

    A family is cut into blocks of about BLOCK_SETS sets and BLOCK_SHINGLES differences, so a task holds two blocks at most.
    """
    sizes = lambda of: F.greatest(F.lit(1.0), F.ceil(F.sum(of.cast("long")) / BLOCK_SETS), F.ceil(F.sum(F.when(of, F.size("differs"))) / BLOCK_SHINGLES)).cast("int")
    blocks = rows.groupBy("family").agg(sizes(~F.col("core")).alias("_lefts"), sizes(F.lit(True)).alias("_rights"), F.bool_or(~F.col("core")).alias("_any")).where("_any").drop("_any")
    placed = rows.join(blocks, "family")
    of = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["rep", "n", "core", "differs"]
    left = placed.where("NOT core").select("family", of(0, "_lefts").alias("i"), every("_rights").alias("j"), F.lit(0).alias("side"), *columns)
    right = placed.select("family", every("_lefts").alias("i"), of(1, "_rights").alias("j"), F.lit(1).alias("side"), *columns)
    return left.union(right).groupBy("family", "i", "j").applyInArrow(linked_in_block(percent), "a long, b long")


def link_sets(sets: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """(id, component) of the sets (rep, n, shingles) that are linked with others."""
    reach = F.col("n") - least_col(F.col("n"), percent) + 2
    score = F.aggregate("all", F.lit(0.0), lambda s, x: s + F.log(x["df"])) / F.col("n")
    low = F.slice(F.array_sort(F.transform("all", lambda x: x["token"])), 1, TURNS * NAMED)
    candidates = tables.written(ordered_shingles(sets, reach).select("rep", "n", score.alias("score"), low.alias("low")))
    sets = tables.written(sets.join(candidates.select("rep"), "rep"))
    members = families(candidates, sets, percent, tables)

    own = (100 - percent) * F.col("n")
    led = members.groupBy(F.col("leader").alias("rep")).agg(F.max("reach").alias("_reach"), F.count(F.lit(1)).alias("held"))
    single = candidates.select("rep", "n").join(members.select("rep"), "rep", "left_anti").join(led, "rep", "left")
    alone = tables.written(single.select("rep", "n", F.greatest(own, "_reach").cast("long").alias("reach"), F.col("_reach").isNotNull().alias("leads"), F.coalesce("held", F.lit(0)).alias("held")))
    widest = alone.agg(F.max(F.col("reach") / ((100 + percent) * F.col("n")))).first()[0] or 0.0
    far = F.greatest(reach, wide_reach(F.col("n"), F.col("n") * (100 + percent) - F.col("reach"), percent, widest))
    firsts = tables.written(ordered_shingles(sets.join(alone.select("rep"), "rep").drop("reach"), F.lit(1 << 30)).select("rep", "n", "own", "all").join(alone.select("rep", "reach"), "rep").where(far > F.col("own")).select("rep", "n", "own", F.slice("all", F.lit(1), (far - F.col("own")).cast("int")).alias("ordered")))
    met = strict_pairs(firsts, percent, tables).union(family_pairs(firsts, alone, percent, widest))
    ends = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    measured = tables.written(differences(ends, sets))
    links = measured.where(similar(F.col("apart"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")
    core = members.where("core").select(F.col("leader").alias("a"), F.col("rep").alias("b"))

    # Sets of one family that may be similar to sets of another are its guests; the smaller family visits.
    of = lambda c: alone.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("reach", "leads", "held")])
    wide = measured.join(of("a"), "a").join(of("b"), "b").where((F.col("leads_a") | F.col("leads_b")) & ((100 + percent) * F.col("apart") <= F.col("reach_a") + F.col("reach_b")))
    hosts = wide.select(F.when(F.col("held_a") >= F.col("held_b"), F.struct(F.col("a").alias("family"), F.col("b").alias("guest"), F.col("reach_a").alias("reach"), "apart")).otherwise(F.struct(F.col("b").alias("family"), F.col("a").alias("guest"), F.col("reach_b").alias("reach"), "apart")).alias("x")).select("x.*")
    visits = hosts.join(members.select(F.col("leader").alias("guest"), F.col("rep"), F.col("reach").alias("_own")), "guest").where((100 + percent) * F.col("apart") <= F.col("reach") + F.col("_own")).select("family", "rep")
    guests = tables.written(hosts.select("family", F.col("guest").alias("rep")).union(visits).distinct())
    open_families = guests.select("family").union(members.where("NOT core").select(F.col("leader").alias("family"))).distinct()
    inside = members.select(F.col("leader").alias("family"), "rep", "core").union(guests.select("family", "rep", F.lit(False)))
    inside = inside.union(open_families.select("family", F.col("family").alias("rep"), F.lit(True))).join(open_families, "family", "left_semi")
    lead = sets.select(F.col("rep").alias("family"), F.col("shingles").alias("_lead"))
    rows = inside.join(lead, "family").join(sets, "rep").select("family", "rep", "n", "core", F.concat(F.array_except("shingles", "_lead"), F.array_except("_lead", "shingles")).alias("differs"))
    more = links_inside(tables.written(rows), percent)
    return components(tables.written(links.union(core).union(more)), tables.written)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text). percent is the least similarity, 67 or more.

    A document's set is its distinct k-word shingles, words being runs of anything but ASCII white space with A-Z lowered;
    with fewer words the whole sequence is one shingle. A null or empty text, or one without words, has an empty set and is
    linked with nothing, as is a row whose doc_id is null (its component_id is null). component_id is the smallest doc_id
    that links reach. Rows that share a doc_id are linked as rows of their own. No rows give no rows. Other columns are not
    read.
    """
    return labelled_sets(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def labelled_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n, print_a, print_b, component, component_id of every row of docs, as a table in the shared folder.

    component numbers the components (null: linked with nothing, without a set or an id); component_id is its smallest doc_id.
    """
    if percent < 67:
        raise ValueError("light sets meet in pairs of shingles, which needs a similarity of two thirds or more")
    ship(docs.sparkSession)
    named = ["n", "print_a", "print_b"]
    tables = Scratch()
    signed = tables.written(set_prints(docs, k))
    linkable = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = tables.written(linkable.groupBy(*named).agg(F.min("doc_id").alias("doc_id")).withColumn("rep", F.monotonically_increasing_id()))
    reps = tables.written(may_link(docs, classes, k, percent))
    sets = tables.written(sets_of(docs, classes.join(reps, "rep"), k))
    if sets.count() > sets.select("rep").distinct().count():  # rows that are repeated with their doc_id
        sets = tables.written(sets.dropDuplicates(["rep"]))
    found = link_sets(sets, percent, tables)
    placed = tables.written(classes.join(found, classes["rep"] == found["id"], "left").select(*named, "doc_id", F.coalesce("component", "rep").alias("component")))
    least_id = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = linkable.join(placed.drop("doc_id"), named).join(least_id, "component").select("doc_id", *named, "component", "component_id")
    alone = signed.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", *named, F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    result = written(linked.union(alone))
    tables.drop()
    return result


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without near duplicates: of each component one row stays, that with the smallest doc_id.

    Of several such rows of one doc_id that with the smallest print of its set stays, and of rows repeated with their doc_id
    one. Rows without words or without a doc_id all stay.
    """
    labelled = labelled_sets(docs, k, percent)
    linkable = labelled.where("component IS NOT NULL")
    plain = [F.col(f"docs.`{c}`") for c in docs.columns]
    if linkable.groupBy("doc_id").count().where("count > 1").isEmpty():
        gone = linkable.where("component_id <> doc_id").select("doc_id")
        return docs.alias("docs").join(gone, "doc_id", "left_anti").select(*plain)
    stays = linkable.groupBy("component").agg(F.min(F.struct("doc_id", "print_a", "print_b")).alias("s")).select("s.*")
    printed = with_prints(docs, k)
    free = printed.where("n = 0 OR row.doc_id IS NULL").select("row")
    kept = printed.where("n > 0").select("row", F.col("row.doc_id").alias("doc_id"), "print_a", "print_b").join(stays, ["doc_id", "print_a", "print_b"]).dropDuplicates(["doc_id", "print_a", "print_b"])
    return free.union(kept.select("row")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def with_prints(docs: DataFrame, k: int) -> DataFrame:
    """Each row of docs as row, with n, print_a and print_b of its set."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in text_lists(batch, 1):
                sets = shingles(texts, k)
                a, b = prints(sets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array([len(x) for x in sets], pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["row", "n", "print_a", "print_b"])

    return held.mapInArrow(run, StructType([held.schema["row"], *[StructField(c, LongType()) for c in ("n", "print_a", "print_b")]]))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shingles of four words, similarity 0.85 or more; see near_duplicates()."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


QUERIES = {"op3_jaccard_join": op3_jaccard_join}
ORACLES = {
    "op3_jaccard_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s FROM worded
),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM shingled),
rows_ AS (SELECT doc_id, unnest(s) AS t FROM shingled),
overlapping AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM rows_ a JOIN rows_ b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM overlapping JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * m >= 85 * (x.n + y.n - m)),
both_ AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, both_.b FROM reach JOIN both_ ON reach.r = both_.a)
SELECT s.doc_id, s.n AS n_shingles, min(r) AS component_id FROM sizes s JOIN reach USING (doc_id) GROUP BY ALL"""
}

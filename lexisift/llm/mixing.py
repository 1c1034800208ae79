"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are word counts.  A source's target is its weight's share of the words
wanted, never above ``max_repeat`` times the source, the excess going to the
others by weight (water filling).  Every source's documents are permuted by a
seeded hash and cut into hash-range blocks.  A source contributes whole passes
over its blocks and then the first blocks of one more permuted pass; the last
block is cut between documents, so the words taken differ from the target by
at most half a document.

The number of block instances of each source is its quota.  A binary tree over
the output shards splits the vector of quotas: each node draws how many blocks
of each source go left from the multivariate hypergeometric law, so every shard
gets its exact share of blocks and a random mixture.  Shard by shard the quotas
name disjoint runs of the permuted instance list, and documents are shuffled
inside their shard by hash.

Scale.  The text is read once for its size; all else works on narrow rows.  A
hot source is spread over its hash blocks, sums are combined before the
shuffle, and the tree works on groups of at most ``GROUP`` sources, so neither
the driver nor a task holds more than one group's quotas.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, starts_of, tokens_of, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEAT = 2
SHARDS = 64
BLOCK_DOCS = 256
GROUP = 4096
KEY = ["s_null", "s_text"]


def sized(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """``doc_id, s_null, s_text, size``: the narrow rows the mix is made from."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("s_null"),
                      F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("s_text"),
                      F.col(text_col).alias("text"))
    return map_texts(src, lambda t: [tokens_of(t)[1]], "size long")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with its place ``rank`` (0 first) in the whole order: a range
    sort, and the rows of earlier partitions added to the place in the own."""
    at = F.monotonically_increasing_id()
    t = written(df.orderBy(*order).select("*", F.shiftright(at, 33).alias("part"),
                                          at.bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "ranked")
    sizes = {r.part: r.n for r in t.groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts = sorted(sizes)
    before = dict(zip(parts, starts_of(np.array([sizes[p] for p in parts]))[:-1].tolist()))
    rows = pd.DataFrame({"part": parts, "before": [before[p] for p in parts]}).astype("int64")
    add = t.sparkSession.createDataFrame(rows, "part long, before long")
    return t.join(F.broadcast(add), "part").withColumn("rank", F.col("before") + F.col("pos")).drop("part", "pos", "before")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sources`` (KEY, source_size) with its ``target``."""
    s = ranked(sources, "s_null", "s_text")
    table = F.array(*(F.lit(float(w)) for w in weights))
    s = written(s.withColumn("w", F.element_at(table, (F.col("rank") % len(weights) + 1).cast("int")))
                .withColumn("cap", F.col("source_size") * float(max_repeat)), "weights")
    want = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, None
    while True:
        # sources above their cap stay there; the others share the rest by weight
        over = F.col("cap") <= F.col("w") * level
        kept, free, n = s.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("w"))),
                              F.count(F.when(over, 1))).first()
        if not free or n == full:
            break
        level, full = (want - (kept or 0.0)) / free, n
    return s.withColumn("target", F.least(F.col("w") * level, F.col("cap"))).select(*KEY, "source_size", "target")


def split_tree(counts: np.ndarray, room: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Deal ``counts[i]`` blocks of source i to shards with ``room[j]`` places
    (equal totals): a matrix with those margins, drawn by halving the shards."""
    out = np.zeros((len(counts), len(room)), np.int64)

    def down(have: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = have
            return
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(have, int(room[lo:mid].sum()), method="marginals")
        down(left, lo, mid)
        down(have - left, mid, hi)

    if len(counts) and len(room):
        down(np.asarray(counts, np.int64), 0, len(room))
    return out


def allot(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``quotas`` (KEY, quota) with ``ends``: for every shard, where its run in
    the source's list of block instances ends."""
    n = quotas.count()
    g = max(1, -(-n // GROUP))
    q = quotas.select(*KEY, "quota", F.pmod(F.xxhash64(*KEY), F.lit(g)).cast("int").alias("g"))
    sums = {r.g: r.n for r in q.groupBy("g").agg(F.sum("quota").alias("n")).collect()}
    ids, total = sorted(sums), sum(sums.values())
    room = np.diff([total * j // shards for j in range(shards + 1)])
    table = split_tree(np.array([sums[i] for i in ids], np.int64), room, np.random.default_rng(seed))
    rooms = {i: table[k].tolist() for k, i in enumerate(ids)}

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame, g = frame.sort_values(KEY), int(frame["g"].iloc[0])
        dealt = split_tree(frame["quota"].to_numpy(), np.array(rooms[g]), np.random.default_rng([seed, g]))
        return frame[KEY].assign(ends=[x.tolist() for x in np.cumsum(dealt, axis=1)])

    return q.groupBy("g").applyInPandas(one, "s_null boolean, s_text string, ends array<long>")


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
        share: float = SHARE, max_repeat: int = MAX_REPEAT, shards: int = SHARDS, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken,
    copies, shards``; ``shards`` lists the output shard of every copy.

    Null and empty texts have size 0 and are part of the mix as far as their
    block is; a null source is a source of its own, the last.  Ties of the
    permutation (repeated ids) go by size, equal rows are interchangeable, so
    reruns agree.  Other columns are not read; an empty table gives no rows.
    """
    d = written(sized(docs, id_col, text_col, source_col), "sizes")
    n = d.count()
    bits = max(4, math.ceil(math.log2(max(1, n / BLOCK_DOCS))))
    d = d.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))).withColumn(
        "block", F.shiftrightunsigned("h", 64 - bits))
    t = written(targets(d.groupBy(*KEY).agg(F.sum("size").alias("source_size")), weights, share, max_repeat), "targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    t = t.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))

    # blocks of every source, in the order of the first pass (by hash range) and of the last, partial one
    b = d.groupBy(*KEY, "block").agg(F.sum("size").alias("words")).join(t, KEY)
    order = Window.partitionBy(*KEY).orderBy(F.xxhash64("block", F.col("passes"), F.lit(seed)), "block")
    b = (b.withColumn("place", F.row_number().over(order) - 1)
         .withColumn("before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("first", F.row_number().over(Window.partitionBy(*KEY).orderBy("block")) - 1)
         .withColumn("started", F.col("before") < F.col("rest")))
    b = written(b, "blocks")
    per = b.groupBy(*KEY).agg(F.count("*").alias("blocks"), F.sum(F.col("started").cast("long")).alias("extra"),
                              F.max("passes").alias("p"))
    quota = written(per.select(*KEY, "blocks", (F.col("blocks") * F.col("p") + F.col("extra")).alias("quota")), "quotas")
    ends = quota.select(*KEY, "blocks").join(allot(quota, shards, seed), KEY)
    shard = lambda at: F.size(F.filter("ends", lambda e: e <= at))
    plan = (b.join(ends, KEY)
            .withColumn("whole", F.transform(F.sequence(F.lit(1), F.greatest("passes", F.lit(1))),
                                             lambda i: shard((i - 1) * F.col("blocks") + F.col("first"))))
            .withColumn("whole", F.slice("whole", F.lit(1), F.col("passes")))
            .withColumn("last", shard(F.col("passes") * F.col("blocks") + F.col("place")))
            .select(*KEY, "block", "source_size", "target", "passes", "rest", "before", "words", "started", "whole", "last"))

    d = d.join(plan, [*KEY, "block"])
    # a block that the rest ends in is cut between documents, at the nearest
    cut = F.col("started") & (F.col("before") + F.col("words") > F.col("rest"))
    line = Window.partitionBy(*KEY, "block").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("size").over(line) - F.col("size") / 2
    more = F.col("started") & (~cut | (upto <= F.col("rest")))
    d = d.withColumn("more", more).withColumn("copies", F.col("passes") + F.col("more").cast("int"))
    return d.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies",
                    F.when(F.col("more"), F.concat("whole", F.array("last"))).otherwise(F.col("whole")).alias("shards"))


def materialise(docs: DataFrame, mixed: DataFrame, id_col="doc_id", seed: int = 42) -> DataFrame:
    """The mixed corpus itself: a row per copy, with ``shard`` and partitioned
    by it, in a locally shuffled order.  Ids must be unique."""
    from .common import fresh
    shard, at = fresh(docs, "shard"), fresh(docs, "order_")
    copies = mixed.select(F.col("doc_id").alias(id_col), F.posexplode("shards").alias(at, shard))
    out = docs.join(copies, id_col).withColumn(at, F.xxhash64(F.col(id_col), F.col(at), F.lit(seed)))
    return out.repartition(shard).sortWithinPartitions(shard, at).drop(at)

"""Near-duplicate embeddings by spherical k-means cells and blocked cosines.

Vectors are compared only under equal, non-null labels, so cells are made per
label: one with up to ``cell_rows`` vectors is one cell, a larger one gets
spherical k-means of its own, fitted in a task on a bounded sample (about
``SAMPLE`` vectors by hash).  Vectors meet their label's centroids in a cogroup
of bounded parts; no centroid is collected or broadcast.  Every vector has the
nearest centroid as home.  If x and y lie within the angle t of
each other, y is at most sin(t) * |c' - c| further from x's centroid c than
from its own c' (the distance to the cells' bisecting plane), so y is
replicated to every cell that passes this bound and no link is lost.  Per label
and cell, home rows are compared with all rows in blocks of bounded size, in
double precision.

Equal vectors are one node with a count (combined before the shuffle), blocks
of a hot cell are dealt to tasks of their own, and a task sends a count per
vector and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, hash_sample, roots, written

COSINE = 0.98
SAMPLE = 20_000
CELL_ROWS = 4096
MAX_CELLS = 4096
BLOCK = 2048
DEAL_ROWS = 8192              # vectors of a label dealt to cells in one task
ROUNDS = 12


def units(vectors) -> np.ndarray:
    """Unit vectors of usable vectors of one length, as rows."""
    x = np.stack([np.asarray(v, float) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centroids (unit vectors) of spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([(x[lo:lo + 8192] @ c.T).argmax(axis=1) for lo in range(0, len(x), 8192)])
        new = np.zeros_like(c)
        np.add.at(new, near, x)
        size = np.sqrt((new * new).sum(axis=1))
        c = np.where(size[:, None] > 1e-9, new / np.maximum(size, 1e-9)[:, None], c)
    return c


def near_duplicates(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label",
                    cosine: float = COSINE, cell_rows: int = CELL_ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and those with a null label, link with nothing: no links, a component of
    their own.  Vectors of different lengths link with nothing either.  Equal
    vectors (repeated rows too) link with each other; a null id stays null, is
    never a component's smallest unless alone, and then ``kept`` is true."""
    src = written(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                                 F.transform(F.col(vector_col), lambda v: v.cast("double")).alias("vec")), "vectors")
    finite = F.col("label").isNotNull() & (F.size("vec") > 0) & F.forall(
        "vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    usable = F.coalesce(finite, F.lit(False))
    nodes = written(src.filter(usable).groupBy("label", "vec").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
                    .withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "nodes")
    count, edges = linked(nodes, cosine, cell_rows, block)
    joined = nodes.join(count, "node", "left").join(components(edges), "node", "left").select(
        "label", "vec", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "low",
        F.coalesce("root", "node").alias("root"))
    joined = written(joined, "linked")
    least = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    found = joined.join(least, "root").select("label", "vec", "n_links", "component_id")
    pairs = src.filter(usable).join(found, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = src.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return pairs.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def linked(nodes: DataFrame, cosine: float, cell_rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(node, linked: rows linked with it, by their counts) and forest edges (a, b)."""
    group = ["label", "dim"]
    sizes = written(nodes.groupBy(*group).agg(F.count("*").alias("k")), "label-sizes")
    sized = nodes.select(*group, "vec", "node", "n").join(sizes, group)
    large = sized.filter(F.col("k") > cell_rows)
    slack = np.sqrt(max(0.0, 1 - cosine * cosine)) + 1e-9 if cosine > 0 else np.inf
    kind = nodes.schema["label"].dataType.simpleString()

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        k, x = int(frame["k"].iloc[0]), units(frame.sort_values("node")["vec"])
        parts = -(-k // DEAL_ROWS)
        c = kmeans(x, min(MAX_CELLS, -(-k // cell_rows))).ravel().tolist()
        return frame[group].iloc[:1].merge(pd.DataFrame({"part": range(parts), "centers": [c] * parts}), how="cross")

    def deal(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        x = units(frame["vec"])
        c = np.array(found["centers"].iloc[0]).reshape(-1, x.shape[1])
        gap = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))                   # |c' - c|
        out = []
        for lo in range(0, len(x), 1024):
            dots = x[lo:lo + 1024] @ c.T
            home = dots.argmax(axis=1)
            row, cell = np.nonzero(dots.max(axis=1)[:, None] - dots <= slack * gap[home] + 1e-12)
            out.append(frame[[*group, "node", "n"]].iloc[lo + row].assign(cell=cell, home=home[row] == cell, unit=list(x[lo + row])))
        return pd.concat(out)

    def alone(frames):
        for f in frames:
            # a batch may hold vectors of several lengths
            yield f[[*group, "node", "n"]].assign(cell=0, home=True, unit=[units([v])[0] for v in f["vec"]])

    shape = f"label {kind}, dim int, node long, n long, cell int, home boolean, unit array<double>"
    picked = F.pmod(F.xxhash64("node"), F.lit(1 << 40)) < F.lit(float(SAMPLE * (1 << 40))) / F.col("k")
    centers = large.filter(picked).groupBy(*group).applyInPandas(fit, f"label {kind}, dim int, part long, centers array<double>")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("k") / DEAL_ROWS)).alias("part")
    dealt = (large.select("*", part).groupBy(*group, "part").cogroup(centers.groupBy(*group, "part")).applyInPandas(deal, shape))
    rows = written(sized.filter(F.col("k") <= cell_rows).mapInPandas(alone, shape).union(dealt), "cells")
    key = ["label", "dim", "cell"]
    parts = rows.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("g"))
    # home rows of part i of a cell meet all rows of part j in the task (i, j)
    part = F.pmod(F.xxhash64("node"), F.col("g")).cast("int")
    every = F.sequence(F.lit(0), F.col("g") - 1)
    spot = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    both = F.concat(F.when(F.col("home"), F.transform(every, lambda j: spot(part, j, True))).otherwise(F.array()),
                    F.transform(every, lambda i: spot(i, part, False)))
    dealt = rows.join(parts, key).select(*key, "node", "n", "unit", F.explode(both).alias("x")).select(
        *key, "x.i", "x.j", "x.left", "node", "n", "unit")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        left = frame["left"].to_numpy()
        if not left.any() or left.all():
            return pd.DataFrame({"a": [], "b": [], "m": []}).astype("int64")
        x, y = np.stack(frame["unit"][left].tolist()), np.stack(frame["unit"][~left].tolist())
        xn, yn, n = frame["node"][left].to_numpy(), frame["node"][~left].to_numpy(), frame["n"][~left].to_numpy()
        ids = np.unique(np.concatenate([xn, yn]))
        xi, yi = np.searchsorted(ids, xn), np.searchsorted(ids, yn)
        label, many = np.arange(len(ids)), np.zeros(len(xn), np.int64)
        for lo in range(0, len(x), 256):
            hit = x[lo:lo + 256] @ y.T >= cosine
            hit &= xn[lo:lo + 256, None] != yn[None, :]
            many[lo:lo + 256] = hit @ n
            i, j = np.nonzero(hit)
            # only the links between what is not yet one group
            a, b = label[xi[lo + i]], label[yi[j]]
            if (a != b).any():
                link = np.unique(np.stack([a[a != b], b[a != b]]), axis=1)
                top = roots(link[0], link[1], len(ids))
                label = top[label]
        out = np.flatnonzero(many)
        tree = np.flatnonzero(label != np.arange(len(ids)))
        return pd.DataFrame({"a": np.concatenate([xn[out], ids[tree]]),
                             "b": np.concatenate([np.full(len(out), -1), ids[label[tree]]]),
                             "m": np.concatenate([many[out], np.zeros(len(tree), np.int64)])}).astype("int64")

    found = written(dealt.groupBy(*key, "i", "j").applyInPandas(compare, "a long, b long, m long"), "cosines")
    count = found.filter("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("m").alias("linked"))
    return count, found.filter("b >= 0").select("a", "b")

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage, release

#: A-Z to a-z, every other byte as it is.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: The same, and every ASCII byte that is neither a digit nor a letter becomes a space.
WORD_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def fold(id_col, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a table in the cluster's shared folder."""
    return cut_lineage(df, name)


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (A-Z) runs of non-white-space of every text, flat and in
    order, and the number of tokens of each text.  Null has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(low)
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    flat, parent = flat.filter(full), parent.filter(full)
    return flat, np.bincount(parent.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64)


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """0 and the running totals of ``lengths``."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def hash_sample(df: DataFrame, keys: list[str], n: int, total: int) -> DataFrame:
    """The ``n`` rows of ``df`` (``total`` rows) with the smallest key hashes.

    Rows far above the n-th hash cannot be among them and are dropped first (a
    tenth and six standard deviations above its expected place are kept), so
    the tasks together send about ``n`` rows, not ``n`` each."""
    h = F.xxhash64(*keys)
    share = (1.1 * n + 6 * n ** 0.5 + 10) / max(1, total)
    some = df if share >= 1 else df.filter(h < F.lit(int(-2 ** 63 + share * 2 ** 64)))
    return some.orderBy(h, *keys).limit(n)


def map_texts(df: DataFrame, fn, added: str, text: str = "text", batch_rows: int | None = None) -> DataFrame:
    """``df`` without its column ``text`` and with the columns of the DDL list
    ``added``, which ``fn`` makes from each Arrow array of texts (one list or
    array per added column).  The other columns pass through as they are."""
    rest = df.drop(text)
    kinds = StructType.fromDDL(added)
    names = kinds.names
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), added])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        for b in batches:
            for lo in range(0, b.num_rows, batch_rows or max(1, b.num_rows)):
                part = b.slice(lo, batch_rows or b.num_rows)
                made = fn(part.column(part.schema.get_field_index(text)))
                cols = [part.column(i) for i, f in enumerate(part.schema) if f.name != text]
                new = [x if isinstance(x, pa.Array) else pa.array(x, to_arrow_type(kinds[k].dataType))
                       for k, x in zip(names, made)]
                yield pa.RecordBatch.from_arrays(cols + new, names=[f.name for f in part.schema if f.name != text] + names)

    return df.mapInArrow(run, schema)


def sum_by_document(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values[starts[i]:starts[i + 1]]`` for every i, also over axis 0
    of a matrix."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 linked by pairs (a, b): the smallest node of each
    node's component."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(nxt := label[label], label):
            label = nxt
        if np.array_equal(before, label):
            return label


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the graph with ``edges`` (a LONG, b LONG).

    Returns ``node, root`` for every node that has an edge; ``root`` is the
    smallest node of the component.  Alternating large-star and small-star
    rounds, each one grouped minimum (combined before the shuffle) and one
    join that adaptive execution can split at a hot node; every round is
    written to the shared folder, nothing is collected but a checksum.
    """
    def stars(e: DataFrame) -> DataFrame:
        # the minima are written, so that both sides of each join are plain shuffles and a hot node can be split
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")), "minima")
        # large star: neighbours above the node to the smallest of all its neighbours
        down = written(e.join(low, e.b == low.u).select("a", F.col("m").alias("b")), "large-star")
        # small star: neighbours below the node, and the node itself, to the smallest of them
        least = written(down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m"), "minima")
        moved = down.join(least, F.col("a") == F.col("u")).filter("b > m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        out = written(moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        for t in (low, down, least):
            release(t)
        return out

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a > b").distinct(), "edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        nxt = stars(e)
        again = _mark(nxt)
        release(e)
        e = nxt
        if again == mark:
            break
        mark = again
    else:
        raise RuntimeError("components did not settle")
    top = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return top.union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

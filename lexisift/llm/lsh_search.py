"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``k`` Gaussian projections, shifted and cut into
cells of one width.  A query visits its own cell and then perturbed ones, in the
order of estimated success: a perturbation's score is the squared distance, in
the projections, from the query to the far cell's border.  Candidates of all
tables are merged and ranked by the exact measure.

Inner products become distances by one more entry: with the largest norm M,
``x -> (x, sqrt(M^2 - |x|^2)) / M`` and ``q -> (q, 0) / |q|`` have a distance
that falls as the inner product grows.

* **Calibration.**  The true neighbours of a bounded sample of queries, found
  by one pass over all rows, say up to which score cells must be visited to
  reach ``TARGET`` of them, and which number of projections does so with the
  least work.  This holds the recall at any size; data without structure only
  make queries visit more cells.
* **Copies.**  Equal vectors are one node that knows its ``top + 1`` smallest
  ids (cut before the shuffle), and one query.  A row's own id is taken out at
  the end, which is what the one more is for.
* **Cells.**  A cell's rows meet the queries that visit it in blocks of bounded
  size, each a task's group; a block sends the best ``top + 1`` of each query.
* **Too few.**  A query whose cells hold fewer than ``top`` candidates is
  compared with all rows, in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import hash_sample, written

TOP = 20
TABLES = 2
TARGET = 0.96
SAMPLE_QUERIES = 128
SAMPLE_ROWS = 20_000
#: Projections to choose from; a cell is this many standard deviations wide.
MOST_PROJECTIONS = 24
WIDTH = 2.0
#: A visit costs about as much as comparing so many rows.
VISIT = 1024
MOST_VISITS = 1 << 11
WORK_QUERIES, WORK_ROWS = 32, 4096
#: Bytes of a block of vectors, in double precision.
BLOCK_BYTES = 32 << 20


def block_rows(dim: int) -> int:
    return max(256, BLOCK_BYTES // (8 * dim))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def exact(q: np.ndarray, i: np.ndarray, x: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``q[i]`` and ``x[j]``, entries added in order."""
    total = np.zeros(len(i))
    for d in range(q.shape[1]):
        total += q[:, d][i] * x[:, d][j]
    return total


def best_of(q: np.ndarray, x: np.ndarray, low: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``top`` rows by score and lower id.
    A matrix product leaves what may be among them within its rounding; the
    exact measure ranks those."""
    out = []
    reach = np.sqrt((x * x).sum(axis=1).max()) if len(x) else 0.0
    step = max(1, (1 << 22) // max(1, len(x)))
    for lo in range(0, len(q), step):
        part = q[lo:lo + step]
        s = part @ x.T
        if s.shape[1] > top:
            least = np.partition(s, s.shape[1] - top, axis=1)[:, s.shape[1] - top]
            slack = 1e-12 * x.shape[1] * reach * np.sqrt((part * part).sum(axis=1))
            i, j = np.nonzero(~(s < (least - slack)[:, None]))
        else:
            i, j = (v.ravel() for v in np.indices(s.shape))
        score = exact(part, i, x, j)
        order = np.lexsort((low[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((i[rank < top] + lo, j[rank < top], score[rank < top]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


class Tables:
    """The hash functions of one vector length."""

    def __init__(self, dim: int, most: float, seed: int = 0):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.most, self.k, self.reach = dim, most, 1, 0.0
        self.directions = rng.normal(size=(TABLES, dim + 1, MOST_PROJECTIONS))
        self.shifts = rng.uniform(size=(TABLES, MOST_PROJECTIONS))
        self.width = np.ones(TABLES)

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.most
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))])

    def queries(self, x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1)[:, None]
        return np.column_stack([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros(len(x))])

    def spread(self, unit: np.ndarray) -> None:
        """Cell widths from the projections of a sample."""
        for t in range(TABLES):
            self.width[t] = max(WIDTH * float((unit @ self.directions[t]).std(axis=0).mean()), 1e-9)

    def places(self, unit: np.ndarray, t: int) -> np.ndarray:
        """Projections of table ``t`` in cell widths."""
        return unit @ self.directions[t] / self.width[t] + self.shifts[t]

    def scores(self, q: np.ndarray, x: np.ndarray, t: int) -> np.ndarray:
        """Squared border distances from paired queries to the rows' cells, for
        1, 2, ... projections."""
        at, cell = self.places(q, t), np.floor(self.places(x, t))
        gap = np.maximum(0.0, np.maximum(cell - at, at - cell - 1)) * self.width[t]
        return np.cumsum(gap * gap, axis=1)

    def visits(self, q: np.ndarray, t: int, most: int | None = None):
        """(query, cell number, score) of all cells of table ``t`` within reach,
        in the order of their scores; None when a query would visit over ``most``."""
        at = self.places(q, t)[:, :self.k]
        base = np.floor(at)
        own, cells, cost = np.arange(len(q)), np.zeros(len(q), np.int64), np.zeros(len(q))
        far = int(np.ceil(np.sqrt(self.reach) / self.width[t])) + 1
        for k in range(self.k):
            parts = []
            for d in range(-far, far + 1):
                cell = base[own, k] + d
                gap = np.maximum(0.0, np.maximum(cell - at[own, k], at[own, k] - cell - 1)) * self.width[t]
                total = cost + gap * gap
                pick = np.flatnonzero(total <= self.reach)
                parts.append((own[pick], _fold(cells[pick], cell[pick]), total[pick]))
            own, cells, cost = (np.concatenate(c) for c in zip(*parts))
            if most is not None and len(own) > most * max(1, len(q)):
                return None
        order = np.lexsort((cost, own))
        return own[order], cells[order], cost[order]

    def cells(self, x: np.ndarray, t: int) -> np.ndarray:
        at, cells = np.floor(self.places(x, t)), np.zeros(len(x), np.int64)
        for k in range(self.k):
            cells = _fold(cells, at[:, k])
        return cells


def _fold(cells: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """One number for the cells of all projections so far (equal numbers of
    different cells only add candidates)."""
    with np.errstate(over="ignore"):
        return cells * np.int64(6364136223846793005) + cell.astype(np.int64) + np.int64(1442695040888963407)


def calibrate(tables: Tables, q: np.ndarray, near: list[np.ndarray], sample: np.ndarray, n: int, target: float) -> None:
    """Choose the number of projections and the reach.  ``near`` are the true
    neighbours of each query; ``sample`` stands for all ``n`` rows."""
    unit, rows = tables.queries(q), tables.rows(sample)
    tables.spread(np.concatenate([unit, rows]))
    own = np.repeat(np.arange(len(q)), [len(x) for x in near])
    if not len(own):
        return
    true = tables.rows(np.concatenate([x for x in near if len(x)]))
    found = np.min([tables.scores(unit[own], true, t) for t in range(TABLES)], axis=0)
    # the work of some queries: cells they visit, and rows of the sample in those
    few, some = unit[:WORK_QUERIES], rows[:WORK_ROWS]
    gaps = [np.zeros((len(few), len(some))) for _ in range(TABLES)]
    at = [(tables.places(few, t), np.floor(tables.places(some, t))) for t in range(TABLES)]
    chosen, least = None, np.inf
    for k in range(1, MOST_PROJECTIONS + 1):
        tables.k, tables.reach = k, float(np.quantile(found[:, k - 1], target, method="higher"))
        for t, (q_at, cell) in enumerate(at):
            near_by = cell[None, :, k - 1] - q_at[:, k - 1, None]
            gaps[t] += (np.maximum(0.0, np.maximum(near_by, -1 - near_by)) * tables.width[t]) ** 2
        visits = [tables.visits(few, t, MOST_VISITS) for t in range(TABLES)]
        if any(v is None for v in visits):
            break
        work = n * sum(float((g <= tables.reach).mean()) for g in gaps) + VISIT * sum(len(v[0]) for v in visits) / len(few)
        if work < least:
            least, chosen = work, (k, tables.reach)
    if chosen is None:          # too many cells even along one projection: one cell holds all
        chosen = (1, tables.reach)
        tables.width[:] = 1e9
    tables.k, tables.reach = chosen


def search(vectors: DataFrame, id_col="vec_id", vector_col="embedding", every: int = 20, top: int = TOP, target: float = TARGET) -> DataFrame:
    """The ``top`` rows nearest by inner product to every row whose id is
    divisible by ``every``: ``query_id, rank, vec_id, score``.

    Rows take no part if their id is null or their vector is null, empty, zero
    or holds a null or non-finite entry; vectors of different lengths are not
    compared.  Repeated rows count once; an id with several vectors is a query
    (and a candidate) with each, and never its own candidate.  Equal scores go
    by the smaller id.  A query has fewer rows only if there are fewer
    candidates, none if there is none; an empty table gives no rows.  Only id
    and vector are read, so other columns may have any name."""
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    number = element if element in ("float", "double") else "double"
    vec = F.col(vector_col).cast(f"array<{number}>")
    usable = F.col("vec_id").isNotNull() & (F.size("vec") > 0) & F.forall(
        "vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    rows = written(vectors.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).filter(F.coalesce(usable, F.lit(False)))
                   .withColumn("asks", F.col("vec_id") % every == 0), "vectors")
    key = ["dim", "vec"]
    dated = rows.withColumn("dim", F.size("vec"))
    # the smallest ids of each vector: asking and other rows apart, so that both are cut before the shuffle
    low = dated.distinct().withColumn("r", F.row_number().over(Window.partitionBy(*key, "asks").orderBy("vec_id"))).filter(F.col("r") <= top + 1)
    nodes = written(low.groupBy(*key).agg(F.max("asks").alias("asks"), F.slice(F.array_sort(F.collect_list("vec_id")), 1, top + 1).alias("ids"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    far = F.array_max(F.transform("vec", lambda v: F.abs(v.cast("double"))))
    norm = far * F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + (v / far) * (v / far)))
    counts = {r.dim: r for r in nodes.groupBy("dim").agg(
        F.count("*").alias("n"), F.max(F.col("asks").cast("int")).alias("asked"),
        F.max(norm).alias("m")).collect()}
    rowsof = {r.dim: r.n for r in dated.groupBy("dim").agg(F.count_distinct("vec_id").alias("n")).collect()}
    tables = {d: _fitted(nodes.filter(F.col("dim") == d), r, top, target) for d, r in counts.items() if r.asked}
    near = _visited(nodes, tables, top)
    ids = _ids(near, top)
    spark = vectors.sparkSession
    if rowsof:
        total = spark.createDataFrame(list(rowsof.items()), "dim int, total long")         # a row per length
        # fewer candidates than asked for: one id is the query's own
        poor = (nodes.filter("asks").join(ids, "node", "left").join(F.broadcast(total), "dim")
                .filter(F.coalesce(F.size("found"), F.lit(0)) < F.least(F.lit(top + 1), F.col("total"))).select(*key, "node"))
        poor = written(poor, "poor")
        if not poor.isEmpty():
            whole = _ids(_exhaustive(poor, nodes, counts, top), top)
            ids = ids.join(poor.select("node"), "node", "left_anti").union(whole)
    asked = nodes.filter("asks").select(*key, "node").join(ids, "node").drop("node")
    out = dated.filter("asks").select("vec_id", *key).distinct().withColumnRenamed("vec_id", "query_id").join(asked, key)
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, top)
    return out.select("query_id", F.posexplode(others).alias("at", "x")).select(
        F.col("query_id").cast("long").alias("query_id"), (F.col("at") + 1).alias("rank"), F.col("x.id").cast("long").alias("vec_id"),
        (-F.col("x.less")).alias("score"))


def _fitted(nodes: DataFrame, facts, top: int, target: float) -> Tables:
    dim = facts.dim
    tables = Tables(dim, min(facts.m, np.finfo(float).max))
    asked = nodes.filter("asks")
    q = hash_sample(asked, ["node"], SAMPLE_QUERIES, asked.count()).select("node", "vec").toArrow()
    queries = matrix(q["vec"].combine_chunks(), dim)
    sample = matrix(hash_sample(nodes, ["node"], SAMPLE_ROWS, facts.n).select("vec").toArrow()["vec"].combine_chunks(), dim)
    # the sampled queries against every node: a bounded broadcast, and each task sends its best ones
    shared = nodes.sparkSession.sparkContext.broadcast(queries)
    number = nodes.schema["vec"].dataType.simpleString()

    def compare(batches):
        held = None
        for b in batches:
            x, low = matrix(b.column(0), dim), b.column(1).to_numpy(zero_copy_only=False)
            i, j, s = best_of(shared.value, x, low, top + 1)
            part = pa.table({"q": pa.array(i), "s": pa.array(s), "low": pa.array(low[j]), "vec": b.column(0).take(pa.array(j))})
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows > 8 * (top + 1) * len(shared.value):
                held = _best(held, top + 1)
        if held is not None:
            yield from _best(held, top + 1).combine_chunks().to_batches()

    order = Window.partitionBy("q").orderBy(F.desc("s"), "low")
    got = (nodes.select("vec", F.get("ids", F.lit(0)).cast("long").alias("low")).mapInArrow(compare, f"q long, s double, low long, vec {number}")
           .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top + 1).select("q", "vec").toArrow())
    own, x = got["q"].to_numpy(), matrix(got["vec"].combine_chunks(), dim)
    # a query's own vector is found in any case
    near = [x[own == i] for i in range(len(queries))]
    calibrate(tables, queries, [v[(v != queries[i]).any(axis=1)] for i, v in enumerate(near)], sample, facts.n, target)
    return tables


def _best(t: pa.Table, top: int) -> pa.Table:
    q, s, low = (t[c].to_numpy() for c in ("q", "s", "low"))
    order = np.lexsort((low, -s, q))
    q = q[order]
    return t.take(pa.array(order[np.arange(len(q)) - np.searchsorted(q, q) < top]))


def _visited(nodes: DataFrame, tables: dict, top: int) -> DataFrame:
    """(q, node, s, ids): the best candidates of every block of a visited cell."""
    spark = nodes.sparkSession
    shared = spark.sparkContext.broadcast(tables)
    number, kind = (nodes.schema[c].dataType.simpleString() for c in ("vec", "ids"))

    def numbered(batches, asking):
        for b in batches:
            dims = b.column(0).to_numpy()
            for d in np.unique(dims):
                if int(d) not in shared.value:
                    continue
                tb = shared.value[int(d)]
                every = np.flatnonzero(dims == d)
                step = 64 if asking else max(1, len(every))
                for lo in range(0, len(every), step):
                    at = every[lo:lo + step]
                    x = matrix(b.column(1).take(pa.array(at)), int(d))
                    unit = tb.queries(x) if asking else tb.rows(x)
                    for t in range(TABLES):
                        if asking:
                            own, cell, _ = tb.visits(unit, t)
                        else:
                            own, cell = np.arange(len(at)), tb.cells(unit, t)
                        yield b, d, t, at[own], cell

    def index(batches):
        for b, d, t, at, cell in numbered(batches, False):
            pick = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), pa.array(np.full(len(at), t, np.int32)), pa.array(cell),
                                              *(b.column(c).take(pick) for c in (2, 1, 3))], names=["dim", "t", "cell", "node", "vec", "ids"])

    def probe(batches):
        for b, d, t, at, cell in numbered(batches, True):
            pick = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), pa.array(np.full(len(at), t, np.int32)), pa.array(cell),
                                              b.column(2).take(pick)], names=["dim", "t", "cell", "q"])

    key = ["dim", "t", "cell"]
    base = nodes.select("dim", "vec", "node", "ids")
    entries = written(base.mapInArrow(index, f"dim int, t int, cell long, node long, vec {number}, ids {kind}"), "cells")
    visits = nodes.filter("asks").select("dim", "vec", "node").mapInArrow(probe, "dim int, t int, cell long, q long")
    sizes = entries.groupBy(*key).agg(F.count("*").alias("n"))
    visits = written(visits.join(sizes, key).drop("n"), "visits")          # without those to empty cells
    most = F.greatest(F.lit(256), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim"))))
    parts = written(sizes.join(visits.groupBy(*key).agg(F.count("*").alias("m")), key).select(
        *key, F.ceil(F.col("n") / most).cast("int").alias("g"), F.ceil(F.col("m") / most).cast("int").alias("h")), "parts")
    part = lambda c, g: F.pmod(F.xxhash64(c), F.col(g)).cast("int")
    upto = lambda g: F.sequence(F.lit(0), F.col(g) - 1)
    # block i of a cell's rows meets block j of its queries in the task's group (i, j)
    left = visits.join(parts, key).join(nodes.filter("asks").select(F.col("node").alias("q"), "vec"), "q").select(
        *key, F.explode(upto("g")).alias("i"), part("q", "h").alias("j"), F.lit(True).alias("asks"), F.col("q").alias("node"), "vec",
        F.lit(None).cast(kind).alias("ids"))
    right = entries.join(parts, key).select(
        *key, part("node", "g").alias("i"), F.explode(upto("h")).alias("j"), F.lit(False).alias("asks"), "node", "vec", "ids")
    return _compared(left.union(right), [*key, "i", "j"], top, kind)


def _exhaustive(poor: DataFrame, nodes: DataFrame, counts: dict, top: int) -> DataFrame:
    """The same for queries (dim, vec, node) against all nodes, in blocks."""
    kind = nodes.schema["ids"].dataType.simpleString()
    blocks = poor.sparkSession.createDataFrame([(d, -(-r.n // block_rows(d))) for d, r in counts.items()], "dim int, g int")
    left = poor.join(F.broadcast(blocks), "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("i"), F.lit(True).alias("asks"), "node", "vec", F.lit(None).cast(kind).alias("ids"))
    right = nodes.join(F.broadcast(blocks), "dim").select(
        "dim", F.pmod(F.xxhash64("node"), F.col("g")).cast("int").alias("i"), F.lit(False).alias("asks"), "node", "vec", "ids")
    return _compared(left.union(right), ["dim", "i"], top, kind)


def _compared(rows: DataFrame, key: list[str], top: int, kind: str) -> DataFrame:
    schema = f"q long, node long, s double, ids {kind}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def compare(table):
        asks = table["asks"].combine_chunks()
        left, right = table.filter(asks), table.filter(pc.invert(asks))
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        dim = table["dim"][0].as_py()
        right = right.sort_by("node").combine_chunks()
        low = right["ids"].combine_chunks()
        i, j, s = best_of(matrix(left["vec"].combine_chunks(), dim), matrix(right["vec"].combine_chunks(), dim),
                          pc.list_element(low, 0).to_numpy(zero_copy_only=False), top + 1)
        pick = pa.array(j)
        return pa.table([left["node"].combine_chunks().take(pa.array(i)), right["node"].combine_chunks().take(pick), pa.array(s), low.take(pick)],
                        schema=kinds)

    return rows.groupBy(*key).applyInArrow(compare, schema)


def _ids(near: DataFrame, top: int) -> DataFrame:
    """(node, found): each query's best ``top + 1`` ids, as (less: minus the
    score, id).  A pair comes once per table at most, so so many rows are enough."""
    order = Window.partitionBy("q").orderBy(F.desc("s"), F.get("ids", F.lit(0)))
    some = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= TABLES * (top + 1))
    pairs = some.groupBy(F.col("q").alias("node")).agg(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("s")).alias("less"), i.alias("id")))).alias("found"))
    return pairs.select("node", F.slice(F.array_sort(F.array_distinct(F.flatten("found"))), 1, top + 1).alias("found"))


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the rows (query_id, vec_id) of ``truth`` that ``found`` holds."""
    pairs = ["query_id", "vec_id"]
    hit = truth.join(found.select(*pairs).withColumn("hit", F.lit(1)), pairs, "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    return float(hit if hit is not None else 1.0)

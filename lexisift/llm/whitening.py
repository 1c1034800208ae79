"""Embedding whitening from a weighted covariance of distinct vectors.

Entries are cut to the grid ``x = floor(64 c) + 1000000``, so that equal x
vectors are exactly equal.  They are grouped once (combined before the shuffle),
each distinct vector enters the fit with a weight (one, or its multiplicity),
and it is whitened once; the rows get the result by a join on the vector, whose
hot keys adaptive execution can split.

* A vector travels as a compact key: its offsets from the grid's origin in the
  narrowest integers that hold them.  Equal keys are equal vectors.
* The mean is exact (integer sums).  The covariance is a weighted centred GEMM:
  every task subtracts the mean, multiplies its rows in blocks and sends one
  matrix, which Spark adds up by cell.  The driver holds the d x d matrix of
  each vector length, never a vector.
* ``identity_error`` is measured in the same way on the whitened table.

Vectors of different lengths have no common covariance: each length is fitted
and whitened apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, starts_of, written

SCALE = 64.0
ORIGIN = 1_000_000
COMPONENTS = 16
#: Entries of the grid are below this, so that sums of their offsets stay exact.
LIMIT = 1 << 56
#: A component with less than this share of the largest variance has no direction.
FLAT = 1e-12
BLOCK = 4096
WIDTHS = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))


def keys_of(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(rows with a usable vector, their lengths, their keys)."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = starts_of(size)
    c = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)       # null rows have none
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * c)
        wrong = ~(np.abs(x) < LIMIT)          # null, not a number, infinite or no long
    good = np.flatnonzero((size > 0) & (np.diff(starts_of(wrong)[at]) == 0))
    keys = []
    for i in good:
        v = x[at[i]:at[i + 1]].astype(np.int64)
        top = max(int(v.max()), -int(v.min()) - 1)
        kind = next(k for k, bits in enumerate((7, 15, 31, 63)) if top < 1 << bits)
        keys.append(bytes([kind]) + v.astype(WIDTHS[kind]).tobytes())
    return good, size[good], keys


def offsets_of(keys: list[bytes], dim: int) -> np.ndarray:
    """The vectors of keys of one length, as offsets from ``ORIGIN``."""
    out = np.empty((len(keys), dim), np.int64)
    kinds = np.array([k[0] for k in keys])
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        out[at] = np.frombuffer(b"".join(keys[i][1:] for i in at), WIDTHS[kind]).reshape(len(at), dim)
    return out


def blocks(batches, columns):
    """Arrow batches as (dim, offsets, weights, rows of the batch) per length."""
    for b in batches:
        dims = b.column(columns.index("dim")).to_numpy(zero_copy_only=False)
        keys = b.column(columns.index("key")).to_pylist()
        n = b.column(columns.index("n")).to_numpy(zero_copy_only=False)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            for lo in range(0, len(at), BLOCK):
                pick = at[lo:lo + BLOCK]
                yield b, int(d), offsets_of([keys[i] for i in pick], int(d)), n[pick], pick


def _sums(distinct: DataFrame, by_count: bool) -> dict:
    """Per length: the fit weight n and the exact sums of the offsets."""
    names = distinct.columns

    def run(batches):
        total = {}
        for _, d, x, n, _ in blocks(batches, names):
            w = n if by_count else np.ones(len(n), np.int64)
            have = total.setdefault(d, [0, [0] * d])
            have[0] += int(w.sum())
            big = len(x) * float(np.abs(x).max()) * float(w.max()) >= 2.0 ** 62
            add = (x.astype(object) * w[:, None].astype(object)).sum(axis=0) if big else (x * w[:, None]).sum(axis=0)
            have[1] = [a + int(b) for a, b in zip(have[1], add)]
        # high and low halves, so that sums of any size stay exact
        for d, (w, s) in total.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "w": pa.array([w] * d, pa.int64()),
                "high": pa.array([v >> 31 for v in s], pa.int64()), "low": pa.array([v & 0x7FFFFFFF for v in s], pa.int64())})

    cells = (distinct.mapInArrow(run, "dim int, i int, w long, high long, low long").groupBy("dim", "i")
             .agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("w", "high", "low"))).collect())
    out = {}
    for r in cells:               # one cell for each entry of the mean itself
        out.setdefault(r.dim, [int(r.w), [0] * r.dim])[1][r.i] = (int(r.high) << 31) + int(r.low)
    return out


def _moments(table: DataFrame, centred) -> dict:
    """Sum of outer products per length: ``centred(batches)`` yields (dim, rows
    minus their mean, weights)."""
    def run(batches):
        total = {}
        for d, x, w in centred(batches):
            part = (x * w[:, None]).T @ x
            total[d] = total[d] + part if d in total else part
        for d, m in total.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_pydict({"dim": pa.array(np.full(len(i), d, np.int32)), "i": pa.array(i.astype(np.int32)),
                                              "j": pa.array(j.astype(np.int32)), "v": pa.array(m[i, j])})

    out = {}
    for r in table.mapInArrow(run, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r.dim, {})[r.i, r.j] = r.v
    full = {}
    for d, cells in out.items():  # d x d cells, the size of the covariance itself
        m = np.zeros((1 + max(j for _, j in cells),) * 2)
        for (i, j), v in cells.items():
            m[i, j] = m[j, i] = v
        full[d] = m
    return full


def deviations(offsets: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n x - S)^2, exact; null where no long holds it."""
    base = [s // n for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, base)], object)
    x = offsets.astype(object) - np.array(base, object)[None, :] if max(map(abs, base), default=0) >= LIMIT else offsets - np.array(base, np.int64)
    reach = float(np.abs(x).max()) + 1.0 if x.size else 0.0
    if (n * reach) ** 2 * max(1, x.shape[1]) < 2.0 ** 62:
        away = n * x.astype(np.int64) - rest.astype(np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - rest
    return [v if v < 1 << 63 else None for v in (away * away).sum(axis=1)]


def whiten(vectors: DataFrame, id_col="vec_id", vector_col="embedding", components: int = COMPONENTS,
           by_count: bool = False) -> DataFrame:
    """One row per usable row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``.

    Left out are rows whose vector is null, empty, or holds a null, non-finite
    or oversized (beyond 2^56 on the grid) entry.  ``by_count`` fits with each
    distinct vector's multiplicity instead of one.  Repeated rows and null ids
    get their rows like any other; only id and vector are read, so other columns
    may have any name.  A vector of d entries has min(d, ``components``)
    components.  A component without variance (all vectors equal, or fewer
    vectors than entries) has a null ``whitened`` and does not enter
    ``identity_error``; ``explained`` is null if there is no variance at all.
    A deviation that no long holds is null.  An empty table gives no rows."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))

    def encode(batches):
        for b in batches:
            good, dims, keys = keys_of(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(good)), pa.array(dims.astype(np.int32)),
                                              pa.array(keys, pa.binary())], names=["vec_id", "dim", "key"])

    rows = written(src.mapInArrow(encode, f"vec_id {id_type}, dim int, key binary"), "vectors")
    distinct = written(rows.groupBy("dim", "key").agg(F.count("*").alias("n")), "distinct")
    sums = _sums(distinct, by_count)
    spark = vectors.sparkSession
    mean = {d: np.array([s // n for s in sm]) for d, (n, sm) in sums.items()}
    shift = {d: np.array([(s - n * (s // n)) / n for s in sm]) for d, (n, sm) in sums.items()}
    shared, names = spark.sparkContext.broadcast((sums, mean, shift)), distinct.columns

    def centre(d, x):
        _, mean, shift = shared.value
        return (x - mean[d]) - shift[d]

    def centred(batches):
        for _, d, x, n, _ in blocks(batches, names):
            yield d, centre(d, x), n if by_count else np.ones(len(n))

    maps, explained = {}, []
    for d, total in _moments(distinct, centred).items():
        e, u = np.linalg.eigh(total / sums[d][0])
        e, u = e[::-1][:components], u[:, ::-1][:, :components]
        trace = float(np.trace(total)) / sums[d][0]
        full = e > FLAT * max(e[0], 0.0)
        maps[d] = np.where(full, u / np.sqrt(np.where(full, e, 1.0)), np.nan)
        explained += [(d, [float(max(v, 0.0)) / trace if trace > 0 else None for v in e])]
    projections = spark.sparkContext.broadcast(maps)

    def project(batches):
        for b, d, x, _, pick in blocks(batches, names):
            n, sm = shared.value[0][d]
            z = centre(d, x) @ projections.value[d]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pick), d, np.int32)), b.column(names.index("key")).take(pa.array(pick)),
                 b.column(names.index("n")).take(pa.array(pick)), pa.array(deviations(x, n, sm), pa.int64()),
                 pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), z.shape[1]).cast(pa.list_(pa.float64()))],
                names=["dim", "key", "n", "deviation", "z"])

    white = written(distinct.mapInArrow(project, "dim int, key binary, n long, deviation long, z array<double>"), "white")
    error = _identity_error(white, sums, by_count, {d: ~np.isnan(m[0]) for d, m in maps.items()})
    facts = spark.createDataFrame([(d, sums[d][0], e, error[d]) for d, e in explained],
                                  "dim int, n long, share array<double>, identity_error double")     # a row per length
    out = (rows.join(white.select("dim", "key", "deviation", "z"), ["dim", "key"]).join(F.broadcast(facts), "dim")
           .select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("z", "share")).alias("at", "c")))
    release(distinct)
    return out.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
                      F.when(~F.isnan("c.z"), F.col("c.z")).alias("whitened"), F.col("c.share").alias("explained"), "identity_error")


def _identity_error(white: DataFrame, sums: dict, by_count: bool, full: dict) -> dict:
    """Largest entry of the whitened vectors' covariance minus the identity, over
    the fit list and centred on their own mean, per length."""
    weight = F.col("n") if by_count else F.lit(1)
    mean = {d: np.zeros(len(f)) for d, f in full.items()}
    for r in (white.select("dim", weight.alias("w"), F.posexplode("z").alias("i", "v")).groupBy("dim", "i")
              .agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("m")).collect()):
        mean[r.dim][r.i] = r.m

    def centred(batches):
        for b in batches:
            dims, n = b.column(0).to_numpy(), b.column(1).to_numpy().astype(float)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                z = b.column(2).take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                yield int(d), (z - mean[int(d)])[:, full[int(d)]], n[at]

    made = _moments(white.select("dim", weight.cast("long").alias("n"), "z"), centred)
    return {d: float(np.abs(made[d] / sums[d][0] - np.eye(len(made[d]))).max()) if full[d].any() else 0.0 for d in full}

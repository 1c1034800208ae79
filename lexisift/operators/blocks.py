"""Training rows in blocks: a few thousand sparse rows in one table row.

The optimisers of :mod:`linear` and :mod:`trees` run one Spark job an iteration
over the blocks; numpy works on a block at a time.  A block is bounded in rows
and in non-zeros, so a task's memory does not follow the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK_ROWS = 4096
BLOCK_VALUES = 1 << 22
SCHEMA = "block long, n int, starts binary, indices binary, vals binary, label binary, fold binary, uid binary"
FIELDS = {"starts": np.int64, "indices": np.int32, "vals": np.float64, "label": np.int32, "fold": np.int32, "uid": np.int64}


@dataclass
class Block:
    starts: np.ndarray
    indices: np.ndarray
    vals: np.ndarray
    label: np.ndarray | None = None
    fold: np.ndarray | None = None
    uid: np.ndarray | None = None
    codes: tuple | None = None          # of the block's (feature, bin) pairs, once some tree needs them

    @property
    def n(self) -> int:
        return len(self.starts) - 1

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.starts))

    def times(self, w: np.ndarray) -> np.ndarray:
        """Rows times a (size, problems) matrix."""
        out, lo = np.zeros((self.n, w.shape[1])), 0
        full = np.flatnonzero(np.diff(self.starts))
        while lo < len(full):           # a few thousand non-zeros at once stay in the cache
            hi = max(lo + 1, int(np.searchsorted(self.starts[full + 1], self.starts[full[lo]] + 8192, side="right")))
            rows = full[lo:hi]
            a, b = self.starts[rows[0]], self.starts[rows[-1] + 1]
            out[rows] = np.add.reduceat(self.vals[a:b, None] * w[self.indices[a:b]], self.starts[rows] - a, axis=0)
            lo = hi
        return out

    def transposed_times(self, r: np.ndarray, size: int) -> np.ndarray:
        """The rows' columns times a (rows, problems) matrix: (size, problems)."""
        out, row = np.zeros((size, r.shape[1])), self.row
        order = np.argsort(self.indices, kind="stable")
        cols, vals, row = self.indices[order], self.vals[order], row[order]
        heads = np.flatnonzero(np.diff(cols, prepend=-1))
        ends, lo = np.append(heads[1:], len(cols)), 0
        while lo < len(heads):
            hi = max(lo + 1, int(np.searchsorted(ends, heads[lo] + 8192, side="right")))
            a, b = heads[lo], ends[hi - 1]
            out[cols[heads[lo:hi]]] = np.add.reduceat(vals[a:b, None] * r[row[a:b]], heads[lo:hi] - a, axis=0)
            lo = hi
        return out

    def take(self, rows: np.ndarray) -> "Block":
        size = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        at = np.arange(starts[-1]) - np.repeat(starts[:-1], size) + np.repeat(self.starts[:-1][rows], size)
        return Block(starts, self.indices[at], self.vals[at], *(None if v is None else v[rows] for v in (self.label, self.fold, self.uid)))


def from_lists(indices: pa.Array, values: pa.Array) -> Block:
    """A block of Arrow lists (null rows are empty)."""
    import pyarrow.compute as pc
    size = pc.fill_null(pc.list_value_length(indices), 0).to_numpy(zero_copy_only=False)
    return Block(np.concatenate([[0], np.cumsum(size)]).astype(np.int64), pc.list_flatten(indices).to_numpy(zero_copy_only=False).astype(np.int32),
                 pc.list_flatten(values).to_numpy(zero_copy_only=False).astype(np.float64))


def read(row: dict) -> Block:
    return Block(**{k: np.frombuffer(row[k], t) for k, t in FIELDS.items()})


def each(batches):
    """(row, block) of every table row, without its data in ``row``."""
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}
            yield {k: v for k, v in row.items() if k not in FIELDS}, read(row)


def to_blocks(rows: DataFrame, key_col: str = "doc_id", label_col: str = "label", fold_col: str | None = None) -> DataFrame:
    """Blocks of rows (``indices``, ``values``, a label index, a fold), written.
    Without folds every row is in fold -1."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
    src = rows.select("indices", "values", F.col(label_col).cast("int").alias("label"), fold.alias("fold"), F.xxhash64(key_col).alias("uid"))

    def pack(batches):
        held, size, filled, count, part = [], 0, 0, 0, None

        def made(batch):
            nonlocal count, part
            if part is None:
                from pyspark import TaskContext
                part = TaskContext.get().partitionId()
            one = from_lists(batch.column(0), batch.column(1))
            data = {"starts": one.starts, "indices": one.indices, "vals": one.vals}
            data |= {c: batch.column(k).to_numpy(zero_copy_only=False).astype(FIELDS[c]) for k, c in ((2, "label"), (3, "fold"), (4, "uid"))}
            count += 1
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) + count], pa.int64()), "n": pa.array([one.n], pa.int32()),
                **{c: pa.array([np.ascontiguousarray(data[c], t).tobytes()], pa.binary()) for c, t in FIELDS.items()}})

        def joined():
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for b in batches:
            lo = 0
            while lo < b.num_rows:
                some = b.slice(lo, min(256, BLOCK_ROWS - size))
                held.append(some)
                size, lo, filled = size + some.num_rows, lo + some.num_rows, filled + len(some.column(0).flatten())
                if size >= BLOCK_ROWS or filled >= BLOCK_VALUES:
                    yield made(joined())
                    held, size, filled = [], 0, 0
        if held:
            yield made(joined())

    return cut_lineage(src.mapInArrow(pack, SCHEMA), "blocks")


def few(df: DataFrame, n_rows: int, per_part: int = BLOCK_ROWS) -> DataFrame:
    """Small sets in fewer partitions (merged, not shuffled)."""
    return df.coalesce(max(1, math.ceil(n_rows / per_part)))

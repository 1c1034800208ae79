"""Tree ensembles grown level by level from histograms.

A level of all growing trees (of every fold and class) is one pass over the
blocks: each open node's rows are summed by (feature, bin), and every possible
cut of the node is judged from these sums.  If the rows lie in several blocks,
the sums are added up by a grouped aggregation and a node's best cut is found
where its cells meet; if one block holds all rows, its sums are complete and the
task grows its trees to the end.  Both use the same functions.

* ``fit_forests``: bootstrap trees (a row's multiplicity in a tree is a Poisson
  draw by the row's key), Gini impurity, features drawn per node, a minimum of
  rows to split and of rows in a leaf.
* ``fit_boosting``: joint softmax boosting; a round fits one regression tree per
  class to the residuals of all classes' probabilities, cuts chosen by Friedman's
  improvement, leaves by the Newton step (K-1)/K sum r / sum |r|(1-|r|).

Features are non-negative (TF-IDF): zero is the lowest bin and is never summed,
a cut's left side being the node's total less the right side.  A feature of up
to ``BINS`` distinct values is cut between any two of them, others between
quantiles of their distinct values.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .blocks import Block, each

BINS = 32
GROUPS = 48                 # parallel groups of trees over one block
CHUNK = 1 << 22             # entries looked at at once
EPS = 1e-12


# -------------------------------------------------------------------- bins --
def cut_points(rows: DataFrame, size: int, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, cuts): the ascending cuts of feature j are
    ``cuts[offsets[j]:offsets[j + 1]]``; at most ``bins`` each, so the table is
    bounded by the model's own size."""
    cells = rows.select(F.explode(F.arrays_zip("indices", "values")).alias("c")).select(
        F.col("c.indices").alias("j"), F.col("c.values").alias("v")).filter("v <> 0").distinct()
    marks = F.percentile_approx("v", F.array(*(F.lit((i + 1) / bins) for i in range(bins))), 10_000)
    got = cells.groupBy("j").agg(F.min("v").alias("low"), F.array_sort(F.array_distinct(marks)).alias("u")).collect()
    per = {r.j: np.array(r.u) for r in got}
    if any(r.low < 0 for r in got):
        raise ValueError("tree features must not be negative")
    sizes, cuts = np.zeros(size, np.int64), []
    for j in sorted(per):
        u = np.concatenate([[0.0], per[j]])
        sizes[j] = len(u) - 1
        cuts.append((u[1:] + u[:-1]) / 2)
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([np.zeros(0), *cuts])


def binned(block: Block, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin of every non-zero, dense bins of the rows)."""
    lo, hi = offsets[block.indices].copy(), offsets[block.indices + 1].copy()
    base = lo.copy()
    while (open_ := lo < hi).any():     # binary search of every value in its feature's cuts
        mid = (lo + hi) // 2
        up = open_ & (cuts[np.minimum(mid, len(cuts) - 1)] < block.vals)
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    bins = (lo - base).astype(np.uint8)
    dense = np.zeros((block.n, len(offsets) - 1), np.uint8)
    dense[block.row, block.indices] = bins
    return bins, dense


# ------------------------------------------------------------------- trees --
class Trees:
    """Nodes of many trees: ``feature`` (-1: leaf), ``cut`` (right if the bin is
    above it), children, and ``sums`` of the node's rows."""

    def __init__(self, n: int, columns: int):
        self.feature, self.cut = np.full(n, -1, np.int32), np.zeros(n, np.int16)
        self.left, self.right = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.sums, self.roots, self.depth = np.zeros((n, columns)), np.arange(n), np.zeros(n, np.int16)

    def split(self, nodes, feature, cut, left, right) -> np.ndarray:
        """Split ``nodes``; ``left`` and ``right`` are the children's sums."""
        n, m = len(self.feature), len(nodes)
        self.feature[nodes], self.cut[nodes] = feature, cut
        self.left[nodes], self.right[nodes] = n + np.arange(m), n + m + np.arange(m)
        pad = lambda a, v: np.concatenate([a, np.full(2 * m, v, a.dtype)])
        self.feature, self.cut, self.left, self.right = pad(self.feature, -1), pad(self.cut, 0), pad(self.left, 0), pad(self.right, 0)
        self.sums = np.concatenate([self.sums, left, right])
        self.depth = np.concatenate([self.depth, self.depth[nodes] + 1, self.depth[nodes] + 1])
        return np.arange(n, n + 2 * m)

    def descend(self, dense: np.ndarray, row: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The leaf of each (row, starting node)."""
        node = node.copy()
        live = np.arange(len(node))
        while len(live := live[self.feature[node[live]] >= 0]):
            at = node[live]
            node[live] = np.where(dense[row[live], self.feature[at]] > self.cut[at], self.right[at], self.left[at])
        return node

    def joined(self, other: "Trees") -> "Trees":
        """Both, the other's trees last."""
        out, n = Trees(0, self.sums.shape[1]), len(self.feature)
        for name in ("feature", "cut", "sums", "depth"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name)]))
        for name in ("left", "right", "roots"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name) + n]).astype(getattr(self, name).dtype))
        return out

    def packed(self) -> bytes:
        with io.BytesIO() as f:
            np.savez(f, **self.__dict__)
            return f.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> "Trees":
        out = Trees(0, 1)
        with np.load(io.BytesIO(data)) as z:
            out.__dict__.update({k: z[k] for k in z.files})
        return out


# ------------------------------------------------------------------ growth --
@dataclass(frozen=True)
class Rules:
    """How trees grow.  ``gini``: the columns before the last are class weights;
    otherwise the first is the residual.  The last column counts rows."""
    gini: bool
    depth: int
    min_split: int = 2
    min_leaf: int = 1
    features: int = 0        # drawn per node (0: all)
    seed: int = 0

    def open(self, sums: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Whether nodes may be split."""
        ok = (depth < self.depth) & (sums[:, -1] >= max(self.min_split, 2 * self.min_leaf, 2))
        if self.gini:
            ok &= (sums[:, :-1] > 0).sum(axis=1) > 1
        return ok

    def gain(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if self.gini:
            score = lambda s: (s[:, :-1] ** 2).sum(axis=1) / np.maximum(s[:, :-1].sum(axis=1), 1e-300)
            return score(left) + score(right)
        return self.gain_of(left[:, 0], left[:, -1], right[:, 0], right[:, -1])

    @staticmethod
    def gain_of(left: np.ndarray, n: np.ndarray, right: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Friedman's improvement from residual sums and row counts of both sides."""
        return n * m / np.maximum(n + m, 1) * (left / np.maximum(n, 1) - right / np.maximum(m, 1)) ** 2


def mixed(*parts) -> np.ndarray:
    """A hash of integers, the same wherever it is computed."""
    h = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def drawn(key: np.ndarray, size: int, count: int) -> np.ndarray:
    """``count`` distinct features for every node key: (nodes, count)."""
    if count * 3 >= size:
        return np.argsort(mixed(key[:, None], np.arange(size)[None, :]), axis=1, kind="stable")[:, :count]
    extra = 24 + count // 4
    got = (mixed(key[:, None], np.arange(count + extra)[None, :]) % np.uint64(size)).astype(np.int32)
    order = np.argsort(got, axis=1, kind="stable")
    ranked = np.take_along_axis(got, order, axis=1)
    again = np.zeros_like(got, bool)
    np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
    at = np.argsort(again, axis=1, kind="stable")[:, :count]         # the first draws of each, in order
    return np.take_along_axis(got, at, axis=1)


def cells_of(block: Block, bins, dense, node: np.ndarray, row: np.ndarray, stats: np.ndarray, n_nodes: int, keys: np.ndarray, rules: Rules):
    """Sums of the entries (``row`` with ``stats`` in ``node``, 0..n_nodes-1) by
    (node, feature, bin) without bin zero: (cell numbers in order, sums)."""
    size = dense.shape[1]
    out_key, out_sum, codes = [], [], block.codes
    order = np.argsort(node, kind="stable")
    node, row, stats = node[order], row[order], stats[order]
    width = rules.features if 0 < rules.features < size else max(1, int(np.diff(block.starts).max(initial=1)))
    lo, starts = 0, np.searchsorted(node, np.arange(n_nodes + 1))
    while lo < n_nodes:         # whole nodes at once
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + max(1, CHUNK // width), side="right")) - 1)
        part = slice(starts[lo], starts[hi])
        own, rows = node[part], row[part]
        if 0 < rules.features < size:
            pick = drawn(keys[lo:hi], size, rules.features)
            at, f = np.nonzero(dense[rows[:, None], pick[own - lo]])
            j = pick[own[at] - lo, f]
            b = dense[rows[at], j]
        else:
            n = np.diff(block.starts)[rows]
            where = np.arange(n.sum()) + np.repeat(block.starts[rows] - (np.cumsum(n) - n), n)
            if codes is None:
                known, code = np.unique(block.indices.astype(np.int64) * (BINS + 1) + bins, return_inverse=True)
                codes = block.codes = known, code, known % (BINS + 1) > 0
            n_codes = len(codes[0])
            key = np.repeat((own - lo).astype(np.int64) * n_codes, n) + codes[1][where]
            if (hi - lo) * n_codes <= 8 * len(key):         # dense enough to be counted without sorting
                some = (hi - lo) * n_codes
                count = np.bincount(key, minlength=some)
                found = np.flatnonzero(((count > 0).reshape(hi - lo, n_codes) & codes[2]).ravel())
                place, code = np.divmod(found, n_codes)
                out_key.append((place + lo) * (size * (BINS + 1)) + codes[0][code])
                # column by column, as best_cuts reads them; a column of ones is the count itself
                out_sum.append(np.stack([count[found].astype(float) if (stats[part][:, c] == 1).all() else np.bincount(
                    key, weights=np.repeat(stats[part][:, c], n), minlength=some)[found] for c in range(stats.shape[1])]).T)
                lo = hi
                continue
            at = np.repeat(np.arange(len(rows)), n)
            j, b = block.indices[where], bins[where]
            full = b > 0
            at, j, b = at[full], j[full], b[full]
        cell = (own[at].astype(np.int64) * size + j) * (BINS + 1) + b
        key, inverse = np.unique(cell, return_inverse=True)
        out_key.append(key)
        out_sum.append(np.stack([np.bincount(inverse, weights=stats[part][at, c], minlength=len(key)) for c in range(stats.shape[1])], axis=1))
        lo = hi
    return np.concatenate(out_key), np.concatenate(out_sum)


def best_cuts(cell: np.ndarray, sums: np.ndarray, size: int, totals: np.ndarray, rules: Rules):
    """(node, feature, cut, left sums, right sums) of the best cut of each node
    that has one; ``cell`` is in order."""
    if not len(cell):
        none = np.zeros((0, totals.shape[1]))
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), none, none
    per = size * (BINS + 1)
    starts = np.searchsorted(cell, np.arange(len(totals) + 1) * per)
    size_of, columns = np.diff(starts), range(sums.shape[1])
    group = cell // (BINS + 1)
    # right of the cut below bin b: this bin and those above it, of the same node and feature
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(heads[1:], len(group))
    total = [np.append(np.cumsum(sums[::-1, c])[::-1], 0.0) for c in columns]
    right = [t[:-1] - np.repeat(t[ends], ends - heads) for t in total]
    if rules.gini:
        right = [np.rint(r) for r in right]          # whole weights
    right[-1] = np.rint(right[-1])
    left = [np.repeat(totals[:, c], size_of) - right[c] for c in columns]
    gain = rules.gain(np.stack(left).T, np.stack(right).T) if rules.gini else rules.gain_of(left[0], left[-1], right[0], right[-1])
    gain[~((left[-1] >= rules.min_leaf) & (right[-1] >= rules.min_leaf))] = -np.inf
    some = np.flatnonzero(size_of)
    most = np.maximum.reduceat(gain, starts[some])
    slack = most - EPS * np.maximum(1.0, np.abs(most))
    near = np.flatnonzero(gain >= np.repeat(np.where(np.isfinite(most), slack, np.inf), size_of[some]))
    node = cell[near] // per
    first = near[np.flatnonzero(np.diff(node, prepend=-1))]        # ties: the first feature and cut
    pick = lambda v: np.stack([x[first] for x in v], axis=1)
    return cell[first] // per, group[first] % size, cell[first] % (BINS + 1) - 1, pick(left), pick(right)


def _level(trees: Trees, frontier: np.ndarray, keys, block, bins, dense, node, row, stats, rules: Rules):
    """Sums and totals of the frontier's nodes over one block."""
    place = np.full(len(trees.feature), -1)
    place[frontier] = np.arange(len(frontier))
    use = place[node] >= 0
    own = place[node[use]]
    totals = np.stack([np.bincount(own, weights=stats[use, c], minlength=len(frontier)) for c in range(stats.shape[1])], axis=1)
    cell, sums = cells_of(block, bins, dense, own, row[use], stats[use], len(frontier), keys, rules)
    return cell, sums, totals


def _node_keys(rules: Rules, tree_keys: np.ndarray, path: np.ndarray, nodes: np.ndarray, tree: np.ndarray) -> np.ndarray:
    return mixed(rules.seed, tree_keys[tree[nodes]], path[nodes])


class Grower:
    """Trees in growth, their open nodes and what names each node."""

    def __init__(self, tree_keys, columns: int, rules: Rules):
        self.rules, self.tree_keys = rules, np.asarray(tree_keys)
        self.trees = Trees(len(self.tree_keys), columns)
        self.tree = np.arange(len(self.tree_keys))
        self.path = np.ones(len(self.tree_keys), np.uint64)
        self.frontier, self.fresh = np.arange(len(self.tree_keys)), True

    def keys(self) -> np.ndarray:
        return _node_keys(self.rules, self.tree_keys, self.path, self.frontier, self.tree)

    def set_totals(self, totals: np.ndarray) -> None:
        """The roots' sums, known after the first pass."""
        if self.fresh:
            self.trees.sums[self.frontier] = totals
            self.fresh = False

    def advance(self, node, feature, cut, left, right) -> None:
        """Split frontier places ``node``; the open children are the new frontier."""
        parents = self.frontier[node]
        if self.rules.open(self.trees.sums[parents], self.trees.depth[parents]).all():
            keep = slice(None)
        else:
            keep = np.flatnonzero(self.rules.open(self.trees.sums[parents], self.trees.depth[parents]))
        parents = parents[keep]
        made = self.trees.split(parents, feature[keep], cut[keep], left[keep], right[keep])
        self.tree = np.concatenate([self.tree, self.tree[parents], self.tree[parents]])
        with np.errstate(over="ignore"):
            self.path = np.concatenate([self.path, mixed(self.path[parents], 0), mixed(self.path[parents], 1)])
        self.frontier = made[self.rules.open(self.trees.sums[made], self.trees.depth[made])]


def grow_here(grower: Grower, block: Block, bins, dense, tree: np.ndarray, row: np.ndarray, stats: np.ndarray) -> Trees:
    """Grow to the end over one block that holds all rows; an entry is a row in a tree."""
    node = tree.copy()
    while len(grower.frontier):
        cell, sums, totals = _level(grower.trees, grower.frontier, grower.keys(), block, bins, dense, node, row, stats, grower.rules)
        grower.set_totals(totals)
        grower.advance(*best_cuts(cell, sums, dense.shape[1], totals, grower.rules))
        node = grower.trees.descend(dense, row, node)
    return grower.trees


def grow_apart(tables: DataFrame, growers: dict, entries, size: int, columns: int, cuts, rules: Rules) -> None:
    """Grow ``growers`` {group: Grower} over blocks (with a column ``group``), one
    job a level.  ``entries(row, block, dense)`` gives (tree, row, stats)."""
    sc = tables.sparkSession.sparkContext
    names = [f"s{c}" for c in range(columns)]
    while any(len(g.frontier) for g in growers.values()):
        shared = sc.broadcast({k: (g.trees, g.frontier, g.keys()) for k, g in growers.items() if len(g.frontier)})
        base = np.cumsum([0, *(len(g.frontier) for g in growers.values())])
        first = dict(zip(growers, base))

        def run(batches):
            for head, block in each(batches):
                if head["group"] not in shared.value:
                    continue
                trees, frontier, keys = shared.value[head["group"]]
                bins, dense = binned(block, *cuts.value)
                tree, row, stats = entries(head, block, dense)
                node = trees.descend(dense, row, tree)
                cell, sums, totals = _level(trees, frontier, keys, block, bins, dense, node, row, stats, rules)
                at = np.concatenate([cell // ((BINS + 1) * size), np.arange(len(frontier))]) + first[head["group"]]
                rest = np.concatenate([cell % ((BINS + 1) * size), np.full(len(frontier), -1)])
                every = np.concatenate([sums, totals])
                yield pa.RecordBatch.from_pydict({"node": pa.array(at, pa.int64()), "cell": pa.array(rest, pa.int64()),
                                                  **{n: pa.array(every[:, c]) for c, n in enumerate(names)}})

        def choose(table: pa.Table) -> pa.Table:
            at = table["node"][0].as_py()
            table = table.sort_by("cell")
            cell, sums = table["cell"].to_numpy(), np.stack([table[n].to_numpy() for n in names], axis=1)
            total = sums[cell < 0].sum(axis=0, keepdims=True)
            found = best_cuts(cell[cell >= 0], sums[cell >= 0], size, total, rules)
            one = len(found[0]) > 0
            row = {"node": [at], "feature": [int(found[1][0]) if one else -1], "cut": [int(found[2][0]) if one else 0],
                   "lefts": [found[3][0].tolist() if one else []], "rights": [found[4][0].tolist() if one else []], "total": [total[0].tolist()]}
            return pa.table(row, schema=pa.schema([("node", pa.int64()), ("feature", pa.int32()), ("cut", pa.int32()), ("lefts", pa.list_(pa.float64())),
                                                   ("rights", pa.list_(pa.float64())), ("total", pa.list_(pa.float64()))]))

        cells = tables.mapInArrow(run, "node long, cell long, " + ", ".join(f"{n} double" for n in names))
        summed = cells.groupBy("node", "cell").agg(*(F.sum(n).alias(n) for n in names))
        got = {r.node: r for r in summed.groupBy("node").applyInArrow(
            choose, "node long, feature int, cut int, lefts array<double>, rights array<double>, total array<double>").collect()}   # a row per open node
        for (name, g), lo, hi in zip(list(growers.items()), base, base[1:]):
            rows = [got.get(i) for i in range(lo, hi)]
            g.set_totals(np.array([r.total if r else np.zeros(columns) for r in rows]).reshape(len(rows), columns))
            pick = [i for i, r in enumerate(rows) if r and r.feature >= 0]
            some = [rows[i] for i in pick]
            g.advance(np.array(pick, np.int64), np.array([r.feature for r in some], np.int64), np.array([r.cut for r in some], np.int64),
                      np.array([r.lefts for r in some]).reshape(len(some), columns), np.array([r.rights for r in some]).reshape(len(some), columns))
        shared.destroy()


# ------------------------------------------------------------------ models --
@dataclass
class Ensemble:
    """``start`` and ``step`` are those of boosting; a forest has neither."""
    trees: Trees
    k: int
    offsets: np.ndarray
    cuts: np.ndarray
    start: np.ndarray | None = None
    step: float = 0.0

    def margins(self, dense: np.ndarray) -> np.ndarray:
        """Sum of the trees' leaves per row and class."""
        n, roots = len(dense), self.trees.roots
        values = leaf_values(self.trees, self.k, self.start is None)
        out = np.zeros((n, self.k)) if self.start is None else np.tile(self.start, (n, 1))
        per = max(1, CHUNK // max(1, n))
        for lo in range(0, len(roots), per):
            some = roots[lo:lo + per]
            leaf = self.trees.descend(dense, np.tile(np.arange(n), len(some)), np.repeat(some, n)).reshape(len(some), n)
            if self.start is None:
                out += values[leaf].sum(axis=0)
            else:
                for i in range(len(some)):
                    out[:, (lo + i) % self.k] += self.step * values[leaf[i]]
        return out

    def probabilities(self, block: Block) -> np.ndarray:
        out = []
        for lo in range(0, block.n, 2048):
            part = block.take(np.arange(lo, min(block.n, lo + 2048)))
            m = self.margins(binned(part, self.offsets, self.cuts)[1])
            out.append(m / max(1, len(self.trees.roots)) if self.start is None else _softmax(m))
        return np.concatenate([np.zeros((0, self.k)), *out])

    def predict(self, block: Block) -> np.ndarray:
        return self.probabilities(block).argmax(axis=1)


def leaf_values(trees: Trees, k: int, forest: bool) -> np.ndarray:
    if forest:
        w = trees.sums[:, :-1]
        return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
    top, under = trees.sums[:, 0], trees.sums[:, 1]
    return np.where(np.abs(under) > 1e-150, (k - 1) / k * top / np.where(under == 0, 1.0, under), 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def multiplicity(seed: int, tree: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """How often a row is in a tree's bootstrap sample."""
    u = (mixed(seed, tree, uid) >> np.uint64(11)).astype(float) / 2.0 ** 53
    return np.searchsorted(POISSON, u, side="right").astype(float)


def fit_forests(blocks: DataFrame, cuts: tuple, k: int, folds, n_trees: int = 200, depth: int = 20, min_split: int = 5, min_leaf: int = 1,
                features: int | str = "sqrt", seed: int = 42, bootstrap: bool = True, n_blocks: int | None = None) -> list[Ensemble]:
    """A forest for each entry of ``folds`` (the fold held out, None: none).  A
    node none of whose drawn features varies is a leaf."""
    size = len(cuts[0]) - 1
    count = max(1, int(math.sqrt(size))) if features == "sqrt" else int(features)
    rules = Rules(True, depth, min_split, min_leaf, count if count < size else 0, seed)
    whole = (blocks.count() if n_blocks is None else n_blocks) <= 1
    per = -(-n_trees // max(1, GROUPS // max(1, len(folds)))) if whole else n_trees
    groups = [(i, lo, min(n_trees, lo + per)) for i in range(len(folds)) for lo in range(0, n_trees, per)]
    shared = blocks.sparkSession.sparkContext.broadcast(cuts)

    def entries(head, block, dense):
        i, lo, hi = groups[head["group"]]
        use = np.arange(block.n) if folds[i] is None else np.flatnonzero(block.fold != folds[i])
        tree, row = np.repeat(np.arange(hi - lo), len(use)), np.tile(use, hi - lo)
        w = multiplicity(seed, tree + lo, block.uid[row]) if bootstrap else np.ones(len(row))
        tree, row, w = tree[w > 0], row[w > 0], w[w > 0]
        stats = np.zeros((len(row), k + 1))
        stats[np.arange(len(row)), block.label[row]] = w
        stats[:, -1] = 1
        return tree, row, stats

    tables = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1)))).repartition(max(1, min(len(groups), GROUPS)), "group") \
        if whole else blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))))

    def grow(batches):
        for head, block in each(batches):
            bins, dense = binned(block, *shared.value)
            _, lo, hi = groups[head["group"]]
            tree, row, stats = entries(head, block, dense)
            done = grow_here(Grower(np.arange(lo, hi), k + 1, rules), block, bins, dense, tree, row, stats)
            yield pa.RecordBatch.from_pydict({"group": pa.array([head["group"]], pa.int32()), "trees": pa.array([done.packed()], pa.binary())})

    if whole:
        made = {r.group: Trees.unpacked(r.trees) for r in tables.mapInArrow(grow, "group int, trees binary").collect()}     # the models themselves
    else:
        growers = {g: Grower(np.arange(lo, hi), k + 1, rules) for g, (_, lo, hi) in enumerate(groups)}
        grow_apart(tables, growers, entries, size, k + 1, shared, rules)
        made = {g: x.trees for g, x in growers.items()}
    out = []
    for i in range(len(folds)):
        own = [made.get(g, Trees(hi - lo, k + 1)) for g, (j, lo, hi) in enumerate(groups) if j == i]
        trees = own[0]
        for t in own[1:]:
            trees = trees.joined(t)
        out.append(Ensemble(trees, k, *cuts))
    return out


STATE_EVERY = 10


def fit_boosting(blocks: DataFrame, cuts: tuple, k: int, folds, rounds: int = 100, depth: int = 5, step: float = 0.1, min_split: int = 2,
                 min_leaf: int = 1, n_blocks: int | None = None) -> list[Ensemble]:
    """A boosted ensemble for each entry of ``folds``.  Rows' margins are written
    every ``STATE_EVERY`` rounds; the trees since then are added in the tasks."""
    size = len(cuts[0]) - 1
    rules = Rules(False, depth, min_split, min_leaf)
    whole = (blocks.count() if n_blocks is None else n_blocks) <= 1
    shared = blocks.sparkSession.sparkContext.broadcast(cuts)
    sc = blocks.sparkSession.sparkContext

    def counts(batches):
        for _, b in each(batches):
            n = np.array([np.bincount(b.label[b.fold != f] if f is not None else b.label, minlength=k) for f in folds])
            yield pa.RecordBatch.from_pydict({"f": pa.array(np.repeat(np.arange(len(folds)), k)), "c": pa.array(np.tile(np.arange(k), len(folds))),
                                              "n": pa.array(n.ravel())})

    prior = np.zeros((len(folds), k))
    for r in blocks.mapInArrow(counts, "f long, c long, n long").groupBy("f", "c").agg(F.sum("n").alias("n")).collect():
        prior[r.f, r.c] = r.n
    start = np.log(np.maximum(prior / np.maximum(prior.sum(axis=1, keepdims=True), 1), np.finfo(np.float32).eps))
    models = [Ensemble(Trees(0, 3), k, *cuts, start[i], step) for i in range(len(folds))]

    def with_margins(table, added):
        """The blocks with the margins of all trees so far."""
        extra = sc.broadcast(added)
        schema = table.schema

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1)
                    head, block = next(each([row]))
                    dense = binned(block, *shared.value)[1]
                    m = head_margins(head, block) + Ensemble(extra.value[head["group"]], k, *shared.value, np.zeros(k), step).margins(dense)
                    cols = [pa.array([m.tobytes()], pa.binary()) if name == "state" else row.column(j) for j, name in enumerate(row.schema.names)]
                    yield pa.RecordBatch.from_arrays(cols, names=row.schema.names)
        return cut_lineage(table.mapInArrow(run, schema), "margins")

    def head_margins(head, block):
        return np.frombuffer(head["state"]).reshape(block.n, k) if head["state"] else np.tile(start[head["group"]], (block.n, 1))

    one = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(len(folds) - 1)))).withColumn("state", F.lit(None).cast("binary"))
    table = cut_lineage(one.repartition(len(folds), "group") if whole else one, "margins")
    def residuals(head, block, margins):
        """(tree, row, stats) of the next round's entries, class by class."""
        g = head["group"]
        use = np.arange(block.n) if folds[g] is None else np.flatnonzero(block.fold != folds[g])
        r = -_softmax(margins)
        r[np.arange(block.n), block.label] += 1
        r = r[use].T.ravel()
        return np.repeat(np.arange(k), len(use)), np.tile(use, k), np.column_stack([r, np.abs(r) * (1 - np.abs(r)), np.ones(len(r))])

    def added(trees, dense):
        return Ensemble(trees, k, *shared.value, np.zeros(k), step).margins(dense)

    def rounds_here(table, n):
        """{group: trees of the next ``n`` rounds}, all in one job."""
        def grow(batches):
            for head, block in each(batches):
                bins, dense = binned(block, *shared.value)
                margins, made = head_margins(head, block), Trees(0, 3)
                for _ in range(n):
                    trees = grow_here(Grower(np.arange(k), 3, rules), block, bins, dense, *residuals(head, block, margins))
                    margins, made = margins + added(trees, dense), made.joined(trees)
                yield pa.RecordBatch.from_pydict({"group": pa.array([head["group"]], pa.int32()), "trees": pa.array([made.packed()], pa.binary())})
        return {r.group: Trees.unpacked(r.trees) for r in table.mapInArrow(grow, "group int, trees binary").collect()}      # the models themselves

    def rounds_apart(table, n):
        """The same in a job for every level of every round."""
        since = [Trees(0, 3) for _ in folds]
        for _ in range(n):
            now = sc.broadcast(since)

            def entries(head, block, dense):
                return residuals(head, block, head_margins(head, block) + added(now.value[head["group"]], dense))

            growers = {g: Grower(np.arange(k), 3, rules) for g in range(len(folds))}
            grow_apart(table, growers, entries, size, 3, shared, rules)
            since = [since[g].joined(x.trees) for g, x in growers.items()]
            now.destroy()
        return dict(enumerate(since))

    for t in range(0, rounds, STATE_EVERY):
        n = min(STATE_EVERY, rounds - t)
        made = (rounds_here if whole else rounds_apart)(table, n)
        since = [made.get(g, Trees(0, 3)) for g in range(len(folds))]
        for m, trees in zip(models, since):
            m.trees = m.trees.joined(trees)
        if t + n < rounds:
            old, table = table, with_margins(table, since)
            release(old)
    release(table)
    return models

"""Optimisers over blocks against brute force: all problems at once, pairwise
coupling, trees against an exhaustive search, boosting against plain loops."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexisift.operators import blocks as B
from lexisift.operators import blockmodels as BM
from lexisift.operators import linear as L
from lexisift.operators import trees as T


def small(n=120, d=12, k=3, seed=0):
    r = np.random.default_rng(seed)
    x = np.round(np.abs(r.normal(size=(n, d))), 1) * (r.random((n, d)) < 0.5)
    y = (x @ r.normal(size=(d, k)) + 0.3 * r.normal(size=(n, k))).argmax(axis=1)
    return x, y


def frame(spark, x, y):
    rows = [(i, [int(j) for j in np.flatnonzero(v)], [float(a) for a in v[np.flatnonzero(v)]], int(y[i]), i % 5) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, indices array<int>, values array<double>, label int, fold int")


def block(x, y=None, fold=None):
    return B.Block(np.concatenate([[0], np.cumsum((x > 0).sum(axis=1))]), np.concatenate([np.flatnonzero(v) for v in x]).astype(np.int32), x[x > 0], y, fold)


def in_blocks(spark, x, y, parts):
    return B.to_blocks(frame(spark, x, y).repartition(parts, "doc_id"), fold_col="fold")


def plain_cuts(cell, sums, size, totals, rules):
    """``best_cuts`` with a row of sums for each cell and a search for each cell's end."""
    group, b = cell // (T.BINS + 1), cell % (T.BINS + 1)
    node = group // size
    total = np.concatenate([np.cumsum(sums[::-1], axis=0)[::-1], np.zeros((1, sums.shape[1]))])
    right = total[:-1] - total[np.searchsorted(group, group, side="right")]
    if rules.gini:
        right = np.rint(right)
    right[:, -1] = np.rint(right[:, -1])
    left = totals[node] - right
    gain = rules.gain(left, right)
    gain[~((left[:, -1] >= rules.min_leaf) & (right[:, -1] >= rules.min_leaf))] = -np.inf
    heads = np.flatnonzero(np.diff(node, prepend=-1))
    most = np.maximum.reduceat(gain, heads)
    slack = most - T.EPS * np.maximum(1.0, np.abs(most))
    near = np.flatnonzero(gain >= np.repeat(np.where(np.isfinite(most), slack, np.inf), np.diff(np.append(heads, len(node)))))
    first = near[np.flatnonzero(np.diff(node[near], prepend=-1))]
    return node[first], group[first] % size, b[first] - 1, left[first], right[first]


@pytest.mark.parametrize("gini", [False, True])
def test_best_cuts_as_plainly_written_and_in_less_time(gini):
    r, size, nodes, n = np.random.default_rng(5), 10_000, 9, 1_500_000
    every = np.arange(nodes * size * (T.BINS + 1))
    every = every[(every % (T.BINS + 1) > 0) & (every // (size * (T.BINS + 1)) != 4)]       # node 4 has no cell
    cell = np.sort(r.choice(every, n, replace=False))
    sums = np.column_stack([r.integers(0, 3, n) if gini else r.normal(size=n), r.random(n), np.ones(n)])
    sums = np.rint(sums) if gini else sums
    totals = np.zeros((nodes, 3))
    np.add.at(totals, cell // (size * (T.BINS + 1)), sums)
    totals += [5, 5, 50]
    rules, times = T.Rules(gini, 5), {}
    for f, laid in ((plain_cuts, sums), (T.best_cuts, np.asfortranarray(sums))):
        for _ in range(5):
            t = time.perf_counter()
            got = f(cell, laid, size, totals, rules)
            times[f] = min(times.get(f, np.inf), time.perf_counter() - t)
        if f is plain_cuts:
            want = got
    assert all(np.array_equal(a, b) for a, b in zip(want, got)) and len(got[0]) == nodes - 1
    assert gini or times[T.best_cuts] < 0.75 * times[plain_cuts]


def test_cells_of_counts_as_a_plain_loop():
    x, y = small()
    b = block(x, y)
    cuts = [(np.unique(np.r_[0.0, c])[1:] + np.unique(np.r_[0.0, c])[:-1]) / 2 for c in x.T]
    bins, dense = T.binned(b, np.cumsum([0, *map(len, cuts)]), np.concatenate(cuts))
    row = np.tile(np.arange(120), 2)
    node = np.concatenate([np.arange(120) % 3, 3 + np.arange(120) % 2])
    stats = np.column_stack([np.random.default_rng(2).integers(-4, 5, 240) / 8, np.ones(240)])       # sums are exact in any order
    cell, sums = T.cells_of(b, bins, dense, node, row, stats, 5, np.zeros(5, np.uint64), T.Rules(False, 5))
    want = {}
    for i in range(240):
        for j in np.flatnonzero(dense[row[i]]):
            at = (node[i] * 12 + j) * (T.BINS + 1) + dense[row[i], j]
            want[at] = want.get(at, 0) + stats[i]
    assert cell.tolist() == sorted(want) and np.array_equal(sums, [want[c] for c in sorted(want)])


def test_block_products_and_bounds(spark, monkeypatch):
    x, y = small()
    x[3] = 0
    b, w = block(x, y), np.random.default_rng(1).normal(size=(12, 4))
    assert np.allclose(b.times(w), x @ w) and np.allclose(b.transposed_times(w[:, :1].repeat(10, 0)[:120], 12), x.T @ w[:, :1].repeat(10, 0)[:120])
    assert np.allclose(b.take(np.array([5, 3, 7])).times(w), x[[5, 3, 7]] @ w)
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    got = [(h["n"], blk) for rows in B.to_blocks(frame(spark, x, y).coalesce(1)).toArrow().to_batches() for h, blk in B.each([rows])]
    assert sum(n for n, _ in got) == 120 and max(n for n, _ in got) <= 256


def test_softmax_of_every_fold_is_optimal_and_equal_over_blocks(spark):
    x, y = small()
    models = {p: L.fit_softmax(in_blocks(spark, x, y, p), 12, 3, [None, 0, 3], tol=1e-7) for p in (1, 3)}
    for f, m in zip((None, 0, 3), models[1]):
        use = np.ones(120, bool) if f is None else np.arange(120) % 5 != f
        p = L.softmax(x[use] @ m.w[:-1] + m.w[-1])
        p[np.arange(use.sum()), y[use]] -= 1
        g = np.vstack([x[use].T @ p, p.sum(axis=0)]) / use.sum()
        g[:-1] += m.w[:-1] / use.sum()
        assert np.abs(g).max() < 1e-6
    for a, b in zip(models[1], models[3]):
        assert np.allclose(a.w, b.w, atol=1e-4)


def test_pairs_reach_the_smallest_hinge_objective(spark):
    x, y = small()
    m = L.fit_pairs(in_blocks(spark, x, y, 1), 12, 3, [(10.0, None), (0.1, 2)], tol=1e-6, max_iter=2000)
    for c, f, model in ((10.0, None, m[0]), (0.1, 2, m[1])):
        use = np.ones(120, bool) if f is None else np.arange(120) % 5 != f
        for (i, j), w in zip(model.pairs, model.w.T):
            at = use & ((y == i) | (y == j))
            s = np.where(y[at] == i, 1.0, -1.0)

            def value(w):
                gap = 1 - s * (x[at] @ w[:-1] + w[-1])
                loss = np.where(gap >= L.CORNER, gap - L.CORNER / 2, np.where(gap > 0, gap ** 2 / (2 * L.CORNER), 0))
                return loss.sum() + (w[:-1] ** 2).sum() / (2 * c)
            r, base = np.random.default_rng(0), value(w)
            assert all(value(w + d * r.normal(size=13)) > base - 1e-4 * max(1, base) for d in (1e-3, 1e-2, 0.1, 1) for _ in range(50))
    assert (m[0].predict(block(x)) == y).mean() > 0.9


def test_coupling_solves_its_quadratic_problem():
    r = np.random.default_rng(0)
    k, p = 4, np.full((6, 4, 4), 0.5)
    for i in range(k):
        for j in range(i + 1, k):
            p[:, i, j] = r.uniform(0.02, 0.98, 6)
            p[:, j, i] = 1 - p[:, i, j]
    got = L.couple(p)
    for one, g in zip(p, got):
        q = -one.T * one
        for i in range(k):
            q[i, i] = sum(one[j, i] ** 2 for j in range(k) if j != i)
        kkt = np.block([[q, np.ones((k, 1))], [np.ones((1, k)), np.zeros((1, 1))]])
        want = np.linalg.solve(kkt, np.append(np.zeros(k), 1))[:k]
        assert np.allclose(g, want, atol=1e-6)
    assert L.couple(np.zeros((0, 3, 3))).shape == (0, 3)


def test_sigmoids_minimise_the_log_loss_of_unseen_decisions(spark):
    x, y = small(200)
    for parts in (1, 2):
        blocks = in_blocks(spark, x, y, parts)
        first, *rest = L.fit_pairs(blocks, 12, 3, [(1.0, f) for f in (None, 0, 1, 2, 3, 4)])
        ab = L.fit_sigmoids(blocks, dict(enumerate(rest)))
        fold = np.arange(200) % 5
        d = np.zeros((200, 3))
        for f, m in enumerate(rest):
            d[fold == f] = m.decisions(block(x[fold == f]))
        for i, (p, q) in enumerate(first.pairs):
            at = (y == p) | (y == q)
            yes = y[at] == p
            t = np.where(yes, (yes.sum() + 1) / (yes.sum() + 2), 1 / ((~yes).sum() + 2))

            def loss(a, b):
                z = a * d[at, i] + b
                return (t * z + np.logaddexp(0, -z)).sum()
            best = loss(*ab[i])
            assert all(loss(ab[i, 0] + u, ab[i, 1] + v) >= best - 1e-9 for u in (-0.01, 0, 0.01) for v in (-0.01, 0, 0.01))
    first.sigmoid = ab
    p = first.probabilities(block(x))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all() and (p.argmax(axis=1) == y).mean() > 0.85


# ------------------------------------------------------------------- trees --
def exhaustive(x, y, k, depth, min_split, min_leaf=1):
    """A Gini tree by trying every cut of every feature; returns a function."""
    share = np.bincount(y, minlength=k) / len(y)
    if depth == 0 or len(y) < min_split or share.max() == 1:
        return lambda v: share
    best = None
    for j in range(x.shape[1]):
        values = np.unique(np.append(x[:, j], 0.0))
        for a, b in zip(values, values[1:]):
            right = x[:, j] > (a + b) / 2
            if min_leaf <= right.sum() <= len(y) - min_leaf:
                score = sum((np.bincount(y[s], minlength=k) ** 2).sum() / s.sum() for s in (right, ~right))
                if best is None or score > best[0] + 1e-9:
                    best = (score, j, (a + b) / 2, right)
    if best is None:
        return lambda v: share
    _, j, t, right = best
    lo, hi = (exhaustive(x[s], y[s], k, depth - 1, min_split, min_leaf) for s in (~right, right))
    return lambda v: hi(v) if v[j] > t else lo(v)


@pytest.mark.parametrize("min_split,min_leaf", [(2, 1), (5, 1), (12, 3)])
def test_one_tree_equals_an_exhaustive_search(spark, min_split, min_leaf):
    x, y = small()
    cuts = T.cut_points(frame(spark, x, y), 12)
    want = exhaustive(x, y, 3, 6, min_split, min_leaf)
    for parts in (1, 3):
        forest, = T.fit_forests(in_blocks(spark, x, y, parts), cuts, 3, [None], 1, 6, min_split, min_leaf, 12, bootstrap=False)
        got = forest.probabilities(block(x))
        assert np.allclose(got, [want(v) for v in x])


def test_forests_of_folds_do_not_depend_on_blocks_and_leave_the_fold_out(spark):
    x, y = small()
    cuts = T.cut_points(frame(spark, x, y), 12)
    one, three = (T.fit_forests(in_blocks(spark, x, y, p), cuts, 3, [None, 1], 8, 5) for p in (1, 3))
    for a, b in zip(one, three):
        assert np.allclose(a.probabilities(block(x)), b.probabilities(block(x)))
    flipped = np.where(np.arange(120) % 5 == 1, (y + 1) % 3, y)
    again = T.fit_forests(in_blocks(spark, x, flipped, 1), cuts, 3, [1], 8, 5)[0]
    assert np.allclose(again.probabilities(block(x)), one[1].probabilities(block(x)))
    drawn = T.multiplicity(1, np.zeros(20000, int), np.arange(20000))
    assert abs(drawn.mean() - 1) < 0.03 and abs((drawn == 0).mean() - np.exp(-1)) < 0.02
    some = T.drawn(np.arange(50).astype(np.uint64), 1000, 31)
    assert all(len(set(r)) == 31 for r in some.tolist()) and some.max() < 1000


def boosted(x, y, k, rounds, depth, step):
    """Joint softmax boosting by plain loops; the margins of the rows."""
    def tree(x, r, depth):
        def leaf(rows):
            under = (np.abs(r[rows]) * (1 - np.abs(r[rows]))).sum()
            return (k - 1) / k * r[rows].sum() / under if under else 0.0

        def grow(rows, depth, out):
            best = None
            if depth and len(rows) >= 2:
                for j in range(x.shape[1]):
                    values = np.unique(np.append(x[rows, j], 0.0))
                    for a, b in zip(values, values[1:]):
                        right = x[rows, j] > (a + b) / 2
                        n, m = right.sum(), (~right).sum()
                        if n and m:
                            gain = n * m / (n + m) * (r[rows][right].mean() - r[rows][~right].mean()) ** 2
                            if best is None or gain > best[0] + 1e-12 * max(1, best[0]):
                                best = (gain, right)
            if best is None:
                out[rows] = leaf(rows)
            else:
                grow(rows[best[1]], depth - 1, out)
                grow(rows[~best[1]], depth - 1, out)
        out = np.zeros(len(x))
        grow(np.arange(len(x)), depth, out)
        return out
    f = np.tile(np.log(np.bincount(y, minlength=k) / len(y)), (len(y), 1))
    for _ in range(rounds):
        r = np.eye(k)[y] - L.softmax(f)
        f = f + step * np.stack([tree(x, r[:, c], depth) for c in range(k)], axis=1)
    return f


def test_boosting_equals_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(T, "STATE_EVERY", 2)
    x, y = small(80, 8)
    cuts = T.cut_points(frame(spark, x, y), 8)
    want = L.softmax(boosted(x, y, 3, 5, 3, 0.3))
    loss = -np.log(want[np.arange(80), y]).mean()
    for parts, rounds in ((1, 5), (2, 5)):
        model, = T.fit_boosting(in_blocks(spark, x, y, parts), cuts, 3, [None], rounds, 3, 0.3)
        p = model.probabilities(block(x))
        assert -np.log(p[np.arange(80), y]).mean() == pytest.approx(loss, rel=1e-6)
        assert np.allclose(p, want, atol=1e-6)


def test_negative_features_are_refused_and_quantile_cuts_are_bounded(spark):
    df = spark.createDataFrame([(0, [0], [-1.0], 0, 0)], "doc_id long, indices array<int>, values array<double>, label int, fold int")
    with pytest.raises(ValueError):
        T.cut_points(df, 1)
    many = spark.range(500).select(F.array(F.lit(1)).alias("indices"), F.array((F.col("id") + 1).cast("double")).alias("values"))
    offsets, cuts = T.cut_points(many, 3)
    assert offsets.tolist() == [0, 0, 32, 32] and (np.diff(cuts) > 0).all()


# ------------------------------------------------------------ transformers --
def test_block_models_transform_and_reload(spark, tmp_path):
    x, y = small()
    df, blocks = frame(spark, x, y), in_blocks(spark, x, y, 1)
    cuts = T.cut_points(df, 12)
    pairs, = L.fit_pairs(blocks, 12, 3, [(1.0, None)])
    fitted = [pairs, L.fit_softmax(blocks, 12, 3, [None])[0], T.fit_forests(blocks, cuts, 3, [None], 5, 4)[0], T.fit_boosting(blocks, cuts, 3, [None], 3, 2)[0]]
    empty = spark.createDataFrame([(900, [], [], 0, 0), (901, None, None, 0, 0)], df.schema)
    for i, m in enumerate(fitted):
        model = BM.BlockModel(m, 12, 3)
        model.save(spark, f"{tmp_path}/{i}")
        again = BM.BlockModel.load(spark, f"{tmp_path}/{i}")
        rows = {r.doc_id: r for r in again.transform(df.union(empty)).collect()}
        assert [rows[j].prediction for j in range(120)] == m.predict(block(x)).tolist() and rows[900].prediction == rows[901].prediction
        assert ("probability" in again.transform(df).columns) == (i > 0)


def test_naive_bayes_of_folds_and_hits(spark):
    x, y = small()
    models = BM.fit_multinomial(in_blocks(spark, x, y, 3), 12, 3, [0, 4], 1.0)
    for f, m in zip((0, 4), models):
        use = np.arange(120) % 5 != f
        s = np.stack([x[use & (y == c)].sum(axis=0) for c in range(3)])
        assert np.allclose(m.theta, np.log(s + 1) - np.log(s.sum(axis=1, keepdims=True) + 12))
    hits = {(r.name, r.fold): (r.hits, r.n) for r in BM.fold_hits(in_blocks(spark, x, y, 2), {"m": dict(zip((0, 4), models))}).collect()}
    at = np.arange(120) % 5 == 4
    assert hits["m", 4] == (int((models[1].predict(block(x[at])) == y[at]).sum()), 24) and len(hits) == 2

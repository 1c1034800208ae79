"""Linear models of many problems in one optimisation.

Folds, values of C and class pairs give dozens of fits on the same rows.  Here
they are the columns of one matrix: an iteration is one Spark job in which every
block computes the losses and gradients of all problems (a problem masks the
rows of its held-out fold and of other classes), and the driver takes a step of
L-BFGS for each.  Problems that have converged leave the job.

* ``softmax``: multinomial logistic regression, one problem per fold.
* ``pairs``: one-vs-one machines with the hinge loss (rounded off within
  ``CORNER`` of its corner, so that it has a gradient), one problem for each
  class pair, C and fold.

The objective of a problem with n rows is ``mean loss + |w|^2 / (2 C n)``; the
intercept is not penalised.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, each

CORNER = 0.1
MEMORY = 8
GROUPS = 48                 # parallel groups of problems over one block


@dataclass(frozen=True)
class Problem:
    """``fold`` is held out (None: none is).  A pair is (class of +1, class of -1);
    without one the problem is the softmax over all classes."""
    c: float
    fold: int | None = None
    pair: tuple[int, int] | None = None

    def rows(self, block: Block) -> np.ndarray:
        """Which rows it trains on."""
        use = np.ones(block.n, bool) if self.fold is None else block.fold != self.fold
        return use & np.isin(block.label, self.pair) if self.pair else use


def _columns(p: Problem, k: int) -> int:
    return 1 if p.pair else k


def parts_of(block: Block, problems: list[Problem], weights: list[np.ndarray], k: int):
    """(losses, gradients) of a block: the sums over each problem's rows.
    ``weights`` are (size + 1, columns), the intercept last."""
    size = len(weights[0]) - 1
    w = np.concatenate(weights, axis=1)
    z = block.times(w[:-1]) + w[-1]
    slope, losses, lo = np.zeros_like(z), [], 0
    for p in problems:
        hi = lo + _columns(p, k)
        use = p.rows(block)
        if p.pair is None:
            m = z[:, lo:hi]
            top = m.max(axis=1, keepdims=True)
            e = np.exp(m - top)
            total = e.sum(axis=1, keepdims=True)
            at = np.arange(block.n), block.label
            losses.append(float((np.log(total[:, 0]) + top[:, 0] - m[at])[use].sum()))
            g = e / total
            g[at] -= 1
            slope[:, lo:hi] = np.where(use[:, None], g, 0.0)
        else:
            y = (block.label == p.pair[0]).astype(float) - (block.label == p.pair[1])
            gap = 1 - y * z[:, lo]
            loss = np.where(gap >= CORNER, gap - CORNER / 2, np.where(gap > 0, gap * gap / (2 * CORNER), 0.0))
            losses.append(float(loss[use].sum()))
            slope[:, lo] = np.where(use, -y * np.clip(gap / CORNER, 0.0, 1.0), 0.0)
        lo = hi
    g = np.concatenate([block.transposed_times(slope, size), slope.sum(axis=0, keepdims=True)])
    ends = np.cumsum([_columns(p, k) for p in problems])
    return losses, np.split(g, ends[:-1], axis=1)


def row_counts(blocks: DataFrame, problems: list[Problem]) -> list[int]:
    """Rows that each problem trains on."""
    def run(batches):
        total = np.zeros(len(problems), np.int64)
        for _, b in each(batches):
            for i, p in enumerate(problems):
                total[i] += int(p.rows(b).sum())
        yield pa.RecordBatch.from_pydict({"p": pa.array(range(len(problems)), pa.int32()), "n": pa.array(total)})

    got = {r.p: r.n for r in blocks.mapInArrow(run, "p int, n long").groupBy("p").sum("n").toDF("p", "n").collect()}
    return [got.get(i, 0) for i in range(len(problems))]


def _evaluate(blocks: DataFrame, problems: list[Problem], trial: dict[int, np.ndarray], k: int) -> dict:
    """{problem: (loss, gradient)} of the trial weights, one job."""
    sc = blocks.sparkSession.sparkContext
    ids = list(trial)
    shared = sc.broadcast(([problems[i] for i in ids], [trial[i] for i in ids]))

    def run(batches):
        some, weights = shared.value
        total = None
        for _, b in each(batches):
            losses, grads = parts_of(b, some, weights, k)
            total = (losses, grads) if total is None else ([x + y for x, y in zip(total[0], losses)], [x + y for x, y in zip(total[1], grads)])
        if total is not None:
            yield pa.RecordBatch.from_pydict({"p": pa.array(ids, pa.int32()), "loss": pa.array(total[0]),
                                              "g": pa.array([g.tobytes() for g in total[1]], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        g = sum(np.frombuffer(x.as_py()) for x in table["g"])
        return pa.table({"p": table["p"].slice(0, 1), "loss": pa.array([sum(table["loss"].to_pylist())]), "g": pa.array([g.tobytes()], pa.binary())})

    schema = "p int, loss double, g binary"
    out = blocks.mapInArrow(run, schema)
    # added up by problem in the tasks; the driver gets one gradient for each
    out = out.groupBy("p").applyInArrow(add, schema)
    got = {r.p: (r.loss, np.frombuffer(r.g).reshape(trial[r.p].shape)) for r in out.collect()}
    shared.destroy()
    return {i: got.get(i, (0.0, np.zeros_like(trial[i]))) for i in ids}


@dataclass
class _State:
    w: np.ndarray
    f: float = np.inf
    g: np.ndarray | None = None
    move: np.ndarray | None = None
    step: float = 1.0
    pairs: list = field(default_factory=list)
    done: bool = False
    rounds: int = 0

    def aim(self) -> None:
        """The L-BFGS direction."""
        q, used = self.g.copy(), []
        for s, y, rho in reversed(self.pairs):
            a = rho * (s * q).sum()
            q -= a * y
            used.append(a)
        if self.pairs:
            s, y, _ = self.pairs[-1]
            q *= (s * y).sum() / (y * y).sum()
        for (s, y, rho), a in zip(self.pairs, reversed(used)):
            q += s * (a - rho * (y * q).sum())
        if not (q * self.g).sum() > 0:
            q, self.pairs = self.g.copy(), []
        self.move = -q
        self.step = 1.0 if self.pairs else min(1.0, 1.0 / max(1e-12, float(np.abs(q).sum())))


def minimise(blocks: DataFrame, problems: list[Problem], size: int, k: int, max_iter: int = 1000, tol: float = 1e-4,
             n_blocks: int | None = None) -> tuple[list[np.ndarray], list[float]]:
    """Weights (size + 1, columns) of every problem and the largest entry of its
    gradient.  A problem stops when that is at most ``tol``, when no step lowers
    its objective, or after ``max_iter`` steps.

    With several blocks an iteration is a job.  If one block holds all rows, its
    sums are complete, and tasks take the problems to the end, some each."""
    if (blocks.count() if n_blocks is None else n_blocks) > 1:
        rows = row_counts(blocks, problems)
        return _descend(lambda trial: _evaluate(blocks, problems, trial, k), rows, problems, size, k, max_iter, tol)
    groups = [list(range(i, len(problems), min(GROUPS, len(problems)))) for i in range(min(GROUPS, len(problems)))]

    def run(batches):
        for head, block in each(batches):
            ids = groups[head["group"]]
            some = [problems[i] for i in ids]
            rows = [int(p.rows(block).sum()) for p in some]

            def here(trial):
                losses, grads = parts_of(block, [some[i] for i in trial], [trial[i] for i in trial], k)
                return dict(zip(trial, zip(losses, grads)))

            weights, rest = _descend(here, rows, some, size, k, max_iter, tol)
            yield pa.RecordBatch.from_pydict({"p": pa.array(ids, pa.int32()), "w": pa.array([w.tobytes() for w in weights], pa.binary()), "rest": pa.array(rest)})

    tables = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1)))).repartition(len(groups), "group")
    got = {r.p: r for r in tables.mapInArrow(run, "p int, w binary, rest double").collect()}      # the models themselves
    none = [np.zeros((size + 1, _columns(p, k))) for p in problems]
    return ([np.frombuffer(got[i].w).reshape(none[i].shape) if i in got else none[i] for i in range(len(problems))],
            [got[i].rest if i in got else 0.0 for i in range(len(problems))])


def _descend(evaluate, rows: list[int], problems: list[Problem], size: int, k: int, max_iter: int, tol: float):
    """L-BFGS with backtracking, all problems in step."""
    state = [_State(np.zeros((size + 1, _columns(p, k)))) for p in problems]

    def objective(i, loss, grad, w):
        n, c = max(1, rows[i]), problems[i].c
        g = grad / n
        g[:-1] += w[:-1] / (c * n)
        return loss / n + float((w[:-1] ** 2).sum()) / (2 * c * n), g

    got = evaluate({i: s.w for i, s in enumerate(state)})
    for i, s in enumerate(state):
        s.f, s.g = objective(i, *got[i], s.w)
        s.done = float(np.abs(s.g).max()) <= tol
        s.aim()
    while not all(s.done for s in state):
        trial = {i: s.w + s.step * s.move for i, s in enumerate(state) if not s.done}
        for i, (loss, grad) in evaluate(trial).items():
            s, w = state[i], trial[i]
            f, g = objective(i, loss, grad, w)
            fall = float((s.g * s.move).sum())
            if not f <= s.f + 1e-4 * s.step * fall:
                s.step *= 0.5 if not np.isfinite(f) else min(0.5, max(0.1, -fall * s.step / (2 * (f - s.f - fall * s.step) + 1e-300)))
                if s.step < 1e-10:
                    s.done = not s.pairs            # a last try along the gradient itself
                    s.pairs = []
                    s.aim()
                continue
            d, y = w - s.w, g - s.g
            curve = float((d * y).sum())
            if curve > 1e-10 * float((y * y).sum()) ** 0.5 * float((d * d).sum()) ** 0.5:
                s.pairs = [*s.pairs, (d, y, 1.0 / curve)][-MEMORY:]
            s.w, s.f, s.g, s.rounds = w, f, g, s.rounds + 1
            s.done = float(np.abs(g).max()) <= tol or s.rounds >= max_iter
            s.aim()
    return [s.w for s in state], [float(np.abs(s.g).max()) for s in state]


# ------------------------------------------------------------------ models --
def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def couple(r: np.ndarray, rounds: int = 200, tol: float = 1e-10) -> np.ndarray:
    """Class probabilities of pairwise ones: ``r[:, i, j]`` estimates
    P(i | i or j).  The minimum of the sum over pairs of ``(r_ji p_i - r_ij
    p_j)^2``, by the fixed-point iteration of Wu, Lin and Weng (2004)."""
    n, k, _ = r.shape
    q = -np.transpose(r, (0, 2, 1)) * r
    at = np.arange(k)
    q[:, at, at] = 0.0
    q[:, at, at] = (np.transpose(r, (0, 2, 1)) ** 2).sum(axis=2) - r[:, at, at] ** 2
    p = np.full((n, k), 1.0 / k)
    for _ in range(rounds):
        qp = np.einsum("nij,nj->ni", q, p)
        pqp = (p * qp).sum(axis=1)
        if n == 0 or np.abs(qp - pqp[:, None]).max() < tol / k:
            break
        for t in range(k):
            move = (pqp - qp[:, t]) / np.maximum(q[:, t, t], 1e-300)
            p[:, t] += move
            grow = 1.0 + move
            pqp = (pqp + move * (move * q[:, t, t] + 2 * qp[:, t])) / grow ** 2
            qp = (qp + move[:, None] * q[:, t]) / grow[:, None]
            p /= grow[:, None]
    return p


@dataclass
class Softmax:
    """Multinomial logistic regression."""
    w: np.ndarray

    def probabilities(self, block: Block) -> np.ndarray:
        return softmax(block.times(self.w[:-1]) + self.w[-1])

    def predict(self, block: Block) -> np.ndarray:
        return self.probabilities(block).argmax(axis=1)


@dataclass
class Pairs:
    """One-vs-one machines; ``sigmoid`` (pair, (a, b)) turns a pair's decision
    value d into P(first | pair) = 1 / (1 + exp(a d + b))."""
    w: np.ndarray
    pairs: list
    k: int
    sigmoid: np.ndarray | None = None

    def decisions(self, block: Block) -> np.ndarray:
        return block.times(self.w[:-1]) + self.w[-1]

    def predict(self, block: Block) -> np.ndarray:
        """The class with the most pairs won, the first of them on ties."""
        d, votes = self.decisions(block), np.zeros((block.n, self.k))
        for (i, j), v in zip(self.pairs, d.T):
            votes[:, i] += v > 0
            votes[:, j] += v <= 0
        return votes.argmax(axis=1)

    def decision(self, block: Block) -> np.ndarray:
        """Per class the pairs won, and within equal numbers the summed values."""
        votes, total = np.zeros((block.n, self.k)), np.zeros((block.n, self.k))
        for (i, j), v in zip(self.pairs, self.decisions(block).T):
            votes[:, i] += v > 0
            votes[:, j] += v <= 0
            total[:, i] += v
            total[:, j] -= v
        return votes + total / (3 * (np.abs(total) + 1))

    def probabilities(self, block: Block) -> np.ndarray:
        if self.sigmoid is None:
            raise ValueError("fit the machines with probabilities")
        r = np.full((block.n, self.k, self.k), 0.5)
        for (i, j), v, (a, b) in zip(self.pairs, self.decisions(block).T, self.sigmoid):
            p = np.clip(1.0 / (1.0 + np.exp(np.clip(a * v + b, -500, 500))), 1e-7, 1 - 1e-7)
            r[:, i, j], r[:, j, i] = p, 1 - p
        return couple(r)


def fit_softmax(blocks: DataFrame, size: int, k: int, folds, c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4) -> list[Softmax]:
    """A model for each entry of ``folds`` (the fold held out, None: none)."""
    weights, _ = minimise(blocks, [Problem(c, f) for f in folds], size, k, max_iter, tol)
    return [Softmax(w) for w in weights]


def fit_pairs(blocks: DataFrame, size: int, k: int, settings, max_iter: int = 200, tol: float = 1e-3) -> list[Pairs]:
    """Machines for each of ``settings``, a list of (C, fold held out)."""
    pairs = list(combinations(range(k), 2))
    if not pairs:
        return [Pairs(np.zeros((size + 1, 0)), [], k, np.zeros((0, 2))) for _ in settings]
    weights, _ = minimise(blocks, [Problem(c, f, p) for c, f in settings for p in pairs], size, k, max_iter, tol)
    each_ = [np.concatenate(weights[i:i + len(pairs)], axis=1) for i in range(0, len(weights), len(pairs))]
    return [Pairs(w, pairs, k) for w in each_]


def fit_sigmoids(blocks: DataFrame, models: dict[int, Pairs], rounds: int = 100, tol: float = 1e-8) -> np.ndarray:
    """Platt's sigmoid of every pair from decision values that the machines never
    trained on: ``models`` are keyed by the inner fold they held out.  Newton
    steps on two numbers a pair; a job sums each pair's gradient and Hessian."""
    first = next(iter(models.values()))
    pairs = first.pairs
    shared = blocks.sparkSession.sparkContext.broadcast(models)

    def held_out(block: Block):
        d, known = np.zeros((block.n, len(pairs))), np.zeros(block.n, bool)
        for f, m in shared.value.items():
            at = np.flatnonzero(block.fold == f)
            d[at], known[at] = m.decisions(block.take(at)), True
        return d, known

    def sums(ab, counts):
        """Per pair: loss, gradient (2), Hessian (3), and the rows of both classes."""
        def run(batches):
            total = np.zeros((len(pairs), 8))
            for _, b in each(batches):
                d, known = held_out(b)
                for i, (p, q) in enumerate(pairs):
                    at = known & ((b.label == p) | (b.label == q))
                    v, y = d[at, i], b.label[at] == p
                    total[i, 6:] += y.sum(), (~y).sum()
                    if counts is None:
                        continue
                    t = np.where(y, (counts[i, 0] + 1) / (counts[i, 0] + 2), 1 / (counts[i, 1] + 2))
                    z = ab[i, 0] * v + ab[i, 1]
                    s = 1 / (1 + np.exp(np.clip(z, -500, 500)))
                    g, h = t - s, s * (1 - s)
                    total[i, :6] += (t * z + np.logaddexp(0, -z)).sum(), (g * v).sum(), g.sum(), (h * v * v).sum(), (h * v).sum(), h.sum()
            yield pa.RecordBatch.from_pydict({"p": pa.array(range(len(pairs)), pa.int32()),
                                              **{f"s{c}": pa.array(total[:, c]) for c in range(8)}})
        names = ", ".join(f"s{c} double" for c in range(8))
        got = blocks.mapInArrow(run, f"p int, {names}").groupBy("p").sum(*(f"s{c}" for c in range(8))).collect()
        return np.array([list(r)[1:] for r in sorted(got, key=lambda r: r[0])]).reshape(len(pairs), 8)

    if not pairs:
        return np.zeros((0, 2))
    counts = sums(None, None)[:, 6:]
    ab = np.column_stack([np.zeros(len(pairs)), np.log((counts[:, 1] + 1) / (counts[:, 0] + 1))])
    step, at = np.zeros_like(ab), ab
    loss, now = np.full(len(pairs), np.inf), sums(ab, counts)
    for _ in range(rounds):
        worse = now[:, 0] > loss + 1e-12
        step = np.where(worse[:, None], step / 2, 0.0) if worse.any() else step * 0
        ok = ~worse
        at = np.where(ok[:, None], ab, at)
        loss = np.where(ok, now[:, 0], loss)
        g = now[:, 1:3]
        if (np.abs(g).max(axis=1)[ok] < tol * np.maximum(1, counts.sum(axis=1))[ok]).all() and ok.all():
            break
        det = (now[:, 3] + 1e-10) * (now[:, 5] + 1e-10) - now[:, 4] ** 2
        newton = np.column_stack([(now[:, 5] + 1e-10) * g[:, 0] - now[:, 4] * g[:, 1], (now[:, 3] + 1e-10) * g[:, 1] - now[:, 4] * g[:, 0]]) / det[:, None]
        step = np.where(ok[:, None], -newton, step)
        ab = at + step
        now = sums(ab, counts)
    return at

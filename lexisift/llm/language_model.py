"""Language-model scoring with a gated recurrent network.

Tokens are lower-cased words and one end per text.  The most frequent words (half
the square root of the corpus's tokens, within ``VOCAB`` and ``MAX_VOCAB``, so a
copy of the network stays below 5 MB) have an embedding and a place in the
output; every other token is one of ``SHAPES`` shapes (its last character, length and script).  The output softmax is factored:
a softmax over classes (frequency bins of words, and the shapes), then a
softmax over the words of the class, or for a shape the smoothed corpus counts
of its tokens.  The score of a text is therefore a proper log-probability of
all of its tokens, and the network's state is carried through the whole text.

* Counts of every token come from all training texts: tasks pre-aggregate, one
  shuffle sums.  They give the base score, the output biases (so an untrained
  network already is the corpus's word distribution) and the shapes' tables.
* The network is trained by truncated backpropagation in numpy, in parallel: in
  each of ``ROUNDS`` rounds every task trains a copy on its texts of one hash
  slice, and a tree of tasks averages the copies by their tokens.  The slices
  together are all training texts.
* Scoring is a map over whole texts.  Tokens that make up at least ``HEAD`` of
  the corpus (so at most 1 / HEAD of them, up to ``HEAD_BYTES`` bytes each) are
  broadcast with their counts; all others are joined with the count table, and
  none of them is frequent enough to be a hot key there.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, starts_of, tokens_of, written

VOCAB, MAX_VOCAB, HIDDEN = 2000, 16_384, 16
SHAPES = 24
ROUNDS = 2
HEAD, HEAD_BYTES = 1e-6, 64
LANES, STEPS, WINDOWS, RATE = 512, 16, 64, 0.1
END = "\n"                    # no word holds white space
HELD_OUT = (10, 0)
ADD = 0.1
CHUNK = 1 << 16               # outputs computed at once
BATCH, BATCH_BYTES = 8192, 8 << 20   # texts handled at once, and their bytes


# ------------------------------------------------------------------ tokens --
@lru_cache(1)
def _endings() -> np.ndarray:
    """Kind of a token by its last byte: 0 letter, digit or non-ASCII, 1 comma and the like, 2 sentence end, 3 other."""
    kind = np.full(256, 3, np.int64)
    kind[128:] = 0
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        kind[c] = 0
    for c in b",;:":
        kind[c] = 1
    for c in b".!?":
        kind[c] = 2
    return kind


def slices(batches, text: int = 0):
    """The batches in parts of at most ``BATCH`` rows whose column ``text``
    holds ``BATCH_BYTES`` bytes (or one longer text)."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, lo = starts_of(size), 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(ends, ends[lo] + BATCH_BYTES, side="right")) - 1
            hi = min(max(hi, lo + 1), lo + BATCH, b.num_rows)
            yield b.slice(lo, hi - lo)
            lo = hi


def shapes_of(tokens: pa.Array) -> np.ndarray:
    """Shape number of every (non-empty) token."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    size = pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(tokens).to_numpy(zero_copy_only=False)
    _, offsets, data = tokens.buffers()
    ends = np.frombuffer(offsets, np.int32)[tokens.offset + 1:tokens.offset + len(tokens) + 1]
    last = _endings()[np.frombuffer(data, np.uint8)[np.maximum(ends - 1, 0)]]
    return last * 6 + np.digitize(chars, [6, 10]) * 2 + (size != chars)


def count_tokens(docs: DataFrame, id_col: str, text_col: str, held_out) -> DataFrame:
    """``token, c`` over all texts outside the held-out fold, ends included."""
    m, r = held_out
    src = docs.filter(fold(id_col, m) != r).select(F.col(text_col).alias("text"))

    def count(batches):
        held, size, ends = [], 0, 0

        def merged():
            return pa.concat_tables(held).group_by("token").aggregate([("c", "sum")]).rename_columns(["token", "c"])

        for b in slices(batches):
            flat, lengths = tokens_of(b.column(0))
            ends += len(lengths)
            vc = flat.value_counts()
            held.append(pa.table({"token": vc.field(0), "c": vc.field(1)}))
            size += len(vc)
            if size > 1 << 19:
                t = merged()
                if t.num_rows > 1 << 18:
                    yield from t.to_batches()
                    held, size = [], 0
                else:
                    held, size = [t], t.num_rows
        if held:
            yield from merged().to_batches()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], names=["token", "c"])

    return src.mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Lexicon:
    """What scoring needs of the counts: the head, the vocabulary and its
    classes, and the shapes' normalisers."""

    def __init__(self, tokens: list[str], counts: np.ndarray, total: int, types: int, shape_n: np.ndarray, shape_v: np.ndarray):
        order = sorted(range(len(tokens)), key=lambda i: (-counts[i], tokens[i]))
        order = [i for i in order if tokens[i] != END]
        self.total, self.types = total, types
        self.tokens, self.counts = pa.array([tokens[i] for i in order], pa.string()), np.asarray(counts, np.int64)[order]
        ends = int(sum(counts[i] for i in range(len(tokens)) if tokens[i] == END))
        self.end_count, v = ends, min(max(VOCAB, min(MAX_VOCAB, int(total ** 0.5 / 2))), len(order))
        n_cls = self.word_classes = max(1, round(0.7 * v ** 0.5))
        self.n_words = v + 1                                      # vocabulary, then the end
        freq = np.concatenate([self.counts[:v], [ends]]).astype(float) + ADD
        share = np.cumsum(freq) - freq / 2
        self.word_class = np.minimum((share / freq.sum() * n_cls).astype(np.int64), n_cls - 1)
        own = shapes_of(self.tokens.slice(0, v))
        self.shape_n = shape_n - np.bincount(own, weights=self.counts[:v], minlength=SHAPES)
        self.shape_v = shape_v - np.bincount(own, minlength=SHAPES)
        self.classes = n_cls + SHAPES
        mass = np.concatenate([np.bincount(self.word_class, weights=freq, minlength=n_cls), self.shape_n + ADD])
        self.class_bias = np.log(np.maximum(mass, 1e-6) / mass.sum())
        self.word_bias = np.log(freq)
        # words of a class are contiguous but for the end, which stands last: sort once
        self.members = [np.flatnonzero(self.word_class == k) for k in range(n_cls)]
        self.base_norm = np.log10(total + ADD * (types + 1))
        self.shape_norm = np.log10(self.shape_n + ADD * (self.shape_v + 1))

    def look_up(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place in the head or -1, input number: word or n_words + shape)."""
        at = pc.fill_null(pc.index_in(flat, value_set=self.tokens), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = at.copy()
        rest = np.flatnonzero((at < 0) | (at >= self.n_words - 1))
        ids[rest] = self.n_words + shapes_of(flat.take(pa.array(rest)))
        return at, ids

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.n_words, self.word_class[np.minimum(ids, self.n_words - 1)],
                        ids - self.n_words + self.word_classes)


def lexicon(counts: DataFrame) -> Lexicon:
    total, types = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0

    def tally(batches):
        n, v = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for b in batches:
            s = shapes_of(b.column(0))
            n += np.bincount(s, weights=b.column(1).to_numpy(), minlength=SHAPES).astype(np.int64)
            v += np.bincount(s, minlength=SHAPES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES)), pa.array(n), pa.array(v)], names=["s", "n", "v"])

    n, v = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in (counts.filter(F.col("token") != END).mapInArrow(tally, "s long, n long, v long")
              .groupBy("s").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()):
        n[r.s], v[r.s] = r.n, r.v
    # bounded: at most 1 / HEAD tokens reach that share of the total
    head = counts.filter(in_head(total)).toArrow()
    return Lexicon(head["token"].to_pylist(), head["c"].to_numpy(), total, types, n, v)


def in_head(total: int):
    return (F.col("c") >= total * HEAD) & (F.octet_length("token") <= HEAD_BYTES) | (F.col("token") == END)


# ----------------------------------------------------------------- network --
class Network:
    """Gated recurrent cell and factored output; parameters are one flat vector."""

    def __init__(self, lex: Lexicon, seed: int = 0):
        rng, h = np.random.default_rng(seed), HIDDEN
        n_in = lex.n_words + SHAPES
        self.shapes = {"X": (n_in, 3 * h), "U": (h, 3 * h), "C": (h, lex.classes), "c": (lex.classes,),
                       "O": (lex.n_words, h), "o": (lex.n_words,)}
        self.p = {"X": rng.normal(0, 0.3, self.shapes["X"]), "U": rng.normal(0, h ** -0.5, self.shapes["U"]),
                  "C": np.zeros(self.shapes["C"]), "c": lex.class_bias.copy(),
                  "O": np.zeros(self.shapes["O"]), "o": lex.word_bias.copy()}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.shapes])

    def load(self, vec: np.ndarray) -> Network:
        at = 0
        for k, s in self.shapes.items():
            size = int(np.prod(s))
            self.p[k] = vec[at:at + size].reshape(s).astype(np.float32)
            at += size
        return self

    def step(self, h, x):
        """New state, and what the way back needs."""
        k = HIDDEN
        a = h @ self.p["U"]
        rz = x[:, :2 * k] + a[:, :2 * k]
        rz *= 0.5
        np.tanh(rz, out=rz)
        rz += 1
        rz *= 0.5
        n = rz[:, :k] * a[:, 2 * k:]
        n += x[:, 2 * k:]
        np.tanh(n, out=n)
        return n + rz[:, k:] * (h - n), rz, n, a[:, 2 * k:]


def log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log softmax(z)[at[i], i] by columns; ``z`` is overwritten by the exponentials."""
    z -= z.max(axis=0)
    own = z[at, np.arange(z.shape[1])]
    np.exp(z, out=z)
    return own - np.log(z.sum(axis=0))


def by_number(ids: np.ndarray, most: int) -> np.ndarray:
    """Stable order of numbers below ``most`` (two bytes are sorted by radix)."""
    return np.argsort(ids.astype(np.uint16) if most <= 1 << 16 else ids, kind="stable")


def output_scores(net: Network, lex: Lexicon, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log of class probability, times word probability for words."""
    cls = lex.class_of(ids)
    out = log_softmax_at(net.p["C"].T @ h.T + net.p["c"][:, None], cls).astype(np.float64)
    order = by_number(cls, lex.classes)
    bound = np.searchsorted(cls[order], np.arange(lex.word_classes + 1))
    for k in range(lex.word_classes):
        rows, words = order[bound[k]:bound[k + 1]], lex.members[k]
        if len(rows) and len(words) > 1:
            out[rows] += log_softmax_at(net.p["O"][words] @ h[rows].T + net.p["o"][words][:, None], np.searchsorted(words, ids[rows]))
    return out


def network_scores(net: Network, lex: Lexicon, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-probabilities (natural; shapes without their token's share) of the
    tokens of every text, ends included in ``ids``; the state starts at zero."""
    starts, out = starts_of(lengths), np.zeros(len(ids))
    order = np.argsort(-lengths, kind="stable")
    size, begin = lengths[order], starts[:-1][order]
    h, held, places, count = np.zeros((len(order), HIDDEN), np.float32), [], [], 0
    table, end = net.p["X"], lex.n_words - 1
    active = len(order)
    last = np.full(active, end)
    for t in range(int(size[0]) if len(size) else 0):
        while size[active - 1] <= t:
            active -= 1
        if active < len(h):
            h, last = h[:active], last[:active]
        h = net.step(h, table[last])[0]
        place = begin[:active] + t
        held.append(h)
        places.append(place)
        last = ids[place]
        count += active
        if count >= CHUNK:
            at = np.concatenate(places)
            out[at] = output_scores(net, lex, np.concatenate(held), ids[at])
            held, places, count = [], [], 0
    if held:
        at = np.concatenate(places)
        out[at] = output_scores(net, lex, np.concatenate(held), ids[at])
    return out


class Trainer:
    """Truncated backpropagation over windows of ``STEPS`` tokens, Adagrad, in
    ``LANES`` lanes (fewer for a stream of fewer than ``WINDOWS`` such windows)."""

    def __init__(self, net: Network, lex: Lexicon):
        self.net, self.lex = net, lex
        self.seen = {k: np.full(s, 1e-2, np.float32) for k, s in net.shapes.items()}

    def run(self, ids: np.ndarray) -> None:
        """One pass over a stream of texts, each closed by its end."""
        n = int(np.clip(len(ids) // (STEPS * WINDOWS), 32, LANES))
        width = -(-len(ids) // n)
        lanes = np.concatenate([ids, np.full(n * width - len(ids), -1)]).reshape(n, width)
        end = self.lex.n_words - 1
        before = np.concatenate([np.full((n, 1), end), lanes[:, :-1]], axis=1)
        h = np.zeros((n, HIDDEN), np.float32)
        for lo in range(0, width, STEPS):
            h = self.window(h, np.maximum(before[:, lo:lo + STEPS], 0), lanes[:, lo:lo + STEPS], end)

    def window(self, h, x, y, end):
        p, k, steps = self.net.p, HIDDEN, x.shape[1]
        trace, hs = [], []
        for t in range(steps):
            new = (x[:, t] == end)[:, None]
            h = np.where(new, np.float32(0), h)
            nxt, rz, n, an = self.net.step(h, p["X"][x[:, t]])
            trace.append((h, rz, n, an, new))
            hs.append(nxt)
            h = nxt
        hid, want = np.concatenate(hs), y.T.ravel()
        ok = want >= 0
        g, dh = self.output_grad(hid[ok], want[ok])
        dhid = np.zeros_like(hid)
        dhid[ok] = dh
        dhid = dhid.reshape(steps, -1, k)
        gx, back = np.zeros((steps, len(h), 3 * k), np.float32), np.zeros_like(h)
        gu = np.zeros_like(p["U"])
        for t in range(steps - 1, -1, -1):
            prev, rz, n, an, new = trace[t]
            r, z = rz[:, :k], rz[:, k:]
            d = dhid[t] + back
            dn = d * (1 - z) * (1 - n * n)
            da = np.concatenate([dn * an * r * (1 - r), d * (prev - n) * z * (1 - z), dn], axis=1)
            gx[t] = da
            da = da.copy()
            da[:, 2 * k:] *= r
            gu += prev.T @ da
            back = np.where(new, np.float32(0), d * z + da @ p["U"].T)
        g["U"] = gu
        self.update(g, len(hid))
        self.sparse("X", x.T.ravel(), gx.reshape(-1, 3 * k), len(hid))
        return h

    def output_grad(self, h, ids):
        p, lex = self.net.p, self.lex
        cls = lex.class_of(ids)

        def error(z, at):
            """softmax(z) by columns, less one where the outcome is"""
            z -= z.max(axis=0)
            np.exp(z, out=z)
            z /= z.sum(axis=0)
            z[at, np.arange(len(at))] -= 1
            return z

        z = error(p["C"].T @ h.T + p["c"][:, None], cls)
        g, dh = {"C": (z @ h).T, "c": z.sum(axis=1), "O": np.zeros_like(p["O"]), "o": np.zeros_like(p["o"])}, z.T @ p["C"].T
        order = by_number(cls, lex.classes)
        bound = np.searchsorted(cls[order], np.arange(lex.word_classes + 1))
        for k in np.flatnonzero(np.diff(bound)):
            mine, words = order[bound[k]:bound[k + 1]], lex.members[k]
            hid, out = h[mine], p["O"][words]
            q = error(out @ hid.T + p["o"][words][:, None], np.searchsorted(words, ids[mine]))
            g["O"][words] = q @ hid
            g["o"][words] = q.sum(axis=1)
            dh[mine] += q.T @ out
        return g, dh

    def update(self, grads, n):
        for k, g in grads.items():
            g = g / np.float32(np.sqrt(n))
            self.seen[k] += g * g
            self.net.p[k] -= np.float32(RATE) * g / np.sqrt(self.seen[k])

    def sparse(self, k, at, g, n):
        order = by_number(at, self.net.shapes[k][0])
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        rows = at[first]
        total = np.add.reduceat(g[order], first, axis=0) / np.float32(np.sqrt(n))
        self.seen[k][rows] += total * total
        self.net.p[k][rows] -= np.float32(RATE) * total / np.sqrt(self.seen[k][rows])


def with_ends(ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """``ids`` with the end after each text's tokens."""
    out = np.full(len(ids) + len(lengths), end, np.int64)
    at = np.ones(len(out), bool)
    at[starts_of(lengths + 1)[1:] - 1] = False
    out[at] = ids
    return out


def train(docs: DataFrame, lex: Lexicon, id_col: str, text_col: str, held_out) -> Network:
    sc = docs.sparkSession.sparkContext
    shared, net = sc.broadcast(lex), Network(lex)
    m, r = held_out
    for turn in range(ROUNDS):
        state = sc.broadcast(net.flat())
        mine = docs.filter((fold(id_col, m) != r) & (F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(ROUNDS)) == turn))

        def work(batches, state=state):
            words = shared.value
            own = Network(words).load(state.value)
            trainer, held, size, seen = Trainer(own, words), [], 0, 0

            def go():
                nonlocal held, size, seen
                trainer.run(np.concatenate(held))
                held, size, seen = [], 0, seen + size

            for b in slices(batches):
                flat, lengths = tokens_of(b.column(0))
                held.append(with_ends(words.look_up(flat)[1], lengths, words.n_words - 1))
                size += len(held[-1])
                if size >= 1 << 20:
                    go()
            if size:
                go()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([own.flat().tobytes()], pa.binary())],
                                                 names=["n", "p"])

        copies = mine.select(F.col(text_col).alias("text")).mapInArrow(work, "n double, p binary").rdd
        zero = (0.0, np.zeros(len(net.flat())))
        n, total = copies.map(lambda row: (row.n, row.n * np.frombuffer(row.p, np.float32).astype(np.float64))).treeAggregate(
            zero, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]), depth=3)
        if n:
            net.load(total / n)
    return net


def score(docs: DataFrame, id_col="doc_id", text_col="text", held_out=HELD_OUT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    A null text is the empty text, which is just its end.  Repeated rows count
    and are scored one by one, null ids are held out with the fold of the empty
    text, ties of the vocabulary go by token, other columns are not read.  With
    no training text every token has count 0."""
    counts = written(count_tokens(docs, id_col, text_col, held_out), "counts")
    lex = lexicon(counts)
    net = train(docs, lex, id_col, text_col, held_out)
    sc = docs.sparkSession.sparkContext
    shared, state = sc.broadcast(lex), sc.broadcast(net.flat())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words = shared.value
        own = Network(words).load(state.value)
        for part in slices(batches, 3):
            cols = score_texts(own, words, part.column(3))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), *cols],
                                             names=["row", "doc_id", "held_out", "n", "known", "base", "score", "rare"])

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                      (fold(id_col, held_out[0]) == held_out[1]).alias("held_out"), F.col(text_col).alias("text"))
    rows = written(src.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n long, known long, base double, score double, "
                                       "rare array<struct<t: string, k: long>>"), "scored")
    rest = counts.filter(~in_head(lex.total)).select(F.col("token").alias("t"), "c")
    rare = (rows.select("row", F.explode("rare").alias("x")).select("row", "x.t", "x.k").join(rest, "t", "left")
            .groupBy("row").agg(F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("more"),
                                F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("seen")))
    more, seen = F.coalesce("more", F.lit(0.0)), F.coalesce("seen", F.lit(0))
    return rows.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + seen).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n") * F.lit(float(lex.base_norm))).alias("base_score"), (F.col("score") + more).alias("score"))


def score_texts(net: Network, lex: Lexicon, texts: pa.Array):
    """Arrow columns n, known, base, score, rare of each text, the last holding
    the tokens outside the head, whose counts are still to be added."""
    flat, lengths = tokens_of(texts)
    n_docs, end = len(lengths), lex.n_words - 1
    at, ids = lex.look_up(flat)
    doc = np.repeat(np.arange(n_docs), lengths)
    out = network_scores(net, lex, with_ends(ids, lengths, end), lengths + 1)
    total = np.bincount(np.repeat(np.arange(n_docs), lengths + 1), weights=out / np.log(10), minlength=n_docs)
    head = at >= 0
    logs = np.log10(lex.counts + ADD)
    own = np.where(head, logs[at] if len(logs) else 0.0, 0.0)
    base = np.bincount(doc, weights=own, minlength=n_docs) + np.log10(lex.end_count + ADD)
    shape = ids >= lex.n_words
    total += np.bincount(doc[shape], weights=own[shape] - lex.shape_norm[ids[shape] - lex.n_words], minlength=n_docs)
    known = np.bincount(doc[head], minlength=n_docs) + (lex.end_count > 0)
    left = pa.array(np.flatnonzero(~head))
    t = pa.table({"d": pa.array(doc[~head]), "t": flat.take(left)}).group_by(["d", "t"], use_threads=False).aggregate([([], "count_all")])
    t = t.sort_by("d")
    offsets = pa.array(np.searchsorted(t["d"].to_numpy(), np.arange(n_docs + 1)).astype(np.int32))
    pairs = pa.StructArray.from_arrays([t["t"].combine_chunks(), t["count_all"].combine_chunks()], names=["t", "k"])
    return [pa.array(lengths + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(total),
            pa.ListArray.from_arrays(offsets, pairs)]

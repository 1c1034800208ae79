"""Quality by hierarchical empirical Bayes.

A document classifier (logistic regression on binned shape features, fitted on
a bounded sample of labelled rows) gives each document's log likelihood ratio of
good against bad.  What is known of its site is added as a prior: the mean
posterior of the documents of its host, shrunk toward the global rate, and of
its path within the host, shrunk toward the host's rate.  The strengths of both
shrinkages are estimated from the data (analysis of variance over the groups),
so a site with few documents says little and a large one much; a document's own
evidence is left out of its site's mean.

Site sums are grouped aggregates, combined before the shuffle, so a hot host
costs one row a task.  The documents themselves are only mapped; site rates are
joined as a broadcast up to ``BROADCAST_SITES`` sites, by a plain join beyond.
"""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, WORD_BYTES, fold, fresh, hash_sample, map_texts, release, written

SAMPLE = {1: 6000, 0: 6000}
BINS = 12
THRESHOLD = 0.5
HELD_OUT = (5, 0)
BROADCAST_SITES = 100_000
#: Ratios of posterior odds are kept inside these bounds, so that one document's evidence never is certain.
MAX_EVIDENCE = 12.0

_KIND = np.full(256, 3, np.int64)                        # 0 lower, 1 upper, 2 white space, 3 other ASCII, 4 digit, 5 rest, 6 . , ; : ' -
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 4, 5
_KIND[[32, *range(9, 14)]] = 2
_KIND[[ord(c) for c in ".,;:'-"]] = 6
FEATURES = ("symbols", "upper", "digits", "stops", "word_length", "distinct", "repeats", "bare", "top", "length", "lines", "glued")


def features(text: str | None) -> list[float]:
    """Shape of a whole text; an empty one is all zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.translate(LOWER).split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7)
    seen = len(raw) - kinds[2]
    alnum = raw.translate(WORD_BYTES).split()
    sizes: dict = {}
    for w in words:
        sizes[w] = sizes.get(w, 0) + 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [kinds[3] / seen, kinds[1] / max(1, kinds[0] + kinds[1]), kinds[4] / seen, kinds[6] / n, seen / n,
            len(sizes) / n ** 0.7, sum(map(operator.eq, words, words[1:])) / n, max(0, n - len(alnum)) / n,
            max(sizes.values()) / n ** 0.7, np.log1p(n), 1 - len(set(lines)) / len(lines), max(0, len(alnum) - n) / n]


class Model:
    """Logistic weights over quantile bins of the features."""

    def __init__(self, edges: np.ndarray, w: np.ndarray, prior: float):
        self.edges, self.w, self.prior = edges, w, prior

    def design(self, x: np.ndarray) -> np.ndarray:
        cols = [np.ones((len(x), 1))]
        for j in range(len(FEATURES)):
            at = np.searchsorted(self.edges[j], x[:, j], side="left")
            cols.append(np.eye(BINS + 1)[at])
        return np.concatenate(cols, axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good against bad."""
        if not len(x):
            return np.zeros(0)
        return np.clip(self.design(x) @ self.w, -MAX_EVIDENCE, MAX_EVIDENCE)

    def of_texts(self, texts) -> np.ndarray:
        return self.evidence(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES)))


def fit(x: np.ndarray, y: np.ndarray, prior: float, rounds: int = 25, ridge: float = 1.0) -> Model:
    """Newton steps on the log-loss with both classes weighted alike, so the
    margin is a likelihood ratio.  One class only: no evidence."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:], axis=0).T if len(x) else np.zeros((len(FEATURES), BINS))
    edges = np.concatenate([edges[:, :-1], np.full((len(FEATURES), 1), np.inf)], axis=1) if len(x) else edges
    model = Model(edges, np.zeros(1 + len(FEATURES) * (BINS + 1)), prior)
    if len(x) and 0 < y.sum() < len(y):
        d = model.design(x)
        c = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(d @ model.w, -30, 30)))
            grad = d.T @ (c * (p - y)) + ridge * model.w
            hess = (d * (c * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ d + ridge * np.eye(d.shape[1])
            move = np.linalg.solve(hess, grad)
            model.w = model.w - move
            if np.abs(move).max() < 1e-8:
                break
    return model


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
          held_out=HELD_OUT, sample=None) -> Model:
    """Learned from labelled rows outside the held-out fold; rows with a null
    id or label teach nothing, an id with several labels takes the smallest."""
    sample = sample or SAMPLE
    m, r = held_out
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, m) != r))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(label_col).cast("int")).alias("y")).filter("y in (0, 1)"))
    total = {x.y: x.n for x in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = (total.get(1, 0) + 1) / (sum(total.values()) + 2)
    # bounded: at most sample[0] + sample[1] ids
    picked = [(x.id, x.y) for y, n in sample.items()
              for x in hash_sample(known.filter(F.col("y") == y), ["id"], n, total.get(y, 0)).collect()]
    if not picked:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), prior)
    ids = docs.sparkSession.createDataFrame(picked, f"id {labels.schema[id_col].dataType.simpleString()}, y int")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min("text").alias("text")))
    got = map_texts(texts, lambda t: [[features(x) for x in t.to_pylist()]], "x array<double>").orderBy("id").toPandas()
    return fit(np.array(got["x"].tolist()).reshape(-1, len(FEATURES)), got["y"].to_numpy().astype(float), prior)


def strength(groups: DataFrame, parent_mean) -> float:
    """Pseudo-count m of a group's prior, weight n / (n + m): within variance
    over between variance of the groups (n, s, q: count, sum, sum of squares),
    ``parent_mean`` being the mean they vary around."""
    m = F.col("s") / F.col("n")
    r = groups.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
                   F.sum(F.col("n") * (m - parent_mean) ** 2).alias("b"),
                   F.sum(F.col("q") - F.col("n") * m * m).alias("w")).first()
    if not r.n or r.k < 2 or r.n <= r.k:
        return 1e6
    within, between = max(r.w, 0.0) / (r.n - r.k), r.b / (r.k - 1)
    size = (r.n - r.nn / r.n) / (r.k - 1)
    return float(np.clip(within / max((between - within) / max(size, 1e-9), 1e-9), 1.0, 1e6))


def sites(rows: DataFrame, prior: float) -> tuple[DataFrame, float, float, float]:
    """Path table (host, path, n, s, host_n, host_s) of rows (host, path, p),
    the global mean and both strengths."""
    paths = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"),
                                                     F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = written(paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in "nsq")), "hosts")
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = (s + prior) / (n + 1) if n else prior
    mh = strength(hosts, F.lit(mean))
    up = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    table = written(paths.join(up, paths.host.eqNullSafe(up.host)).select(paths.host, "path", "n", "s", "q", "host_n", "host_s"),
                    "sites")
    mp = strength(table, F.col("host_s") / F.col("host_n"))
    release(paths)
    release(hosts)
    return table.drop("q"), mean, mh, mp


def logit(c):
    c = F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(c / (1 - c))


def posterior(df: DataFrame, evidence: str, table: DataFrame, mean: float, mh: float, mp: float, prior: float,
              host, path, out: str) -> DataFrame:
    """``df`` with column ``out``: the posterior from its evidence and the site
    rates without its own part."""
    n_sites = table.count()
    h, p, *stats = (fresh(df, x + "_site") for x in ("h", "p", "n", "s", "hn", "hs"))
    side = table.toDF(h, p, *stats)
    side = F.broadcast(side) if n_sites <= BROADCAST_SITES else side
    joined = df.join(side, host.eqNullSafe(F.col(h)) & path.eqNullSafe(F.col(p)))
    n, s, hn, hs = map(F.col, stats)
    own = 1 / (1 + F.exp(-(F.col(evidence) + logit(F.lit(prior)))))
    up = (hs - own + mh * mean) / (hn - 1 + mh)
    rate = (s - own + mp * up) / (n - 1 + mp)
    return joined.withColumn(out, 1 / (1 + F.exp(-(F.col(evidence) + logit(rate))))).drop(h, p, *stats)


def classify(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", host_col="source", path_col="lang",
             held_out=HELD_OUT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, evidence, score,
    predicted`` (1: good).

    Null and empty texts are one shape of their own; a null host or path is a
    site of its own; without labels the evidence is 0 and the score the site's
    prior.  Repeated rows give a row each, other columns are not read."""
    model = train(docs, labels, id_col, text_col, held_out=held_out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      (fold(id_col, held_out[0]) == held_out[1]).alias("held_out"),
                      F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    rows = written(map_texts(src, lambda t: [pa.array(shared.value.of_texts(t.to_pylist()))], "evidence double"), "evidence")
    p = 1 / (1 + F.exp(-(F.col("evidence") + logit(F.lit(model.prior)))))
    table, mean, mh, mp = sites(rows.withColumn("p", p), model.prior)
    out = posterior(rows, "evidence", table, mean, mh, mp, model.prior, F.col("host"), F.col("path"), "score")
    return out.select("doc_id", "held_out", "evidence", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_bad(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", host_col="source",
             path_col="lang") -> DataFrame:
    """The rows of ``docs`` whose posterior reaches the threshold, all columns
    kept.  The texts are mapped twice (site sums, then the decision) and never
    shuffled or copied."""
    model = train(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.of_texts(texts), dtype=float)

    weigh = evidence.asNondeterministic()
    host, path = F.col(host_col).cast("string"), F.col(path_col).cast("string")
    e, out = fresh(docs, "evidence_"), fresh(docs, "score_")
    rows = docs.select(host.alias("host"), path.alias("path"), weigh(text_col).alias("e"))
    table, mean, mh, mp = sites(rows.select("host", "path", (1 / (1 + F.exp(-(F.col("e") + logit(F.lit(model.prior)))))).alias("p")),
                                model.prior)
    scored = posterior(docs.withColumn(e, weigh(text_col)), e, table, mean, mh, mp, model.prior, host, path, out)
    return scored.filter(F.col(out) >= THRESHOLD).select(*docs.columns)

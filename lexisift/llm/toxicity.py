"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its distinct lower-cased words and their prefixes
(endings vary, stems carry the insult), hashed into ``BUCKETS``.  A word is a run
of letters, marks and digits of any script.  A run without spaces of its own
(Chinese, Japanese, Thai and the like) or longer than ``LONG`` characters gives
its character n-grams at every position.  The score is the logistic function of

    w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2)

over the terms present, so pairs of terms add what neither weighs alone.  The
model is fitted by numpy on a bounded sample of the labelled rows (``SAMPLE``
per class, by hash of the id; the classes' shares in the whole label table
weigh the sample back), on every term of at least ``LEAST`` sampled texts: a
term that says nothing alone may matter in a pair.  Scoring is a map over whole
texts with the model as a broadcast, whose size follows the sample's
vocabulary; nothing is shuffled but the labels.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, fold, fresh, hash_sample, map_texts, release, starts_of, sum_by_document, written

BUCKETS = 1 << 24
SAMPLE = {1: 4000, 0: 8000}
LEAST = 3
LONG = 24
FACTORS = 4
THRESHOLD = 0.3
HELD_OUT = (4, 2)
PART = 1 << 18                # characters scored at once


#: Scripts that put no spaces between words: Thai to Tibetan, Myanmar, Khmer, kana and Han.
UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
                      "\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, k: int) -> np.ndarray:
    """Bucket of a hash of ``k`` characters (0: of a whole word)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31)) ^ np.uint64(k)) * FACTOR
        return ((h ^ (h >> np.uint64(29))) * FACTOR >> np.uint64(64 - 24)).astype(np.int32)


def _grams(word: str, least: int) -> np.ndarray:
    """Buckets of a run: itself and its n-grams of up to 7 from every position."""
    code = np.frombuffer(word.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(code) - 1, FACTOR))])
        out, h = [_bucket((code[::-1] * powers).sum(keepdims=True), 0)], np.zeros(len(code), np.uint64)
        for k in range(1, min(7, len(code)) + 1):
            h = h[:len(code) - k + 1] * FACTOR + code[k - 1:]
            if k >= least:
                out.append(_bucket(h, k))
    return np.concatenate(out)


def terms_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): the terms of every word, all words at once.  A word's
    are itself and its prefixes of 3 to 7 characters; those of a long or
    unspaced run are its n-grams."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    code = np.array(words, f"U{LONG}").view(np.uint32).reshape(len(words), LONG)
    size = (code > 0).sum(axis=1)
    h, parts, own = np.zeros(len(words), np.uint64), [], []
    apart = {i for i, w in enumerate(words) if len(w) > LONG}
    apart |= {int(i) for i in np.flatnonzero((code >= 0xE00).any(axis=1)) if UNSPACED.search(words[i])}
    plain = np.ones(len(words), bool)
    plain[list(apart)] = False
    with np.errstate(over="ignore"):
        for k in range(1, int(size.max()) + 1):
            live = size >= k
            h = np.where(live, h * FACTOR + (code[:, k - 1] + np.uint64(1)), h)
            if 3 <= k <= 7:
                at = np.flatnonzero(live & plain)
                parts.append(_bucket(h[at], k))
                own.append(at)
    at = np.flatnonzero(plain)
    parts.append(_bucket(h[at], 0))
    own.append(at)
    for i in sorted(apart):
        parts.append(_grams(words[i], 1 if UNSPACED.search(words[i]) else 3))
        own.append(np.full(len(parts[-1]), i))
    flat, own = np.concatenate(parts), np.concatenate(own)
    order = np.argsort(own, kind="stable")
    return flat[order], starts_of(np.bincount(own, minlength=len(words)))


SIMPLE = re.compile(r"[^\W_]+")


@lru_cache(1)
def _marks() -> frozenset[str]:
    """The marks, which ``\\w`` leaves out."""
    return frozenset(c for c in map(chr, range(0x300, sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M")


def words_of(text: str | None) -> set[str]:
    if text is None:
        return set()
    low = text.lower()
    if low.isascii():
        return set(low.encode().translate(WORD_BYTES).decode().split())
    used, marks = set(low), _marks()
    if marks.isdisjoint(used):
        return set(SIMPLE.findall(low))
    return set(low.translate({ord(c): " " for c in used if not c.isalnum() and c not in marks}).split())


def text_terms(texts: list[str | None], keep=lambda flat, starts: (flat, starts)) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): the distinct terms of every text; a word that several
    of them hold is hashed once, and ``keep`` may choose or renumber its terms."""
    sets = [words_of(t) for t in texts]
    words = pa.array([w for s in sets for w in s], pa.string()).dictionary_encode()
    flat, starts = keep(*terms_of(words.dictionary.to_pylist()))
    code = words.indices.to_numpy()
    size = np.diff(starts)[code]
    doc = np.repeat(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), size)
    at = np.arange(len(doc)) - np.repeat(starts_of(size)[:-1], size) + np.repeat(starts[:-1][code], size)
    key = np.unique(doc * BUCKETS + flat[at])
    return (key % BUCKETS).astype(np.int32), starts_of(np.bincount(key // BUCKETS, minlength=len(sets)))


def in_parts(texts):
    """Lists of texts of about ``PART`` characters, so that a few long texts are
    not joined by many others."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= PART or len(held) >= 1024:
            yield held
            held, size = [], 0
    if held:
        yield held


class Model:
    """Weights of the terms that were kept."""

    def __init__(self, buckets: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.buckets, self.bias, self.w, self.v = buckets, bias, w, v

    def known(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same texts' terms as places in ``buckets``, unknown ones left out."""
        if not len(self.buckets) or not len(flat):
            return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        at = np.minimum(np.searchsorted(self.buckets, flat), len(self.buckets) - 1)
        ok = self.buckets[at] == flat
        return at[ok], starts_of(ok)[starts]

    def margins(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        pair = sum_by_document(self.v[flat], starts) ** 2 - sum_by_document(self.v[flat] ** 2, starts)
        return self.bias + sum_by_document(self.w[flat], starts) + 0.5 * pair.sum(axis=1)

    def scores(self, texts) -> np.ndarray:
        return logistic(np.concatenate([np.zeros(0), *(self.margins(*text_terms(part, self.known)) for part in in_parts(texts))]))


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit(buckets: np.ndarray, flat: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float, seed: int = 0,
        epochs: int = 40, batch: int = 256, step: float = 0.002, rise: float = 0.1, noise: float = 2.0, patience: int = 10) -> Model:
    """Weighted log-loss; ``flat[starts[i]:starts[i + 1]]`` are the terms of text i, as
    places in ``buckets``.

    The linear weights are those of standardised terms, with momentum and an L1
    penalty of ``noise`` standard deviations of a pure-chance gradient: there are
    far more terms than texts, and most say nothing alone.  The factors learn by
    Adam with rates of one scale, so rare terms do not run ahead.  The number of
    epochs is the best one for every fifth text; then all texts are used."""
    k, n = len(buckets), len(starts) - 1

    def parts(pick):
        idx = np.concatenate([flat[:0], *(flat[starts[i]:starts[i + 1]] for i in pick)])
        return idx, starts_of(np.diff(starts)[pick])

    def descend(rows, rounds, unseen=()):
        """The model after each epoch over ``rows``, and its loss on ``unseen``."""
        rng = np.random.default_rng(seed)
        bias, w, v = np.array([np.log(rate / (1 - rate))]), np.zeros(k), rng.normal(0, 0.01, (k, FACTORS))
        share = np.zeros(k)
        for lo in range(0, len(rows), batch):
            idx, begin = parts(rows[lo:lo + batch])
            share += np.bincount(idx, weights=np.repeat(weight[rows[lo:lo + batch]], np.diff(begin)), minlength=k)
        share /= weight[rows].sum()
        many = weight[rows].sum() ** 2 / (weight[rows] ** 2).sum()
        sd = np.sqrt(np.maximum(share * (1 - share), 1 / many))
        least = noise * np.sqrt(rate * (1 - rate) / many)
        speed, t = np.zeros(k), 0
        m1, m2 = [np.zeros(1), np.zeros((k, FACTORS))], [np.zeros(1), np.zeros((k, FACTORS))]
        for _ in range(rounds):
            order = rng.permutation(rows)
            for lo in range(0, len(order), batch):
                pick = order[lo:lo + batch]
                idx, begin = parts(pick)
                own, t = np.repeat(np.arange(len(pick)), np.diff(begin)), t + 1
                vi = v[idx]
                s = sum_by_document(vi, begin)
                out = bias[0] + sum_by_document(w[idx], begin) + 0.5 * (s ** 2 - sum_by_document(vi ** 2, begin)).sum(axis=1)
                g = (logistic(out) - y[pick]) * weight[pick] / weight[pick].sum()
                gi = g[own]
                speed = 0.9 * speed + 0.1 * np.bincount(idx, weights=gi, minlength=k) / sd
                w = w * sd - rise * speed
                w = np.sign(w) * np.maximum(np.abs(w) - rise * least, 0) / sd
                grads = [np.array([g.sum()]), np.stack([np.bincount(idx, weights=gi * (s[own, f] - vi[:, f]), minlength=k)
                                                        for f in range(FACTORS)], axis=1)]
                for i, grad in enumerate(grads):
                    m1[i] = 0.9 * m1[i] + 0.1 * grad
                    m2[i] = 0.999 * m2[i] + 0.001 * grad ** 2
                    size = np.sqrt(m2[i] / (1 - 0.999 ** t))
                    move = step * (m1[i] / (1 - 0.9 ** t)) / (np.maximum(size, 0.3 * size.max()) + 1e-12)
                    if i:
                        v = v - move
                    else:
                        bias = bias - move
            model = Model(buckets, float(bias[0]), w, v)
            loss = 0.0
            for lo in range(0, len(unseen), batch):
                some = unseen[lo:lo + batch]
                z = model.margins(*parts(some))
                loss += (weight[some] * (np.logaddexp(0, z) - y[some] * z)).sum()
            yield loss, model

    model = Model(buckets, float(np.log(rate / (1 - rate))), np.zeros(k), np.zeros((k, FACTORS)))
    if k and 0 < y.sum() < len(y):
        mixed, best = np.random.default_rng([seed, 1]).permutation(n), (np.inf, epochs)
        kept, unseen = np.sort(mixed[n // 5:]), np.sort(mixed[:n // 5])
        if 0 < y[unseen].sum() < len(unseen):
            for turn, (loss, _) in enumerate(descend(kept, epochs, unseen), 1):
                best = min(best, (loss, turn))
                if turn - best[1] >= patience:
                    break
        for _, model in descend(np.arange(n), best[1]):
            pass
    return model


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
          held_out=HELD_OUT, sample=None) -> Model:
    """The model learned from the labelled rows outside the held-out fold.

    Rows with a null id or label teach nothing; an id with several labels
    counts as toxic if one says so, with several texts as the smallest one."""
    sample = sample or SAMPLE
    m, r = held_out
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, m) != r))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
             .filter("y in (0, 1)"))
    total = {x.y: x.n for x in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    # bounded: at most sample[0] + sample[1] ids
    picked = [(x.id, x.y) for y, n in sample.items()
              for x in hash_sample(known.filter(F.col("y") == y), ["id"], n, total.get(y, 0)).collect()]
    n = sum(total.values())
    rate = (total.get(1, 0) + 0.01) / (n + 1)
    if not picked:
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0), np.zeros(0), rate)
    spark = docs.sparkSession
    ids = spark.createDataFrame(picked, f"id {labels.schema[id_col].dataType.simpleString()}, y int")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min("text").alias("text")))

    def buckets(arr):
        sizes, flats = [], [np.zeros(0, np.int32)]
        for part in in_parts(arr.to_pylist()):
            flat, starts = text_terms(part)
            flats.append(flat)
            sizes.append(np.diff(starts))
        return [pa.ListArray.from_arrays(starts_of(np.concatenate([np.zeros(0, np.int64), *sizes])).astype(np.int32), np.concatenate(flats))]

    rows = written(map_texts(texts, buckets, "terms array<int>"), "terms")
    keep = kept_terms(rows)
    shared = spark.sparkContext.broadcast(keep)

    def places(batches):
        known = shared.value
        for b in batches:
            lists = b.column(2)
            flat, size = lists.flatten().to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
            ok = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            row = np.repeat(np.arange(len(size)), size)[ok]
            ends = starts_of(np.bincount(row, minlength=len(size))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(ends, at[ok].astype(np.int32))],
                                             names=["id", "y", "terms"])

    # bounded: the sampled rows, four bytes a term
    got = rows.mapInArrow(places, rows.schema).orderBy("id").toArrow()
    release(rows)
    y = got["y"].to_numpy().astype(float)
    part = {c: max(1, (y == c).sum()) for c in (0, 1)}
    weight = np.where(y == 1, total.get(1, 0) / part[1], total.get(0, 0) / part[0])
    size = pc.list_value_length(got["terms"]).to_numpy().astype(np.int64)
    flat = pc.list_flatten(got["terms"]).to_numpy()
    del got
    return fit(keep, flat, starts_of(size), y, weight, rate)


def kept_terms(rows: DataFrame) -> np.ndarray:
    """Buckets of the terms in at least ``LEAST`` texts, in order."""
    got = rows.select(F.explode("terms").alias("b")).groupBy("b").agg(F.count("*").alias("c")).filter(F.col("c") >= LEAST).select("b").toArrow()
    return np.sort(got["b"].to_numpy().astype(np.int64))


def score(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", held_out=HELD_OUT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts have no terms and get the score of the bias.  Without
    any label the rate is 1 %.  Repeated rows give a row each; only id and text
    are read, so other columns may have any name; a null id is in the fold of
    the empty text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, held_out=held_out))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      (fold(id_col, held_out[0]) == held_out[1]).alias("held_out"))
    out = map_texts(src, lambda t: [pa.array(model.value.scores(t.to_pylist()))], "score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` with a score under the threshold, all columns kept."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(texts), dtype=float)

    s = fresh(docs, "score")
    return docs.withColumn(s, scores.asNondeterministic()(text_col)).filter(F.col(s) < THRESHOLD).drop(s)

"""Language identification by multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every character that is not a letter becomes a space and
runs of spaces one; its 1- to 3-grams are hashed into ``BUCKETS`` columns.
Counts by language are summed over all training rows: each task adds up its own
count matrix and sends its non-zero cells once, so a language with a third of
all rows costs no more than any other.  The smoothed log-probability matrix
(languages x buckets, its size checked) is broadcast, and texts are scored in
sparse batches: non-zero counts of a batch times their rows of the matrix.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts, starts_of, sum_by_document

BUCKETS = 1 << 14
ORDERS = 3
SMOOTH = 0.1
PIECE = 1 << 20            # characters handled at once; n-grams do not span pieces
BATCH = 256                # texts handled at once
MODEL_BYTES = 512 << 20
HELD_OUT = (5, 0)
UNKNOWN = "und"
#: Odd multipliers of the rolling hash.
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@lru_cache(1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def batches(texts):
    """(first text, its number of texts, pieces) in runs of bounded size."""
    lo, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = (t or "").lower()
        for a in range(0, max(1, len(t)), PIECE):
            held.append((i - lo, t[a:a + PIECE]))
            size += len(held[-1][1])
            if size >= PIECE:
                yield lo, i - lo + 1, held
                # a text cut here goes on in the next run, under the same number
                lo, held, size = i, [], 0
        if i - lo + 1 >= BATCH:
            yield lo, i - lo + 1, held
            lo, held, size = i + 1, [], 0
    if held:
        yield lo, held[-1][0] + 1, held


def grams(pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every n-gram, and the numbers of texts with a letter."""
    raw = "".join(t for _, t in pieces).encode("utf-32-le", "surrogatepass")
    cp = np.frombuffer(raw, np.uint32)
    doc = np.repeat([d for d, _ in pieces], [len(t) for _, t in pieces]).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), [len(t) for _, t in pieces])
    alpha = letters()[cp]
    cp = np.where(alpha, cp, np.uint32(32))
    again = np.zeros(len(cp), bool)
    again[1:] = ~alpha[1:] & ~alpha[:-1] & (piece[1:] == piece[:-1])
    cp, doc, piece, alpha = cp[~again], doc[~again], piece[~again], alpha[~again]
    docs, buckets, h = [], [], np.zeros(len(cp), np.uint32)
    for n in range(ORDERS):
        if n >= len(cp):
            break
        h = (h[:len(cp) - n] if n == 0 else h[:-1]) * _MIX[1] + cp[n:] * _MIX[0] + np.uint32(n)
        ok = piece[n:] == piece[:len(cp) - n]
        if n == 0:
            ok = alpha
        mixed = (h ^ (h >> np.uint32(15))) * _MIX[2]
        buckets.append((mixed >> np.uint32(18))[ok].astype(np.int64))
        docs.append(doc[:len(cp) - n][ok])
    return np.concatenate(docs or [doc]), np.concatenate(buckets or [doc]), np.unique(doc[alpha])


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", held_out=HELD_OUT):
    """(languages, log-prior, log-probability matrix) from all rows outside the
    held-out fold whose language is not null."""
    m, r = held_out
    src = (docs.filter(F.col(lang_col).isNotNull() & (fold(id_col, m) != r))
           .select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")))

    def count(frames):
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for f in frames:
            langs, code = np.unique(f["lang"].to_numpy().astype(str), return_inverse=True)
            for x, n in zip(langs, np.bincount(code)):
                rows[x] = rows.get(x, 0) + int(n)
            for lo, _, pieces in batches(f["text"].where(f["text"].notna(), None)):
                doc, bucket, _ = grams(pieces)
                total = np.bincount(code[doc + lo] * BUCKETS + bucket, minlength=len(langs) * BUCKETS).reshape(-1, BUCKETS)
                for x, c in zip(langs, total):
                    sums[x] = sums[x] + c if x in sums else c
        for x, n in rows.items():
            c = sums.get(x, np.zeros(BUCKETS, np.int64))
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": x, "bucket": np.concatenate([[-1], at]), "n": np.concatenate([[n], c[at]])})

    cells = src.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    size = src.select("lang").distinct().count() * BUCKETS * 8
    if size > MODEL_BYTES:
        raise ValueError(f"{size} bytes of model for these languages; raise MODEL_BYTES or merge languages")
    got = cells.toPandas()
    langs = sorted(got["lang"].unique())
    table, prior = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    for k, x in enumerate(langs):
        part = got[got["lang"] == x]
        own = part["bucket"].to_numpy() < 0
        prior[k] = part["n"][own].sum()
        table[k, part["bucket"][~own].to_numpy().astype(int)] = part["n"][~own].to_numpy()
    logp = np.log(table + SMOOTH) - np.log(table.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
    return langs, np.log(prior / prior.sum()) if len(langs) else prior, logp.T


def predict(texts, langs, prior, logp) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    total, known = np.zeros((n, len(langs))), np.zeros(n, bool)
    for lo, size, pieces in batches(texts):
        doc, bucket, seen = grams(pieces)
        counts = np.bincount(doc * BUCKETS + bucket, minlength=size * BUCKETS)
        cell = np.flatnonzero(counts)                                # sparse rows: text, bucket, count
        starts = np.searchsorted(cell, np.arange(size + 1) * BUCKETS)
        total[lo:lo + size] += sum_by_document(counts[cell][:, None] * logp[cell % BUCKETS], starts)
        known[lo + seen] = True
    if not langs:
        return [UNKNOWN] * n, np.zeros(n)
    z = total + prior
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    best = p.argmax(axis=1)
    return ([langs[b] if k else UNKNOWN for b, k in zip(best, known)],
            np.where(known, p[np.arange(n), best], 0.0))


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", held_out=HELD_OUT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``
    (the posterior of the predicted language).

    A null text or one without a letter is ``und`` with score 0, as is all
    text when nothing can be learned; ties go to the first language in order.
    Repeated rows give a row each, a null id is in the fold of the empty text;
    other columns are not read."""
    langs, prior, logp = train(docs, id_col, text_col, lang_col, held_out)
    model = docs.sparkSession.sparkContext.broadcast((langs, prior, logp))

    def run(texts):
        names, p = predict(texts.to_pylist(), *model.value)
        return [pa.array(names, pa.string()), pa.array(p)]

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      (fold(id_col, held_out[0]) == held_out[1]).alias("held_out"))
    return map_texts(src, run, "lang_pred string, score double", batch_rows=2048)

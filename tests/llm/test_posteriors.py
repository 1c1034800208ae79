"""The whole results of op3_quality and op6_langid against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_cases import EDGE, docs_df, random_docs

from lexisift.llm import langid, quality


def fold(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


# ------------------------------------------------------------------ op6 --
def grams(t):
    t = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in (t or "").lower()))
    return [g for n in (1, 2, 3) for g in (t[i:i + n] for i in range(len(t) - n + 1)) if g != " "]


def bucket(g):
    h, mask = 0, 0xFFFFFFFF
    for n, c in enumerate(g):
        h = (h * 0x85EBCA77 + ord(c) * 0x9E3779B1 + n) & mask
    return (((h ^ (h >> 15)) * 0xC2B2AE3D) & mask) >> 18


def test_language_posteriors_equal_brute_force(spark):
    r = random.Random(2)
    parts = {"en": ["the", "cat", "is", "ab", "x1"], "de": ["der", "hund", "ist", "ab", "ß"], "zz": ["qa", "ab", "kk"], None: ["the", "der"]}
    rows = [(100 + i, " ".join(r.choice(parts[x]) for _ in range(r.randrange(9))), x, "s", 0)
            for i in range(150) for x in [r.choice(list(parts))]] + EDGE
    counts, docs = defaultdict(Counter), Counter()
    for i, t, lang, *_ in rows:
        if lang is not None and fold(i, 5) != 0:
            docs[lang] += 1
            counts[lang].update(map(bucket, grams(t)))
    langs = sorted(docs)
    got = {}
    for g in langid.identify(docs_df(spark, rows)).collect():
        got.setdefault(g.doc_id, []).append((g.held_out, g.lang_pred, g.score))
    want = {}
    for i, t, *_ in rows:
        z = [math.log(docs[x] / sum(docs.values())) + sum(
            n * math.log((counts[x][b] + 0.1) / (sum(counts[x].values()) + 0.1 * (1 << 14))) for b, n in Counter(map(bucket, grams(t))).items())
            for x in langs]
        p = [1 / sum(math.exp(min(700, b - a)) for b in z) for a in z]
        k = max(range(len(langs)), key=lambda j: (z[j], -j))
        seen = any(c.isalpha() for c in t or "")
        want.setdefault(i, []).append((fold(i, 5) == 0, langs[k] if seen else "und", p[k] if seen else 0.0))
    assert set(got) == set(want)
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i])):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)


# ------------------------------------------------------------------ op3 --
def strength(groups):
    """Groups of values, each with the mean it varies around."""
    n, k = sum(len(v) for v, _ in groups), len(groups)
    if k < 2 or n <= k:
        return 1e6
    mean = [sum(v) / len(v) for v, _ in groups]
    within = sum((x - m) ** 2 for (v, _), m in zip(groups, mean) for x in v) / (n - k)
    between = sum(len(v) * (m - up) ** 2 for (v, up), m in zip(groups, mean)) / (k - 1)
    size = (n - sum(len(v) ** 2 for v, _ in groups) / n) / (k - 1)
    return min(1e6, max(1.0, within / max((between - within) / max(size, 1e-9), 1e-9)))


def brute_scores(rows, prior):
    """Posteriors of rows (host, path, evidence), own part left out."""
    odds = lambda p: math.log(p / (1 - p))
    own = [1 / (1 + math.exp(-(e + odds(prior)))) for _, _, e in rows]
    by_host, by_path = defaultdict(list), defaultdict(list)
    for (h, p, _), x in zip(rows, own):
        by_host[h].append(x)
        by_path[h, p].append(x)
    mean = (sum(own) + prior) / (len(own) + 1)
    host_mean = {h: sum(v) / len(v) for h, v in by_host.items()}
    mh = strength([(v, mean) for v in by_host.values()])
    mp = strength([(v, host_mean[h]) for (h, _), v in by_path.items()])
    out = []
    for (h, p, e), x in zip(rows, own):
        v, u = by_host[h], by_path[h, p]
        up = (sum(v) - x + mh * mean) / (len(v) - 1 + mh)
        rate = min(1 - 1e-6, max(1e-6, (sum(u) - x + mp * up) / (len(u) - 1 + mp)))
        out.append(1 / (1 + math.exp(-(e + odds(rate)))))
    return out


@pytest.mark.parametrize("taught", [True, False])
def test_quality_posteriors_equal_brute_force(spark, taught):
    r = random.Random(5)
    rows = [(100 + i, "buy now!!! " * 20 if r.random() < (0.9 if s == "s0" else 0.2) else t, r.choice(["en", "de", None]), s, 0)
            for i, (_, t, _, s, _) in enumerate(random_docs(160, seed=3))] + EDGE
    labels = [(i, int("buy" not in (t or "")), 0) for i, t, *_ in rows if i is not None and i >= 100 and taught]
    known = [(i, y) for i, y, _ in labels if fold(i, 5) != 0]
    got = quality.classify(docs_df(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    text = defaultdict(list)
    for i, t, lang, s, _ in rows:
        text[i].append((t, s, lang))
    # the evidence is the model's, which the next test holds to its optimum
    x = np.array([quality.features(text[i][0][0]) for i, _ in sorted(known)]).reshape(-1, len(quality.FEATURES))
    prior = (sum(y for _, y in known) + 1) / (len(known) + 2)
    model = quality.fit(x, np.array([float(y) for _, y in sorted(known)]), prior)
    flat = [(i, *k) for i in text for k in text[i]]
    evidence = model.of_texts([t for _, t, _, _ in flat])
    want = brute_scores([(s, lang, float(e)) for (_, _, s, lang), e in zip(flat, evidence)], prior)
    pairs = sorted((repr(i), round(float(e), 6), round(w, 6)) for (i, *_), e, w in zip(flat, evidence, want))
    mine = sorted((repr(g.doc_id), round(g.evidence, 6), round(g.score, 6)) for g in got)
    assert [p[0] for p in mine] == [p[0] for p in pairs]
    for a, b in zip(mine, pairs):
        assert a[1] == pytest.approx(b[1], abs=1e-5) and a[2] == pytest.approx(b[2], abs=1e-5)
    assert all(g.predicted == int(g.score >= 0.5) and g.held_out == (fold(g.doc_id, 5) == 0) for g in got)


def test_quality_weights_are_at_the_optimum():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, len(quality.FEATURES)))
    y = (x[:, 0] + 0.3 * r.normal(size=200) > 0.5).astype(float)
    m = quality.fit(x, y, 0.5)

    def loss(w):
        z = m.design(x) @ w
        c = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
        return float((c * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * w @ w)

    for j in range(len(m.w)):
        step = np.zeros(len(m.w))
        step[j] = 1e-4
        assert abs(loss(m.w + step) - loss(m.w - step)) / 2e-4 < 1e-4

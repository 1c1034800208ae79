"""Toxicity, quality, language id and the language model: held-out accuracy on
the test tables, brute-force restatements, and awkward rows."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import EDGE, docs_df, random_docs

from lexisift.llm import langid, quality, toxicity
from lexisift.llm import language_model as LM

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def fold(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


EXTRA = ", score double, held_out int, predicted string, evidence int, host string, path string, n long, text_ string"


def extra(rows):
    return [(*r, 0.5, 1, "x", 2, "h", "p", 3, "t") for r in rows]


# ------------------------------------------------------------------ op1 --
def test_toxicity_on_held_out_labels(spark):
    out = toxicity.score(read(spark, "documents"), read(spark, "labels"))
    rows = out.join(read(spark, "labels"), "doc_id").filter("held_out").toPandas()
    assert out.count() == 10_000 and (rows.doc_id.map(lambda i: fold(i, 4)) == 2).all()
    hit = (rows.predicted == 1) & (rows.toxic == 1)
    assert hit.sum() / rows.toxic.sum() > 0.85 and hit.sum() / (rows.predicted == 1).sum() > 0.9
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()


def test_factorization_machine_learns_a_pair():
    # neither word is toxic alone, both together are
    r = random.Random(0)
    sets, y = [], []
    for _ in range(800):
        a, b = r.random() < 0.5, r.random() < 0.5
        sets.append(np.array(sorted([1] * a + [2] * b + [10 + r.randrange(3)])))
        y.append(float(a and b))
    buckets = np.unique(np.concatenate(sets))
    starts = np.cumsum([0, *(len(s) for s in sets)])
    m = toxicity.fit(buckets, np.searchsorted(buckets, np.concatenate(sets)), starts, np.array(y), np.ones(800), 0.25, epochs=150)
    at = {int(b): i for i, b in enumerate(m.buckets)}
    z = m.margins(np.array([at[1], at[2], at[1], at[2]]), np.array([0, 1, 2, 4]))
    assert z[0] < 0 and z[1] < 0 and z[2] > 0


def test_training_keeps_terms_that_matter_only_in_pairs(spark):
    # toxic if exactly one of two words is there, so neither has a margin; thousands of other terms have one by chance
    r = random.Random(1)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(2500)]
    rows = []
    for i in range(4000):
        a, b = r.random() < 0.5, r.random() < 0.5
        rows.append((i, " ".join(["zuvwx"] * a + ["qyrst"] * b + [r.choice(vocab) for _ in range(12)]), int(a != b)))
    docs = docs_df(spark, [(i, t, "en", "s", 0) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], LABELS)
    want = {i: y for i, _, y in rows}
    got = [g for g in toxicity.score(docs, labels).collect() if g.held_out]
    assert len(got) > 900 and np.mean([(g.score >= 0.5) == want[g.doc_id] for g in got]) > 0.95


def test_words_end_at_any_punctuation_and_unspaced_runs_are_read_whole(spark):
    quoted = ("“idiot”", "«idiot»", "¿idiot?", "so—idiot—so", "é_idiot_é")
    assert all("idiot" in toxicity.words_of(t) for t in quoted)
    assert toxicity.words_of("हिन्दी x_y naïve") == {"हिन्दी", "x", "y", "naïve"}
    def terms(word):
        return set(toxicity.terms_of([word])[0].tolist())
    assert (terms("馬鹿") - terms("馬")) & terms("今日はとても良い天気です" * 3 + "馬鹿" + "ね")
    assert terms("idiot") & terms("x" * 40 + "idiot" + "x" * 40)
    # all words at once give the terms of each
    words = ["idiot", "馬鹿", "a", "x" * 40 + "idiot", "naïve"]
    flat, starts = toxicity.terms_of(words)
    assert [set(flat[a:b].tolist()) for a, b in zip(starts, starts[1:])] == [terms(w) for w in words]
    r, rows = random.Random(0), []
    for i in range(800):
        y, text = int(i % 4 == 0), "".join(r.choice("今日明天気良悪花山川海空雨雪春秋") for _ in range(40))
        rows.append((i, text[:30] + "馬鹿" + text[30:] if y else text, y))
    rows += [(i, ("kind words " if i % 4 else "“idiot” words ") + r.choice(("a", "b", "c")), int(i % 4 == 0)) for i in range(800, 1600)]
    docs = docs_df(spark, [(i, t, "x", "s", 0) for i, t, _ in rows] + [(5000, "«idiot»", "x", "s", 0), (5001, "¡idiot!", "x", "s", 0), (5002, "kind", "x", "s", 0)])
    got = {g.doc_id: g.predicted for g in toxicity.score(docs, spark.createDataFrame([(i, 1, y) for i, _, y in rows], LABELS)).collect()}
    assert np.mean([got[i] == y for i, _, y in rows if fold(i, 4) == 2]) > 0.95
    assert got[5000] == got[5001] == 1 and got[5002] == 0


def test_fm_margin_is_the_sum_over_pairs():
    r = np.random.default_rng(0)
    m = toxicity.Model(np.arange(6), 0.3, r.normal(size=6), r.normal(size=(6, 4)))
    ids = [0, 2, 5]
    want = 0.3 + m.w[ids].sum() + sum(m.v[i] @ m.v[j] for k, i in enumerate(ids) for j in ids[:k])
    assert m.margins(np.array(ids), np.array([0, 3]))[0] == pytest.approx(want)


def test_toxicity_edge_rows(spark):
    labels = spark.createDataFrame([(i + 100, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (4, None, None), (103, 1, 0), (103, 1, 1)], LABELS)
    rows = [(i + 100, ("vile " if i % 3 == 0 else "kind ") + t, a, b, n) for i, t, a, b, n in random_docs(60)] + EDGE
    d = docs_df(spark, extra(rows), EXTRA)
    got = toxicity.score(d, labels).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    blank = [g.score for g in got if g.doc_id in (1, 2)]
    assert blank[0] == blank[1]
    kept = toxicity.drop_toxic(d, labels)
    assert kept.columns == d.columns
    bad = sum(g.predicted for g in got)
    assert kept.count() == len(rows) - bad and bad >= 15
    none = labels.limit(0)
    assert all(g.predicted == 0 for g in toxicity.score(d, none).collect())
    assert toxicity.score(d.limit(0), labels).count() == 0


# ------------------------------------------------------------------ op3 --
def test_quality_on_held_out_labels(spark):
    out = quality.classify(read(spark, "documents"), read(spark, "labels"))
    rows = out.join(read(spark, "labels"), "doc_id").filter("held_out").toPandas()
    good = rows.quality == 1
    assert ((rows.predicted == 1) & good).sum() >= 0.99 * good.sum()
    assert ((rows.predicted == 0) & ~good).sum() >= 0.9 * (~good).sum()


def test_quality_shrinks_sparse_sites(spark):
    # each site also holds the row that is judged, whose own evidence is even and is left out
    own = [(h, "x" if h else None, 0.5) for h in ("a", "b", "c", None)]
    rows = [("a", "x", 0.9)] * 400 + [("b", "x", 0.1)] * 400 + [("c", "x", 0.1)] + own
    df = spark.createDataFrame(rows, "host string, path string, p double")
    table, mean, mh, mp = quality.sites(df, 0.5)
    assert mean == pytest.approx(0.5, abs=0.05)
    one = spark.createDataFrame([("a", "x", 0.0), ("b", "x", 0.0), ("c", "x", 0.0), (None, None, 0.0)], "host string, path string, e double")
    from pyspark.sql import functions as F
    got = {r.host: r.out for r in quality.posterior(one, "e", table, mean, mh, mp, 0.5, F.col("host"), F.col("path"), "out").collect()}
    assert got["a"] > 0.8 and got["b"] < 0.2 and got["b"] < got["c"] < got["a"] and abs(got[None] - mean) < 0.1


def test_quality_edge_rows(spark):
    labels = spark.createDataFrame([(i + 100, int(i % 2), 0) for i in range(60)] + [(None, 1, 1), (4, None, None), (105, 0, 0)], LABELS)
    rows = [(i + 100, t if i % 2 else "zz " * 30, a, b, n) for i, t, a, b, n in random_docs(60)] + EDGE
    d = docs_df(spark, extra(rows), EXTRA)
    got = quality.classify(d, labels).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    kept = quality.drop_bad(d, labels)
    assert kept.columns == d.columns and kept.count() == sum(g.predicted for g in got)
    assert quality.classify(d, labels.limit(0)).count() == len(rows)
    assert quality.classify(d.limit(0), labels).count() == 0
    assert quality.drop_bad(d.limit(0), labels).count() == 0


# ------------------------------------------------------------------ op6 --
def test_language_on_held_out_rows(spark):
    out = langid.identify(read(spark, "documents")).filter("held_out").join(read(spark, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    ok = (out.lang_pred == out.lang)[out.lang.notna() & (out.lang_pred != "und")]
    assert ok.mean() > 0.98


def brute_grams(t):
    t = "".join(c if c.isalpha() else " " for c in t.lower())
    t = re.sub(" +", " ", t)
    return [g for n in (1, 2, 3) for g in (t[i:i + n] for i in range(len(t) - n + 1)) if g != " "]


def test_ngram_counts_equal_brute_force(monkeypatch):
    texts = ["Hello, wörld 12 x", "", None, "aaa", "ß", "  ", "日本語 text", "a" * 50 + " b"]
    def bucket(g):
        h = np.uint64(0)
        for n, c in enumerate(g):
            h = (h * np.uint64(0x85EBCA77) + np.uint64(ord(c)) * np.uint64(0x9E3779B1) + np.uint64(n)) & np.uint64(0xFFFFFFFF)
        h = ((h ^ (h >> np.uint64(15))) * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
        return int(h >> np.uint64(18))
    want = [sorted(bucket(g) for g in brute_grams(t or "")) for t in texts]
    for batch in (256, 2):
        monkeypatch.setattr(langid, "BATCH", batch)
        got = [[] for _ in texts]
        for lo, n, pieces in langid.batches(texts):
            doc, b, _ = langid.grams(pieces)
            for d, x in zip(doc + lo, b):
                got[d].append(int(x))
        assert [sorted(g) for g in got] == want


def test_pieces_cover_long_texts(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 10)
    texts = ["abcdefghijklmnopqrstuvwxyz", "xy", "", "k" * 10, "z"]
    got = [""] * 5
    for lo, n, pieces in langid.batches(texts):
        assert all(0 <= d < n for d, _ in pieces)
        for d, t in pieces:
            got[lo + d] += t
    assert got == texts


def test_language_edge_rows(spark):
    rows = [(i, "the cat and the dog " * 3 if i % 2 else "der hund und die katze " * 3, "en" if i % 2 else "de", "s", 0) for i in range(40)]
    rows += [*EDGE, (50, "123 !?", "en", "s", 0), (51, "the dog", None, "s", 0)]
    rows = [(*r[:2], "xx" if r[0] in (7, 8) else r[2], *r[3:]) for r in rows if r[0] is None or r[0] >= 10 or r in EDGE]
    d = docs_df(spark, extra(rows), EXTRA)
    got = langid.identify(d).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 for g in got)
    by = {g.doc_id: g.lang_pred for g in got}
    assert by[1] == by[2] == by[3] == by[50] == "und" and by[51] == by[11] == "en" and by[12] == "de"
    assert all(g.lang_pred == "und" for g in langid.identify(d.filter("doc_id = 50")).collect())
    assert langid.identify(d.limit(0)).count() == 0


# ------------------------------------------------------------------ op2 --
def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def brute_base(rows):
    count, end = {}, 0
    for r in rows:
        if fold(r[0], 10):
            end += 1
            for w in words(r[1]):
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()) + end, len(count) + (end > 0)
    out = []
    for r in rows:
        w = words(r[1])
        c = [count.get(x, 0) for x in w] + [end]
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in c)
        out.append((repr(r[0]), fold(r[0], 10) == 0, len(c), sum(x > 0 for x in c), n, round(base, 6)))
    return sorted(out)


@pytest.mark.parametrize("head", [1e-6, 2e-3])
def test_base_score_equals_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(LM, "HEAD", head)
    rows = random_docs(300, seed=4, vocab=900) + EDGE + [(700 + i, "Rare" + "r" * 80 + str(i) + " tail " * i, "en", "s", 0) for i in range(20)]
    got = LM.score(docs_df(spark, extra(rows), EXTRA)).collect()
    assert sorted((repr(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == brute_base(rows)
    assert all(np.isfinite(g.score) and g.score < 0 for g in got)


def test_language_model_beats_the_base(spark):
    got = LM.score(read(spark, "documents")).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > 0.97 * got["sum(base_score)"]


def small_lexicon():
    toks = [f"w{i}" for i in range(30)] + [LM.END]
    counts = np.array([100 - 3 * i for i in range(30)] + [40])
    rest = pa.array([f"rare{i}," for i in range(50)])
    shape_n = np.bincount(LM.shapes_of(rest), minlength=LM.SHAPES) * 1.0 + np.bincount(LM.shapes_of(pa.array(toks[:30])), weights=counts[:30], minlength=LM.SHAPES)
    shape_v = np.bincount(LM.shapes_of(rest), minlength=LM.SHAPES) + np.bincount(LM.shapes_of(pa.array(toks[:30])), minlength=LM.SHAPES)
    return LM.Lexicon(toks, counts, int(counts.sum()) + 50, 81, shape_n, shape_v)


def test_next_token_probabilities_sum_to_one():
    lex = small_lexicon()
    net = LM.Network(lex)
    rng = np.random.default_rng(1)
    for k in ("C", "O"):
        net.p[k] = rng.normal(0, 1, net.shapes[k]).astype(np.float32)
    h = np.repeat(rng.normal(0, 1, (1, LM.HIDDEN)).astype(np.float32), lex.n_words + LM.SHAPES, axis=0)
    p = np.exp(LM.output_scores(net, lex, h, np.arange(lex.n_words + LM.SHAPES)))
    assert p.sum() == pytest.approx(1, abs=1e-4)


def test_state_carries_through_the_whole_text(monkeypatch):
    lex = small_lexicon()
    net = LM.Network(lex)
    rng = np.random.default_rng(1)
    for k in ("C", "O"):
        net.p[k] = rng.normal(0, 1, net.shapes[k]).astype(np.float32)
    lengths = np.array([3, 50, 1, 7])
    ids = rng.integers(0, lex.n_words + LM.SHAPES, lengths.sum())
    ids[np.cumsum(lengths) - 1] = lex.n_words - 1
    whole = LM.network_scores(net, lex, ids, lengths)
    monkeypatch.setattr(LM, "CHUNK", 5)
    assert np.allclose(whole, LM.network_scores(net, lex, ids, lengths))
    lone = np.concatenate([LM.network_scores(net, lex, ids[a:b], np.array([b - a])) for a, b in zip(np.cumsum(lengths) - lengths, np.cumsum(lengths))])
    assert np.allclose(whole, lone, atol=1e-4)


def test_gradient_equals_differences():
    lex = small_lexicon()
    net = LM.Network(lex)
    rng = np.random.default_rng(2)
    net.p = {k: rng.normal(0, 0.5, s) for k, s in net.shapes.items()}
    x = rng.integers(0, lex.n_words + LM.SHAPES, (3, 5))
    y = rng.integers(0, lex.n_words + LM.SHAPES, (3, 5))
    y[2, 3:] = -1
    grads = {}
    tr = LM.Trainer(net, lex)
    tr.update = lambda g, n: grads.update(g)
    def sparse(k, at, g, n):
        full = np.zeros(net.shapes[k])
        np.add.at(full, at, g)
        grads[k] = full
    tr.sparse = sparse
    end = lex.n_words - 1
    tr.window(np.zeros((3, LM.HIDDEN)), x, y, end)

    def loss():
        h, total = np.zeros((3, LM.HIDDEN)), 0.0
        for t in range(5):
            h = np.where((x[:, t] == end)[:, None], 0, h)
            h = net.step(h, net.p["X"][x[:, t]])[0]
            ok = y[:, t] >= 0
            total -= LM.output_scores(net, lex, h[ok], y[ok, t]).sum()
        return total

    for k, shape in net.shapes.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in shape)
            if k == "X":
                at = (x.ravel()[rng.integers(0, 15)], at[1])
            keep = net.p[k][at]
            net.p[k][at] = keep + 1e-5
            up = loss()
            net.p[k][at] = keep - 1e-5
            down = loss()
            net.p[k][at] = keep
            assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=2e-3)


def test_language_model_without_training_rows(spark):
    held = [r for r in random_docs(60) if fold(r[0], 10) == 0]
    got = LM.score(docs_df(spark, held)).collect()
    assert held and all(g.n_known == 0 and g.train_tokens == 0 and g.base_score == pytest.approx(0) and np.isfinite(g.score) for g in got)
    assert LM.score(docs_df(spark, held).limit(0)).count() == 0

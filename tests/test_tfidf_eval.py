"""TF-IDF against a pure-Python statement of the vectoriser, evaluation
against brute-force metrics, and edge cases."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lexisift.operators import evaluation as EV
from lexisift.operators import tfidf as TF

from conftest import SF_SMALL

WORD = re.compile(r"[^\W]{2,}")


def py_terms(text):
    toks = re.findall(r"(?u)\b\w\w+\b", text.lower())
    out = list(toks)
    for n in (2, 3):
        out += [" ".join(toks[i:i + n]) for i in range(len(toks) - n + 1)]
    return out


def py_tfidf(texts, max_features, min_df=2):
    tfs = {k: Counter(py_terms(t)) for k, t in texts.items()}
    df, ctf = Counter(), Counter()
    for c in tfs.values():
        for term, v in c.items():
            df[term] += 1
            ctf[term] += v
    kept = [t for t in df if df[t] >= min_df]
    kept = sorted(kept, key=lambda t: (-ctf[t], t))[:max_features]
    n = len(texts)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for k, c in tfs.items():
        w = {t: (1 + math.log(v)) * idf[t] for t, v in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            out[(k, t)] = x / norm
    return out, sorted(kept)


def test_tfidf_brute_force(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").limit(120)
    rows = {r.doc_id: r.text for r in d.collect()}
    d = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    m = TF.fit_tfidf(d, "text", "doc_id", max_features=500, min_df=2)
    got = {(r.doc_id, r.term): r.w for r in m.weights(d, "text", "doc_id").collect()}
    exp, vocab = py_tfidf(rows, 500)
    assert [r.term for r in m.vocabulary.orderBy("idx").collect()] == vocab
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)


def test_vectors_norm_and_empty_rows(spark):
    d = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta delta"), (3, "zz"), (4, None)],
                              "doc_id long, text string")
    m = TF.fit_tfidf(d, "text", "doc_id", max_features=10, min_df=2)
    v = {r.doc_id: r.features for r in m.vectors(d, "text", "doc_id").collect()}
    assert set(v) == {1, 2, 3, 4}                              # rows without a kept term stay
    assert v[3].numNonzeros() == 0 and v[4].numNonzeros() == 0
    assert abs(v[1].dot(v[1]) - 1.0) < 1e-12


def test_tfidf_model_roundtrip(spark, tmp_path):
    d = spark.createDataFrame([(1, "aa bb cc"), (2, "aa bb dd"), (3, "bb cc dd")], "doc_id long, text string")
    m = TF.fit_tfidf(d, "text", "doc_id", max_features=None, min_df=1)
    m.save(str(tmp_path / "p"))
    m2 = TF.TfidfModel.load(spark, str(tmp_path / "p"))
    a = sorted(tuple(r) for r in m.weights(d, "text", "doc_id").collect())
    b = sorted(tuple(r) for r in m2.weights(d, "text", "doc_id").collect())
    assert a == b and m2.size == m.size


def _preds(spark, rows):
    return spark.createDataFrame([("m", i, a, p) for i, (a, p) in enumerate(rows)],
                                 "model string, key long, label string, prediction string")


def test_metrics_edge_cases(spark):
    # class "c" never predicted; class "d" predicted but never true
    rows = [("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("c", "d")]
    m = EV.metrics(_preds(spark, rows)).first()
    pc = {r["class"]: r for r in EV.per_class(_preds(spark, rows)).collect()}
    assert pc["c"].precision == 0.0 and pc["c"].recall == 0.0
    assert pc["d"].recall == 0.0 and pc["d"].support == 0
    # brute force: sklearn-style macro over the union of labels
    classes = sorted({x for r in rows for x in r})
    p, r_, f = [], [], []
    for c in classes:
        tp = sum(1 for a, q in rows if a == c and q == c)
        npred = sum(1 for _, q in rows if q == c)
        sup = sum(1 for a, _ in rows if a == c)
        pp = tp / npred if npred else 0.0
        rr = tp / sup if sup else 0.0
        p.append(pp)
        r_.append(rr)
        f.append(2 * pp * rr / (pp + rr) if pp + rr else 0.0)
    assert abs(m.accuracy - 3 / 6) < 1e-12
    assert abs(m.precision_macro - sum(p) / len(p)) < 1e-12
    assert abs(m.recall_macro - sum(r_) / len(r_)) < 1e-12
    assert abs(m.f1_macro - sum(f) / len(f)) < 1e-12


def test_best_model_ties_and_confusion(spark):
    a = spark.createDataFrame([("second", 1, "x", "x"), ("first", 1, "x", "x"), ("third", 1, "x", "y")],
                              "model string, key long, label string, prediction string")
    assert EV.best_model(a, ["first", "second", "third"]).first().model == "first"
    rows = [("a", "b")] * 3 + [("a", "a")] * 7 + [("b", "a")]
    p = _preds(spark, rows)
    errs = EV.confusion_errors(p).collect()
    assert [(r.actual, r.predicted, r["count"]) for r in errs] == [("a", "b", 3), ("b", "a", 1)]
    assert abs(errs[0].percentage - 30.0) < 1e-9
    over = {(r.actual, r.predicted) for r in EV.confusion_over_threshold(p, 0.1).collect()}
    assert over == {("a", "b"), ("b", "a")}
    wide = EV.confusion_matrix_wide(p, ["a", "b"]).orderBy("actual").collect()
    assert [(r.a, r.b) for r in wide] == [(7, 3), (1, 0)]
    txt = EV.report_text(EV.classification_report(p)).first().classification_report
    assert txt == (
        "              precision    recall  f1-score   support\n\n"
        "           a       0.88      0.70      0.78        10\n"
        "           b       0.00      0.00      0.00         1\n\n"
        "    accuracy                           0.64        11\n"
        "   macro avg       0.44      0.35      0.39        11\n"
        "weighted avg       0.80      0.64      0.71        11\n")
    dense = {(r.actual, r.predicted): r["count"] for r in EV.confusion_dense(p).collect()}
    assert dense == {("a", "a"): 7, ("a", "b"): 3, ("b", "a"): 1, ("b", "b"): 0}


def test_empty_rows_of_the_confusion_matrix(spark):
    p = _preds(spark, [("a", "c"), ("a", "a")])
    got = {(r.actual, r.predicted): r.fraction for r in EV.confusion_normalized(p).collect()}
    assert got == {("a", "a"): 0.5, ("a", "c"): 0.5, ("c", "a"): None, ("c", "c"): None}


def test_term_counts(spark):
    rows = [(["b", "a", "b", "c", "a", "b"],), ([],), (["x"],)]
    got = spark.createDataFrame(rows, "t array<string>").select(TF.term_counts(F.col("t")).alias("c")).collect()
    assert [(x.term, x.tf) for x in got[0].c] == [("a", 2), ("b", 3), ("c", 1)] and got[1].c == [] and [tuple(x) for x in got[2].c] == [("x", 1)]


def _weighed(rows, vocab, idf):
    """(key: {term: w}) over all rows of a key, by plain Python."""
    raw = defaultdict(list)
    for k, t in rows:
        for term, v in Counter(py_terms(t or "")).items():
            if term in idf:
                raw[k].append((term, (1 + math.log(v)) * idf[term]))
    return {k: sorted((t, round(w / math.sqrt(sum(x * x for _, x in e)), 9)) for t, w in e) for k, e in raw.items()}


def test_bounded_vocabulary_is_the_exact_best(spark):
    import random
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i % 50 if i % 9 else None, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.randrange(40)))) for i in range(60)]
    rows += [(3, None), (4, ""), (5, "Ünder Été ünder"), (5, "été ünder"), (6, "x " * 50), (7, "big " * 5000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    df, ctf = Counter(), Counter()
    for _, t in rows:
        for term, v in Counter(py_terms(t or "")).items():
            df[term] += 1
            ctf[term] += v
    for k, least in ((1, 1), (7, 2), (40, 3), (1000, 2), (100_000, 1)):
        m = TF.fit_tfidf(d, "text", "doc_id", max_features=k, min_df=least)
        kept = sorted(sorted((t for t in df if df[t] >= least), key=lambda t: (-ctf[t], t))[:k])
        got = [(r.term, r.df, r.ctf) for r in m.vocabulary.orderBy("idx").collect()]
        assert got == [(t, df[t], ctf[t]) for t in kept]
    idf = {r.term: r.idf for r in m.vocabulary.collect()}
    exp = _weighed(rows, kept, idf)
    for model in (m, TF.TfidfModel(m.vocabulary.withColumn("idx", F.col("idx") + 5), m.n_docs, m.size + 5)):   # the second is joined
        got = defaultdict(list)
        for r in model.weights(d, "text", "doc_id").collect():
            got[r.doc_id].append((r.term, round(r.w, 9)))
        assert {k: sorted(v) for k, v in got.items()} == exp
        arrays = {r.doc_id: r for r in model.sparse_arrays(d, "text", "doc_id").collect()}
        assert set(arrays) == {k for k, _ in rows}
        assert all(sorted(round(v, 9) for v in arrays[k]["values"]) == sorted(w for _, w in e) for k, e in exp.items())


def test_ngram_counts_and_term_statistics(spark):
    rows = [("aa bb aa bb cc",), (None,), ("",), ("aa bb",), ("zz",)]
    d = spark.createDataFrame(rows, "text string")
    exp = Counter(t for (x,) in rows for t in py_terms(x or ""))
    assert {r.term: r["count"] for r in TF.ngram_counts(d, "text").collect()} == exp
    tf = TF.term_frequency(d.withColumn("doc_id", F.lit(1)), "text", "doc_id")
    a, b = ({tuple(r) for r in x.select("term", "df", "ctf").collect()} for x in (TF.document_frequency(tf), TF.term_statistics(d, "text")))
    assert a == b and {t: c for t, _, c in a} == exp


def test_unit_values_do_not_sum_the_norm_for_every_element(spark):
    d = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(5000)))], "doc_id long, text string")
    m = TF.fit_tfidf(d, "text", "doc_id", max_features=20_000, min_df=1)
    import time
    m.sparse_arrays(d, "text", "doc_id").collect()
    t = time.time()
    values = m.sparse_arrays(d, "text", "doc_id").first()["values"]
    assert len(values) == 14997 and abs(sum(x * x for x in values) - 1) < 1e-9 and time.time() - t < 20


def test_stopword_predictions_by_plain_python(spark, tmp_path):
    from lexisift.plans import q_eval as Q
    texts = ["the cat and le chat", "le la les", "der die und", "Que QUE que", "xthe _and", "", None, "ein y zu es", "los las, el"]
    rows = [(i, t, "en") for i, t in enumerate(texts)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))

    def best(text):
        toks = re.findall(r"\w{2,}", (text or "").lower())
        hits = {lang: sum(t in ws for t in toks) for lang, ws in Q.STOPWORDS.items()}
        top = min(hits, key=lambda x: (-hits[x], x))
        return top if hits[top] else "en"

    p = Q.stopword_predictions(spark, str(tmp_path))
    assert sorted((r.key, r.prediction) for r in p.collect()) == sorted((i, best(t)) for i, t, _ in rows)
    assert p._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1     # four passes over the text before

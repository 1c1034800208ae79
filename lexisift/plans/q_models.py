"""Testdata bindings: classifiers (G1-G14) on the balanced documents.

Pipeline as in the reference: clean -> balance (400/class) -> TF-IDF fitted
on the whole balanced table -> stratified 80/20 split -> train -> evaluate,
with the reference's own settings.

Learned numbers of the models other than naive Bayes have no SQL twin; those
queries return facts that SQL can state and the real fit must meet: the test
rows of each label, known class names, an accuracy above the majority's, an
optimality residual near zero, probabilities that sum to one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as M
from ..operators import split as S
from ..operators import tfidf as TF
from ..session import cut_lineage
from .q_features import sql_tf, sql_vocab, sql_weights
from .q_text import SQL_BALANCED, SQL_SPLIT, balanced_table, sql_folds
from .registry import query

MAX_FEATURES = 10000
FOLDS = 5
GRID_C = (0.1, 1.0, 10.0)
KERNELS = ("linear", "rbf")


def feature_table(spark, sf):
    """(doc_id, language, split, indices, values, features), written once."""
    b = balanced_table(spark, sf)
    sp = cut_lineage(S.stratified_split(b, "language", "doc_id", 0.2, 42), "split")
    model = TF.fit_tfidf(b, "clean_code", "doc_id", max_features=MAX_FEATURES, min_df=2)
    arrays = model.sparse_arrays(sp, "clean_code", "doc_id", keep_cols=("language", "split"))
    return TF.vector_table(arrays, model.size), model


def train_rows(arrays):
    return arrays.filter(F.col("split") == "train")


def test_rows(arrays):
    return arrays.filter(F.col("split") == "test")


def trained_on(arrays, tfidf, names, **over):
    return M._fit_only(train_rows(arrays), "language", tfidf.size, M.ModelConfig(models=list(names), **over))


def test_facts(pred):
    """Per label of a predictions table: its rows, and whether the accuracy over
    all rows beats always answering the commonest label."""
    per = pred.groupBy("label").agg(F.count("*").alias("n_test"), F.sum((F.col("label") == F.col("prediction")).cast("long")).alias("hit"))
    total = per.agg(F.sum("hit").alias("hits"), F.max("n_test").alias("most"))
    return per.join(F.broadcast(total)).select("label", "n_test", (F.col("hits") > F.col("most")).alias("beats_majority"))


SQL_FACTS = f"""SELECT language AS label, count(*) AS n_test, TRUE AS beats_majority
FROM ({SQL_SPLIT}) WHERE split = 'test' GROUP BY language"""


def _one(name, **over):
    def run(spark, sf):
        arrays, model = feature_table(spark, sf)
        return trained_on(arrays, model, [name], **over).predict(test_rows(arrays), "doc_id", "language")
    return run


def _nb_parts(src: str, train: str, test: str, test_weights: str) -> str:
    """WITH tables of multinomial naive Bayes (alpha 1): vocabulary and weights
    fitted on ``src``, trained on the rows (doc_id, language) of ``train``,
    scoring the rows (doc_id, label) of ``test`` with their weights."""
    return f"""vocab AS ({sql_vocab(src)}),
w AS ({sql_weights(sql_tf(src), src)}),
trn AS ({train}),
tr AS (SELECT w.doc_id, w.idx, w.w, trn.language FROM w JOIN trn ON w.doc_id = trn.doc_id),
S AS (SELECT language, idx, sum(w) AS s FROM tr GROUP BY language, idx),
Tc AS (SELECT language, sum(w) AS t FROM tr GROUP BY language),
Nc AS (SELECT language, count(*) AS nc FROM trn GROUP BY language),
N AS (SELECT sum(nc) AS n, count(*) AS k FROM Nc),
D AS (SELECT count(*) AS d FROM vocab),
te AS ({test}),
aw AS ({test_weights}),
wsums AS (SELECT doc_id, sum(w) AS wsum FROM aw GROUP BY doc_id),
base AS (SELECT te.doc_id, te.label, Nc.language,
           ln(nc + 1) - ln(n + k) - ln(coalesce(t, 0) + d) * coalesce(wsum, 0) AS b
         FROM te CROSS JOIN Nc CROSS JOIN N CROSS JOIN D
         LEFT JOIN Tc ON Tc.language = Nc.language LEFT JOIN wsums ON wsums.doc_id = te.doc_id),
part AS (SELECT aw.doc_id, S.language, sum(aw.w * ln(S.s + 1)) AS p
         FROM aw JOIN te ON aw.doc_id = te.doc_id JOIN S ON S.idx = aw.idx GROUP BY aw.doc_id, S.language),
score AS (SELECT base.doc_id, base.label, base.language, b + coalesce(p, 0) AS score
          FROM base LEFT JOIN part ON part.doc_id = base.doc_id AND part.language = base.language),
best AS (SELECT doc_id, label, language AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, language) AS rn FROM score) WHERE rn = 1)"""


def sql_nb(train="SELECT doc_id, language FROM sp WHERE split = 'train'",
           test="SELECT doc_id, language AS label FROM sp WHERE split = 'test'", test_weights="SELECT * FROM w") -> str:
    """The twin on the split of the balanced documents; ``best`` has the predictions."""
    return f"WITH sp AS (SELECT doc_id, language, split FROM ({SQL_SPLIT})),\n" + _nb_parts(SQL_BALANCED, train, test, test_weights)


SQL_NB = sql_nb()
SQL_NB_PREDICT = f"""{SQL_NB}
SELECT 'NaiveBayes' AS model, doc_id AS key, label, prediction FROM best"""


@query("naive_bayes_predict", sql=SQL_NB_PREDICT)
def q_naive_bayes_predict(spark, sf):
    return _one("NaiveBayes")(spark, sf)


@query("naive_bayes_theta", sql=f"""{SQL_NB}
SELECT Nc.language, vocab.idx, round(ln(coalesce(S.s, 0) + 1) - ln(coalesce(Tc.t, 0) + d), 6) AS theta
FROM Nc CROSS JOIN vocab CROSS JOIN D LEFT JOIN S ON S.language = Nc.language AND S.idx = vocab.idx
LEFT JOIN Tc ON Tc.language = Nc.language""")
def q_naive_bayes_theta(spark, sf):
    """The fitted matrix is the model's own, k rows on the driver; its cells are
    spread out by Spark."""
    arrays, model = feature_table(spark, sf)
    trained = trained_on(arrays, model, ["NaiveBayes"])
    rows = [(float(c), row.tolist()) for c, row in enumerate(trained.models["NaiveBayes"].theta.toArray())]
    m = spark.createDataFrame(rows, "label_index double, theta array<double>").join(F.broadcast(trained.classes), "label_index")
    return m.select("language", F.posexplode("theta").alias("idx", "theta")).select(
        "language", F.col("idx").cast("long").alias("idx"), F.round("theta", 6).alias("theta"))


@query("train_logistic", sql=f"SELECT *, TRUE AS optimal FROM ({SQL_FACTS})")
def q_train_logistic(spark, sf):
    arrays, model = feature_table(spark, sf)
    trained = trained_on(arrays, model, ["LogisticRegression"])
    rest = M.logistic_residual(trained, train_rows(arrays))
    return test_facts(trained.predict(test_rows(arrays))).withColumn("optimal", F.lit(rest < 1e-3))


def _facts(name, **over):
    def run(spark, sf):
        return test_facts(_one(name, **over)(spark, sf))
    return run


for _q, _name, _over in (("train_svm", "SVM", {}), ("train_svm_linear", "SVM", {"svm_kernel": "linear"}),
                         ("train_random_forest", "RandomForest", {}), ("train_gbt", "GradientBoosting", {})):
    query(_q, sql=SQL_FACTS)(_facts(_name, **_over))


SQL_MODELS = "(VALUES " + ", ".join(f"('{m}')" for m in M.MODEL_NAMES) + ") models(model)"


@query("train_all", sql=f"""{sql_nb(test="SELECT doc_id, language AS label FROM sp WHERE split = 'train'")}
SELECT model, TRUE AS beats_majority,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) FROM best) END AS nb_accuracy
FROM {SQL_MODELS}""")
def q_train_all(spark, sf):
    """All five models; their training accuracy (exact for naive Bayes, above
    the majority's for the others)."""
    arrays, model = feature_table(spark, sf)
    tr = train_rows(arrays)
    _, acc = M.train_all(tr, "language", model.size, M.ModelConfig())
    return _above(acc, "train_accuracy", tr).withColumnRenamed("nb", "nb_accuracy")


def _above(scores, col, rows):
    """(model, beats_majority, nb: the score of naive Bayes) of per-model scores."""
    per = rows.groupBy("language").count()
    most = per.agg((F.max("count") / F.sum("count")).alias("most"))
    return scores.join(F.broadcast(most)).select("model", (F.col(col) > F.col("most")).alias("beats_majority"),
                                                 F.when(F.col("model") == "NaiveBayes", F.round(col, 6)).alias("nb"))


@query("evaluate_all", sql=f"""{SQL_NB}
SELECT model, TRUE AS beats_majority,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) FROM best) END AS nb_accuracy
FROM {SQL_MODELS}""")
def q_evaluate_all(spark, sf):
    arrays, model = feature_table(spark, sf)
    trained = trained_on(arrays, model, M.MODEL_NAMES)
    te = test_rows(arrays)
    _, m = M.evaluate_all(trained, te)
    return _above(m, "accuracy", te).withColumnRenamed("nb", "nb_accuracy")


def _sql_fold_scores(k=FOLDS):
    """Naive Bayes accuracy of every fold of the training rows."""
    src = f"SELECT doc_id, language FROM ({SQL_SPLIT}) WHERE split = 'train'"
    parts = []
    for f in range(k):
        parts.append(f"""SELECT {f} AS fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc FROM (
  WITH folds AS ({sql_folds(src, 'doc_id', k)}),
  {_nb_parts(SQL_BALANCED, f"SELECT doc_id, language FROM folds WHERE fold <> {f}",
             f"SELECT doc_id, language AS label FROM folds WHERE fold = {f}", "SELECT * FROM w")}
  SELECT label, prediction FROM best)""")
    return " UNION ALL ".join(parts)


def _cv(arrays, model):
    folds = cut_lineage(S.stratified_folds(train_rows(arrays), "language", "doc_id", FOLDS), "folds")
    return M.cross_validate(folds, model.size, "language", "fold", FOLDS, M.ModelConfig())


@query("cross_validate", sql=f"""WITH f AS ({_sql_fold_scores()})
SELECT model, {FOLDS} AS folds, TRUE AS beats_majority,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(avg(acc), 6) FROM f) END AS nb_mean,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(stddev_pop(acc), 6) FROM f) END AS nb_std FROM {SQL_MODELS}""")
def q_cross_validate(spark, sf):
    """All five models over five folds."""
    arrays, model = feature_table(spark, sf)
    cv = cut_lineage(_cv(arrays, model), "cv")
    above = _above(cv, "mean_accuracy", train_rows(arrays)).select("model", "beats_majority", F.col("nb").alias("nb_mean"))
    return cv.join(above, "model").select("model", F.size("scores").alias("folds"), "beats_majority", "nb_mean",
                                          F.when(F.col("model") == "NaiveBayes", F.round("std_accuracy", 6)).alias("nb_std"))


@query("grid_search", sql=f"""SELECT kernel, c AS "C", TRUE AS beats_majority
FROM (VALUES {', '.join(f"('{k}')" for k in KERNELS)}) a(kernel), (VALUES {', '.join(f'({c}::DOUBLE)' for c in GRID_C)}) b(c)""")
def q_grid_search(spark, sf):
    arrays, model = feature_table(spark, sf)
    tr = S.stratified_folds(train_rows(arrays), "language", "doc_id", FOLDS)
    g = M.grid_search(cut_lineage(tr, "folds"), model.size, "language", "fold", GRID_C, KERNELS)
    most = train_rows(arrays).groupBy("language").count().agg((F.max("count") / F.sum("count")).alias("most"))
    return g.join(F.broadcast(most)).select("kernel", "C", (F.col("mean_accuracy") > F.col("most")).alias("beats_majority"))


@query("predict_proba", sql=f"""SELECT model, doc_id, len(list(DISTINCT c)) AS n_classes, TRUE AS sums_to_one, TRUE AS in_range
FROM (SELECT model, doc_id FROM {SQL_MODELS}, ({SQL_SPLIT}) WHERE split = 'test') t, (SELECT DISTINCT language AS c FROM ({SQL_SPLIT})) k
GROUP BY model, doc_id""")
def q_predict_proba(spark, sf):
    """Probabilities of all five models (one-vs-rest models by Platt scaling)."""
    arrays, model = feature_table(spark, sf)
    trained = trained_on(arrays, model, M.MODEL_NAMES, platt=True)
    te, out = test_rows(arrays), None
    for name in M.MODEL_NAMES:
        p = trained.predict_proba(te, name).select(
            F.lit(name).alias("model"), "doc_id", F.size("probability").cast("long").alias("n_classes"),
            (F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6).alias("sums_to_one"),
            F.forall("probability", lambda x: (x >= 0) & (x <= 1)).alias("in_range"))
        out = p if out is None else out.unionByName(p)
    return out


@query("train_baseline", sql=f"""{SQL_NB}, f AS ({_sql_fold_scores()})
SELECT model, {FOLDS} AS folds, TRUE AS beats_majority,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) FROM best) END AS nb_accuracy,
  CASE WHEN model = 'NaiveBayes' THEN (SELECT round(avg(acc), 6) FROM f) END AS nb_mean FROM {SQL_MODELS}""")
def q_train_baseline(spark, sf):
    """The whole baseline run from raw documents (clean, balance, split,
    TF-IDF, train, evaluate, 5-fold CV) through ``plans.pipeline``."""
    from .pipeline import preprocess, train_baseline
    from .q_text import docs
    prep = preprocess(docs(spark, sf), "code", "language", "doc_id", classes=None, n_samples_per_class=400)
    _, _, metrics, _, cv = train_baseline(prep, "language", "doc_id", M.ModelConfig(), cv_folds=FOLDS)
    both = cut_lineage(metrics.join(cv, "model").select("model", "accuracy", "mean_accuracy", F.size("scores").alias("folds")), "baseline")
    above = _above(both, "accuracy", test_rows(prep.arrays)).select("model", "beats_majority", F.col("nb").alias("nb_accuracy"))
    return both.join(above, "model").select("model", "folds", "beats_majority", "nb_accuracy",
                                            F.when(F.col("model") == "NaiveBayes", F.round("mean_accuracy", 6)).alias("nb_mean"))

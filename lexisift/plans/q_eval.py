"""Testdata bindings: evaluation (E1-E16) over an engine-neutral predictions
table so that the oracle can rebuild it exactly:

* ``stopwords`` - ``documents``: the language whose stop words occur most
  often (ties: language name; no hit: ``en``);
* ``majority``  - ``documents``: always ``en`` (classes never predicted);
* ``quality``   - ``labels``: ``quality`` as truth, ``1 - toxic`` as guess.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import WORD_TOKEN_PATTERN, word_tokens
from ..operators import classes as K
from ..operators import evaluation as EV
from ..operators.termblocks import blocks
from ..session import spread
from .q_text import docs
from .registry import query, table

# Test fixture (not reference data): a few stop words per language.
STOPWORDS = {
    "en": ["the", "and", "of", "to", "is", "that", "it", "with", "for", "was"],
    "fr": ["le", "la", "les", "et", "des", "est", "une", "que", "dans", "pour"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "mit", "ein", "zu", "den"],
    "es": ["el", "los", "las", "y", "que", "es", "una", "por", "con", "para"],
}
MODEL_ORDER = ["stopwords", "majority", "quality"]
PAIR = ("en", "fr")


def _stopword_languages(batches):
    """The language of most stop words of each row (ties: name; no hit: en)."""
    langs = sorted(STOPWORDS)
    every = sorted({w for ws in STOPWORDS.values() for w in ws})
    of = np.array([[w in STOPWORDS[lang] for lang in langs] for w in every] + [[False] * len(langs)])
    for rest, flat, rows in blocks(batches):
        at = pc.fill_null(pc.index_in(flat, value_set=pa.array(every)), len(every)).to_numpy()
        hits = np.array([np.bincount(rows[of[at, k]], minlength=rest.num_rows) for k in range(len(langs))])
        best = np.where(hits.max(0) > 0, np.array(langs, object)[hits.argmax(0)], "en")
        yield pa.record_batch([*rest.columns, pa.array(best, pa.string())], names=[*rest.schema.names, "prediction"])


def stopword_predictions(spark, sf):
    """Hits are counted in blocks of rows inside the tasks (1-char words are
    never tokens), so there is no explode, join or shuffle."""
    d = docs(spark, sf).transform(lambda x: spread(x, "doc_id"))
    d = d.select(F.col("doc_id").alias("key"), F.col("language").alias("label"), word_tokens("code").alias("_words"))
    schema = T.StructType([*d.drop("_words").schema.fields, T.StructField("prediction", T.StringType())])
    return d.mapInArrow(_stopword_languages, schema).select(F.lit("stopwords").alias("model"), "key", "label", "prediction")


def predictions(spark, sf):
    d = docs(spark, sf)
    major = d.select(F.lit("majority").alias("model"), F.col("doc_id").alias("key"),
                     F.col("language").alias("label"), F.lit("en").alias("prediction"))
    lab = table(spark, sf, "labels").select(
        F.lit("quality").alias("model"), F.col("doc_id").alias("key"),
        F.col("quality").cast("string").alias("label"), (1 - F.col("toxic")).cast("string").alias("prediction"))
    return stopword_predictions(spark, sf).unionByName(major).unionByName(lab)


_SW_VALUES = ", ".join(f"('{w}', '{lang}')" for lang, ws in STOPWORDS.items() for w in ws)
SQL_PRED = f"""sw(word, sw_lang) AS (VALUES {_SW_VALUES}),
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_TOKEN_PATTERN}', 0)) AS word FROM documents),
hits AS (SELECT doc_id, sw_lang, count(*) AS h FROM toks JOIN sw USING (word) GROUP BY doc_id, sw_lang),
best AS (SELECT doc_id, sw_lang FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY h DESC, sw_lang) AS rn FROM hits) WHERE rn = 1),
pred AS (
  SELECT 'stopwords' AS model, d.doc_id AS key, d.lang AS label, coalesce(b.sw_lang, 'en') AS prediction
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
  UNION ALL SELECT 'majority', doc_id, lang, 'en' FROM documents
  UNION ALL SELECT 'quality', doc_id, CAST(quality AS VARCHAR), CAST(1 - toxic AS VARCHAR) FROM labels),
cells AS (SELECT model, label AS actual, prediction AS predicted, count(*) AS cnt FROM pred GROUP BY ALL),
tt AS (SELECT model, actual AS class, sum(cnt) AS support,
         sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) AS tp FROM cells GROUP BY ALL),
pp AS (SELECT model, predicted AS class, sum(cnt) AS n_pred FROM cells GROUP BY ALL),
pc0 AS (SELECT coalesce(tt.model, pp.model) AS model, coalesce(tt.class, pp.class) AS class,
          CAST(coalesce(tp, 0) AS BIGINT) AS tp, CAST(coalesce(n_pred, 0) AS BIGINT) AS n_pred,
          CAST(coalesce(support, 0) AS BIGINT) AS support
        FROM tt FULL OUTER JOIN pp ON tt.model = pp.model AND tt.class = pp.class),
pc1 AS (SELECT *, coalesce(tp / nullif(n_pred, 0), 0.0) AS precision,
          coalesce(tp / nullif(support, 0), 0.0) AS recall FROM pc0),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc1),
m AS (SELECT model, sum(tp) / sum(support) AS accuracy, avg(precision) AS precision_macro,
        avg(recall) AS recall_macro, avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted
      FROM pc GROUP BY model),
nm AS (SELECT model, actual AS class FROM cells UNION SELECT model, predicted FROM cells),
dense AS (SELECT g.model, g.actual, g.predicted, CAST(coalesce(cnt, 0) AS BIGINT) AS cnt
          FROM (SELECT a.model, a.class AS actual, b.class AS predicted FROM nm a JOIN nm b USING (model)) g
          LEFT JOIN cells c ON g.model = c.model AND g.actual = c.actual AND g.predicted = c.predicted),
norm AS (SELECT model, actual, predicted, cnt AS count,
           cnt / nullif(sum(cnt) OVER (PARTITION BY model, actual), 0) AS fraction FROM dense)"""


def _r(c):
    return F.round(c, 6)


@query("eval_accuracy", sql=f"WITH {SQL_PRED} SELECT model, round(accuracy, 6) AS accuracy FROM m")
def q_eval_accuracy(spark, sf):
    return EV.metrics(predictions(spark, sf)).select("model", _r("accuracy").alias("accuracy"))


for _name, _col in [("eval_precision_macro", "precision_macro"), ("eval_recall_macro", "recall_macro"),
                    ("eval_f1_macro", "f1_macro"), ("eval_f1_weighted", "f1_weighted")]:
    def _mk(col):
        def _q(spark, sf):
            return EV.metrics(predictions(spark, sf)).select("model", _r(col).alias(col))
        return _q
    query(_name, sql=f"WITH {SQL_PRED} SELECT model, round({_col}, 6) AS {_col} FROM m")(_mk(_col))


@query("per_class_metrics", sql=f"""WITH {SQL_PRED} SELECT model, class, tp, n_pred, support,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pc""")
def q_per_class_metrics(spark, sf):
    pc = EV.per_class(predictions(spark, sf))
    return pc.select("model", "class", "tp", "n_pred", "support", _r("precision").alias("precision"),
                     _r("recall").alias("recall"), _r("f1").alias("f1"))


@query("model_comparison", sql=f"""WITH {SQL_PRED} SELECT model, round(accuracy, 6) AS accuracy,
  round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro,
  round(f1_macro, 6) AS f1_macro, round(f1_weighted, 6) AS f1_weighted FROM m""")
def q_model_comparison(spark, sf):
    m = EV.model_comparison(predictions(spark, sf))
    return m.select("model", *[_r(c).alias(c) for c in
                               ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]])


@query("best_model", sql=f"""WITH {SQL_PRED} SELECT model, round(accuracy, 6) AS accuracy FROM m
ORDER BY accuracy DESC, CASE model {' '.join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MODEL_ORDER))} END LIMIT 1""")
def q_best_model(spark, sf):
    return EV.best_model(predictions(spark, sf), MODEL_ORDER).select("model", _r("accuracy").alias("accuracy"))


SQL_REPORT = f"""{SQL_PRED},
tot AS (SELECT model, sum(tp) AS tp, sum(support) AS n, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
          sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
          sum(f1 * support) / sum(support) AS wf FROM pc GROUP BY model),
rep AS (
  SELECT model, class AS row, precision, recall, f1, support, 0 AS row_order FROM pc
  UNION ALL SELECT model, 'accuracy', NULL, NULL, tp / n, CAST(n AS BIGINT), 1 FROM tot
  UNION ALL SELECT model, 'macro avg', mp, mr, mf, CAST(n AS BIGINT), 2 FROM tot
  UNION ALL SELECT model, 'weighted avg', wp, wr, wf, CAST(n AS BIGINT), 3 FROM tot)"""


@query("classification_report", sql=f"""WITH {SQL_REPORT}
SELECT model, row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  support, row_order FROM rep""")
def q_classification_report(spark, sf):
    r = EV.classification_report(predictions(spark, sf))
    return r.select("model", "row", _r("precision").alias("precision"), _r("recall").alias("recall"),
                    _r("f1").alias("f1"), "support", "row_order")


@query("confusion_matrix", sql=f"WITH {SQL_PRED} SELECT model, actual, predicted, CAST(cnt AS BIGINT) AS count FROM cells")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(predictions(spark, sf))


@query("confusion_dense", sql=f"WITH {SQL_PRED} SELECT model, actual, predicted, cnt AS count FROM dense")
def q_confusion_dense(spark, sf):
    return EV.confusion_dense(predictions(spark, sf))


@query("confusion_normalized", sql=f"WITH {SQL_PRED} SELECT model, actual, predicted, count, round(fraction, 6) AS fraction FROM norm")
def q_confusion_normalized(spark, sf):
    n = EV.confusion_normalized(predictions(spark, sf))
    return n.select("model", "actual", "predicted", "count", _r("fraction").alias("fraction"))


SQL_ERRORS = """SELECT model, actual, predicted, count, fraction * 100 AS percentage FROM norm
WHERE actual <> predicted AND count > 0"""


@query("confusion_errors", sql=f"WITH {SQL_PRED} SELECT model, actual, predicted, count, round(percentage, 6) AS percentage FROM ({SQL_ERRORS})")
def q_confusion_errors(spark, sf):
    e = EV.confusion_errors(predictions(spark, sf))
    return e.select("model", "actual", "predicted", "count", _r("percentage").alias("percentage"))


@query("top_confusions", sql=f"""WITH {SQL_PRED} SELECT * FROM (
  SELECT model, actual, predicted, count, round(percentage, 6) AS percentage,
    CAST(row_number() OVER (PARTITION BY model ORDER BY count DESC, actual, predicted) AS INTEGER) AS rank
  FROM ({SQL_ERRORS})) WHERE rank <= 15""")
def q_top_confusions(spark, sf):
    t = EV.top_confusions(predictions(spark, sf), 15)
    return t.select("model", "actual", "predicted", "count", _r("percentage").alias("percentage"), "rank")


SQL_OVER = """SELECT model, actual, predicted, fraction * 100 AS percentage FROM norm
WHERE actual <> predicted AND fraction > 0.1"""


@query("confusion_over_threshold", sql=f"WITH {SQL_PRED} SELECT model, actual, predicted, round(percentage, 6) AS percentage FROM ({SQL_OVER})")
def q_confusion_over_threshold(spark, sf):
    o = EV.confusion_over_threshold(predictions(spark, sf), 0.1)
    return o.select("model", "actual", "predicted", _r("percentage").alias("percentage"))


@query("confusion_pair", sql=f"""WITH {SQL_PRED} SELECT model, actual, predicted, round(percentage, 6) AS percentage
FROM ({SQL_OVER}) WHERE actual IN ('{PAIR[0]}', '{PAIR[1]}') AND predicted IN ('{PAIR[0]}', '{PAIR[1]}') AND actual <> predicted""")
def q_confusion_pair(spark, sf):
    o = EV.confusion_over_threshold(predictions(spark, sf), 0.1)
    return K.pair_filter(o, PAIR).select("model", "actual", "predicted", _r("percentage").alias("percentage"))


@query("text_preview", sql="""SELECT doc_id, translate(substring(text, 1, 80), chr(10), ' ') AS preview,
  CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS short_text FROM documents""")
def q_text_preview(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", EV.text_preview("text", 80).alias("preview"), EV.text_ellipsis("text", 100).alias("short_text"))


@query("head_n", sql="SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 5")
def q_head_n(spark, sf):
    return EV.head_n(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 5)

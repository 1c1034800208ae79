"""Testdata bindings: sources (S1-S4, S8) and sinks (K1-K7) as round trips
through files written under the session's checkpoint folder (the cluster's
shared folder; a scratch folder only in local runs)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import classes as K
from ..operators import evaluation as EV
from ..operators import models as M
from ..operators import split as S
from ..operators import tfidf as TF
from ..session import ensure_checkpoint_dir
from ..sources import readers as R
from ..sources import writers as W
from .q_eval import SQL_PRED, SQL_REPORT, predictions
from .q_features import ALL, fitted, sql_tf, sql_weights
from .q_models import SQL_MODELS, SQL_NB, feature_table, sql_nb, test_rows, trained_on
from .q_text import SQL_BALANCED
from .registry import query, table

SQL_DOCS_MD5 = "SELECT md5(text) AS code_md5, lang AS language FROM documents"


def scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}/{name}"


def _snippets(spark, sf):
    return table(spark, sf, "documents").select(F.col("text").alias("code"), F.col("lang").alias("language"))


def _write_text(df, path, header):
    """Lines of text, commas and all, each file under one header line."""
    df.select(F.col("value").alias(header)).write.mode("overwrite").option("header", True).option("sep", "\u0001").csv(path)


def _md5(df):
    return df.select(F.md5("code").alias("code_md5"), "language")


@query("scan_csv_fallback", sql=SQL_DOCS_MD5)
def q_scan_csv_fallback(spark, sf):
    """Four candidates: missing, without the columns, with rows that do not
    parse (passed over only because the whole file is read), and the good one."""
    docs, lone, broken, good = _snippets(spark, sf), scratch(spark, "a.csv"), scratch(spark, "b.csv"), scratch(spark, "c.csv")
    W.write_snapshot_csv(docs.withColumnRenamed("code", "text"), lone)
    _write_text(docs.select(F.concat(F.md5("code"), F.lit(",en,too,many")).alias("value")), broken, "code,language")
    W.write_snapshot_csv(docs, good)
    return _md5(R.scan_csv_fallback(spark, [scratch(spark, "missing.csv"), lone, broken, good]))


@query("scan_csv_split", sql=SQL_DOCS_MD5)
def q_scan_csv_split(spark, sf):
    """The same rows by the reader that splits files with quoted newlines."""
    path = scratch(spark, "code.csv")
    W.write_snapshot_csv(_snippets(spark, sf), path)
    return _md5(R.scan_csv_fallback(spark, [path], split=True))


@query("convert_to_format", sql=SQL_DOCS_MD5)
def q_convert_to_format(spark, sf):
    """The first CSV of a folder tree, here a folder of part files, behind
    files of other kinds and before another CSV."""
    root, out = scratch(spark, "in"), scratch(spark, "canonical.csv")
    table(spark, sf, "pages").select("url").write.text(f"{root}/a/notes")
    W.write_snapshot_csv(_snippets(spark, sf), f"{root}/b/export.csv")
    W.write_snapshot_csv(table(spark, sf, "benchmark"), f"{root}/c/later.csv")
    W.convert_to_format(spark, root, out)
    return _md5(R.read_csv_snippets(spark, out))


@query("scan_jsonl_recursive", sql="""SELECT md5(text) AS code_md5, lang AS language FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL
UNION ALL SELECT md5(text), role FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL""")
def q_scan_jsonl_recursive(spark, sf):
    """Nested folders of JSON lines read through the operator; files without
    the columns and files with another ending give nothing."""
    root, docs = scratch(spark, "jsonl"), _snippets(spark, sf)
    talk = table(spark, sf, "conversations").select(F.col("text").alias("code"), F.col("role").alias("language"), "turn")
    docs.write.json(f"{root}/docs/a")
    talk.write.json(f"{root}/talk/b/c")
    table(spark, sf, "pages").select("url", "html").write.json(f"{root}/pages")
    docs.select(F.to_json(F.struct("code", "language")).alias("value")).write.text(f"{root}/docs/other")
    return _md5(R.scan_jsonl_recursive(spark, root, glob="*.json"))


@query("scan_parquet_checked", sql=SQL_DOCS_MD5)
def q_scan_parquet_checked(spark, sf):
    path = scratch(spark, "export")
    _snippets(spark, sf).write.mode("overwrite").parquet(path)
    bad = R.scan_parquet_checked(spark, scratch(spark, "missing"))
    return _md5(R.scan_parquet_checked(spark, path).unionByName(bad))


#: Endings given to the templates in turn: names, the shifted name, an escaped dollar, and three that are skipped.
TEMPLATE_ENDS = ["$func", "${Class} $param", "$Struct2", "$$ $Interface", " costs $5", " $unknown", "$"]
TEMPLATE_ROWS = 500


def _templates(spark, sf):
    b = table(spark, sf, "benchmark")
    ends = F.array(*(F.lit(x) for x in TEMPLATE_ENDS))
    return b.select(F.concat(F.lit("b"), (F.col("item_id") % 4).cast("string")).alias("language"), F.col("item_id").alias("idx"),
                    F.concat("text", F.lit(" "), F.element_at(ends, (F.col("item_id") % len(TEMPLATE_ENDS) + 1).cast("int"))).alias("template"))


def sql_expanded(n: str) -> str:
    """The rows of the templates for ``n`` rows of each language."""
    return f"""WITH r AS (
  SELECT 'b' || CAST(item_id % 4 AS VARCHAR) AS language, text, item_id % {len(TEMPLATE_ENDS)} AS kind,
         row_number() OVER (PARTITION BY item_id % 4 ORDER BY item_id) - 1 AS idx,
         count(*) OVER (PARTITION BY item_id % 4) AS n_t FROM benchmark),
rows AS (SELECT r.*, i, ['greet', 'process', 'calculate', 'transform', 'handle'][i % 5 + 1] AS f,
           ['User', 'Product', 'Order', 'Item', 'Data'] AS c, ['x', 'value', 'data', 'input', 'item'][i % 5 + 1] AS p
         FROM r JOIN (SELECT unnest(range({n})) AS i) ON r.idx = i % r.n_t WHERE kind < 4)
SELECT md5(text || ' ' || CASE kind WHEN 0 THEN f WHEN 1 THEN c[i % 5 + 1] || ' ' || p WHEN 2 THEN c[(i + 1) % 5 + 1]
                          ELSE '$ ' || c[i % 5 + 1] END) AS code_md5, language FROM rows"""


@query("template_expand", sql=sql_expanded(str(TEMPLATE_ROWS)))
def q_template_expand(spark, sf):
    return _md5(R.template_expand(spark, _templates(spark, sf), n_per_class=TEMPLATE_ROWS))


def _samples_map(spark, sf, per_class=2):
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"), "text")
    first = S.first_per_class(d, "language", "doc_id", per_class)
    per = first.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("l"))
    per = per.select("language", F.transform("l", lambda x: x["text"]).alias("codes"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("language", "codes"))).alias("samples"))


@query("explode_samples", sql="""SELECT md5(text) AS code_md5, lang AS language FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 2""")
def q_explode_samples(spark, sf):
    return _md5(R.explode_samples(_samples_map(spark, sf)))


@query("csv_roundtrip", sql="SELECT doc_id, md5(text) AS code_md5, lang AS language FROM documents")
def q_csv_roundtrip(spark, sf):
    path = scratch(spark, "snapshot.csv")
    W.write_snapshot_csv(table(spark, sf, "documents").select("doc_id", F.col("text").alias("code"),
                                                              F.col("lang").alias("language")), path)
    back = (spark.read.schema("doc_id long, code string, language string").option("header", True)
            .option("multiLine", True).option("escape", '"').csv(path))
    return back.select("doc_id", F.md5("code").alias("code_md5"), "language")


_METRIC_COLS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]


@query("comparison_csv", sql=f"WITH {SQL_PRED} SELECT model, " + ", ".join(f"round({c}, 6) AS {c}" for c in _METRIC_COLS) + " FROM m")
def q_comparison_csv(spark, sf):
    path = scratch(spark, "model_comparison.csv")
    W.write_comparison_csv(EV.metrics(predictions(spark, sf)), path)
    back = spark.read.option("header", True).schema("model string, " + ", ".join(f"{c} double" for c in _METRIC_COLS)).csv(path)
    return back.select("model", *[F.round(c, 6).alias(c) for c in _METRIC_COLS])


SQL_REPORT_TEXT = """lines AS (SELECT model, row_order, row, max(length(row)) OVER (PARTITION BY model) AS w,
  precision, recall, f1, support FROM rep),
txt AS (SELECT model, repeat(' ', max(w)) || '  precision    recall  f1-score   support' || chr(10) || chr(10) ||
  string_agg(CASE WHEN row = 'accuracy' THEN chr(10) ELSE '' END || lpad(row, CAST(w AS INTEGER), ' ') || ' ' ||
    coalesce(lpad(printf('%.2f', precision), 10, ' '), repeat(' ', 10)) || coalesce(lpad(printf('%.2f', recall), 10, ' '), repeat(' ', 10)) ||
    lpad(printf('%.2f', f1), 10, ' ') || printf(' %9d', support), chr(10) ORDER BY row_order, row) || chr(10) AS classification_report
  FROM lines GROUP BY model)"""


@query("report_json", sql=f"""WITH {SQL_REPORT}, {SQL_REPORT_TEXT}
SELECT m.model, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro, round(f1_weighted, 6) AS f1_weighted,
  classification_report FROM m JOIN txt ON m.model = txt.model""")
def q_report_json(spark, sf):
    pred = predictions(spark, sf)
    m = EV.metrics(pred)
    txt = EV.report_text(EV.classification_report(pred))
    rep = m.join(txt, "model").select("model", "accuracy", "f1_macro", "f1_weighted", "classification_report")
    path = scratch(spark, "reports")
    W.write_reports_json(rep, path)
    back = W.load_table_json(spark, path)
    return back.select("model", *[F.round(c, 6).alias(c) for c in ["accuracy", "f1_macro", "f1_weighted"]], "classification_report")


@query("json_roundtrip", sql="SELECT lang AS language, count(*) AS count FROM documents GROUP BY lang")
def q_json_roundtrip(spark, sf):
    from ..operators.classes import class_distribution
    path = scratch(spark, "distribution.json")
    W.save_table_json(class_distribution(_snippets(spark, sf), "language"), path)
    return W.load_table_json(spark, path, "language string, count long")


@query("preproc_roundtrip", sql=f"""SELECT term, round(w, 6) AS w, CAST(item_id AS VARCHAR) AS item FROM (
  {sql_weights(sql_tf('SELECT item_id, text FROM benchmark', 'item_id', 'text'), ALL, 'item_id')})
UNION ALL SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE), 'label' FROM (SELECT DISTINCT lang FROM documents)""")
def q_preproc_roundtrip(spark, sf):
    """Vectoriser and label encoder, saved together and loaded again."""
    docs, m = fitted(spark, sf)
    path = scratch(spark, "preprocessor")
    K.LabelEncoder.fit(docs, "language").save(f"{path}/labels")
    m.save(path)
    loaded, labels = TF.TfidfModel.load(spark, path), K.LabelEncoder.load(spark, f"{path}/labels")
    w = loaded.weights(table(spark, sf, "benchmark"), "text", "item_id") \
        .select("term", F.round("w", 6).alias("w"), F.col("item_id").cast("string").alias("item"))
    names = docs.select("language").distinct()
    back = labels.inverse(labels.transform(names, "language", "label"), "label", "name")
    return w.unionByName(back.select(F.col("name").alias("term"), F.col("label").alias("w"), F.lit("label").alias("item")))


@query("model_roundtrip", sql=f"""{SQL_NB} SELECT model, key, label, prediction, agrees FROM (
  SELECT 'NaiveBayes' AS model, doc_id AS key, label, prediction, TRUE AS agrees FROM best
  UNION ALL SELECT 'SVM', doc_id, label, NULL, TRUE FROM best)""")
def q_model_roundtrip(spark, sf):
    """Naive Bayes and the RFF SVM saved as best models and loaded from the
    folder alone: the same predictions as before (naive Bayes: as in SQL)."""
    arrays, model = feature_table(spark, sf)
    out = None
    for name in ("NaiveBayes", "SVM"):
        trained = trained_on(arrays, model, [name])
        M.evaluate_all(trained, test_rows(arrays))
        loaded = M.load_best(spark, trained.save_best(scratch(spark, "models")))
        old = trained.predict_best(test_rows(arrays)).select("key", F.col("prediction").alias("old"))
        new = loaded.predict_best(test_rows(arrays), "doc_id", "language").join(old, "key")
        shown = F.col("prediction") if name == "NaiveBayes" else F.lit(None).cast("string")
        part = new.select("model", "key", "label", shown.alias("prediction"), (F.col("prediction") == F.col("old")).alias("agrees"))
        out = part if out is None else out.unionByName(part)
    return out


SAMPLE_ROWS = """SELECT doc_id, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 2"""
SQL_MANUAL_NB = f"""{sql_nb(test=f"SELECT doc_id, lang AS label FROM ({SAMPLE_ROWS})",
                           test_weights=sql_weights(sql_tf(SAMPLE_ROWS, 'doc_id', 'text'), SQL_BALANCED))}
SELECT 'NaiveBayes' AS model, round(100 * avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy_pct,
  CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS n_correct, count(*) AS n FROM best"""


def _manual(spark, sf, names):
    """Two raw (uncleaned) texts per language, vectorised with the
    fitted TF-IDF, scored by the models; accuracy in percent."""
    arrays, model = feature_table(spark, sf)
    samples = R.explode_samples(_samples_map(spark, sf))
    samples = samples.withColumn("sample_id", F.xxhash64("language", "position"))
    return M.manual_check(trained_on(arrays, model, names), model, samples, "code", "language", "sample_id", clean=False)[1]


@query("manual_check_nb", sql=SQL_MANUAL_NB)
def q_manual_check_nb(spark, sf):
    return _manual(spark, sf, ["NaiveBayes"]).select("model", F.round("accuracy_pct", 6).alias("accuracy_pct"), "n_correct", "n")


@query("manual_check", sql=f"""SELECT models.model, m.n, TRUE AS percent_of_n,
  CASE WHEN models.model = 'NaiveBayes' THEN m.n_correct END AS nb_correct FROM {SQL_MODELS}, ({SQL_MANUAL_NB}) m""")
def q_manual_check(spark, sf):
    """All five models on the samples."""
    s = _manual(spark, sf, M.MODEL_NAMES)
    share = F.abs(F.col("accuracy_pct") - 100 * F.col("n_correct") / F.col("n")) < 1e-9
    return s.select("model", "n", share.alias("percent_of_n"),
                    F.when(F.col("model") == "NaiveBayes", F.col("n_correct")).alias("nb_correct"))

"""Testdata bindings: whole runs (sources filled, assembled, the main run)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import LANGUAGE_ALIASES, LANGUAGES, sql_map_case
from ..operators import models as M
from ..sources import readers as R
from ..sources import writers as W
from . import pipeline as P
from .q_io import SQL_MANUAL_NB, _md5, _samples_map, _snippets, _templates, _write_text, scratch, sql_expanded
from .q_models import SQL_NB, test_facts
from .q_text import RAW_LABELS, SQL_RAW_LABEL, docs
from .registry import query, table

PER_CLASS = 40
#: Templates for the classes that the snapshot lacks, and one it has.
TEMPLATES = [("java", 0, "class $Class {}"), ("java", 1, "int $param = 1;"), ("rust", 0, "fn $func() {}"), ("sql", 0, "SELECT $$1 FROM $Struct2"),
             ("cpp", 0, "int $func();")]
SQL_NAMES = "['greet', 'process', 'calculate', 'transform', 'handle']"
SQL_CLASSES = "['User', 'Product', 'Order', 'Item', 'Data']"
SQL_SYNTHETIC = f"""SELECT CASE language
    WHEN 'java' THEN CASE WHEN i % 2 = 0 THEN 'class ' || {SQL_CLASSES}[i % 5 + 1] || ' {{}}'
                     ELSE 'int ' || ['x', 'value', 'data', 'input', 'item'][i % 5 + 1] || ' = 1;' END
    WHEN 'rust' THEN 'fn ' || {SQL_NAMES}[i % 5 + 1] || '() {{}}'
    ELSE 'SELECT $1 FROM ' || {SQL_CLASSES}[(i + 1) % 5 + 1] END AS code, language
  FROM (VALUES ('java'), ('rust'), ('sql')) l(language), range({PER_CLASS}) r(i)"""
SQL_KNOWN = "(" + ", ".join(f"'{x}'" for x in LANGUAGES) + ")"


@query("collect_filled", sql=f"""WITH d AS (SELECT text AS code,
  coalesce({sql_map_case(f'lower({SQL_RAW_LABEL})', LANGUAGE_ALIASES)}, lower({SQL_RAW_LABEL})) AS language FROM documents)
SELECT md5(code) AS code_md5, language FROM d WHERE language IN {SQL_KNOWN}
UNION ALL SELECT md5(code), language FROM ({SQL_SYNTHETIC})""")
def q_collect_filled(spark, sf):
    """The snapshot source: alias map, known classes, missing ones filled, and
    the result written as the raw snapshot."""
    raw = F.element_at(F.array(*(F.lit(x) for x in RAW_LABELS)), (F.col("doc_id") % len(RAW_LABELS) + 1).cast("int"))
    path = scratch(spark, "code_data.csv")
    W.write_snapshot_csv(table(spark, sf, "documents").select(F.col("text").alias("code"), raw.alias("language")), path)
    templates = spark.createDataFrame(TEMPLATES, "language string, idx int, template string")
    return _md5(R.collect_data(spark, "kaggle", scratch(spark, "code_snippets.csv"), paths=[scratch(spark, "none.csv"), path],
                               templates=templates, n_per_class=PER_CLASS))


@query("collect_synthetic", sql=sql_expanded("(SELECT count(*) FROM documents)"))
def q_collect_synthetic(spark, sf):
    """No usable snapshot (only one without the columns): all of the synthetic
    source, as many rows of each language as the snapshot has, from the
    templates of a table."""
    d = _snippets(spark, sf)
    other = scratch(spark, "other.csv")
    W.write_snapshot_csv(d.withColumnRenamed("code", "text"), other)
    return _md5(R.collect_data(spark, "kaggle", paths=[other], templates=_templates(spark, sf), n_per_class=d.count()))


@query("assemble_sources", sql="""SELECT md5(text) AS code_md5, 'python' AS language FROM documents WHERE length(text) > 10
UNION ALL SELECT md5(text), l FROM (
  SELECT text, CASE turn % 3 WHEN 0 THEN 'javascript' WHEN 1 THEN 'csharp' END AS l,
    row_number() OVER (PARTITION BY turn % 3 ORDER BY conv_id, turn) AS r FROM conversations) WHERE r = 1 AND l IS NOT NULL""")
def q_assemble_sources(spark, sf):
    """Solutions (whole texts, and a missing and a short one beside each), a
    broken answer file (gives nothing, stops nothing), and the first program of
    each known name of the index, by its position."""
    py, cpp, index = (scratch(spark, x) for x in ("data_python.csv", "data_cpp.csv", "index.csv"))
    d = table(spark, sf, "documents")
    each = F.explode(F.array(F.col("text"), F.lit(None).cast("string"), F.substring("text", 1, 10))).alias("python_solutions")
    W.write_snapshot_csv(d.select(F.lit("t").alias("problem_title"), each), py)
    _write_text(d.select(F.lit("a,b,c").alias("value")), cpp, "Answer,n")
    names = F.element_at(F.array(F.lit("JavaScript"), F.lit("C#"), F.lit("Klingon")), (F.col("turn") % 3 + 1).cast("int"))
    talk = table(spark, sf, "conversations").select(
        names.alias("language_name"), F.col("text").alias("program"), (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("position"))
    W.write_snapshot_csv(talk, index)
    return _md5(R.assemble_sources(spark, py, cpp, index))


@query("run_all", sql=f"""WITH s AS ({SQL_MANUAL_NB}),
p AS ({SQL_NB} SELECT label, prediction FROM best)
SELECT label, count(*) AS n_test, TRUE AS beats_majority, (SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) FROM p) AS accuracy,
  (SELECT n_correct FROM s) AS n_correct, 1 AS n_reports FROM p GROUP BY label""")
def q_run_all(spark, sf):
    """The main run with naive Bayes, from raw documents to the sinks."""
    samples = R.explode_samples(_samples_map(spark, sf)).withColumn("sample_id", F.xxhash64("language", "position"))
    out = scratch(spark, "run")
    got = P.run_all(docs(spark, sf), samples, out, cfg=M.ModelConfig(models=["NaiveBayes"]))
    comparison = spark.read.option("header", True).schema("model string, accuracy double").csv(f"{out}/model_comparison.csv")
    reports = W.load_table_json(spark, f"{out}/reports").agg(F.count("*").cast("int").alias("n_reports"))
    return (test_facts(got["predictions"]).join(F.broadcast(comparison.select(F.round("accuracy", 6).alias("accuracy"))))
            .join(F.broadcast(got["sample_summary"].select("n_correct"))).join(F.broadcast(reports)))

"""Sinks: raw snapshot CSV, per-model JSON reports and the comparison CSV,
JSON save/load of result tables, and MLlib model persistence."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot_csv(df: DataFrame, path: str) -> None:
    """K1: header, quoted fields (newlines and outer blanks are kept), overwrite."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_comparison_csv(metrics: DataFrame, path: str) -> None:
    """K2: one row per model; a missing precision / recall becomes 0."""
    cols = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]
    out = metrics.select("model", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    out.orderBy(F.desc("accuracy"), "model").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_reports_json(reports: DataFrame, path: str) -> None:
    """K3: one JSON document per model (``model, accuracy, f1_macro,
    f1_weighted, classification_report``), one folder per model."""
    reports.write.mode("overwrite").partitionBy("model").json(path)


def save_table_json(df: DataFrame, path: str) -> None:
    """K4: save a result table as JSON lines."""
    df.write.mode("overwrite").json(path)


def load_table_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """K4: load it back (with the schema when given)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def save_model(model, path: str) -> str:
    """K6: any MLlib model / pipeline via its writer (no pickle)."""
    model.write().overwrite().save(path)
    return path


def load_model(loader_cls, path: str):
    """K6: ``loader_cls`` is the model class (e.g. ``NaiveBayesModel``)."""
    return loader_cls.load(path)


def convert_to_format(spark: SparkSession, input_dir: str, output_path: str) -> str | None:
    """The first CSV found under ``input_dir`` (paths sorted, so the
    choice is deterministic) re-written under a canonical name; columns are
    kept as they are.  A folder named ``*.csv``, as Spark writes it, is one CSV
    with all its part files.  ``None`` when there is no CSV."""
    try:          # names only: the content column is not read
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
                 .load(input_dir).select("path"))
        base = input_dir.split("://")[-1].rstrip("/") + "/"
        below = F.instr("path", base) + len(base)
        folder = F.regexp_extract(F.expr("substring(path, below)"), r"^(.*?\.csv)/", 1)
        named = files.withColumn("below", below).withColumn("folder", F.when(F.col("below") > len(base), folder).otherwise(""))
        found = named.agg(F.min(F.when(F.col("folder") != "", F.concat(F.expr("substring(path, 1, below - 1)"), "folder"))
                                .otherwise(F.col("path")))).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    if found is None or found[0] is None:
        return None
    first = found[0]
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(first)
    write_snapshot_csv(df, output_path)
    return first

"""Imports every binding module so the registry is complete."""

from __future__ import annotations

from . import q_eval, q_features, q_io, q_models, q_neural, q_runs, q_stream, q_text  # noqa: F401

#: Queries that fit many full-size models; they come last.
LONG = ("train_gbt", "train_all", "evaluate_all", "predict_proba", "manual_check", "grid_search", "cross_validate", "train_baseline")


def flagship(spark, sf_dir):
    """Top TF-IDF terms per language: clean -> fit -> weights -> summed weight
    per class, best 10 terms per class."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    c, m = q_features.fitted(spark, sf_dir)
    w = m.weights(c).join(c.select("doc_id", "language"), "doc_id")
    per = w.groupBy("language", "term").agg(F.sum("w").alias("weight"))
    # best of each hash part first, so no task ranks a whole class's terms
    part = F.pmod(F.xxhash64("term"), F.lit(64))
    top = lambda *by: F.row_number().over(Window.partitionBy("language", *by).orderBy(F.desc("weight"), "term"))
    some = per.withColumn("part", part).withColumn("rank", top("part")).filter("rank <= 10").drop("part")
    return some.withColumn("rank", top()).filter("rank <= 10")

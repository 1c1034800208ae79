"""Evaluation and error analysis over one predictions table
``(model, key, label, prediction)``.

Everything is an aggregation: per-class counts come from one ``groupBy``
over the predictions (map-side combined), and every later table (metrics,
report, confusion, comparison) is computed from those small per-model,
per-class tables.  Classes of a model are the union of its true and
predicted labels; precision / recall / F1 of a class with no predictions /
no rows / no hits are 0 (``zero_division=0``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _cells(pred: DataFrame, model_col="model", label_col="label", pred_col="prediction") -> DataFrame:
    return (pred.groupBy(model_col, label_col, pred_col).agg(F.count(F.lit(1)).alias("count"))
            .select(F.col(model_col).alias("model"), F.col(label_col).alias("actual"),
                    F.col(pred_col).alias("predicted"), "count"))


def confusion_matrix(pred: DataFrame, model_col="model", label_col="label", pred_col="prediction") -> DataFrame:
    """E7 (long form, non-zero cells): ``model, actual, predicted, count``."""
    return _cells(pred, model_col, label_col, pred_col)


def confusion_matrix_wide(pred: DataFrame, classes: list[str], model_col="model", label_col="label",
                          pred_col="prediction") -> DataFrame:
    """E7 dense: one row per (model, actual), one column per class, zeros
    filled.  ``classes`` is the (bounded) class list."""
    cells = _cells(pred, model_col, label_col, pred_col)
    wide = cells.groupBy("model", "actual").pivot("predicted", classes).agg(F.sum("count"))
    return wide.fillna(0, subset=classes)


def per_class(pred: DataFrame, model_col="model", label_col="label", pred_col="prediction") -> DataFrame:
    """Per model and class: ``tp, n_pred, support, precision, recall, f1``."""
    cells = _cells(pred, model_col, label_col, pred_col)
    # a cell counts for its true and for its predicted class: one aggregate gives both
    n, hit = F.col("count"), F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)
    roles = F.array(F.struct(F.col("actual").alias("class"), n.alias("support"), hit.alias("tp"), F.lit(0).cast("long").alias("n_pred")),
                    F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("tp"), n.alias("n_pred")))
    j = cells.select("model", F.explode(roles).alias("r")).groupBy("model", F.col("r.class").alias("class")).agg(
        *(F.sum(f"r.{c}").alias(c) for c in ("tp", "n_pred", "support")))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    j = j.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return j.withColumn("f1", f1)


def metrics(pred: DataFrame, model_col="model", label_col="label", pred_col="prediction") -> DataFrame:
    """E1-E5 / E12 core: ``model, accuracy, precision_macro, recall_macro,
    f1_macro, f1_weighted``."""
    pc = per_class(pred, model_col, label_col, pred_col)
    return pc.groupBy("model").agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def model_comparison(pred: DataFrame, **kw) -> DataFrame:
    """Metrics sorted by accuracy (desc), then model."""
    return metrics(pred, **kw).orderBy(F.desc("accuracy"), F.asc("model"))


def best_model(pred: DataFrame, model_order: list[str], **kw) -> DataFrame:
    """Highest accuracy; ties go to the model declared first."""
    order = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
    return metrics(pred, **kw).orderBy(F.desc("accuracy"), order).limit(1)


def classification_report(pred: DataFrame, **kw) -> DataFrame:
    """Per-class rows, then ``accuracy``, ``macro avg``, ``weighted avg``
    (``row_order`` keeps the printed order)."""
    pc = per_class(pred, **kw)
    row = lambda name, p, r, f, n, order: F.struct(
        name.alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"), n.alias("support"), F.lit(order).alias("row_order"))
    nul, col, lit = F.lit(None).cast("double"), F.col, F.lit
    weighted = lambda c: (F.sum(col(c) * col("support")) / F.sum("support"))
    # the class rows and the totals of a model leave one aggregate together (k + 3 rows)
    tot = pc.groupBy("model").agg(
        F.collect_list(row(col("class"), col("precision"), col("recall"), col("f1"), col("support"), 0)).alias("per"),
        F.sum("tp").alias("tp"), F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        weighted("precision").alias("wp"), weighted("recall").alias("wr"), weighted("f1").alias("wf"))
    totals = F.array(row(lit("accuracy"), nul, nul, col("tp") / col("n"), col("n"), 1),
                     row(lit("macro avg"), col("mp"), col("mr"), col("mf"), col("n"), 2),
                     row(lit("weighted avg"), col("wp"), col("wr"), col("wf"), col("n"), 3))
    return tot.select("model", F.explode(F.concat("per", totals)).alias("r")).select("model", "r.*")


def report_text(report: DataFrame) -> DataFrame:
    """The report as one text block per model: names right-aligned to the
    longest of them, two decimals (half to even, as Python prints), a blank line
    after the header and before ``accuracy``."""
    wide = Window.partitionBy("model")
    name = F.lpad("row", F.max(F.length("row")).over(wide).cast("int"), " ")
    num = lambda c: F.coalesce(F.lpad(F.format_number(c, 2), 10, " "), F.lit(" " * 10))
    line = F.concat(F.when(F.col("row") == "accuracy", "\n").otherwise(""), name, F.lit(" "), num("precision"), num("recall"),
                    num("f1"), F.format_string(" %9d", "support"))
    head = F.concat(F.lpad(F.lit(""), F.max(F.length("row")).over(wide).cast("int"), " "),
                    F.lit("  precision    recall  f1-score   support\n\n"))
    lines = report.select("model", "row_order", "row", line.alias("line"), head.alias("head"))
    agg = lines.groupBy("model", "head").agg(F.sort_array(F.collect_list(F.struct("row_order", "row", "line"))).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return agg.select("model", F.concat("head", body, F.lit("\n")).alias("classification_report"))


def confusion_dense(pred: DataFrame, **kw) -> DataFrame:
    """E7 (long form, every cell): the k x k cells of each model's classes (true
    or predicted), zeros filled.  The counted cells are written once (k x k rows
    at most), so the predictions are read once."""
    cells = cut_lineage(_cells(pred, **kw), "cells")
    names = cells.select("model", F.col("actual").alias("class")).union(cells.select("model", "predicted")).distinct()
    grid = names.withColumnRenamed("class", "actual").join(names.withColumnRenamed("class", "predicted"), "model")
    return grid.join(cells, ["model", "actual", "predicted"], "left").withColumn("count", F.coalesce("count", F.lit(0)))


def confusion_normalized(pred: DataFrame, **kw) -> DataFrame:
    """Each cell over its (model, actual) row total; null in the row of a
    class without true rows."""
    cells = confusion_dense(pred, **kw)
    row_total = F.sum("count").over(Window.partitionBy("model", "actual"))
    return cells.withColumn("fraction", F.col("count") / F.nullif(row_total, F.lit(0)))


def _errors(pred: DataFrame, **kw) -> DataFrame:
    n = confusion_normalized(pred, **kw)
    return (n.filter((F.col("actual") != F.col("predicted")) & (F.col("count") > 0))
            .select("model", "actual", "predicted", F.col("count").cast("long").alias("count"),
                    (F.col("fraction") * 100).alias("percentage")))


def confusion_errors(pred: DataFrame, **kw) -> DataFrame:
    """Off-diagonal cells with their percentage of the actual row,
    most frequent first (ties: actual, predicted)."""
    return _errors(pred, **kw).orderBy(F.desc("count"), "actual", "predicted")


def top_confusions(pred: DataFrame, k: int = 15, **kw) -> DataFrame:
    """E9 printed view: the first ``k`` errors per model."""
    w = Window.partitionBy("model").orderBy(F.desc("count"), "actual", "predicted")
    return _errors(pred, **kw).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def confusion_over_threshold(pred: DataFrame, threshold: float = 0.1, **kw) -> DataFrame:
    """Off-diagonal cells above ``threshold`` of their row, with
    the model name."""
    n = confusion_normalized(pred, **kw)
    return (n.filter((F.col("actual") != F.col("predicted")) & (F.col("fraction") > threshold))
            .select("model", "actual", "predicted", (F.col("fraction") * 100).alias("percentage")))


def text_preview(c, width: int = 80) -> F.Column:
    """First ``width`` characters with newlines as spaces."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(F.substring(col, 1, width), "\n", " ")


def text_ellipsis(c, width: int = 100) -> F.Column:
    """``width`` characters plus ``...`` when longer."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit("..."))).otherwise(col)


def head_n(df: DataFrame, key_col: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (a top-k, not a scan of everything)."""
    return df.orderBy(key_col).limit(n)

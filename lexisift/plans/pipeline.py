"""End-to-end runs built from the operators (the reference's three entry
points, as Spark jobs).

* :func:`preprocess` - clean -> non-empty -> known classes -> balance ->
  TF-IDF (fitted on the balanced table, or on the train rows) -> split.
* :func:`train_baseline` - preprocess -> train all -> evaluate -> CV on the
  train rows -> comparison; optionally saves the best model.
* :func:`run_all` - the main run: also confusion analysis and sinks.

Each expensive intermediate is written once to the checkpoint folder, so
later jobs (several aggregates, several models) read it instead of
re-running the cleaning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_text
from ..operators import classes as K
from ..operators import evaluation as EV
from ..operators import models as M
from ..operators import split as S
from ..operators import tfidf as TF
from ..session import cut_lineage, release, spread
from ..sources import writers as W


@dataclass
class Prepared:
    arrays: DataFrame          # key, label, split, indices, values, features
    tfidf: TF.TfidfModel
    balanced: DataFrame


def preprocess(df: DataFrame, text_col: str = "code", label_col: str = "language", key_col: str = "doc_id",
               classes=None, n_samples_per_class: int | None = 400, min_samples_per_class: int = 2,
               max_features: int | None = 10000, min_df: int = 2, test_size: float = 0.2,
               seed: int = 42, fit_on: str = "all", keep_intermediate: bool = False) -> Prepared:
    d = spread(df.select(key_col, text_col, label_col), key_col)
    d = K.filter_known_classes(d, label_col, classes) if classes else d       # pushed below cleaning
    c = cut_lineage(K.with_nonempty(d, clean_text(text_col), "clean_code").drop(text_col), "cleaned")
    b = cut_lineage(S.balance_classes(c, label_col, key_col, n_samples_per_class, min_samples_per_class, seed), "balanced")
    sp = cut_lineage(S.stratified_split(b, label_col, key_col, test_size, seed), "split")
    fit_rows = sp if fit_on == "all" else sp.filter(F.col("split") == "train")
    model = TF.fit_tfidf(fit_rows, "clean_code", key_col, max_features=max_features, min_df=min_df)
    arrays = TF.vector_table(model.sparse_arrays(sp, "clean_code", key_col, keep_cols=(label_col, "split")), model.size)
    if not keep_intermediate:           # the feature table holds what later steps read
        for t in (c, sp):
            release(t)
    return Prepared(arrays, model, b)


def train_baseline(prep: Prepared, label_col: str = "language", key_col: str = "doc_id",
                   cfg: M.ModelConfig | None = None, cv_folds: int = 5, save_dir: str | None = None):
    cfg = cfg or M.ModelConfig()
    tr = prep.arrays.filter(F.col("split") == "train")
    te = prep.arrays.filter(F.col("split") == "test")
    trained, train_acc = M.train_all(tr, label_col, prep.tfidf.size, cfg)
    preds, metrics = M.evaluate_all(trained, te, key_col, label_col)
    cv = None
    if cv_folds:
        folds = cut_lineage(S.stratified_folds(tr, label_col, key_col, cv_folds))
        cv = M.cross_validate(folds, prep.tfidf.size, label_col, "fold", cv_folds, cfg)
    if save_dir:
        trained.save_best(save_dir)
    return trained, preds, metrics.orderBy(F.desc("accuracy"), "model"), train_acc, cv


def analyse(preds: DataFrame, pair=("java", "cpp"), threshold: float = 0.1):
    """Confusion analysis tables of the main run."""
    return {
        "confusion": EV.confusion_matrix(preds),
        "errors": EV.confusion_errors(preds),
        "top_errors": EV.top_confusions(preds, 15),
        "over_threshold": EV.confusion_over_threshold(preds, threshold),
        "pair": K.pair_filter(EV.confusion_over_threshold(preds, threshold), pair),
        "comparison": EV.model_comparison(preds),
        "report": EV.report_text(EV.classification_report(preds)),
    }


def run_all(raw: DataFrame, samples: DataFrame, out_dir: str, text_col: str = "code", label_col: str = "language",
            key_col: str = "doc_id", classes=None, n_samples_per_class: int | None = 400, pair=("java", "cpp"),
            cfg: M.ModelConfig | None = None) -> dict[str, DataFrame]:
    """The main run: normalise labels -> preprocess -> train -> evaluate ->
    analyse -> check the samples by hand -> sinks.

    ``raw`` is what :func:`lexisift.sources.readers.collect_data` gave, with a
    key; ``samples`` is (sample_id, text, label).  Written under ``out_dir``:
    the TF-IDF model, the label encoder, the best model, the comparison (CSV)
    and the reports (JSON).  Returns the tables of every step."""
    out_dir = out_dir.rstrip("/")
    prep = preprocess(K.normalize_labels(raw, label_col), text_col, label_col, key_col, classes, n_samples_per_class)
    trained, preds, metrics, train_acc, _ = train_baseline(prep, label_col, key_col, cfg, cv_folds=0, save_dir=f"{out_dir}/models")
    preds = cut_lineage(preds, "predictions")
    found = analyse(preds, pair)
    rows, summary = M.manual_check(trained, prep.tfidf, samples, text_col, label_col, "sample_id")
    prep.tfidf.save(f"{out_dir}/preprocessor")
    K.LabelEncoder.fit(prep.balanced, label_col).save(f"{out_dir}/preprocessor/labels")
    W.write_comparison_csv(metrics, f"{out_dir}/model_comparison.csv")
    W.write_reports_json(metrics.join(found["report"], "model")
                         .select("model", "accuracy", "f1_macro", "f1_weighted", "classification_report"), f"{out_dir}/reports")
    return {**found, "predictions": preds, "metrics": metrics, "train_accuracy": train_acc, "sample_rows": rows,
            "sample_summary": summary, "class_counts": K.class_distribution(prep.balanced, label_col)}

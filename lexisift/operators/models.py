"""Classifiers on TF-IDF features (MLlib), their training loop, prediction
table, cross-validation and grid search.

Mapping of the reference's five models (its settings are the defaults here):

* ``SVM`` - RBF kernel, C=10, gamma="scale": random Fourier features
  (Rahimi & Recht, 2007) of the TF-IDF rows, then one-vs-one machines
  (:mod:`linear`) with votes and pairwise coupled probabilities;
  ``kernel="linear"`` skips the feature map.
* ``RandomForest`` - 200 trees, depth 20, sqrt features, at least five rows to
  split (:mod:`trees`).
* ``LogisticRegression`` - multinomial, C=1 -> ``regParam=1/(C*n)``,
  no standardisation, 1000 iterations (MLlib; over folds :mod:`linear`).
* ``GradientBoosting`` - 100 rounds, depth 5, step 0.1, joint softmax
  (:mod:`trees`).
* ``NaiveBayes`` - multinomial, alpha=1 (MLlib; over folds from class sums).

Cross-validation and grid search fit all folds and settings of a model in one
optimisation over the same blocks of rows.  The feature map of the SVM is a
vectorised ``mapInPandas`` (projection matrix drawn from a seed in each task,
never shipped from the driver).
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, join_small, release
from ..versions import current, save_version
from . import linear, trees
from .blockmodels import BlockModel, blocks_of, fit_folds, fit_with_probabilities, fold_hits
from .classes import class_index
from .evaluation import metrics
from .tfidf import vector_table

MODEL_NAMES = ["SVM", "RandomForest", "LogisticRegression", "GradientBoosting", "NaiveBayes"]


@dataclass
class ModelConfig:
    """Hyper-parameters; defaults are the reference's."""
    svm_c: float = 10.0
    svm_kernel: str = "rbf"
    svm_components: int = 512
    svm_max_iter: int = 200
    svm_tol: float = 1e-3
    rf_trees: int = 200
    rf_depth: int = 20
    rf_min_split: int = 5
    rf_min_instances: int = 1
    lr_c: float = 1.0
    lr_max_iter: int = 1000
    lr_tol: float = 1e-4
    gbt_rounds: int = 100
    gbt_depth: int = 5
    gbt_step: float = 0.1
    nb_alpha: float = 1.0
    seed: int = 42
    parallelism: int = 4
    platt: bool = False
    models: list = field(default_factory=lambda: list(MODEL_NAMES))


# ---------------------------------------------------------------- features --
def with_vectors(arrays: DataFrame, size: int) -> DataFrame:
    """``arrays`` with MLlib vectors in ``features`` (as they are if present)."""
    return arrays if "features" in arrays.columns else vector_table(arrays, size)


def labelled_features(arrays: DataFrame, size: int, label_col: str = "language",
                      classes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, label DOUBLE, features SparseVector, ...) and the class table.
    Classes are indexed alphabetically (``classes`` reused when given); a null
    or unknown label raises."""
    if classes is None:      # k rows, written once and counted: a proven bound
        classes = cut_lineage(class_index(arrays, label_col), "classes")
    out = join_small(with_vectors(arrays, size), classes, label_col, "left", row_bound=classes.count())
    wrong = F.raise_error(F.concat(F.lit("unknown label "), F.coalesce(F.col(label_col), F.lit("null")))).cast("double")
    return out.withColumn("label", F.coalesce("label_index", wrong)).drop("label_index"), classes


def gamma_scale(arrays: DataFrame, size: int) -> float:
    """sklearn's ``gamma='scale'`` = 1 / (d * var(X)) over all n*d entries,
    from distributed sums of the non-zeros."""
    agg = arrays.select(F.count(F.lit(1)).alias("n"),
                        F.sum(F.aggregate("values", F.lit(0.0), lambda a, x: a + x)).alias("s"),
                        F.sum(F.aggregate("values", F.lit(0.0), lambda a, x: a + x * x)).alias("s2")).first()
    cells = float(agg["n"]) * size
    mean = (agg["s"] or 0.0) / cells
    var = (agg["s2"] or 0.0) / cells - mean * mean
    return 1.0 / (size * var) if var > 0 else 1.0


def random_fourier_features(arrays: DataFrame, size: int, gamma: float, components: int = 512,
                            seed: int = 42, out_col: str = "features") -> DataFrame:
    """z(x) = sqrt(2/D) cos(x W + b), W ~ N(0, 2*gamma), b ~ U(0, 2*pi):
    inner products of z approximate the RBF kernel.  Row j of W is drawn from
    the seed (seed, j), only for the columns that a batch uses, so neither the
    driver nor a task ever holds the whole matrix; rows are projected in chunks
    of bounded size."""
    drop = {"indices", "values", out_col}
    in_fields = [f for f in arrays.schema.fields if f.name not in drop]
    schema = T.StructType(in_fields + [T.StructField("_z", T.ArrayType(T.DoubleType()))])
    keep = [f.name for f in in_fields]

    def project(batches):
        b = np.random.default_rng(seed).uniform(0.0, 2.0 * math.pi, size=components)
        sigma, scale = math.sqrt(2.0 * gamma), math.sqrt(2.0 / components)
        for pdf in batches:
            sizes = pdf["indices"].map(len).to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            flat = np.concatenate(pdf["indices"].tolist()).astype(np.int64) if starts[-1] else np.zeros(0, np.int64)
            vals = np.concatenate(pdf["values"].tolist()).astype(np.float64) if starts[-1] else np.zeros(0)
            used, at = np.unique(flat, return_inverse=True)
            w = np.stack([np.random.default_rng([seed, int(j)]).normal(0.0, sigma, components) for j in used]) if len(used) else None
            z, lo = np.zeros((len(pdf), components)), 0
            while lo < len(pdf):
                hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + 8192, side="right")) - 1)
                full = np.flatnonzero(sizes[lo:hi]) + lo
                if len(full):
                    span = slice(starts[lo], starts[hi])
                    z[full] = np.add.reduceat(vals[span, None] * w[at[span]], starts[full] - starts[lo], axis=0)
                lo = hi
            out = pdf[keep].copy()
            out["_z"] = list(scale * np.cos(z + b))
            yield out

    return (arrays.select(*keep, "indices", "values").mapInPandas(project, schema)
            .withColumn(out_col, array_to_vector("_z")).drop("_z"))


# -------------------------------------------------------------- estimators --
BLOCK_MODELS = ("SVM", "RandomForest", "GradientBoosting")


def estimator(name: str, cfg: ModelConfig, n_train: int):
    """The MLlib estimators."""
    if name == "LogisticRegression":
        return LogisticRegression(family="multinomial", regParam=1.0 / (cfg.lr_c * n_train), elasticNetParam=0.0,
                                  standardization=False, maxIter=cfg.lr_max_iter, tol=cfg.lr_tol)
    if name == "NaiveBayes":
        return NaiveBayes(modelType="multinomial", smoothing=cfg.nb_alpha)
    raise ValueError(f"unknown model {name}")


@dataclass
class TrainedModels:
    """G6 result: fitted models (feature map per model) and the class table."""
    models: dict
    classes: DataFrame
    cfg: ModelConfig
    size: int
    gamma: float | None = None
    best_name: str | None = None
    n_classes: int | None = None

    def features_for(self, name: str, arrays: DataFrame) -> DataFrame:
        if name == "SVM" and self.cfg.svm_kernel == "rbf":
            return random_fourier_features(arrays, self.size, self.gamma, self.cfg.svm_components, self.cfg.seed)
        return with_vectors(arrays, self.size)

    def _best(self, name: str | None) -> str:
        """The named model, else the best one; an error before training."""
        if name is None and self.best_name is None:
            raise ValueError("train and evaluate the models first")
        name = name or self.best_name
        if name not in self.models:
            raise ValueError(f"{name} is not trained")
        return name

    def predict(self, arrays: DataFrame, key_col: str = "doc_id", label_col: str | None = "language",
                names=None) -> DataFrame:
        """Predictions of every (named) model, long table ``(model, key,
        label, prediction)`` with class names (index -> name via the class table)."""
        out = None
        for name in names or list(self.models):
            feats = self.features_for(name, arrays)
            p = self.models[self._best(name)].transform(feats)
            lab = F.col(label_col) if label_col else F.lit(None).cast("string")
            part = p.select(F.lit(name).alias("model"), F.col(key_col).alias("key"), lab.alias("label"),
                            F.col("prediction"))
            out = part if out is None else out.unionByName(part)
        names_tbl = self.classes.select(F.col("label_index").alias("prediction"),
                                        F.col(self.classes.columns[0]).alias("_name"))
        # index -> name: one row per class, bounded by the models' output size
        k = self.n_classes if self.n_classes is not None else self.classes.count()
        out = join_small(out, names_tbl, "prediction", "inner", row_bound=k)
        return out.select("model", "key", "label", F.col("_name").alias("prediction"))

    def predict_best(self, arrays: DataFrame, key_col: str = "doc_id", label_col: str | None = None) -> DataFrame:
        """Predictions of the best model; ``ValueError`` before evaluation."""
        return self.predict(arrays, key_col, label_col, [self._best(None)])

    def predict_proba(self, arrays: DataFrame, name: str | None = None, key_col: str = "doc_id",
                      fallback: str = "abs") -> DataFrame:
        """Class probabilities as an array, of the best model by default.
        Pairwise machines fitted without them (``ModelConfig.platt``) give the
        absolute values of their decision values (``"abs"``) or the values'
        softmax (``"softmax"``)."""
        name = self._best(name)
        p = self.models[name].transform(self.features_for(name, arrays))
        if "probability" in p.columns:
            return p.select(key_col, vector_to_array("probability").alias("probability"))
        raw = vector_to_array("rawPrediction")
        if fallback == "abs":
            return p.select(key_col, F.transform(raw, lambda x: F.abs(x)).alias("probability"))
        from ..functions.arrays import softmax
        return p.select(key_col, softmax(raw).alias("probability"))

    def save_best(self, directory: str) -> str:
        """K7: ``baseline_{best}``: the MLlib model, the class table, and the
        parameters that scoring needs (gamma, seed, sizes), as one version."""
        name = self._best(None)
        path = f"{directory.rstrip('/')}/baseline_{name}"
        spark = self.classes.sparkSession
        state = json.dumps({"name": name, "size": self.size, "gamma": self.gamma, "cfg": asdict(self.cfg)})

        def write(folder):
            if name in BLOCK_MODELS:
                self.models[name].save(spark, f"{folder}/model")
            else:
                self.models[name].write().overwrite().save(f"{folder}/model")
            self.classes.write.mode("overwrite").parquet(f"{folder}/classes")
            spark.createDataFrame([(state,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/state")

        return save_version(spark, path, write)


LOADERS = {"LogisticRegression": LogisticRegressionModel, "NaiveBayes": NaiveBayesModel}


def load_best(spark, path: str) -> TrainedModels:
    """A saved best model (its newest whole version), ready to predict."""
    path = current(spark, path)
    state = json.loads(spark.read.text(f"{path}/state").first()[0])
    name, classes = state["name"], spark.read.parquet(f"{path}/classes")
    model = BlockModel.load(spark, f"{path}/model") if name in BLOCK_MODELS else LOADERS[name].load(f"{path}/model")
    return TrainedModels({name: model}, classes, ModelConfig(**state["cfg"]), state["size"], state["gamma"], name, classes.count())


def train_all(train_arrays: DataFrame, label_col: str = "language", size: int = 0,
              cfg: ModelConfig | None = None) -> tuple[TrainedModels, DataFrame]:
    """Fit every configured model on one written training table (vectors
    and label indices are made once); returns the models and ``(model,
    train_accuracy)``."""
    cfg = cfg or ModelConfig()
    trained = _fit_only(train_arrays, label_col, size, cfg)
    preds = trained.predict(train_arrays, label_col=label_col)
    acc = preds.groupBy("model").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("train_accuracy"))
    return trained, acc


def evaluate_all(trained: TrainedModels, test_arrays: DataFrame, key_col: str = "doc_id",
                 label_col: str = "language") -> tuple[DataFrame, DataFrame]:
    """Predictions on the test rows, metrics per model; sets the best
    model (highest accuracy, first declared on ties)."""
    preds = trained.predict(test_arrays, key_col, label_col)
    m = metrics(preds)
    order = F.array_position(F.array(*[F.lit(x) for x in trained.cfg.models]), F.col("model"))
    best = m.orderBy(F.desc("accuracy"), order).first()
    trained.best_name = best["model"] if best else None
    return preds, m


def cross_validate(arrays_with_folds: DataFrame, size: int, label_col: str = "language",
                   fold_col: str = "fold", k: int = 5, cfg: ModelConfig | None = None) -> DataFrame:
    """K-fold accuracy of every model on the given folds: ``model,
    mean_accuracy, std_accuracy (population), scores``.

    All folds of a model are fitted together over the same blocks; the SVM's
    Fourier features take gamma from all rows, not from each fold's."""
    cfg = cfg or ModelConfig()
    folds = list(range(k))
    n, classes, tables = _block_tables(arrays_with_folds, size, label_col, fold_col, cfg, cfg.models)
    n_classes = classes.count()
    cuts = trees.cut_points(tables["tf-idf"][1], size) if {"RandomForest", "GradientBoosting"} & set(cfg.models) else None

    def one(name):
        own = "fourier" if name == "SVM" and cfg.svm_kernel == "rbf" else "tf-idf"
        blocks, _, width = tables[own]
        models = fit_folds(name, blocks, cuts, width, n_classes, folds, cfg)
        # computed here: a row per fold, so the models can go
        return cut_lineage(fold_hits(blocks, {name: dict(zip(folds, models))}), "fold")

    rows = in_threads(one, cfg.models, cfg.parallelism)
    for blocks, _, _ in tables.values():
        release(blocks)
    allf = rows[0]
    for r in rows[1:]:
        allf = allf.unionByName(r)
    allf = allf.select(F.col("name").alias("model"), "fold", (F.col("hits") / F.col("n")).alias("acc"))
    return allf.groupBy("model").agg(
        F.avg("acc").alias("mean_accuracy"), F.stddev_pop("acc").alias("std_accuracy"),
        F.transform(F.sort_array(F.collect_list(F.struct("fold", "acc"))), lambda x: x["acc"]).alias("scores"))


def _block_tables(arrays: DataFrame, size: int, label_col: str, fold_col: str | None, cfg: ModelConfig, names, kernels=None):
    """(rows, classes, {features: (blocks, rows, width)}) of the features that the
    models read: TF-IDF, and Fourier features for the RBF kernel."""
    kernels = kernels or ([cfg.svm_kernel] if "SVM" in names else [])
    classes = cut_lineage(class_index(arrays, label_col), "classes")
    keys = [c for c in arrays.columns if c not in ("indices", "values", "features", label_col, fold_col)]
    rows = arrays.withColumn("_uid", F.xxhash64(*keys) if keys else F.monotonically_increasing_id()).select(
        "_uid", "indices", "values", label_col, *([fold_col] if fold_col else []))
    lab, _ = labelled_features(rows.withColumn("features", F.lit(None)), size, label_col, classes)
    lab = cut_lineage(lab.select("_uid", "indices", "values", "label", *([fold_col] if fold_col else [])), "training")
    n = lab.count()
    tables = {}
    if set(names) - {"SVM"} or "linear" in kernels:
        tables["tf-idf"] = (blocks_of(lab, size, n, "_uid", "label", fold_col), lab, size)
    if "rbf" in kernels:
        z = random_fourier_features(lab, size, gamma_scale(lab, size), cfg.svm_components, cfg.seed)
        tables["fourier"] = (blocks_of(z, cfg.svm_components, n, "_uid", "label", fold_col), z, cfg.svm_components)
    return n, classes, tables


def in_threads(fn, items, n: int) -> list:
    """``fn`` of every item, ``n`` at a time: an iterative fit is a chain of
    small jobs that leaves most of the cluster idle, so several run side by side."""
    with ThreadPoolExecutor(max(1, n)) as pool:
        return list(pool.map(fn, items))


# Rows per training partition: iterative fitters run one job per iteration,
# so tiny partitions cost more in scheduling than in work.
TRAIN_ROWS_PER_PARTITION = 20_000


def right_size(df: DataFrame, n_rows: int) -> DataFrame:
    """Tiny sets in fewer partitions (merged, not shuffled); a set with more
    than ``TRAIN_ROWS_PER_PARTITION`` rows per partition keeps its own."""
    return df.coalesce(max(1, math.ceil(n_rows / TRAIN_ROWS_PER_PARTITION)))


def _fit_only(train_arrays: DataFrame, label_col: str, size: int, cfg: ModelConfig) -> TrainedModels:
    lab, classes = labelled_features(train_arrays, size, label_col)
    n_train = lab.count()
    gamma = gamma_scale(train_arrays, size) if "SVM" in cfg.models and cfg.svm_kernel == "rbf" else None
    trained = TrainedModels({}, classes, cfg, size, gamma, n_classes=classes.count())
    lab = cut_lineage(right_size(lab, n_train), "training")

    key = next((c for c in lab.columns if c not in ("indices", "values", "features", "label", label_col)), label_col)
    # inner folds for the sigmoids of pairwise machines
    inner = F.pmod(F.xxhash64(key), F.lit(5)).cast("int")
    tree_names = {"RandomForest", "GradientBoosting"} & set(cfg.models)
    cuts = trees.cut_points(lab, size) if tree_names else None
    plain = blocks_of(lab, size, n_train, key) if tree_names else None
    k = trained.n_classes

    def fit(name):
        if name == "SVM":
            feats = trained.features_for(name, lab)
            width = cfg.svm_components if cfg.svm_kernel == "rbf" else size
            blocks = blocks_of(feats.withColumn("_inner", inner), width, n_train, key, "label", "_inner")
            model = fit_with_probabilities(blocks, width, k, cfg) if cfg.platt else fit_folds(name, blocks, None, width, k, [None], cfg)[0]
            release(blocks)
            return BlockModel(model, width, k)
        if name in BLOCK_MODELS:
            return BlockModel(fit_folds(name, plain, cuts, size, k, [None], cfg)[0], size, k)
        return estimator(name, cfg, n_train).fit(right_size(lab, n_train))

    trained.models = dict(zip(cfg.models, in_threads(fit, cfg.models, cfg.parallelism)))
    if plain is not None:
        release(plain)
    return trained


def grid_search(train_arrays: DataFrame, size: int, label_col: str = "language", fold_col: str = "fold",
                c_values=(0.1, 1.0, 10.0), kernels=("linear", "rbf"), cfg: ModelConfig | None = None) -> DataFrame:
    """SVM over C x kernel with k-fold accuracy on ``fold_col``: ``kernel, C,
    mean_accuracy``.  All C, folds and class pairs of a kernel are one
    optimisation, and one pass scores the held-out rows of all of them."""
    cfg = cfg or ModelConfig()
    last = train_arrays.agg(F.max(fold_col)).first()[0]
    folds = list(range(int(last) + 1))
    _, classes, tables = _block_tables(train_arrays, size, label_col, fold_col, cfg, ["SVM"], kernels)
    n_classes = classes.count()

    def one(kernel):
        blocks, _, width = tables["fourier" if kernel == "rbf" else "tf-idf"]
        settings = [(c, f) for c in c_values for f in folds]
        models = dict(zip(settings, linear.fit_pairs(blocks, width, n_classes, settings, cfg.svm_max_iter, cfg.svm_tol)))
        hits = fold_hits(blocks, {str(float(c)): {f: models[c, f] for f in folds} for c in c_values})
        return cut_lineage(hits.groupBy("name").agg(F.avg(F.col("hits") / F.col("n")).alias("mean_accuracy")).select(
            F.lit(kernel).alias("kernel"), F.col("name").cast("double").alias("C"), "mean_accuracy"), "grid")

    parts = in_threads(one, kernels, cfg.parallelism)
    for blocks, _, _ in tables.values():
        release(blocks)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def logistic_residual(trained: TrainedModels, arrays: DataFrame, label_col: str = "language") -> float:
    """Largest component of the gradient of the logistic objective (mean
    log-loss plus the ridge term) at the fitted weights, over the training rows:
    near zero only at the optimum."""
    model = trained.models["LogisticRegression"]
    lab, _ = labelled_features(arrays, trained.size, label_col, trained.classes)
    n = lab.count()
    p = model.transform(lab).select("label", "indices", "values", vector_to_array("probability").alias("p"))
    k = trained.n_classes
    err = F.transform("p", lambda x, c: x - (F.col("label") == c).cast("double"))
    cells = p.withColumn("e", err).select("e", F.posexplode(F.arrays_zip("indices", "values")).alias("pos", "x"))
    sums = cells.groupBy(F.col("x.indices").alias("j")).agg(
        *(F.sum(F.get("e", F.lit(c)) * F.col("x.values")).alias(f"g{c}") for c in range(k))).collect()
    grad = np.zeros((k, trained.size))
    for r in sums:                      # at most one row for each column of the model itself
        grad[:, r.j] = [r[f"g{c}"] / n for c in range(k)]
    return float(np.abs(grad + model.coefficientMatrix.toArray() / (trained.cfg.lr_c * n)).max())


def manual_check(trained: "TrainedModels", tfidf, samples: DataFrame, text_col: str = "code",
                 label_col: str = "language", key_col: str = "sample_id", clean: bool = False,
                 names=None) -> tuple[DataFrame, DataFrame]:
    """Score labelled samples with every model.  Texts are vectorised
    raw by default (as the reference does; ``clean=True`` cleans first).
    Returns per-sample rows ``(model, key, label, prediction, correct,
    preview)`` and the summary ``(model, accuracy_pct, n_correct, n)``."""
    from ..functions.cleaning import clean_text
    from .evaluation import text_preview
    s = samples.withColumn("_text", clean_text(text_col) if clean else F.col(text_col))
    arr = tfidf.sparse_arrays(s, "_text", key_col, keep_cols=(label_col,))
    pred = trained.predict(arr, key_col, label_col, names)
    previews = samples.select(F.col(key_col).alias("key"), text_preview(text_col, 80).alias("preview"))
    rows = pred.withColumn("correct", F.col("label") == F.col("prediction")).join(previews, "key", "left")
    summary = rows.groupBy("model").agg(
        (100 * F.avg(F.col("correct").cast("double"))).alias("accuracy_pct"),
        F.sum(F.col("correct").cast("int")).alias("n_correct"),
        F.count(F.lit(1)).alias("n"))
    return rows, summary

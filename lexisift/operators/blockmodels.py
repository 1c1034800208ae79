"""Models fitted over blocks, as DataFrame transformers, and the fits of all
folds at once.

A fitted model (:mod:`linear`, :mod:`trees`) scores blocks; :class:`BlockModel`
puts it on a DataFrame with an Arrow function and saves it.  ``fit_folds`` fits
a model for every held-out fold in one optimisation, ``fold_hits`` scores the
held-out rows of all of them in one pass.
"""

from __future__ import annotations

import io
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear, trees
from .blocks import Block, each, few, from_lists, to_blocks


def with_lists(df: DataFrame, size: int) -> DataFrame:
    """``df`` with ``indices`` and ``values`` (dense ones of its vectors, if it
    has only those)."""
    if "indices" in df.columns and "values" in df.columns:
        return df
    return df.withColumn("indices", F.sequence(F.lit(0), F.lit(size - 1))).withColumn("values", vector_to_array("features"))


def blocks_of(df: DataFrame, size: int, n_rows: int, key_col: str, label_col: str = "label", fold_col: str | None = None) -> DataFrame:
    return to_blocks(few(with_lists(df, size), n_rows), key_col, label_col, fold_col)


@dataclass
class BlockModel:
    """``transform`` adds ``prediction`` (class index), ``rawPrediction`` and,
    if the model has any, ``probability``."""
    model: object
    size: int
    k: int

    @property
    def has_probabilities(self) -> bool:
        return not isinstance(self.model, linear.Pairs) or self.model.sigmoid is not None

    def scores(self, block: Block) -> np.ndarray:
        """(rows, 1 + k or 1 + 2k): the class, raw scores, probabilities."""
        if isinstance(self.model, linear.Pairs):
            parts = [self.model.predict(block)[:, None], self.model.decision(block)]
            return np.column_stack([*parts, self.model.probabilities(block)] if self.has_probabilities else parts)
        p = self.model.probabilities(block)
        return np.column_stack([p.argmax(axis=1), p, p])

    def transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self)
        k = self.k

        @F.arrow_udf("array<double>")
        def scored(indices: pa.Array, values: pa.Array) -> pa.Array:
            s = shared.value.scores(from_lists(indices, values))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.ravel()))

        lists = with_lists(df, self.size)
        out = lists.withColumn("_scores", scored("indices", "values"))
        out = out.withColumn("prediction", F.get("_scores", F.lit(0))).withColumn("rawPrediction", array_to_vector(F.slice("_scores", 2, k)))
        if self.has_probabilities:
            out = out.withColumn("probability", array_to_vector(F.slice("_scores", 2 + k, k)))
        return out.select(*df.columns, "prediction", "rawPrediction", *(["probability"] if self.has_probabilities else []))

    def save(self, spark, path: str) -> None:
        m, arrays = self.model, {}
        kind = type(m).__name__
        if isinstance(m, linear.Pairs):
            arrays = {"w": m.w, "pairs": np.array(m.pairs).reshape(-1, 2), **({"sigmoid": m.sigmoid} if m.sigmoid is not None else {})}
        elif isinstance(m, linear.Softmax):
            arrays = {"w": m.w}
        elif isinstance(m, trees.Ensemble):
            arrays = {"offsets": m.offsets, "cuts": m.cuts, "step": np.array(m.step), **({"start": m.start} if m.start is not None else {}),
                      **{f"tree_{k}": v for k, v in m.trees.__dict__.items()}}
        with io.BytesIO() as f:
            np.savez(f, **arrays)
            data = f.getvalue()
        head = json.dumps({"kind": kind, "size": self.size, "k": self.k})
        spark.createDataFrame([(head, bytearray(data))], "head string, data binary").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "BlockModel":
        row = spark.read.parquet(path).first()
        head = json.loads(row.head)
        with np.load(io.BytesIO(bytes(row.data))) as z:
            a = {k: z[k] for k in z.files}
        if head["kind"] == "Pairs":
            model = linear.Pairs(a["w"], [tuple(map(int, p)) for p in a["pairs"]], head["k"], a.get("sigmoid"))
        elif head["kind"] == "Softmax":
            model = linear.Softmax(a["w"])
        else:
            t = trees.Trees(0, 1)
            t.__dict__.update({k[5:]: v for k, v in a.items() if k.startswith("tree_")})
            model = trees.Ensemble(t, head["k"], a["offsets"], a["cuts"], a.get("start"), float(a["step"]))
        return BlockModel(model, head["size"], head["k"])


@dataclass
class Multinomial:
    """Naive Bayes from class sums."""
    prior: np.ndarray
    theta: np.ndarray

    def probabilities(self, block: Block) -> np.ndarray:
        return linear.softmax(block.times(self.theta.T) + self.prior)

    def predict(self, block: Block) -> np.ndarray:
        return (block.times(self.theta.T) + self.prior).argmax(axis=1)


def fit_multinomial(blocks: DataFrame, size: int, k: int, folds, alpha: float) -> list[Multinomial]:
    """A model per held-out fold: one pass sums each fold's classes, a fold's
    model has the total without them."""
    def run(batches):
        total = {}
        for _, b in each(batches):
            for f in np.unique(b.fold):
                at = np.flatnonzero(b.fold == f)
                part = b.take(at)
                member = np.zeros((len(at), k))
                member[np.arange(len(at)), part.label] = 1
                s = np.vstack([part.transposed_times(member, size), member.sum(axis=0)])
                total[int(f)] = total[int(f)] + s if int(f) in total else s
        for f, s in total.items():
            yield pa.RecordBatch.from_pydict({"f": pa.array([f], pa.int32()), "s": pa.array([s.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        s = sum(np.frombuffer(x.as_py()) for x in table["s"])
        return pa.table({"f": table["f"].slice(0, 1), "s": pa.array([s.tobytes()], pa.binary())})

    schema = "f int, s binary"
    sums = {r.f: np.frombuffer(r.s).reshape(size + 1, k) for r in blocks.mapInArrow(run, schema).groupBy("f").applyInArrow(add, schema).collect()}
    whole, out = sum(sums.values()), []
    for f in folds:
        s = whole - sums.get(f, 0.0)
        n = s[-1]
        out.append(Multinomial(np.log(n + alpha) - np.log(n.sum() + k * alpha),
                               (np.log(np.maximum(s[:-1], 0) + alpha) - np.log(np.maximum(s[:-1], 0).sum(axis=0) + alpha * size)).T))
    return out


def fit_folds(name: str, blocks: DataFrame, cuts, size: int, k: int, folds, cfg) -> list:
    """Models of one kind, one per held-out fold (None: none is)."""
    if name == "NaiveBayes":
        return fit_multinomial(blocks, size, k, folds, cfg.nb_alpha)
    if name == "LogisticRegression":
        return linear.fit_softmax(blocks, size, k, folds, cfg.lr_c, cfg.lr_max_iter, cfg.lr_tol)
    if name == "SVM":
        return linear.fit_pairs(blocks, size, k, [(cfg.svm_c, f) for f in folds], cfg.svm_max_iter, cfg.svm_tol)
    if name == "RandomForest":
        return trees.fit_forests(blocks, cuts, k, folds, cfg.rf_trees, cfg.rf_depth, cfg.rf_min_split, cfg.rf_min_instances, "sqrt", cfg.seed)
    if name == "GradientBoosting":
        return trees.fit_boosting(blocks, cuts, k, folds, cfg.gbt_rounds, cfg.gbt_depth, cfg.gbt_step)
    raise ValueError(f"unknown model {name}")


def fit_with_probabilities(blocks: DataFrame, size: int, k: int, cfg, inner: int = 5) -> linear.Pairs:
    """Pairwise machines whose sigmoids come from inner folds (the blocks'
    folds), all fitted in one optimisation."""
    first, *rest = linear.fit_pairs(blocks, size, k, [(cfg.svm_c, f) for f in [None, *range(inner)]], cfg.svm_max_iter, cfg.svm_tol)
    first.sigmoid = linear.fit_sigmoids(blocks, dict(enumerate(rest)))
    return first


def fold_hits(blocks: DataFrame, models: dict) -> DataFrame:
    """``name, fold, hits, n`` of models {name: {fold held out: model}}, each on
    the rows of its fold, in one pass."""
    shared = blocks.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for _, b in each(batches):
            for name, per in shared.value.items():
                for f, m in per.items():
                    at = np.flatnonzero(b.fold == f)
                    if len(at):
                        part = b.take(at)
                        hit = int((m.predict(part) == part.label).sum())
                        yield pa.RecordBatch.from_pydict({"name": [name], "fold": pa.array([f], pa.int32()), "hits": pa.array([hit], pa.int64()),
                                                          "n": pa.array([len(at)], pa.int64())})

    return blocks.mapInArrow(run, "name string, fold int, hits long, n long").groupBy("name", "fold").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))

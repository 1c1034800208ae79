"""Re-aimed transformer path: fixed-length encodings, batched inference with
a pluggable model, probabilities, and a classifier Spark trains itself
(Word2Vec document vectors -> multilayer perceptron).

Pretrained transformer weights and their sub-word tokenizer are not part of
this package; ``batch_predict`` takes any ``make_predict_fn`` (the loader is
a parameter), and the test binding uses a numpy linear scorer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import encode_ids, word_tokens
from ..session import BROADCAST_BYTES, cut_lineage, join_small
from ..versions import current, save_version
from .classes import class_index
from .termblocks import word_ids


def encode_texts(df: DataFrame, vocab: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
                 max_length: int = 512, vocab_bound: int | None = None) -> DataFrame:
    """T5/H8: word tokens -> ids (``idx + 2`` of the vocabulary, 1 unknown,
    0 padding), truncated and padded to ``max_length``; returns ``key,
    input_ids, attention_mask``.  Truncation happens before the lookup."""
    per = _word_ids(df, vocab, text_col, [key_col], max_length, vocab_bound).groupBy(key_col).agg(F.collect_list("_ids").alias("_l"))
    enc = encode_ids(_merged("_l"), max_length)
    return per.select(key_col, enc["input_ids"].alias("input_ids"), enc["attention_mask"].alias("attention_mask"))


def _merged(lists: str):
    """The ids of a key's rows by position (one row: as they are)."""
    placed = F.flatten(F.transform(lists, lambda ids: F.transform(ids, lambda x, i: F.named_struct(F.lit("pos"), i, F.lit("id"), x))))
    return F.when(F.size(lists) == 1, F.element_at(lists, 1)).otherwise(F.transform(F.sort_array(placed), lambda x: x["id"]))


def _word_ids(df: DataFrame, vocab: DataFrame, text_col: str, cols, max_length: int, vocab_bound: int | None) -> DataFrame:
    """``cols, _ids``: the ids of each row's first ``max_length`` words.  A
    vocabulary with a proven small bound is sent to the tasks; another is joined."""
    words = F.slice(word_tokens(text_col), 1, max_length)
    spark, ids = df.sparkSession, vocab.select("term", (F.col("idx") + 2).cast("int").alias("id"))
    if vocab_bound is not None and vocab_bound * 256 <= BROADCAST_BYTES:
        v = ids.filter("term IS NOT NULL").toArrow()
        if v["term"].nbytes <= BROADCAST_BYTES and len(set(v["term"].to_pylist())) == v.num_rows and not v["id"].null_count:
            small = spark.sparkContext.broadcast((v["term"].to_pylist(), v["id"].to_numpy()))
            schema = T.StructType([*df.select(*cols).schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType()))])
            return df.select(*cols, words.alias("_words")).mapInArrow(word_ids(small, 1), schema)
    # numbered before the words are dealt out
    rows = df.select(*cols, F.monotonically_increasing_id().alias("_row"), words.alias("_words"))
    toks = rows.select(*cols, "_row", F.posexplode_outer("_words").alias("pos", "term"))
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(1)).alias("id")))
    per = join_small(toks, ids, "term", "left").select(*cols, "_row", entry.alias("_e")).groupBy(*cols, "_row").agg(
        F.sort_array(F.collect_list("_e")).alias("_p"))
    return per.select(*cols, F.transform("_p", lambda x: x["id"]).alias("_ids"))


def labelled_records(df: DataFrame, vocab: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
                     label_col: str | None = None, classes: DataFrame | None = None, max_length: int = 512,
                     vocab_bound: int | None = None) -> DataFrame:
    """H8: encodings with the label's index (``labels``) when ``label_col`` is
    given; an unknown label raises."""
    if label_col is None:
        return encode_texts(df, vocab, text_col, key_col, max_length, vocab_bound)
    classes = class_index(df, label_col) if classes is None else classes
    known = df.filter(F.col(key_col).isNotNull()).join(classes, label_col, "left").withColumn(
        "labels", F.coalesce(F.col("label_index").cast("int"), F.raise_error(
            F.concat(F.lit("unknown label "), F.coalesce(label_col, F.lit("null")))).cast("int")))
    per = _word_ids(known, vocab, text_col, [key_col, "labels"], max_length, vocab_bound).groupBy(key_col).agg(
        F.collect_list("_ids").alias("_l"), F.collect_list("labels").alias("_labels"))
    rows = per.select(key_col, _merged("_l").alias("_i"), F.explode("_labels").alias("labels"))
    enc = encode_ids("_i", max_length)
    return rows.select(key_col, enc["input_ids"].alias("input_ids"), enc["attention_mask"].alias("attention_mask"), "labels")


def batch_predict(df: DataFrame, make_predict_fn, input_col: str, dim: int, batch_size: int = 32,
                  out_col: str = "prediction", return_type=T.IntegerType()) -> DataFrame:
    """H1: Arrow-batched inference (``batch_size`` rows per call); the model
    is built once per Python worker by ``make_predict_fn``."""
    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size,
                            input_tensor_shapes=[[dim]])
    return df.withColumn(out_col, udf(F.col(input_col)))


def linear_scorer(weights):
    """A ``make_predict_fn`` for a fixed linear model: argmax of x @ W.T."""
    def make():
        import numpy as np
        w = np.asarray(weights, dtype=np.float64)

        def predict(x):
            return np.argmax(np.asarray(x, dtype=np.float64) @ w.T, axis=1).astype(np.int32)
        return predict
    return make


@dataclass
class EmbeddingClassifier:
    """Fitted pipeline (words -> mean word vector -> perceptron) and its class table."""
    model: PipelineModel
    classes: DataFrame          # language, label_index: one row per class
    text_col: str = "clean_code"

    def predict(self, df: DataFrame, key_col: str = "doc_id", label_col: str | None = "language") -> DataFrame:
        """(model, key, label, prediction) of every row."""
        out = self.model.transform(df.withColumn("_words", word_tokens(self.text_col)))
        names = self.classes.select(F.col("label_index").alias("prediction"), F.col("language").alias("_name"))
        lab = F.col(label_col) if label_col else F.lit(None).cast("string")
        out = out.select(F.col(key_col).alias("key"), lab.alias("label"), "prediction")
        return join_small(out, names, "prediction").select(F.lit("EmbeddingMLP").alias("model"), "key", "label",
                                                           F.col("_name").alias("prediction"))

    def save(self, path: str) -> str:
        def write(folder):
            self.model.write().overwrite().save(f"{folder}/pipeline")
            self.classes.withColumn("text_col", F.lit(self.text_col)).write.mode("overwrite").parquet(f"{folder}/classes")

        return save_version(self.classes.sparkSession, path, write)


def load_embedding_mlp(spark, path: str) -> EmbeddingClassifier:
    """H7: pipeline and class names of a saved classifier (its newest whole version)."""
    path = current(spark, path)
    classes = spark.read.parquet(f"{path}/classes")
    return EmbeddingClassifier(PipelineModel.load(f"{path}/pipeline"), classes.drop("text_col"), classes.first()["text_col"])


def train_embedding_mlp(train: DataFrame, text_col: str = "clean_code", label_col: str = "language",
                        vector_size: int = 16, hidden: int = 16, max_iter: int = 100, seed: int = 42,
                        min_count: int = 5, partitions: int | None = None) -> EmbeddingClassifier:
    """H6: Word2Vec document vectors (mean of word vectors) -> MLP, fitted as
    one MLlib pipeline.  Word vectors are trained in ``partitions`` tasks (one
    per core by default; one pass per partition over the whole text keeps the
    averaged vectors trained), and words of fewer than ``min_count``
    occurrences have none, which bounds the vocabulary MLlib keeps."""
    classes = cut_lineage(class_index(train, label_col).withColumnRenamed(label_col, "language"), "classes")
    k = classes.count()
    data = join_small(train.withColumnRenamed(label_col, "language"), classes, "language", "inner", row_bound=k) \
        .withColumnRenamed("label_index", "label").withColumn("_words", word_tokens(text_col))
    n = partitions or train.sparkSession.sparkContext.defaultParallelism
    w2v = Word2Vec(vectorSize=vector_size, minCount=min_count, seed=seed, inputCol="_words", outputCol="_vec",
                   numPartitions=n, maxIter=n)
    mlp = MultilayerPerceptronClassifier(layers=[vector_size, hidden, int(k)], maxIter=max_iter, seed=seed,
                                         featuresCol="_vec", labelCol="label")
    return EmbeddingClassifier(Pipeline(stages=[w2v, mlp]).fit(data), classes, text_col)


@dataclass
class EmbeddingRun:
    predictions: DataFrame
    metrics: DataFrame
    classes: DataFrame
    path: str | None


def run_embedding_mlp(split: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id", label_col: str = "language",
                      path: str | None = None, **kw) -> EmbeddingRun:
    """H9: train on the rows of split 'train', evaluate on 'test', save."""
    from .evaluation import metrics
    fitted = train_embedding_mlp(split.filter(F.col("split") == "train"), text_col, label_col, **kw)
    pred = fitted.predict(split.filter(F.col("split") == "test"), key_col, label_col)
    if path:
        fitted.save(path)
    return EmbeddingRun(pred, metrics(pred), fitted.classes, path)

"""TF-IDF over word n-grams, in long form ``(key, term, w)`` and as MLlib
sparse vectors.

Semantics (the reference's vectoriser): lower-case word tokens of 2+ word
characters, n-grams ``n_min..n_max`` joined by one space, ``min_df`` on
document frequency, then the ``max_features`` terms of highest corpus count
(ties: term ascending), terms indexed alphabetically, smoothed idf
``ln((1+n)/(1+df)) + 1`` with ``n`` = every fitted row, sublinear tf
``1 + ln(tf)``, L2 norm per row.

Physical plan: n-grams are counted in blocks of rows inside the tasks
(``termblocks``) and the text is never shuffled.  Statistics are a grouped sum
by term, combined before the one shuffle; a bounded vocabulary shuffles only
terms whose bucket of a count table is full enough.  A small vocabulary is sent
to the tasks, which weigh whole rows; a larger one is joined.  Vectors are
written in MLlib's own struct layout and read back as vectors.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import ngrams, word_tokens
from ..session import BROADCAST_BYTES, cut_lineage, ensure_checkpoint_dir, join_small, release
from ..versions import current, save_version
from . import termblocks as B


def term_counts(terms: Column) -> Column:
    """ARRAY<STRUCT<term, tf>> of an array column: sorted, then the length of
    each run.  One-element arrays bind the sorted terms and the runs' ends."""
    def runs(t):
        ends = F.when(F.size(t) > 0, F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: (i == F.size(t)) | (
            F.get(t, i - 1) != F.get(t, i)))).otherwise(F.array().cast("array<int>"))
        return F.element_at(F.transform(F.array(ends), lambda e: F.transform(
            e, lambda i, j: F.struct(F.get(t, i - 1).alias("term"),
                                     (i - F.coalesce(F.get(e, j - 1), F.lit(0))).cast("long").alias("tf")))), 1)
    return F.element_at(F.transform(F.array(F.array_sort(terms)), runs), 1)


def _words(df: DataFrame, text_col: str, *cols) -> DataFrame:
    return df.select(*cols, word_tokens(text_col).alias("_words"))


def _with(df: DataFrame, cols, more: str) -> T.StructType:
    return T.StructType([*df.select(*cols).schema.fields, *T._parse_datatype_string(more).fields])


def term_frequency(df: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
                   n_min: int = 1, n_max: int = 3) -> DataFrame:
    """``(key, term, tf)`` - occurrences of each n-gram in each row."""
    return _words(df, text_col, key_col).mapInArrow(B.frequencies(n_min, n_max), _with(df, [key_col], "term string, tf long"))


def ngram_counts(df: DataFrame, text_col: str = "clean_code", n_min: int = 1, n_max: int = 3) -> DataFrame:
    """T4 over a table: ``(term, count)`` of the n-grams of all rows, counted
    in blocks of rows before the one shuffle."""
    return (_words(df, text_col).mapInArrow(B.totals(n_min, n_max), "term string, count long")
            .repartition("term").groupBy("term").agg(F.sum("count").alias("count")))


def term_statistics(df: DataFrame, text_col: str = "clean_code", n_min: int = 1, n_max: int = 3, chosen=None) -> DataFrame:
    """``document_frequency`` of the term frequencies of ``df``, combined in
    blocks of rows before the shuffle; ``chosen`` flags buckets of hashed
    n-grams, the others are left out."""
    flags = None if chosen is None else df.sparkSession.sparkContext.broadcast(np.packbits(chosen).tobytes())
    return (_words(df, text_col).mapInArrow(B.statistics(n_min, n_max, flags), "term string, df long, ctf long")
            .groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf")))


def frequent_statistics(df: DataFrame, text_col: str, min_df: int, max_features: int, n_min: int, n_max: int) -> DataFrame:
    """:func:`term_statistics` of (at least) all terms that can be among the
    ``max_features`` of highest corpus count, exactly.

    Occurrences are first counted in 2^21 buckets of hashed n-grams, a count
    table of fixed size: a term occurs at most as often as its bucket.  Terms
    of full buckets are then counted themselves.  When the last of the
    ``max_features`` best of them occurs more often than any other bucket, no
    other term can be among the best; else all buckets are counted that reach it."""
    got = (_words(df, text_col).mapInArrow(B.bucket_counts(n_min, n_max), "bucket int, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    load = np.zeros(1 << B.BITS, np.int64)
    load[got["bucket"].to_numpy()] = got["n"].to_numpy()
    least = max(min_df, 1)
    cut = max(least, int(np.partition(load, -max_features)[-max_features]) // 2) if 0 < max_features <= len(load) else least
    while True:
        stats = cut_lineage(term_statistics(df, text_col, n_min, n_max, load >= cut).filter(F.col("df") >= min_df), "stats")
        best = stats.orderBy(F.desc("ctf")).limit(max_features).agg(F.count(F.lit(1)), F.min("ctf")).first()
        last = best[1] if best[0] == max_features else least
        if cut <= least or last >= cut:         # a bucket left out holds fewer than ``cut``
            return stats
        release(stats)
        cut = last


def document_frequency(tf: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """F3 (before the threshold): ``(term, df, ctf)`` = rows containing the
    term and its corpus count.  Partial aggregation makes a hot term cost one
    row per task in the shuffle."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ctf"))


def select_vocabulary(stats: DataFrame, n_docs: int, min_df: int = 2, max_features: int | None = 10000,
                      smooth_idf: bool = True) -> DataFrame:
    """Threshold, top-k by corpus count, alphabetical index, idf.

    The index is a range-partitioned sort, written, plus the sizes of the
    earlier partitions (one number per partition on the driver), so a
    vocabulary of any size is numbered without a single task or Python."""
    kept = stats.filter(F.col("df") >= min_df)
    if max_features is not None:
        kept = kept.orderBy(F.desc("ctf"), F.asc("term")).limit(max_features)
    place = F.monotonically_increasing_id()
    t = cut_lineage(kept.orderBy("term").select("*", F.shiftright(place, 33).alias("_part"),
                                                place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")), "terms")
    sizes = sorted((r[0], r[1]) for r in t.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = stats.sparkSession.createDataFrame(starts, "_part long, _start long")
    idx = t.join(F.broadcast(offsets), "_part").withColumn("idx", F.col("_start") + F.col("_pos"))
    one = F.lit(1.0) if smooth_idf else F.lit(0.0)
    idf = F.log((F.lit(float(n_docs)) + one) / (F.col("df") + one)) + F.lit(1.0)
    return idx.select("term", "idx", F.col("df").cast("long").alias("df"),
                      F.col("ctf").cast("long").alias("ctf"), idf.alias("idf"))


def vector_table(arrays: DataFrame, size: int, out_col: str = "features") -> DataFrame:
    """``arrays`` (indices, values, ...) with a sparse vector column: written
    in the struct layout of MLlib vectors and read back under their type."""
    spark = arrays.sparkSession
    struct = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.col("indices").cast("array<int>").alias("indices"), F.col("values").alias("values"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vectors-{uuid.uuid4().hex}"
    arrays.withColumn(out_col, struct).write.parquet(path)
    schema = T.StructType([*arrays.schema.fields, T.StructField(out_col, VectorUDT())])
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


@dataclass
class TfidfModel:
    """Fitted vocabulary + parameters.  ``vocabulary`` has at most
    ``max_features`` rows: ``term, idx, df, ctf, idf``."""

    vocabulary: DataFrame
    n_docs: int
    size: int
    n_min: int = 1
    n_max: int = 3
    sublinear_tf: bool = True
    max_features: int | None = 10000

    # --------------------------------------------------------- transform --
    def _broadcast(self):
        """The vocabulary as (terms by index, idf) when it is proven small, else None."""
        if self.size * 256 > BROADCAST_BYTES or (self.vocabulary.agg(F.sum(F.octet_length("term"))).first()[0] or 0) > BROADCAST_BYTES:
            return None
        v = self.vocabulary.select("term", "idx", "idf").orderBy("idx").toArrow()
        if not np.array_equal(v["idx"].to_numpy(), np.arange(self.size)):
            return None
        return self.vocabulary.sparkSession.sparkContext.broadcast((v["term"].to_pylist(), v["idf"].to_numpy()))

    def _entries(self, df: DataFrame, text_col: str, key_col: str, keep_cols=()) -> DataFrame:
        """``key, keep_cols, _e``: the (idx, w) of each key in order, before the
        norm.  Under a small vocabulary rows are weighed in blocks and only
        their entries are shuffled; under one of any size, their terms."""
        cols = [key_col, *keep_cols]
        small = self._broadcast()
        if small is not None:
            rows = _words(df, text_col, *cols).mapInArrow(
                B.entries(small, self.n_min, self.n_max, self.sublinear_tf), _with(df, cols, "_e array<struct<idx:int,w:double>>"))
            return rows.groupBy(*cols).agg(F.sort_array(F.flatten(F.collect_list("_e"))).alias("_e"))
        counts = term_counts(ngrams(word_tokens(text_col), self.n_min, self.n_max))
        rows = df.select(*cols, F.explode_outer(counts).alias("_t")).select(*cols, "_t.term", "_t.tf")
        j = join_small(rows, self.vocabulary.select("term", "idx", "idf"), "term", "left")
        raw = (F.lit(1.0) + F.log(F.col("tf").cast("double"))) if self.sublinear_tf else F.col("tf").cast("double")
        e = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx").cast("int").alias("idx"), (raw * F.col("idf")).alias("w")))
        return j.select(*cols, e.alias("_e")).groupBy(*cols).agg(F.sort_array(F.collect_list("_e")).alias("_e"))

    def weights(self, df: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id") -> DataFrame:
        """F7/F8 long form: ``(key, term, idx, w)``, L2-normalised per row;
        terms outside the vocabulary are dropped (a row may have none)."""
        norm = F.sqrt(F.aggregate("_e.w", F.lit(0.0), lambda a, x: a + x * x))
        rows = self._entries(df, text_col, key_col).withColumn("_n", norm)
        rows = rows.select(key_col, "_n", F.explode("_e").alias("_t")).select(
            key_col, F.col("_t.idx").cast("long").alias("idx"), (F.col("_t.w") / F.col("_n")).alias("w"))
        return join_small(rows, self.vocabulary.select("term", "idx"), "idx", row_bound=self.size).select(key_col, "term", "idx", "w")

    def sparse_arrays(self, df: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
                      keep_cols=()) -> DataFrame:
        """Per input row: ``indices`` (sorted) and ``values`` arrays; both
        empty when the row has no kept term."""
        # the norm is bound once: as a column it would be inlined into the lambda and summed for every element
        values = F.transform(F.array(F.sqrt(F.aggregate("_e.w", F.lit(0.0), lambda a, x: a + x * x))),
                             lambda n: F.transform("_e.w", lambda x: x / n))
        return self._entries(df, text_col, key_col, keep_cols).select(
            key_col, *keep_cols, F.col("_e.idx").alias("indices"), F.element_at(values, 1).alias("values"))

    def vectors(self, df: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
                keep_cols=(), out_col: str = "features") -> DataFrame:
        """one MLlib SparseVector per input row (empty when no kept term);
        ``keep_cols`` of the input are carried along."""
        return vector_table(self.sparse_arrays(df, text_col, key_col, keep_cols), self.size, out_col) \
            .select(key_col, *keep_cols, out_col)

    # ------------------------------------------------------- persistence --
    def save(self, path: str) -> None:
        """K5: vocabulary as parquet + parameters as JSON (no pickle), as one version."""
        params = dict(n_docs=self.n_docs, size=self.size, n_min=self.n_min, n_max=self.n_max,
                      sublinear_tf=self.sublinear_tf, max_features=self.max_features)
        spark = self.vocabulary.sparkSession

        def write(folder):
            self.vocabulary.write.mode("overwrite").parquet(os.path.join(folder, "vocabulary"))
            spark.createDataFrame([(json.dumps(params),)], "params string") \
                .coalesce(1).write.mode("overwrite").text(os.path.join(folder, "params"))

        save_version(spark, path, write)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TfidfModel":
        path = current(spark, path)
        params = json.loads(spark.read.text(os.path.join(path, "params")).first()[0])
        return cls(vocabulary=spark.read.parquet(os.path.join(path, "vocabulary")), **params)


def fit_tfidf(df: DataFrame, text_col: str = "clean_code", key_col: str = "doc_id",
              max_features: int | None = 10000, min_df: int = 2, n_min: int = 1, n_max: int = 3,
              sublinear_tf: bool = True, smooth_idf: bool = True) -> TfidfModel:
    """Fit the vocabulary and idf on ``df`` (every row counts in ``n``)."""
    n_docs = df.count()
    if max_features is None or max_features < 1:
        # written: a range sort reads its input twice
        stats = cut_lineage(term_statistics(df, text_col, n_min, n_max).filter(F.col("df") >= min_df), "stats")
    else:
        stats = frequent_statistics(df, text_col, min_df, max_features, n_min, n_max)
    vocab = select_vocabulary(stats, n_docs, min_df, max_features, smooth_idf)
    release(stats)
    return TfidfModel(vocab, n_docs, vocab.count(), n_min, n_max, sublinear_tf, max_features)

"""Testdata bindings: TF-IDF (F1-F9) fitted on all cleaned documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from ..functions import tokens as T
from ..operators import tfidf as TF
from .q_text import SQL_CLEANED_NONEMPTY, SQL_NGRAM_LIST, cleaned
from .registry import query, table

MAX_FEATURES = 10000
MIN_DF = 2


def fitted(spark, sf, max_features=MAX_FEATURES):
    """All cleaned documents, and the TF-IDF fitted on them."""
    c = cleaned(spark, sf)
    return c, TF.fit_tfidf(c, "clean_code", "doc_id", max_features=max_features, min_df=MIN_DF)


def sql_tf(src: str, key: str = "doc_id", text: str = "clean_code") -> str:
    return f"""SELECT {key}, term, count(*) AS tf FROM (
  SELECT {key}, unnest({SQL_NGRAM_LIST}) AS term
  FROM (SELECT {key}, {T.sql_word_tokens(text)} AS t FROM ({src}))) GROUP BY {key}, term"""


def sql_stats(src: str) -> str:
    return f"SELECT term, count(*) AS df, sum(tf) AS ctf FROM ({sql_tf(src)}) GROUP BY term HAVING count(*) >= {MIN_DF}"


def sql_vocab(src: str) -> str:
    return f"""SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx,
  CAST(df AS BIGINT) AS df, CAST(ctf AS BIGINT) AS ctf,
  ln((1 + (SELECT count(*) FROM ({src}))) / (1 + df)) + 1 AS idf
FROM (SELECT * FROM ({sql_stats(src)}) ORDER BY ctf DESC, term LIMIT {MAX_FEATURES})"""


def sql_weights(tf_sql: str, src: str, key: str = "doc_id") -> str:
    """Weights of the rows of ``tf_sql`` under the vocabulary fitted on ``src``."""
    return f"""SELECT {key}, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS w FROM (
  SELECT {key}, tf.term, idx, (1 + ln(tf)) * idf AS w
  FROM ({tf_sql}) tf JOIN ({sql_vocab(src)}) v ON tf.term = v.term)"""


ALL = SQL_CLEANED_NONEMPTY
SQL_TRANSFORM = f"""SELECT item_id, term, round(w, 6) AS w
FROM ({sql_weights(sql_tf('SELECT item_id, text FROM benchmark', 'item_id', 'text'), ALL, 'item_id')})"""


@query("term_frequency", sql=f"SELECT doc_id, term, CAST(tf AS BIGINT) AS tf FROM ({sql_tf(ALL)})")
def q_term_frequency(spark, sf):
    return TF.term_frequency(cleaned(spark, sf), "clean_code", "doc_id")


@query("document_frequency", sql=f"SELECT term, CAST(df AS BIGINT) AS df, CAST(ctf AS BIGINT) AS ctf FROM ({sql_stats(ALL)})")
def q_document_frequency(spark, sf):
    tf = TF.term_frequency(cleaned(spark, sf), "clean_code", "doc_id")
    return TF.document_frequency(tf).filter(F.col("df") >= MIN_DF)


@query("vocabulary_topk", sql=f"SELECT term, ctf, df FROM ({sql_vocab(ALL)})")
def q_vocabulary_topk(spark, sf):
    _, m = fitted(spark, sf)
    return m.vocabulary.select("term", "ctf", "df")


@query("vocabulary_index", sql=f"SELECT term, idx FROM ({sql_vocab(ALL)})")
def q_vocabulary_index(spark, sf):
    _, m = fitted(spark, sf)
    return m.vocabulary.select("term", "idx")


@query("vocabulary_unbounded", sql=f"SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM ({sql_stats(ALL)})")
def q_vocabulary_unbounded(spark, sf):
    """F4 without ``max_features``: every term of two documents, indexed."""
    _, m = fitted(spark, sf, None)
    return m.vocabulary.select("term", "idx")


@query("idf", sql=f"SELECT term, round(idf, 6) AS idf FROM ({sql_vocab(ALL)})")
def q_idf(spark, sf):
    _, m = fitted(spark, sf)
    return m.vocabulary.select("term", F.round("idf", 6).alias("idf"))


@query("tfidf", sql=f"SELECT doc_id, term, round(w, 6) AS w FROM ({sql_weights(sql_tf(ALL), ALL)})")
def q_tfidf(spark, sf):
    c, m = fitted(spark, sf)
    return m.weights(c).select("doc_id", "term", F.round("w", 6).alias("w"))


@query("tfidf_transform", sql=SQL_TRANSFORM)
def q_tfidf_transform(spark, sf):
    _, m = fitted(spark, sf)
    bench = table(spark, sf, "benchmark")
    return m.weights(bench, "text", "item_id").select("item_id", "term", F.round("w", 6).alias("w"))


@query("tfidf_vectors", sql=f"""SELECT d.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS nnz, round(coalesce(s, 0), 6) AS norm2
FROM ({ALL}) d LEFT JOIN (
  SELECT doc_id, count(*) AS n, sum(w * w) AS s FROM ({sql_weights(sql_tf(ALL), ALL)}) GROUP BY doc_id) x ON d.doc_id = x.doc_id""")
def q_tfidf_vectors(spark, sf):
    """Sizes and norms of the vectors themselves, read back as arrays."""
    c, m = fitted(spark, sf)
    v = m.vectors(c).select("doc_id", unwrap_udt("features").alias("v"))
    return v.select("doc_id", F.size("v.indices").alias("nnz"),
                    F.round(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))

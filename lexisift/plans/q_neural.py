"""Testdata bindings: encodings (T5), batched scorer (H1), softmax (H2),
argmax (H3) on ``embeddings``, and the Word2Vec -> MLP classifier (H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import argmax, dot, softmax
from ..operators import neural as N
from ..operators import split as S
from ..session import cut_lineage
from .q_features import ALL, fitted, sql_vocab
from .q_text import SQL_SPLIT, balanced_table
from .q_io import scratch
from .q_models import test_facts
from .registry import query, table

N_CLASSES, DIM = 10, 64


def weight(c: int, j: int) -> float:
    """Fixed scorer weights, exact in binary floating point."""
    return ((c * 7 + j * 13) % 17 - 8) / 8.0


WEIGHTS = [[weight(c, j) for j in range(DIM)] for c in range(N_CLASSES)]


def _logits_col(col="embedding"):
    e = F.col(col).cast("array<double>")
    return F.array(*[dot(e, F.array(*[F.lit(v) for v in row])) for row in WEIGHTS])


def _sql_logits(col="embedding"):
    parts = []
    for row in WEIGHTS:
        lits = ", ".join(repr(v) for v in row)
        parts.append(f"list_dot_product(CAST({col} AS DOUBLE[]), [{lits}]::DOUBLE[])")
    return "[" + ", ".join(parts) + "]"


@query("batch_predict", sql=f"""SELECT vec_id, label, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS prediction
FROM (SELECT vec_id, label, {_sql_logits()} AS l FROM embeddings)""")
def q_batch_predict(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    out = N.batch_predict(e, N.linear_scorer(WEIGHTS), "x", DIM, batch_size=32)
    return out.select("vec_id", "label", "prediction")


@query("softmax", sql=f"""SELECT vec_id, round(list_max(p), 6) AS p_max, round(list_sum(p), 6) AS p_sum FROM (
  SELECT vec_id, list_transform(l, lambda v: exp(v - list_max(l)) / list_sum(list_transform(l, lambda u: exp(u - list_max(l))))) AS p
  FROM (SELECT vec_id, {_sql_logits()} AS l FROM embeddings))""")
def q_softmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", softmax(_logits_col()).alias("p"))
    return e.select("vec_id", F.round(F.array_max("p"), 6).alias("p_max"),
                    F.round(F.aggregate("p", F.lit(0.0), lambda a, v: a + v), 6).alias("p_sum"))


@query("argmax", sql="""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax
FROM embeddings""")
def q_argmax(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", argmax("embedding").alias("argmax"))


SQL_ENCODED = f"""WITH vocab AS ({sql_vocab(ALL)}),
b AS ({ALL}),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(clean_code), '[\\p{{L}}\\p{{N}}_]{{2,}}', 0)) AS term,
        generate_subscripts(regexp_extract_all(lower(clean_code), '[\\p{{L}}\\p{{N}}_]{{2,}}', 0), 1) - 1 AS pos FROM b),
ids AS (SELECT t.doc_id, t.pos, coalesce(v.idx + 2, 1) AS id FROM t LEFT JOIN vocab v ON t.term = v.term WHERE t.pos < 512),
per AS (SELECT doc_id, list(id ORDER BY pos) AS l FROM ids GROUP BY doc_id),
enc AS (SELECT b.doc_id, CAST(coalesce(len(l), 0) AS INTEGER) AS n_tokens,
  md5(array_to_string(list_concat(coalesce(l, []), list_transform(range(512 - coalesce(len(l), 0)), lambda x: 0)), ',')) AS ids_md5
  FROM b LEFT JOIN per ON b.doc_id = per.doc_id)"""


def _digest(enc, *more):
    return enc.select("doc_id", F.aggregate("attention_mask", F.lit(0), lambda a, v: a + v).alias("n_tokens"),
                      F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_md5"), *more)


@query("encode_fixed_length", sql=f"{SQL_ENCODED} SELECT doc_id, n_tokens, ids_md5 FROM enc")
def q_encode_fixed_length(spark, sf):
    b, m = fitted(spark, sf)
    return _digest(N.encode_texts(b, m.vocabulary, "clean_code", "doc_id", 512, vocab_bound=m.max_features))


@query("labelled_records", sql=f"""{SQL_ENCODED},
names AS (SELECT language, CAST(row_number() OVER (ORDER BY language) - 1 AS INTEGER) AS labels FROM (SELECT DISTINCT language FROM b))
SELECT enc.doc_id, n_tokens, ids_md5, labels FROM enc JOIN b ON enc.doc_id = b.doc_id JOIN names ON names.language = b.language""")
def q_labelled_records(spark, sf):
    """H8: the encodings with the index of each row's label."""
    b, m = fitted(spark, sf)
    return _digest(N.labelled_records(b, m.vocabulary, "clean_code", "doc_id", "language", max_length=512,
                                      vocab_bound=m.max_features), "labels")


@query("train_embedding_mlp", sql=f"""SELECT language AS label, count(*) AS n_test, TRUE AS known_classes, TRUE AS beats_majority,
  TRUE AS reload_agrees FROM ({SQL_SPLIT}) WHERE split = 'test' GROUP BY language""")
def q_train_embedding_mlp(spark, sf):
    """H6, H7, H9: trained on the training rows, evaluated on the test rows, saved
    and loaded again; test counts per label and checked facts of the real fit."""
    sp = cut_lineage(S.stratified_split(balanced_table(spark, sf), "language", "doc_id", 0.2, 42), "split")
    run = N.run_embedding_mlp(sp, path=scratch(spark, "embedding"))
    pred = cut_lineage(run.predictions, "predictions")
    again = N.load_embedding_mlp(spark, run.path).predict(sp.filter(F.col("split") == "test"))
    other = pred.join(again.select("key", F.col("prediction").alias("p2")), "key").filter("NOT prediction <=> p2").limit(1).count()
    known = pred.join(run.classes, pred.prediction == run.classes.language, "left_anti").limit(1).count()
    return test_facts(pred).select("label", "n_test", F.lit(known == 0).alias("known_classes"), "beats_majority",
                                   F.lit(other == 0).alias("reload_agrees"))

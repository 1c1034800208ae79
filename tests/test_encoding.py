"""Fixed-length encodings: both kinds of vocabulary, rows that share a key."""

import pytest

from lexisift.operators import neural as N


def test_encodings_of_repeated_and_null_keys(spark):
    vocab = spark.createDataFrame([("aa", 0), ("bb", 1), ("aa bb", 2)], "term string, idx long")
    d = spark.createDataFrame([(1, "aa zz bb aa", "x"), (2, None, "y"), (3, "bb", "x"), (3, "aa aa", "y"), (None, "aa", "x")],
                              "doc_id long, clean_code string, language string")
    exp = {1: [2, 1, 3, 2], 2: [0] * 4, 3: [2, 3, 2, 0], None: [2, 0, 0, 0]}
    for bound in (3, None):
        got = {r.doc_id: r.input_ids for r in N.encode_texts(d, vocab, max_length=4, vocab_bound=bound).collect()}
        assert got == exp
        rows = N.labelled_records(d, vocab, label_col="language", max_length=4, vocab_bound=bound).collect()
        assert sorted((r.doc_id, r.input_ids, r.labels) for r in rows) == [
            (1, exp[1], 0), (2, exp[2], 1), (3, exp[3], 0), (3, exp[3], 1)]
    with pytest.raises(Exception, match="unknown label null"):
        N.labelled_records(d.selectExpr("doc_id", "clean_code", "nullif(language, 'y') AS language"), vocab,
                           label_col="language", classes=spark.createDataFrame([("x", 0.0)], "language string, label_index double")).collect()


def test_labelled_records_shuffles_texts_once(spark):
    vocab = spark.createDataFrame([("aa", 0)], "term string, idx long")
    d = spark.createDataFrame([(1, "aa", "x")], "doc_id long, clean_code string, language string")
    classes = spark.createDataFrame([("x", 0.0)], "language string, label_index double")
    plan = N.labelled_records(d, vocab, label_col="language", classes=classes, vocab_bound=1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Join") == 1

"""End-to-end: the preprocess plan's invariants, and the streaming scorer
giving the same predictions as the batch path."""

from collections import Counter

from pyspark.sql import functions as F

from lexisift.operators import models as M
from lexisift.plans.pipeline import preprocess
from lexisift.streaming.scoring import score_stream

from conftest import SF_SMALL


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        "doc_id", F.col("text").alias("code"), F.col("lang").alias("language"))


def test_preprocess_invariants(spark):
    prep = preprocess(_docs(spark), n_samples_per_class=30, max_features=500)
    rows = prep.arrays.collect()
    per_class = Counter(r.language for r in rows)
    smallest = min(Counter(r.language for r in _docs(spark).collect()).values())
    assert set(per_class.values()) == {max(min(30, smallest), 2)}   # exact balance at the A4 target
    assert len({r.doc_id for r in rows}) == len(rows)
    split = Counter(r.split for r in rows)
    assert split["test"] == -(-len(rows) * 2 // 10)             # ceil(0.2 n)
    for r in rows:
        if r.values:
            assert abs(sum(v * v for v in r.values) - 1.0) < 1e-9
            assert list(r.indices) == sorted(r.indices) and max(r.indices) < prep.tfidf.size


def test_stream_equals_batch(spark, tmp_path):
    prep = preprocess(_docs(spark), n_samples_per_class=30, max_features=500)
    trained, _ = M.train_all(prep.arrays.filter("split = 'train'"), "language", prep.tfidf.size,
                             M.ModelConfig(models=["NaiveBayes"]))
    src = tmp_path / "incoming"
    raw = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    raw.filter("doc_id % 2 = 0").write.parquet(str(src / "a"))
    raw.filter("doc_id % 2 = 1").write.parquet(str(src / "b"))
    sink = str(tmp_path / "scored")
    for _ in range(2):                 # the second run has nothing left to score
        q = score_stream(spark, str(src / "*"), raw.schema, prep.tfidf, trained, sink, "NaiveBayes",
                         text_col="text", key_col="doc_id")
        q.awaitTermination()
    assert spark.read.parquet(f"{sink}/scores").count() == raw.count()
    streamed = {r.doc_id: r.prediction for r in spark.read.parquet(f"{sink}/scores").collect()}
    from lexisift.functions.cleaning import clean_text
    batch_in = raw.withColumn("_text", clean_text("text"))
    arrays = prep.tfidf.sparse_arrays(batch_in, "_text", "doc_id")
    batch = {r.key: r.prediction for r in trained.predict(arrays, "doc_id", None, names=["NaiveBayes"]).collect()}
    assert streamed == batch and len(streamed) == raw.count()


def test_release_written_table(spark):
    from lexisift.session import cut_lineage, release
    t = cut_lineage(spark.range(10), "scratch")
    files = t.inputFiles()
    assert files
    release(t)
    import os
    assert not any(os.path.exists(f.replace("file:", "")) for f in files)
    release(spark.range(3))            # not a written table: left alone


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from lexisift.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_best_model_api_and_platt(spark, tmp_path):
    import pytest
    prep = preprocess(_docs(spark), n_samples_per_class=20, max_features=300)
    tr = prep.arrays.filter("split = 'train'")
    cfg = M.ModelConfig(models=["SVM"], svm_components=64, platt=True)
    trained, _ = M.train_all(tr, "language", prep.tfidf.size, cfg)
    with pytest.raises(ValueError):
        trained.predict_best(prep.arrays)
    with pytest.raises(ValueError):
        trained.predict_proba(prep.arrays)
    M.evaluate_all(trained, prep.arrays.filter("split = 'test'"))
    old = {r.key: r.prediction for r in trained.predict_best(prep.arrays).collect()}
    loaded = M.load_best(spark, trained.save_best(str(tmp_path)))
    assert {r.key: r.prediction for r in loaded.predict_best(prep.arrays).collect()} == old
    names = [r[0] for r in loaded.classes.orderBy("label_index").collect()]
    rows = loaded.predict_proba(prep.arrays).collect()
    assert all(abs(sum(r.probability) - 1) < 1e-9 and min(r.probability) >= 0 for r in rows)
    agree = sum(names[max(range(len(names)), key=lambda i: r.probability[i])] == old[r.doc_id] for r in rows)
    assert agree >= 0.9 * len(rows)


def test_random_fourier_features_approximate_the_kernel(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(i, sorted(rng.choice(50, 6, replace=False).tolist()), rng.random(6).tolist()) for i in range(12)] + [(12, [], [])]
    df = spark.createDataFrame(rows, "k long, indices array<int>, values array<double>")
    z = {r.k: r.features.toArray() for r in M.random_fourier_features(df, 50, 0.3, 4096, 1).collect()}
    x = np.zeros((13, 50))
    for k, idx, val in rows:
        x[k, idx] = val
    for a in range(13):
        for b in range(13):
            assert abs(z[a] @ z[b] - np.exp(-0.3 * ((x[a] - x[b]) ** 2).sum())) < 0.1


def test_stream_score_reads_a_file_and_a_folder(spark, tmp_path):
    from lexisift.plans.q_stream import q_stream_score
    words = {"en": "the house and the garden", "fr": "la maison et le jardin"}
    rows = [(i, f"{words[lang]} number{i % 7} word{i % 5}", lang, "s") for i in range(40) for lang in [("en", "fr")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = []
    for name, parts in (("file", 1), ("folder", 3)):
        path = tmp_path / name / "documents.parquet"
        docs.repartition(parts).write.parquet(str(path))
        if name == "file":
            part = next(path.glob("part-*"))
            path = tmp_path / "one" / "documents.parquet"
            path.parent.mkdir()
            path.write_bytes(part.read_bytes())
        got.append(sorted(tuple(r) for r in q_stream_score(spark, str(path.parent)).collect()))
    assert got[0] == got[1] and [r[0] for r in got[0]] == list(range(40))
    assert all(p == rows[i][2] for i, p in got[0])

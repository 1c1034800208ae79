"""Saves that break off, follow each other and are cleaned up."""

import pytest

from lexisift import versions as V
from lexisift.operators import tfidf as TF


def model(spark, n):
    d = spark.createDataFrame([(i, f"alpha beta w{i % n} w{i % n}") for i in range(12)], "doc_id long, clean_code string")
    return TF.fit_tfidf(d, min_df=1)


def test_a_broken_save_leaves_the_former_model(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    old, new = model(spark, 2), model(spark, 5)
    old.save(path)
    # the vocabulary is written, the parameters are not
    monkeypatch.setattr(TF.json, "dumps", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        new.save(path)
    monkeypatch.undo()
    back = TF.TfidfModel.load(spark, path)
    assert back.size == old.size and sorted(back.vocabulary.collect()) == sorted(old.vocabulary.collect())
    new.save(path)
    assert TF.TfidfModel.load(spark, path).size == new.size != old.size
    assert V.prune(spark, path) == 1 and V.prune(spark, path) == 0
    assert TF.TfidfModel.load(spark, path).size == new.size


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        V.current(spark, path)
    seen = []
    for k in range(3):
        V.save_version(spark, path + "/", lambda f, k=k: (seen.append(f), spark.range(k + 1).write.parquet(f)))
        assert V.current(spark, path) == seen[-1] and spark.read.parquet(V.current(spark, path)).count() == k + 1
    assert [r.seq for r in V.commits(spark, path).orderBy("seq").collect()] == [0, 1, 2]
    # a folder without a commit is nobody's
    spark.range(9).write.parquet(f"{path}/v-zzz")
    assert V.current(spark, path) == seen[-1]
    assert V.prune(spark, path, keep=2) == 1

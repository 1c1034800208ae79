"""Label filters, class aggregates and the exact per-class rank / sample /
split / folds against brute force."""

import math
from collections import Counter, defaultdict

import hashlib
import pytest
from pyspark.sql import functions as F

from lexisift.functions.labels import LANGUAGES
from lexisift.operators import classes as K
from lexisift.operators import split as S

from conftest import SF_MED


def test_normalize_and_tags(spark):
    df = spark.createDataFrame([("C++",), ("JS",), ("Golang",), ("CSS",), ("Kotlin",), (None,)], "language string")
    got = [r.language for r in K.normalize_labels(df).collect()]
    assert got == ["cpp", "javascript", "go", "htmlcss", "kotlin", None]
    tags = spark.createDataFrame([("c-plus-plus",), ("html-css",), ("perl",)], "tag string")
    assert [r.language for r in K.map_tags(tags).collect()] == ["cpp", "htmlcss"]


def test_known_classes_and_min_length(spark):
    df = spark.createDataFrame([("python", "x" * 11), ("perl", None), (None, "y" * 20), ("sql", "short")],
                               "language string, code string")
    assert K.filter_known_classes(df).count() == 2          # null label never passes
    assert {r.language for r in K.filter_min_length(df, "code", 10).collect()} == {"python", None}
    assert set(LANGUAGES) == {"python", "javascript", "java", "cpp", "go", "rust", "sql", "htmlcss"}


def test_drop_rare_raises_when_nothing_left(spark):
    df = spark.createDataFrame([("a",), ("b",)], "language string")
    with pytest.raises(ValueError):
        K.drop_rare_classes(df, "language", 2)
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "language string")
    assert K.drop_rare_classes(df, "language", 2).count() == 2


def _skewed(spark):
    """One hot class holding most rows plus small ones."""
    rows = [(i, "hot" if i % 10 < 7 else f"c{i % 3}") for i in range(3000)]
    return spark.createDataFrame(rows, "k long, label string")


def _md5(s):
    return hashlib.md5(s.encode()).hexdigest()


@pytest.mark.parametrize("rows_per_bucket", [100_000, 7])
def test_cut_classes_equals_row_number(spark, rows_per_bucket, monkeypatch):
    """Segments by ranks in hash order, whole buckets and cut buckets alike."""
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", rows_per_bucket)
    df, h = _skewed(spark), S.seeded_hash("k", 9)
    cuts = {"hot": [0, 3, 700, 701], "c0": [300], "c1": [1, 299], "c2": []}
    table = spark.createDataFrame(list(cuts.items()), "label string, cuts array<long>")
    bucket = S.hash_bucket(h, S.bucket_count(2100))
    got = {r.k: r.part for r in S.cut_classes(df, "label", bucket, [h, "k"], table, "part").collect()}
    first = {r.k for r in S.cut_classes(df, "label", bucket, [h, "k"], table, "part", last=0).collect()}
    by = defaultdict(list)
    for r in df.collect():
        by[r.label].append((_md5(f"9:{r.k}"), r.k))
    want = {k: sum(c <= i for c in cuts[label]) for label, xs in by.items() for i, (_, k) in enumerate(sorted(xs))}
    assert got == want and first == {k for k, v in want.items() if v == 0}


def test_hash_buckets_follow_the_hash_order(spark):
    h = F.md5(F.col("id").cast("string"))
    rows = spark.range(2000).select(h.alias("h"), S.hash_bucket(h, 97).alias("b")).orderBy("h").collect()
    b = [r.b for r in rows]
    assert b == sorted(b) and set(b) == set(range(97))


def test_first_per_class(spark):
    got = Counter((r.label, r.k) for r in S.first_per_class(_skewed(spark), "label", "k", 3).collect())
    by = defaultdict(list)
    for r in _skewed(spark).collect():
        by[r.label].append(r.k)
    assert got == Counter((label, k) for label, ks in by.items() for k in sorted(ks)[:3])


def test_null_labels_raise(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(40)], "k long, label string")
    for make in (lambda: S.balance_classes(df, "label", "k"), lambda: S.stratified_split(df, "label", "k"),
                 lambda: S.stratified_folds(df, "label", "k"), lambda: K.encode_labels(df, "label").collect()):
        with pytest.raises(Exception, match="null"):
            make()


def test_label_encoder_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "language string")
    K.LabelEncoder.fit(df).save(str(tmp_path / "e"))
    enc = K.LabelEncoder.load(spark, str(tmp_path / "e"))
    out = enc.transform(df)
    assert sorted((r.language, r.label) for r in out.collect()) == [("a", 0.0), ("a", 0.0), ("b", 1.0), ("c", 2.0)]
    assert sorted(r.back for r in enc.inverse(out, "label", "back").collect()) == ["a", "a", "b", "c"]
    with pytest.raises(Exception, match="unseen label zz"):
        enc.transform(spark.createDataFrame([("zz",)], "language string")).collect()


def test_balance_exact(spark):
    df = _skewed(spark)
    out = S.balance_classes(df, "label", "k", 250, 2, seed=3)
    counts = Counter(r.label for r in out.collect())
    assert counts == {"hot": 250, "c0": 250, "c1": 250, "c2": 250}
    small = S.balance_classes(df, "label", "k", None, 2, seed=3)  # target = smallest class
    assert set(Counter(r.label for r in small.collect()).values()) == {300}


def _approximate_mode(counts, n_draws):
    """Largest-remainder allotment, ties by label (the rule documented in
    split_plan), in exact integers."""
    n = sum(counts.values())
    floors = {c: v * n_draws // n for c, v in counts.items()}
    short = n_draws - sum(floors.values())
    order = sorted(counts, key=lambda c: (-(counts[c] * n_draws % n), c))
    for c in order[:short]:
        floors[c] += 1
    return floors


def test_stratified_split_sizes(spark):
    df = _skewed(spark)
    out = S.stratified_split(df, "label", "k", 0.2, 42).collect()
    counts = Counter(r.label for r in df.collect())
    n_test = math.ceil(0.2 * sum(counts.values()))
    train = _approximate_mode(counts, sum(counts.values()) - n_test)
    got = Counter((r.label, r.split) for r in out)
    for c in counts:
        assert got[(c, "train")] == train[c]
        assert got[(c, "test")] == counts[c] - train[c]
    assert len(out) == 3000 and len({r.k for r in out}) == 3000     # a partition of the rows


def _folds(rows, k):
    """Unshuffled stratified k-fold: classes in the order of their first rows are
    dealt round robin, each class takes its folds as contiguous blocks."""
    import numpy as np
    rows = sorted(rows)
    labels = list(dict.fromkeys(label for _, label in rows))
    y = np.sort(np.array([labels.index(label) for _, label in rows]))
    alloc = np.array([np.bincount(y[i::k], minlength=len(labels)) for i in range(k)])
    out = {}
    for c, label in enumerate(labels):
        out.update(zip([key for key, x in rows if x == label], np.arange(k).repeat(alloc[:, c]).tolist()))
    return out


@pytest.mark.parametrize("text_keys", [False, True])
def test_stratified_folds_brute_force(spark, text_keys, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 10)
    rows = [(f"k{i}" if text_keys else i, ["c", "a", "b"][i % 3] if i < 100 else "a") for i in range(137)]
    df = spark.createDataFrame(rows, f"k {'string' if text_keys else 'long'}, label string")
    got = {r.k: r.fold for r in S.stratified_folds(df, "label", "k", 5).collect()}
    assert got == _folds(rows, 5)


def test_missing_and_fill(spark):
    prim = spark.createDataFrame([("x", "python"), ("y", "sql")], "code string, language string")
    fb = spark.createDataFrame([("f1", "go"), ("f2", "python"), ("f3", "rust")], "code string, language string")
    miss = {r.language for r in K.missing_classes(prim, "language", ["python", "sql", "go"]).collect()}
    assert miss == {"go"}
    out = K.fill_missing_classes(prim, fb, "language", ["python", "sql", "go"])
    assert sorted(r.code for r in out.collect()) == ["f1", "x", "y"]
    assert K.fill_missing_classes(None, fb, "language").count() == 3


def test_split_on_documents_partition(spark):
    d = spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", F.col("lang").alias("language"))
    sp = S.stratified_split(d, "language", "doc_id")
    assert sp.count() == d.count() == sp.select("doc_id").distinct().count()


def test_fold_allotment_random_configs(spark):
    """The k-fold formula against the numpy statement on many random class
    size configurations at once (each configuration is its own table)."""
    import random

    import numpy as np
    rng = random.Random(11)
    expected, rows = {}, []
    for cfg in range(40):
        k = rng.choice([2, 3, 5, 7])
        sizes = [rng.randint(k, 40) for _ in range(rng.randint(1, 5))]
        labels = [f"l{j}" for j in range(len(sizes))]
        y = np.repeat(np.arange(len(sizes)), sizes)
        alloc = np.asarray([np.bincount(y[i::k], minlength=len(sizes)) for i in range(k)])
        for c, n in enumerate(sizes):
            folds = np.arange(k).repeat(alloc[:, c])
            start = int(sum(sizes[:c]))
            for r in range(n):
                expected[(cfg, c, r)] = int(folds[r])
                rows.append((cfg, k, c, r, start, n))
    df = spark.createDataFrame(rows, "cfg int, k int, c int, r int, start long, n long")
    got = {}
    for kk in (2, 3, 5, 7):
        fold = F.size(F.filter(S.fold_cuts(F.col("start"), F.col("n"), kk), lambda c: c <= F.col("r")))
        part = df.filter(F.col("k") == kk).select("cfg", "c", "r", fold.alias("fold")).collect()
        got.update({(x.cfg, x.c, x.r): x.fold for x in part})
    assert got == expected

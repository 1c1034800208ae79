"""Readers, writers, dispatch, and the driver contract."""

import pytest
from pyspark.sql import functions as F

from lexisift.sources import readers as R
from lexisift.sources import writers as W


def test_csv_fallback_order(spark, tmp_path):
    good = str(tmp_path / "good.csv")
    bad = str(tmp_path / "bad.csv")
    spark.createDataFrame([("a\nb", "python")], "code string, language string").coalesce(1) \
        .write.option("header", True).option("escape", '"').csv(good)
    spark.createDataFrame([("x", "y")], "other string, cols string").write.option("header", True).csv(bad)
    broken = tmp_path / "broken.csv"
    broken.write_text("code,language\nfine,python\n" + "a,b,too,many\n")
    df = R.scan_csv_fallback(spark, [str(tmp_path / "missing.csv"), bad, str(broken), good])
    assert [tuple(r) for r in df.collect()] == [("a\nb", "python")]
    assert R.scan_csv_fallback(spark, [str(tmp_path / "missing.csv")]) is None


def test_jsonl_recursive(spark, tmp_path):
    root = tmp_path / "csn"
    (root / "a" / "b").mkdir(parents=True)
    (root / "a" / "b" / "x.jsonl").write_text('{"code": "print(1)", "language": "python", "repo": "r"}\n')
    (root / "a" / "y.jsonl").write_text('{"text": "no code column"}\n')
    (root / "a" / "z.json").write_text('{"code": "skip", "language": "go"}\n')
    df = R.scan_jsonl_recursive(spark, str(root))
    assert [tuple(r) for r in df.collect()] == [("print(1)", "python")]
    assert R.scan_jsonl_recursive(spark, str(tmp_path / "nothing")).count() == 0


def test_parquet_checked_and_dispatch(spark, tmp_path):
    assert R.scan_parquet_checked(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        R.collect_data(spark, "nope")
    assert R.collect_data(spark, "codesearchnet", directory=str(tmp_path / "none")).count() == 0


def test_template_expand_and_samples(spark):
    t = spark.createDataFrame([("py", 0, "def $func($param): pass"), ("py", 1, "class $Class: $unknown"),
                               ("sql", 0, "SELECT $$x FROM $Class"), ("go", 0, "costs $5"), ("go", 1, "$"),
                               ("rust", 0, "struct ${Struct2};")], "language string, idx int, template string")
    out = R.template_expand(spark, t, n_per_class=4).collect()
    got = sorted((r.language, r.code) for r in out)
    assert ("py", "def greet(x): pass") in got and ("py", "def calculate(data): pass") in got
    assert all("unknown" not in c for _, c in got)            # failing substitution skipped
    assert ("sql", "SELECT $x FROM User") in got and len([g for g in got if g[0] == "sql"]) == 4
    assert sorted(c for lang, c in got if lang == "rust") == ["struct Data;", "struct Item;", "struct Order;", "struct Product;"]
    assert not any(lang == "go" for lang, _ in got)
    s = spark.createDataFrame([({"go": ["a", "b"], "sql": ["c"]},)], "samples map<string, array<string>>")
    got = sorted(tuple(r) for r in R.explode_samples(s).collect())
    assert got == [("go", 0, "a"), ("go", 1, "b"), ("sql", 0, "c")]


def test_json_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 2)], "language string, count long")
    W.save_table_json(df, str(tmp_path / "j"))
    assert [tuple(r) for r in W.load_table_json(spark, str(tmp_path / "j"), "language string, count long").collect()] == [("a", 2)]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["language", "term", "weight", "rank"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_convert_to_format(spark, tmp_path):
    src = tmp_path / "in" / "sub"
    src.mkdir(parents=True)
    (src / "b.csv").write_text("code,language\nx,go\n")
    (tmp_path / "in" / "a.csv").write_text("code,language\ny,sql\n")
    first = W.convert_to_format(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert first.endswith("a.csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == [("y", "sql")]
    assert W.convert_to_format(spark, str(tmp_path / "none"), str(tmp_path / "o2")) is None


def test_scale_conf():
    from lexisift.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert int(c["spark.sql.shuffle.partitions"]) == 20_000      # bounded: blocks are map tasks x partitions
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_unreadable_is_told_from_other_errors(spark, tmp_path):
    (tmp_path / "junk.parquet").write_text("no parquet")
    assert R.scan_parquet_checked(spark, str(tmp_path / "junk.parquet")).count() == 0
    assert not R.is_unreadable(RuntimeError("Permission denied"))

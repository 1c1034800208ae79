"""CSV with quoted newlines, cut into many splits."""

import csv
import random

import pytest

from lexisift.sources import readers as R
from lexisift.sources import split_csv as C
from lexisift.sources import writers as W


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL).writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_do_not_depend_on_the_splits(spark, tmp_path, small_splits, end):
    r = random.Random(4)
    bits = ["a", "é", '"', '""', "\n", "\n\n", ",", " ", "x" * 30, '",\n"']
    rows = [("".join(r.choice(bits) for _ in range(r.randrange(1, 12))) + "z", f"l{i % 3}") for i in range(60)]
    # a record over many splits, and one that ends with a split's last line
    rows[7] = ("line\n" * 100 + 'quote " inside', "long")
    rows[30] = ("\n" * 200 + "z", "long")
    write(tmp_path / "a.csv", [("code", "language"), *rows], end)
    lines = C._lines(spark, str(tmp_path / "a.csv"))
    assert lines.select("at").distinct().count() > 10
    got = [tuple(x) for x in C.read_split_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert sorted(got) == sorted(rows)
    plain = [tuple(x) for x in R.read_csv_snippets(spark, str(tmp_path / "a.csv")).collect()]
    assert sorted(got) == sorted(plain)


def test_split_table_against_plain_counting(spark, tmp_path, small_splits):
    text = 'code,language\n' + '"a\nb",x\n' * 20 + '"' + "row\n" * 60 + '",y\n' + "c,d\n" * 20
    (tmp_path / "b.csv").write_text(text)
    for s in C.split_table(C._lines(spark, str(tmp_path / "b.csv"))).collect():
        # lines that start before the split's first line
        start = s.at if s.at == 0 else text.index("\n", s.at - 1) + 1 if text[s.at - 1] != "\n" else s.at
        assert s.carry == text[:start].count('"') % 2


def test_edges(spark, tmp_path, small_splits):
    (tmp_path / "head.csv").write_text("code,language\n")
    assert C.read_split_csv(spark, str(tmp_path / "head.csv")).count() == 0
    (tmp_path / "open.csv").write_text('code,language\n\na,b\n\n"no end,\nc')
    with pytest.raises(Exception):
        C.read_split_csv(spark, str(tmp_path / "open.csv")).collect()
    (tmp_path / "wide.csv").write_text("code,language\na,b,c\n")
    assert R.scan_csv_fallback(spark, [str(tmp_path / "wide.csv")], split=True) is None
    write(tmp_path / "x.csv", [("code", "language"), ("a\nb", "go"), ("", "c")])
    write(tmp_path / "d.csv", [("the code\nof all", "language " * 40), ("r", "s")])
    assert [tuple(x) for x in R.scan_csv_fallback(spark, [str(tmp_path / "wide.csv"), str(tmp_path / "x.csv")], split=True).collect()] \
        == [tuple(x) for x in R.read_csv_snippets(spark, str(tmp_path / "x.csv")).collect()]
    assert [tuple(x) for x in C.read_split_csv(spark, str(tmp_path / "d.csv")).collect()] == [("r", "s")]


def test_folder_of_part_files_is_one_csv(spark, tmp_path):
    W.write_snapshot_csv(spark.createDataFrame([(f"c{i}\n", "go") for i in range(9)], "code string, language string").repartition(3),
                         str(tmp_path / "in" / "sub" / "all.csv"))
    first = W.convert_to_format(spark, str(tmp_path / "in"), str(tmp_path / "out.csv"))
    assert first.endswith("sub/all.csv")
    assert R.read_csv_snippets(spark, str(tmp_path / "out.csv")).count() == 9

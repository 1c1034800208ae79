"""Quoted CSV read by many tasks, also where a file is large and its fields
hold newlines.

Spark splits text files by lines, but a line is a record only if no quoted
field is open at its start.  Whether one is open follows from the number of
quote characters before the line (a quote inside a field is doubled), so

1. every input split reports whether it holds an odd number of quotes, and
   whether a record would start in it if a field were open at its start;
2. running sums over the splits of a file (a row per split) say which splits
   start inside a field, and in which earlier split that record starts;
3. every split is cut into records.  The pieces of a record that runs over the
   border of splits, at most one for each split, meet by the split it starts in.

Only those pieces are shuffled.  The tasks of step 3 know the splits that start
inside a field: 24 bytes for each such split, far less than the scheduler holds
for it as a task.  Files are those that quote as RFC 4180 has it: a quote
character stands only around a field or doubled inside a quoted one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES = "file long, owner long, at long, header boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, at`` (start of the split), ``odd`` (quotes of the line), ``value``,
    in the order of the file within a split."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        (quotes % 2).cast("int").alias("odd"), "value")


def _runs(frames):
    """The lines of each split, frame by frame: ``(file, at), frame``."""
    for f in frames:
        edge = np.flatnonzero((f["file"].to_numpy()[1:] != f["file"].to_numpy()[:-1]) | (f["at"].to_numpy()[1:] != f["at"].to_numpy()[:-1])) + 1
        for a, b in zip([0, *edge], [*edge, len(f)]):
            if b > a:
                yield (int(f["file"].iloc[a]), int(f["at"].iloc[a])), f.iloc[a:b]


def open_at(odd: np.ndarray, before: int) -> np.ndarray:
    """For each line 1 if a field is open at its start, given ``before`` for the first."""
    return (before + np.cumsum(odd) - odd) % 2


def _split_facts(frames):
    key, odd, inside = None, 0, False
    for k, f in _runs(frames):
        if k != key:
            if key is not None:
                yield pd.DataFrame([(*key, odd, inside)], columns=["file", "at", "odd", "inside"])
            key, odd, inside = k, 0, False
        o = f["odd"].to_numpy()
        inside = inside or bool((open_at(o, odd) == 1).any())
        odd = int(odd + o.sum()) % 2
    if key is not None:
        yield pd.DataFrame([(*key, odd, inside)], columns=["file", "at", "odd", "inside"])


def split_table(lines: DataFrame) -> DataFrame:
    """A row per split: ``file, at, carry`` (1: a field is open at its start)
    and ``owner`` (start of the split in which that field's record starts)."""
    facts = lines.select("file", "at", "odd").mapInPandas(_split_facts, "file long, at long, odd int, inside boolean")
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carry = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int")
    own = F.when((F.col("carry") == 0) | F.col("inside"), F.col("at"))
    return facts.withColumn("carry", carry).select("file", "at", "carry", F.last(own, ignorenulls=True).over(earlier).alias("owner"))


def _cut(owners: dict):
    """Lines to records and pieces: ``owner`` is null for a whole record."""
    def flush(key, buf, owner, header):
        return (key[0], owner, key[1], header, "\n".join(buf))

    def run(frames):
        key, buf, owner, state, top = None, [], None, 0, False

        def end():
            if buf:     # a field still open: the record goes on in the next split
                yield flush(key, buf, key[1] if owner is None and state else owner, top)

        for k, f in _runs(frames):
            out = []
            if k != key:
                out.extend(end() if key is not None else ())
                key, buf, owner = k, [], owners.get(k)
                state, top = int(owner is not None), k[1] == 0
            o, values = f["odd"].to_numpy(), f["value"].tolist()
            starts = np.flatnonzero(open_at(o, state) == 0)
            buf.extend(values[:starts[0] if len(starts) else len(values)])
            for a, b in zip(starts, [*starts[1:], len(values)]):
                if buf:
                    out.append(flush(key, buf, owner, top))
                    top = top and not "".join(buf).strip("\r")
                buf, owner = values[a:b], None
            state = int(state + o.sum()) % 2
            yield pd.DataFrame(out, columns=["file", "owner", "at", "header", "text"]).astype({"owner": "Int64"})
        if key is not None:
            yield pd.DataFrame(list(end()), columns=["file", "owner", "at", "header", "text"]).astype({"owner": "Int64"})
    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every record but each file's first (the header) and empty lines."""
    lines = _lines(spark, path)
    inner = split_table(lines).filter("carry = 1").select("file", "at", "owner").toArrow()
    owners = dict(zip(zip(inner.column("file").to_pylist(), inner.column("at").to_pylist()), inner.column("owner").to_pylist()))
    pieces = lines.mapInPandas(_cut(owners), PIECES)
    whole = pieces.filter("owner IS NULL").select("header", "text")
    run_on = pieces.filter("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))
    joined = run_on.select("header", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    text = F.regexp_replace("text", "\r$", "")
    return whole.unionByName(joined).filter(~F.col("header")).select(text.alias("text")).filter("text <> ''")


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a CSV file or folder with headers, all columns as text; a
    record with too few or too many fields raises.  Columns are named by the
    header of one file.  Empty lines give nothing."""
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    if not names:
        return spark.createDataFrame([], "code string").drop("code")
    ddl = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    row = F.from_csv("text", ddl, {"multiLine": "true", "escape": '"', "mode": "FAILFAST"})
    return records(spark, path).select(row.alias("r")).select("r.*")

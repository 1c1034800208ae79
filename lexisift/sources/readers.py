"""Readers for labelled snippets: CSV with an ordered path fallback,
recursive JSON lines, a checked parquet export, template expansion, an
in-memory sample map, and the source dispatcher.

Every reader returns ``(code STRING, language STRING)`` with an explicit
schema (no inference); when nothing usable is found the result is an empty
table of that schema."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import HELLO_WORLD_TARGETS
from ..operators import classes as K
from . import writers as W
from .split_csv import read_split_csv


SNIPPET_SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("language", T.StringType())])
REQUIRED = ("code", "language")


def empty_snippets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SNIPPET_SCHEMA)


def has_columns(df: DataFrame, required=REQUIRED) -> bool:
    """Required-columns predicate."""
    return set(required) <= set(df.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_csv_snippets(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """One CSV source: header, quoted fields that may hold newlines.

    Spark's own reader does not split such files, so one large file is one
    task.  With ``split`` many tasks read it (``split_csv``); the file must then
    quote as RFC 4180 has it."""
    if split:
        return read_split_csv(spark, path)
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


#: Spark's names for input that cannot be found or read as what it should be.
UNREADABLE = ("MALFORMED_RECORD", "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "MALFORMED_CSV_RECORD",
              "MalformedInputException", "TextParsingException", "is not a Parquet file")


def is_unreadable(e: Exception) -> bool:
    """The input is missing or malformed; anything else (rights, network, a
    lost executor) is for the caller to see."""
    return any(name in str(e) for name in UNREADABLE)


def scan_csv_fallback(spark: SparkSession, paths: list[str], explicit: str | None = None, split: bool = False) -> DataFrame | None:
    """The first path (explicit one first) that exists, parses and has
    ``code`` and ``language`` wins; a parse error moves on.  To know that it
    parses, a candidate is read once in full (both columns, nothing kept).
    ``None`` when no candidate is usable (the caller falls back)."""
    for path in ([explicit] if explicit else []) + list(paths):
        if not path or not _exists(spark, path):
            continue
        try:
            df = read_csv_snippets(spark, path, split)
            if has_columns(df):
                df.write.format("noop").mode("overwrite").save()
                return df.select(F.col("code").cast("string"), F.col("language").cast("string"))
        except (PySparkException, Py4JJavaError) as e:
            if not is_unreadable(e):
                raise
    return None


def scan_jsonl_recursive(spark: SparkSession, directory: str, glob: str = "*.jsonl") -> DataFrame:
    """Every JSON-lines file under ``directory`` (recursively); only
    ``code`` and ``language`` are read (schema given, so a file lacking one
    gives nulls, and those rows are dropped)."""
    if not _exists(spark, directory):
        return empty_snippets(spark)
    df = (spark.read.schema(SNIPPET_SCHEMA).option("recursiveFileLookup", True)
          .option("pathGlobFilter", glob).json(directory))
    return df.filter(F.col("code").isNotNull() & F.col("language").isNotNull())


def scan_parquet_checked(spark: SparkSession, path: str) -> DataFrame:
    """S3 (re-aimed from a dataset hub): a local parquet export, checked for
    the two columns and projected; an empty table if it is missing, is no
    Parquet or lacks a column (other errors are raised)."""
    try:
        df = spark.read.parquet(path)
    except (PySparkException, Py4JJavaError) as e:
        if not is_unreadable(e):
            raise
        return empty_snippets(spark)
    if not has_columns(df):
        return empty_snippets(spark)
    return df.select(F.col("code").cast("string"), F.col("language").cast("string"))


# --- fixed values: placeholder names of the template source --------------
PLACEHOLDERS = ["func", "Class", "param", "Struct", "Interface", "Struct2"]
DEFAULT_NAMES = {
    "func": ["greet", "process", "calculate", "transform", "handle"],
    "Class": ["User", "Product", "Order", "Item", "Data"],
    "param": ["x", "value", "data", "input", "item"],
    "Struct": ["User", "Product", "Order", "Item", "Data"],
    "Interface": ["User", "Product", "Order", "Item", "Data"],
    "Struct2": ["Product", "Order", "Item", "Data", "User"],
}


def fill_placeholders(template: Column, i: Column, names: dict | None = None) -> Column:
    """``$name`` -> ``names[name][i % len]``; ``$$`` -> ``$``."""
    names = names or DEFAULT_NAMES
    out = F.regexp_replace(template, r"\$\$", "\u0000")
    for ph in sorted(PLACEHOLDERS, key=len, reverse=True):
        lst = names[ph]
        pick = F.element_at(F.array(*[F.lit(x) for x in lst]), (i % len(lst) + 1).cast("int"))
        out = F.regexp_replace(out, r"\$\{" + ph + r"\}|\$" + ph + r"(?![A-Za-z0-9_])", pick)
    return out


def is_filled(template: Column) -> Column:
    """Every ``$`` of the template is doubled or starts a known placeholder."""
    names = "|".join(sorted(PLACEHOLDERS, key=len, reverse=True))
    rest = F.regexp_replace(template, rf"\$\$|\$\{{(?:{names})\}}|\$(?:{names})(?![A-Za-z0-9_])", "")
    return ~F.contains(rest, F.lit("$"))


def template_expand(spark: SparkSession, templates: DataFrame, n_per_class: int = 500,
                    names: dict | None = None) -> DataFrame:
    """For each language, row ``i`` of ``n_per_class`` takes template
    ``i % n_templates`` (templates ordered by ``idx``) and fills its
    placeholders from the name lists at ``i % 5``; templates with any other
    ``$`` are skipped.  ``templates``: ``language, idx, template``.

    Each template is expanded to its own row numbers, so the ranks and counts
    are per template table row, not per generated row; the templates are the
    source's own small list, ``n_per_class`` may be large."""
    place = Window.partitionBy("language")
    ranked = templates.select("language", "template", (F.row_number().over(place.orderBy("idx")) - 1).alias("at"),
                              F.count(F.lit(1)).over(place).alias("n_templates"))
    last = F.lit(n_per_class - 1)
    numbers = F.when(F.col("at") <= last, F.sequence(F.col("at").cast("long"), last.cast("long"), F.col("n_templates")))
    rows = ranked.filter(is_filled(F.col("template"))).select("language", "template", F.explode(numbers).alias("i"))
    code = F.regexp_replace(fill_placeholders(F.col("template"), F.col("i"), names), "\u0000", "\\$")
    return rows.select(code.alias("code"), "language")


def explode_samples(samples: DataFrame, map_col: str = "samples") -> DataFrame:
    """``MAP<language, ARRAY<code>>`` -> ``(language, position, code)``
    rows (``position`` inside the language's list, so equal texts stay
    distinct samples)."""
    one = samples.select(F.explode(map_col).alias("language", "codes"))
    return one.select("language", F.posexplode("codes").alias("position", "code"))


def collect_filled(primary: DataFrame | None, synthetic: DataFrame, classes=None, aliases=None) -> DataFrame:
    """S5 for CSV snapshots: labels through the alias map, known classes only,
    classes without rows filled from the synthetic source; all of that source
    when there is no snapshot."""
    if primary is None:
        return synthetic
    known = K.filter_known_classes(K.normalize_labels(primary, "language", aliases), "language", classes)
    return K.fill_missing_classes(known, synthetic, "language", classes)


def collect_data(spark: SparkSession, source: str, snapshot: str | None = None, **kw) -> DataFrame:
    """Dispatch by source name; unknown names raise ``ValueError``.  With
    ``snapshot`` the collected rows are written there as CSV, whatever the
    source, and read back, so later steps do not collect again."""
    readers = {
        "synthetic": lambda: template_expand(spark, kw["templates"], kw.get("n_per_class", 500)),
        "codesearchnet": lambda: _first_with_rows(
            *([scan_parquet_checked(spark, kw["hub"])] if kw.get("hub") else []),
            scan_jsonl_recursive(spark, kw.get("directory", "data/raw/codesearchnet"))),
        "huggingface": lambda: scan_parquet_checked(spark, kw.get("path", "data/raw/hub")),
        "kaggle": lambda: collect_filled(scan_csv_fallback(spark, kw.get("paths", []), kw.get("explicit")),
                                         template_expand(spark, kw["templates"], kw.get("n_per_class", 500)),
                                         kw.get("classes"), kw.get("aliases")),
    }
    if source not in readers:
        raise ValueError(f"unknown source: {source}")
    rows = readers[source]()
    if snapshot is None:
        return rows
    W.write_snapshot_csv(rows, snapshot)
    return spark.read.schema(SNIPPET_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(snapshot)


def _first_with_rows(*frames: DataFrame) -> DataFrame:
    for df in frames[:-1]:
        if df.limit(1).count():
            return df
    return frames[-1]


def assemble_sources(spark: SparkSession, python: str | None, cpp: str | None, index: str | None, min_chars: int = 10) -> DataFrame:
    """The three-file assembly: solutions (``python_solutions``), answers
    (``Answer``) longer than ``min_chars`` (a missing text reads ``nan``), and the
    first program of each hello-world language, under its class name: the first
    by the index's ``position``, if it has that column, else in file order.  A file
    that is missing, malformed or lacks its column gives nothing and does not
    stop the others."""
    def one(path, make):
        if path is None or not _exists(spark, path):
            return empty_snippets(spark)
        try:
            df = read_csv_snippets(spark, path)
            df.write.format("noop").mode("overwrite").save()
            out = make(df)
            return out if out is not None else empty_snippets(spark)
        except (PySparkException, Py4JJavaError) as e:
            if not is_unreadable(e):
                raise
            return empty_snippets(spark)

    def texts(col, language):
        def make(df):
            if not has_columns(df, (col,)):
                return None
            part = df.select(F.coalesce(F.col(col).cast("string"), F.lit("nan")).alias("code"), F.lit(language).alias("language"))
            return K.filter_min_length(part, "code", min_chars)
        return make

    def hello(df):
        if not has_columns(df, ("language_name", "program")):
            return None
        place = df.select("language_name", F.coalesce(F.col("program").cast("string"), F.lit("nan")).alias("program"),
                          (F.col("position").cast("long") if has_columns(df, ("position",)) else F.monotonically_increasing_id()).alias("_row"))
        first = K.first_per_key(place, HELLO_WORLD_TARGETS, "language_name", ["program"], ["_row"], "language")
        return first.select(F.col("program").alias("code"), "language")

    return one(python, texts("python_solutions", "python")).unionByName(one(cpp, texts("Answer", "cpp"))).unionByName(one(index, hello))

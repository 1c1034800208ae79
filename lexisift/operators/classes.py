"""Class-level operators: filters, distributions, rare-class removal,
label encoding and the set logic around class lists.

Per-class statistics are computed with ``groupBy`` (map-side partial
aggregation, so a class holding a third of all rows costs one row per task in
the shuffle) and applied back with a semi/left join on a side whose size is
the number of classes, checked before it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import LANGUAGES, map_tag, normalize_label
from ..session import cut_lineage, join_small


# ---------------------------------------------------------------- filters --
def normalize_labels(df: DataFrame, label_col: str = "language", aliases: dict | None = None,
                     out_col: str | None = None) -> DataFrame:
    """Lower-case + alias map; unmapped labels pass through."""
    return df.withColumn(out_col or label_col, normalize_label(label_col, aliases))


def map_tags(df: DataFrame, tag_col: str = "tag", out_col: str = "language",
             tags: dict | None = None, drop_unmapped: bool = True) -> DataFrame:
    """Tag -> class; unmapped tags give null and are dropped."""
    out = df.withColumn(out_col, map_tag(tag_col, tags))
    return out.filter(F.col(out_col).isNotNull()) if drop_unmapped else out


def filter_known_classes(df: DataFrame, label_col: str = "language", classes=None) -> DataFrame:
    """P5: keep rows whose label is one of ``classes`` (null never passes)."""
    return df.filter(F.col(label_col).isin(list(classes or LANGUAGES)))


def filter_min_length(df: DataFrame, text_col: str = "code", min_chars: int = 10,
                      null_text: str = "nan") -> DataFrame:
    """Keep rows whose text (null read as ``'nan'``) is longer than
    ``min_chars`` code points."""
    return df.filter(F.length(F.coalesce(F.col(text_col), F.lit(null_text))) > min_chars)


def filter_nonempty(df: DataFrame, text_col: str = "clean_code") -> DataFrame:
    """Drop rows that are empty (after cleaning)."""
    return df.filter(F.length(F.col(text_col)) > 0)


def with_nonempty(df: DataFrame, expr: Column, out_col: str = "clean_code") -> DataFrame:
    """P7 fused with the expression that makes the text: add ``out_col`` and
    keep only rows where it is non-empty.

    A plain ``withColumn`` + ``filter`` lets the optimizer push the filter
    below the projection by inlining the expression, so an expensive one (the
    cleaning chain) runs twice, the first time before any repartition.  A
    one-element ``explode`` computes it once; a filter on a generated column
    is never pushed below the generator."""
    kept = F.filter(F.array(expr), lambda x: F.length(x) > 0)
    return df.select("*", F.explode(kept).alias(out_col))


def first_per_key(df: DataFrame, targets: list[tuple[str, str]], name_col: str = "language_name",
                  value_cols=("program",), order_cols=None, out_col: str = "language") -> DataFrame:
    """For each requested name (in ``targets`` order) the first matching
    row, with the name rewritten by the map.  ``order_cols`` define "first"
    (the file order in the reference)."""
    spark = df.sparkSession
    t = spark.createDataFrame([(n, v, i) for i, (n, v) in enumerate(targets)],
                              f"{name_col} string, {out_col} string, target_pos int")
    order_cols = list(order_cols or [])
    # one row per requested name: the minimum over the ordering key, computed
    # by aggregation (no group is ever gathered into one task)
    keyed = join_small(df, t, name_col, "inner", row_bound=len(targets))
    order_struct = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in value_cols])
    first = keyed.groupBy(name_col, out_col, "target_pos").agg(F.min(order_struct).alias("_first"))
    return first.select("target_pos", out_col, *[F.col(f"_first.{c}").alias(c) for c in value_cols])


def pair_filter(df: DataFrame, pair=("java", "cpp"), actual_col: str = "actual",
                predicted_col: str = "predicted") -> DataFrame:
    """Both sides in ``pair`` and different."""
    a, p = F.col(actual_col), F.col(predicted_col)
    return df.filter(a.isin(list(pair)) & p.isin(list(pair)) & (a != p))


# ----------------------------------------------------------- aggregations --
def class_distribution(df: DataFrame, label_col: str = "language") -> DataFrame:
    """A1: rows per class, most frequent first (ties by label)."""
    return (df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(label_col)))


def distinct_labels(df: DataFrame, label_col: str = "language") -> DataFrame:
    """A2."""
    return df.select(label_col).distinct()


def class_counts(df: DataFrame, label_col: str = "language") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_class"))


def drop_rare_classes(df: DataFrame, label_col: str = "language", min_samples: int = 2,
                      check_nonempty: bool = True) -> DataFrame:
    """A3/U4: remove classes with fewer than ``min_samples`` rows; raise when
    no class is left (the check runs one small aggregate)."""
    valid = class_counts(df, label_col).filter(F.col("n_class") >= min_samples).select(label_col)
    if check_nonempty and valid.limit(1).count() == 0:
        raise ValueError(f"no class has at least {min_samples} rows")
    return join_small(df, valid, label_col, "left_semi")


def balance_target(df: DataFrame, label_col: str = "language", n_samples_per_class: int | None = None,
                   min_samples_per_class: int = 2) -> DataFrame:
    """A4: one row ``target = max(min(n or inf, smallest class), min_samples)``."""
    smallest = class_counts(df, label_col).agg(F.min("n_class").alias("m"))
    cap = F.col("m") if n_samples_per_class is None else F.least(F.col("m"), F.lit(n_samples_per_class))
    return smallest.select(F.greatest(cap, F.lit(min_samples_per_class)).cast("long").alias("target"))


def encode_labels(df: DataFrame, label_col: str = "language", out_col: str = "label") -> DataFrame:
    """Sorted distinct labels -> 0..k-1 as DOUBLE (MLlib's label type); a
    null label raises."""
    return LabelEncoder.fit(df, label_col).transform(df, label_col, out_col)


class LabelEncoder:
    """A6 fitted: a table (name, label_index) of one row per class."""

    def __init__(self, classes: DataFrame):
        self.classes = classes

    @classmethod
    def fit(cls, df: DataFrame, label_col: str = "language") -> "LabelEncoder":
        return cls(cut_lineage(class_index(df, label_col).withColumnRenamed(label_col, "name"), "classes"))

    def transform(self, df: DataFrame, label_col: str = "language", out_col: str = "label") -> DataFrame:
        """Index of every label; a null or unseen one raises when it is read."""
        side = self.classes.select(F.col("name").alias("_name"), F.col("label_index").alias("_index"))
        j = df.join(side, F.col(label_col) == F.col("_name"), "left")
        wrong = F.raise_error(F.concat(F.lit("unseen label "), F.coalesce(F.col(label_col), F.lit("null")))).cast("double")
        return j.withColumn(out_col, F.coalesce("_index", wrong)).drop("_name", "_index")

    def inverse(self, df: DataFrame, index_col: str = "label", out_col: str = "language") -> DataFrame:
        """Name of every index; an unknown index raises."""
        side = self.classes.select(F.col("name").alias("_name"), F.col("label_index").alias("_index"))
        j = df.join(side, F.col(index_col) == F.col("_index"), "left")
        return j.withColumn(out_col, F.coalesce("_name", F.raise_error(F.lit("unknown label index")))).drop("_name", "_index")

    def save(self, path: str) -> None:
        self.classes.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "LabelEncoder":
        return cls(spark.read.parquet(path))


def class_index(df: DataFrame, label_col: str = "language") -> DataFrame:
    """Distinct labels with their alphabetical index (a table of k rows)."""
    w = Window.orderBy(label_col)
    return (df.select(label_col).where(F.col(label_col).isNotNull()).distinct()
            .withColumn("label_index", (F.row_number().over(w) - 1).cast("double")))


# ---------------------------------------------------------------- set ops --
def canonicalize_union(frames: list[tuple[DataFrame, str, str | Column]],
                       text_name: str = "code", label_name: str = "language") -> DataFrame:
    """Several sources with their own column names -> one
    ``(text, label)`` table by UNION ALL.  Each entry is ``(df, text column,
    label column name or literal Column)``."""
    out = None
    for frame, text_col, label in frames:
        lab = label if isinstance(label, Column) else F.col(label)
        part = frame.select(F.col(text_col).cast("string").alias(text_name),
                            lab.cast("string").alias(label_name))
        out = part if out is None else out.unionByName(part)
    return out


def missing_classes(df: DataFrame, label_col: str = "language", classes=None) -> DataFrame:
    """Expected classes that have no row."""
    spark = df.sparkSession
    expected = spark.createDataFrame([(c,) for c in (classes or LANGUAGES)], f"{label_col} string")
    present = df.select(label_col).distinct()
    return expected.join(present, label_col, "left_anti")


def fill_missing_classes(primary: DataFrame | None, fallback: DataFrame, label_col: str = "language",
                         classes=None) -> DataFrame:
    """Rows of the fallback for the classes missing from the primary,
    appended to the primary; the whole fallback when there is no primary."""
    if primary is None:
        return fallback
    missing = missing_classes(primary, label_col, classes)
    return primary.unionByName(join_small(fallback, missing, label_col, "left_semi",
                                          row_bound=len(classes or LANGUAGES)))


def tokenize_column(df: DataFrame, column: str = "code", drop_whitespace: bool = False) -> DataFrame:
    """Add ``{column}_tokens`` (code tokens, whitespace kept by default)."""
    from ..functions.tokens import code_tokens
    return df.withColumn(f"{column}_tokens", code_tokens(column, drop_whitespace))

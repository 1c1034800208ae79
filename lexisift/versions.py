"""Model folders that hold whole versions only.

A model is several tables, and a job can be lost between two of them.  Every
save therefore writes a folder of its own, and its last step is one row in the
table of commits, a single file that the committer of the write moves into
place.  A load reads the newest committed version; a save broken off before
its commit changes nothing, and readers of the former version are not
disturbed while a new one is written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "seq long, version string"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``seq, version`` of every finished save."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{path.rstrip('/')}/commits")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], COMMIT)


def save_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Call ``write`` with a new folder under ``path``, then commit it."""
    base = path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    write(f"{base}/{version}")
    seq = commits(spark, base).agg(F.coalesce(F.max("seq") + 1, F.lit(0))).first()[0]
    spark.createDataFrame([(seq, version)], COMMIT).coalesce(1).write.mode("append").parquet(f"{base}/commits")
    return path


def current(spark: SparkSession, path: str) -> str:
    """The folder of the newest committed version (of two saves at the same
    time, the one with the larger name)."""
    last = commits(spark, path).orderBy(F.desc("seq"), F.desc("version")).first()
    if last is None:
        raise FileNotFoundError(f"no finished save in {path}")
    return f"{path.rstrip('/')}/{last.version}"


def prune(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the committed versions before the newest ``keep``; how many went.
    Their commits stay (a number is never given twice)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for row in commits(spark, path).orderBy(F.desc("seq"), F.desc("version")).collect()[max(1, keep):]:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{row.version}")
        gone += bool(folder.getFileSystem(conf).delete(folder, True))
    return gone

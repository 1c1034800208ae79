"""Session helpers: a local session for tests/bench, the checkpoint folder,
and a size-checked broadcast."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "lexisift",
                  shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session sized for tests and the bench.  On a cluster the
    session comes from the launcher and this function is not used."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Xss16m")
        .config("spark.executor.extraJavaOptions", "-Xss16m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session whose executors run in this process or on this machine
    (``local[...]``, as in tests) gets a scratch folder when it names none; on
    a cluster a missing setting is an error, since executors would each write
    to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lexisift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as parquet into the shared checkpoint folder and
    read it back: one computation (an RDD checkpoint of an uncached plan
    computes it twice), a lineage that survives lost executors, and later
    reads that prune columns and push filters into the scan."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


# A side with a proven row bound is broadcast up to this many bytes.
BROADCAST_BYTES = 64 << 20


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               row_bound: int | None = None, row_bytes: int = 256) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    With a proven bound (``row_bound`` rows of at most ``row_bytes``, e.g. the
    number of classes) within ``BROADCAST_BYTES`` the side is broadcast
    explicitly.  Without one, a plain join is planned and AQE re-plans it at
    run time from the measured size of the materialised side."""
    if row_bound is not None and row_bound * row_bytes <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when the scan gives fewer tasks than
    the cluster has cores (small files with one row group); on large inputs
    the scan is already split and nothing is added."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key) if key else df.repartition(cores)


def scale_conf(shuffled_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2,
               least: int = 200, most: int = 20_000) -> dict[str, str]:
    """Session settings for a large run whose widest shuffle moves
    ``shuffled_bytes``.  Scans split at ``target_partition_bytes``.  Shuffle
    partitions follow the shuffled bytes, not the scan: past ``most`` of them
    the number of shuffle blocks (map tasks times partitions) costs more than
    larger partitions, which spill or are split by AQE; small shuffles are
    coalesced."""
    n = min(most, max(least, -(-int(shuffled_bytes) // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)


def release(df: DataFrame) -> None:
    """Delete a table written by :func:`cut_lineage` once nothing reads it any
    more, so that the intermediate tables of a run do not pile up in the shared
    folder.  Works through Hadoop FS on any cluster store; any other DataFrame
    is left alone."""
    path = getattr(df, "written_to", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

"""Session settings and the shared scratch location.

All timestamps in this library are UTC wall-clock values; the session time
zone is pinned to UTC so ``to_date`` / ``date_format`` never shift a day.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every session of this library wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A write to thousands of date folders costs by folder, so a small load isn't
    # merged into one task (670 folders: 22.8 s in one, 5.4 s in eight); nor is
    # their listing dealt into as many tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Layers are stored at some 25 bytes a row that tasks hold at 400 to 600: larger parts would spill while rows
    # are shuffled or sorted.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A task writes its date folders side by side instead of sorting (and spilling) its rows by
    # date first; from this many on, the rest of its rows is sorted.
    "spark.sql.maxConcurrentOutputFileWriters": "100",
    # The JVM never compiles a method of over 8,000 bytes (the flattener's, if fused, has 12,800), so such
    # stages aren't fused; their expressions then are in small methods of their own.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # incremental merges rewrite only the partitions they touch
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # MAX/MIN/COUNT answered from parquet footers where possible (watermarks)
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass ``master=None``
    and let spark-submit decide; shuffle partitions should then be sized to
    the data (AQE coalesces small ones)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Results depend on these; a session that refuses them can't be used.
REQUIRED = ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode")


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime-settable subset of BASE_CONF, for sessions built elsewhere
    (e.g. the driver's). Tuning that the session won't take is left as the
    cluster has it; a setting that results depend on raises."""
    for k, v in BASE_CONF.items():
        if not k.startswith("spark.ui."):
            try:
                spark.conf.set(k, v)
            except AnalysisException:  # static or locked
                pass
    for k in REQUIRED:
        if spark.conf.get(k, "").lower() != BASE_CONF[k].lower():
            raise RuntimeError(f"{k} is {spark.conf.get(k, None)}; {BASE_CONF[k]} is needed")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (see ``scratch_dir``)."""
    return scratch_dir(spark, "ckpt").rsplit("/", 1)[0]


def cut_lineage(df, name: str = "cut"):
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    later plans read the written result instead of recomputing (and
    re-shuffling) its lineage, it survives lost executors (never
    ``localCheckpoint``), and unlike an RDD checkpoint it stays columnar, so
    readers keep column pruning and filter push-down."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh directory under the shared checkpoint location.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we use it
    for lineage cuts and intermediate tables. Where it is unset, a session in
    one process (tests) gets a temporary folder; on a cluster, whose machines
    don't share such a folder, that raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        base = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name or 'run'}-{uuid.uuid4().hex[:12]}"

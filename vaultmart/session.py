"""Session defaults and the checkpoint folder.

The settings below are what the builders assume: UTC session zone (Hive's
``from_unixtime`` rendered the warehouse's zone, which is UTC here), ANSI on
(bad text goes through ``try_cast`` explicitly), adaptive execution with skew
handling, and dynamic partition overwrite so that writing one year never
touches the others.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

# Of every table written: texts of hashes halve, which snappy leaves as they are; at the lowest level, as
# there is no more in them that a higher one could find.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "vaultmart", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the defaults above.

    On a cluster ``master`` is left to spark-submit and ``shuffle_partitions``
    should be sized so that one shuffle partition holds ~128-256 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used as it is.  Only a local session (tests, bench) without the setting gets
    a folder of its own.  A cluster session without it is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # one process; local-cluster has several
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vaultmart-ckpt-"))
    return sc.getCheckpointDir()


_OPEN_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables ``cut_lineage`` writes inside the block when it ends.

    For runs that store their results (the pipelines); a query that returns a
    lazy frame still reading a cut table must not use it.
    """
    created: list[str] = []
    _OPEN_SCOPES.append(created)
    try:
        yield
    finally:
        _OPEN_SCOPES.pop()
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in created:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables in the shared checkpoint folder; it goes with the open scope, or with the session."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)  # else it outlives the session
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    read it back.

    One job writes it (``checkpoint()`` would compute the plan twice unless
    cached); the table survives the loss of any executor, keeps the plan of
    the next step short, and its file sizes give the planner real statistics
    for its broadcast decisions.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").options(**CODEC).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

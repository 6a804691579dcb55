"""Session defaults and the shared working folder of a job."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Defaults for a session made here. A cluster's own settings always win:
#: nothing below is applied to a session that exists already.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def session(app: str = "siltstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Where ``spark.checkpoint.dir`` is unset and the session runs in one process,
    a folder is made and removed at exit; a cluster must name its own.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors of {master} share")
    path = tempfile.mkdtemp(prefix="siltstone-")
    atexit.register(shutil.rmtree, path, True)
    spark.conf.set(CHECKPOINT_KEY, f"file://{path}")
    return f"file://{path}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` for work that costs far more than moving its rows, where its files give fewer partitions than the cluster has cores: its rows are dealt out once. Any larger input stays where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file wherever the session's file systems reach; an earlier one is replaced."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def is_mounted(uri: str) -> bool:
    """Whether the path is one of a mounted file system."""
    return uri.startswith("file:") or "://" not in uri


def local_path(uri: str) -> str:
    """A ``file:`` URI or plain path as a path of the file system."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri} is not on a mounted file system")
    return uri

"""Session construction and lineage management.

The settings below are the ones a cluster job wants too: AQE re-plans joins
and partition counts from runtime sizes, the skew-join rule splits hot
partitions, and the UI server stays off. On a real cluster the shuffle
partition count and the checkpoint folder come from the cluster config;
``build_session`` only fills in values that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "epistar",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a SparkSession with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system path set by the cluster
    configuration. Only when it is unset on a local master (tests) do we
    create a scratch folder of our own; on a cluster an unset value is an
    error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would be lost with its executor
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an object store)")
        configured = tempfile.mkdtemp(prefix="epistar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


# folders of the open scopes, the innermost last; threads of a load share them
_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Tables that ``cut_lineage`` writes inside are removed at the end; nothing that reads them may be used after it."""
    name = f"scope-{uuid.uuid4().hex}"
    _scopes.append(name)
    path = os.path.join(checkpoint_dir(spark), "tables", name)
    try:
        yield path
    finally:
        _scopes.remove(name)
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder.

    The written table survives executor loss (unlike a local checkpoint),
    is columnar and compressed (unlike an RDD checkpoint, which serialises
    rows one by one), and its file statistics let the planner size it, e.g.
    to broadcast a small result.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", *_scopes[-1:], uuid.uuid4().hex)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)

"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reviewlens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_LOCAL: dict[str, str] = {}


def _base(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``.

    Only a local master without that setting, as in tests, gets a temporary folder of its own machine.
    """
    key, app = "spark.checkpoint.dir", spark.sparkContext.applicationId
    base = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.setdefault(app, "") or tempfile.mkdtemp(prefix="run-")
        _LOCAL[app] = base
    return os.path.join(base, "reviewlens", app)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach."""
    return os.path.join(_base(spark), f"{purpose}-{uuid.uuid4().hex}")


def release(spark: SparkSession) -> None:
    """Delete what this application stored; call it when no result is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_base(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a costly table that is used more than once: it survives lost executors, is not computed
    again, and its size on disk is known to the optimizer.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    table = df.sparkSession.read.parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned; call it once all that reads them is stored itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

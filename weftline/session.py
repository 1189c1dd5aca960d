"""Session factory with the settings the library assumes."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(name: str = "weftline", **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; every setting can be overridden, none names a machine's folder."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | settings
    return SparkSession.builder.appName(name).config(map=conf).getOrCreate()


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """The file system that holds ``path`` deletes it when the driver ends."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(held)


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Where that is unset, a temporary folder in local mode, else an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="weftline-")
            drop_at_exit(spark, named)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()

"""Lineage cuts for operators that iterate: rows go to a folder that all executors share and are read from there."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: With this setting Spark drops the shuffle files of a finished execution; without it they stay until the driver's
#: garbage is collected. What a checkpoint holds has no need of them.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, as spark.checkpoint.dir names it.

    A session whose executors are threads of the driver, as in tests, may go without: it gets a temporary folder that is
    removed at its end. Elsewhere no folder of one machine would do, so a missing setting raises RuntimeError.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[[^\[\]]*\])?", context.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="terravane-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """``df`` in the checkpoint folder: a lost executor costs a reread, and the shuffles that made it are dropped."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint()  # a plan of its own, which is made under the setting
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder by whatever file system holds it; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

"""Session helpers shared by every subpackage."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: `spark.checkpoint.dir`.

    Where the cluster names none it is an error, unless driver and executors are one
    process (local master, as in tests): then a folder of our own is set.
    """
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if held:
        return held
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    held = "file://" + tempfile.mkdtemp(prefix="mercato-")
    spark.sparkContext.setCheckpointDir(held)
    return held


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's file systems reach it; a missing one is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether some file matches the path or glob, on the file system that Spark would read it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends in files that survive a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle and checkpoint files of frames that nothing refers to: it does so only when the driver's JVM collects its memory, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

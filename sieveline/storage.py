"""Lineage cuts in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this session; a temporary one only where none is set and Spark runs locally."""
    sc = spark.sparkContext
    if (found := sc.getCheckpointDir()) is not None:
        return found
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="sieveline-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there, so that a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system it lies."""
    system, at = _file_system(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this engine wrote."""
    system, at = _file_system(spark, path)
    system.delete(at, True)


def joined(spark: SparkSession, folder: str, to: str, head: str = "") -> None:
    """One file of ``head`` and the parts that Spark wrote in ``folder``, in their order; its bytes pass through the driver, and none are held."""
    system, at = _file_system(spark, folder)
    jvm = spark._jvm
    parts = sorted(p for p in (str(f.getPath()) for f in system.listStatus(at)) if p.rsplit("/", 1)[1].startswith("part-"))
    out = system.create(jvm.org.apache.hadoop.fs.Path(to), False)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            source = system.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20)
            finally:
                source.close()
    finally:
        out.close()


def copied(spark: SparkSession, path: str, to: str) -> None:
    """A copy of the driver's file where all can read it."""
    system, at = _file_system(spark, to)
    system.copyFromLocalFile(spark._jvm.org.apache.hadoop.fs.Path(f"file://{path}"), at)

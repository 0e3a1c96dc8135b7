"""Folders and files through Spark's own file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str | None) -> bool:
    if not path:
        return False
    p, fs = file_system(spark, path)
    return fs.globStatus(p) is not None


def remove(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one that driver and executors share.

    ``spark.checkpoint.dir`` names it.  Only a session whose executors are threads
    of the driver may do without: a temporary folder takes its place and is set.
    All folders of a session lie together; :func:`clean` removes them.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="virelay-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/virelay/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Removes all folders of :func:`scratch` that this session has made; results that read them must be written before."""
    remove(spark, scratch(spark, "x").rpartition("/")[0])


def concatenated(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """Joins the part files of a folder, in order, to one file, and removes the folder.

    The driver copies bytes through a buffer; nothing is held or sorted in one task.
    """
    source, fs = file_system(spark, folder)
    path, out_fs = file_system(spark, target)
    parts = sorted((str(s.getPath()) for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")), key=lambda x: x.rpartition("/")[2])
    out = out_fs.create(path, True)
    try:
        if head:
            out.write(bytearray(head.encode()))
        for part in parts:
            p, _ = file_system(spark, part)
            opened = fs.open(p)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(opened, out, 1 << 16, False)
            finally:
                opened.close()
    finally:
        out.close()
    fs.delete(source, True)

"""Session for local runs, and the shared folder for data that must outlive executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "saldomart", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the caller brings its own."""
    threads = str(os.cpu_count() or 8) if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", threads)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # saves driver round trips
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where nothing is set, a local session gets a temporary folder that goes when Python
    ends. A cluster session must name a folder that all executors see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="saldomart-")  # tests and trial runs on one machine
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop knows them."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text, None where there is none."""
    fs, file = hadoop_path(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, file = hadoop_path(spark, path)
    out = fs.create(file, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    _, to = hadoop_path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(jpath, to):
        raise OSError(f"cannot move {path} to {target}")

"""Tables, sizes and checkpoints, the same on a laptop and on a cluster."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: they needn't have it installed."""
    context = spark.sparkContext
    if getattr(context, "_leadweave_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="leadweave-"), "leadweave.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    context.addPyFile(at)
    context._leadweave_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where the session names none, a local one if Spark itself is local."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='leadweave-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def work_path(spark: SparkSession, what: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written table."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must be new: it is written under another name and appears, whole, by one rename."""
    jvm = spark.sparkContext._jvm
    at, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(at) or not fs.rename(draft, at):
        fs.delete(draft, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class Pointer:
    """The state of a written store: numbered files in ``path/_state``, of which the greatest counts. A step that fails
    before its file is there changes nothing, and two writers of one version exclude each other."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.at = spark, f"{path.rstrip('/')}/_state"

    def version(self) -> int:
        return max([int(n) for n in list_names(self.spark, self.at) if n.isdigit()], default=0)

    def read(self) -> tuple[int, dict]:
        v = self.version()
        return v, json.loads(read_text(self.spark, f"{self.at}/{v}")) if v else {}

    def write(self, version: int, state: dict) -> None:
        write_text(self.spark, f"{self.at}/{version}", json.dumps(state))


def cut(df: DataFrame, what: str = "cut", free: tuple[DataFrame, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there and survives lost executors.

    ``free``: results of earlier cuts that only ``df`` still needed; their files go once ``df`` is written.
    """
    spark = df.sparkSession
    at = work_path(spark, what)
    df.write.parquet(at)
    for old in free:
        delete_path(spark, old._leadweave_path)
    out = spark.read.schema(df.schema).parquet(at)
    out._leadweave_path = at
    return out


"""Session factory (API-7) and the shared scratch location.

The factory pins the session time zone to UTC so bar times never depend on the
JVM zone, turns on adaptive execution (runtime partition coalescing and skew
splitting), keeps the web UI off, and takes credentials only from the
environment through ordinary Spark configuration.
"""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Checkpoint files (global row positions) are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "ohlcflow",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Return (or reuse) a session with the library defaults applied.

    ``master`` is left to spark-submit on a cluster; tests pass ``local[n]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: runtime SQL settings still apply.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


@contextmanager
def spark_session(
    app_name: str = "ohlcflow",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> Iterator[SparkSession]:
    """Context manager form: the session is stopped on exit."""
    spark = build_session(app_name, master, conf)
    try:
        yield spark
    finally:
        spark.stop()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local master gets a private
    temporary folder; a cluster is refused, since its executors would each
    write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.split("[")[0] == "local":
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="ohlcflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Scratch folders of this process that have not been deleted yet.
_scratch: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, deleted with
    :func:`clean_scratch` or when the process ends."""
    path = f"{checkpoint_root(spark)}/ohlcflow/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_clean_at_exit, spark)
    _scratch.add(path)
    return path


def clean_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete these scratch folders (all of this process without arguments).

    Frames that still read them must have been used before."""
    for path in paths or list(_scratch):
        delete_path(spark, path)
        _scratch.discard(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the Hadoop file system of its scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def has_children(spark: SparkSession, path: str, prefix: str) -> bool:
    """Whether a folder has an entry whose name begins with ``prefix``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{prefix}*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries; none where there is no such folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file, read by the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


#: Folder of a table's columns, one numbered document per version.
SCHEMA_FOLDER = "_schema"


def schema_versions(spark: SparkSession, path: str) -> list[str]:
    """The versions of a table's columns, oldest first."""
    return sorted(n for n in list_names(spark, f"{path}/{SCHEMA_FOLDER}") if n.endswith(".json"))


def table_columns(spark: SparkSession, path: str) -> StructType | None:
    """The columns a table keeps, as of now; None if it keeps none."""
    versions = schema_versions(spark, path)
    return StructType.fromJson(json.loads(read_file(spark, f"{path}/{SCHEMA_FOLDER}/{versions[-1]}"))) if versions else None


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small text file there, whole, unless there is one of that name; whether it
    was put."""
    sc = spark.sparkContext
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    out = fs.create(part)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    plain = sc._gateway.new_array(rename, 1)
    plain[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(part, target, plain)
        return True
    except Py4JJavaError:
        fs.delete(part, False)
        if fs.exists(target):
            return False
        raise


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of its scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean_at_exit(spark: SparkSession) -> None:
    # A session that was stopped or whose JVM is gone has nothing to ask any more.
    if spark.sparkContext._jsc is not None and spark.sparkContext._jvm is not None:
        with suppress(Exception):
            clean_scratch(spark)

"""Session builder, the folder shared by all executors, and shipping of the package."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "leasemill", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators expect: UTC, ANSI, AQE and Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | (conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset a folder of this machine is made, if all of the session runs
    on it (tests, a laptop), and removed at exit; on a cluster that is an error, for executors would not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is not set, and {master} needs a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="leasemill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder).as_uri()
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/leasemill/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in the part that belongs to this application."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store_path(spark: SparkSession, name: str) -> str:
    """The path of a store that later applications find again under its name."""
    return f"{shared_dir(spark).rstrip('/')}/leasemill-stores/{name}"


def file_system(spark: SparkSession, path: str):
    """The path as Hadoop knows it, and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_intermediate(spark: SparkSession) -> None:
    """Remove all intermediate tables this application has written. Results that were not written elsewhere are lost with
    them; stores stay."""
    path, fs = file_system(spark, _own_folder(spark))
    fs.delete(path, True)


def persist_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a table that may come to the driver to be given to every task.
MOST_LOCAL_ROWS = 20_000


def small_or_stored(df: DataFrame, name: str) -> tuple[DataFrame, pa.Table | None]:
    """The rows of ``df``, computed once: held by the driver, also as a table of its own, if there are at most
    ``MOST_LOCAL_ROWS`` of them, else written to the shared folder."""
    rows = df.limit(MOST_LOCAL_ROWS + 1).toArrow()
    if rows.num_rows <= MOST_LOCAL_ROWS:
        return df.sparkSession.createDataFrame(rows, df.schema), rows
    return persist_table(df, name), None


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever they start: a zip in the shared folder, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_leasemill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, os.path.join(root.name, file.relative_to(root)))
    target = f"{shared_dir(spark).rstrip('/')}/leasemill-packages/{sc.applicationId}.zip"
    path, fs = file_system(spark, target)
    out = fs.create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target)
    sc._leasemill_shipped = True

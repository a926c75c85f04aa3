"""Session builder, table access and staging in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app_name: str = "tarnflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` keys use ``__`` for dots.

    Partition counts are left to the cluster's settings and to adaptive execution, so the same code
    serves a laptop and a large cluster.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, through Spark's own reader, so any file system will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: dict[tuple, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``; below a temporary one if that is unset and
    one machine does all the work; on a cluster that is an error.

    The JVM deletes it when the application ends.
    """
    app = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if (app, named) not in _FOLDERS:
        top = named.rstrip("/") if named else f"file://{_own_folder(spark)}"
        _FOLDERS[app, named] = f"{top}/tarnflow-{app}"
        path, files = _hadoop(spark, _FOLDERS[app, named])
        files.mkdirs(path)
        files.deleteOnExit(path)
    return _FOLDERS[app, named]


def _own_folder(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share; the master is {master}")
    folder = tempfile.mkdtemp(prefix="tarnflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _hadoop(spark: SparkSession, name: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: Bytes of an Arrow batch between the JVM and Python while results are staged; both sides hold a few of them a task.
ARROW_BYTES = 8 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_ARROW, None)
    held = int(before.rstrip("b")) if before and before.rstrip("b").isdigit() else None
    if held is None or 0 < held <= ARROW_BYTES:
        yield  # unknown here, or smaller already
        return
    spark.conf.set(_ARROW, ARROW_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_ARROW, before)


def stage(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors.

    ``by`` names a string column of few values that gets a folder for each, so that readers of one skip the rest.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    with _small_batches(spark):
        df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each that may be broadcast: some 40 MB in an executor.
BROADCAST_ROWS = 500_000


def broadcast_if_small(staged: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A staged frame of short rows, marked for broadcast only if it has at most ``most``; the count comes from its files."""
    return F.broadcast(staged) if staged.count() <= most else staged


def drop_staged(df: DataFrame) -> None:
    """Delete the folder behind a staged frame once nothing that still has to run reads it."""
    for name in df.inputFiles()[:1]:
        path, files = _hadoop(df.sparkSession, name)
        files.delete(path.getParent(), True)

"""Session construction and the two settings every operator relies on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "weftline", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Create a session with adaptive execution, Arrow and UTC switched on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so that the
    submit-time configuration decides.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def parallelism(spark: SparkSession) -> int:
    """Task count for an explicit repartition: the larger of cores and shuffle width."""
    return max(spark.sparkContext.defaultParallelism,
               int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, removed
    at exit, because a machine-local folder does not survive a lost executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="weftline-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


_own: list[str] = []
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Kernels are pickled by name, so workers must be able to import them wherever
    they were started.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="weftline-ship-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(
            os.path.join(folder, "weftline"), "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(app)


def clear_cuts(spark: SparkSession) -> None:
    """Remove what ``cut`` wrote for this application; results read from it are gone as well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_cut_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _cut_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/cuts-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, removed by ``clear_cuts``."""
    ship(spark)
    return f"{_cut_folder(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Lineage ends here, a lost executor costs a re-read, several readers cost one
    computation, and the size of the result is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._cut_path = path
    return written


def drop_cuts(*written: DataFrame) -> None:
    """Remove tables that ``cut`` returned, once nothing that is still to be computed reads them."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

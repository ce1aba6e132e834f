"""Session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames.  ``build_session`` is for tests, benchmarks and scripts; on a
cluster the caller builds the session and only ``recommended_conf`` matters.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that shape the physical plans the operators rely on:
# AQE re-plans joins at runtime (broadcast when a side turns out small,
# skew-join splitting when one key holds a large share of the rows) and
# coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Target bytes per shuffle partition for the largest stage; AQE coalesces
# smaller stages back towards ``advisoryPartitionSizeInBytes``.
SHUFFLE_TARGET_BYTES = 256 << 20


def shuffle_partitions_for(input_bytes: int, target_bytes: int = SHUFFLE_TARGET_BYTES,
                           minimum: int = 8) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for an input of ``input_bytes``
    (compressed Parquet grows a few times in memory; 256 MB compressed per
    partition keeps a task's shuffle block well inside executor memory).
    100 TB gives ~400 000 partitions; AQE merges the small ones at runtime."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def recommended_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "forumlens", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory))
    for k, v in recommended_conf(shuffle_partitions).items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is read as is.  Only
    when it is unset (local tests) do we create a scratch folder for it.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is unset; set it to a shared folder")
        path = tempfile.mkdtemp(prefix="forumlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_STAGING: list[str] = []      # folders of the open ``staging`` blocks


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = _STAGING[-1] if _STAGING else ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def staging(spark: SparkSession, name: str):
    """Tables staged in this block lie in one folder, which it yields, to be
    deleted by ``delete_path`` once what was built from them is written."""
    _STAGING.append(shared_path(spark, name))
    try:
        yield _STAGING[-1]
    finally:
        _STAGING.pop()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, path = _hadoop(spark, path)
    fs.delete(path, True)


_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Spark deletes the shuffle files of a query that runs in this block as
    soon as the query ends, not when the driver next collects garbage."""
    before = spark.conf.get(_DELETE_SHUFFLES, None)
    spark.conf.set(_DELETE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DELETE_SHUFFLES)
        else:
            spark.conf.set(_DELETE_SHUFFLES, before)


def materialize(df, name: str = "stage"):
    """Compute ``df`` once and cut its lineage: written as a Parquet table in
    the shared checkpoint folder and read back.  Survives executor loss
    (unlike a local checkpoint or an in-memory cache), is columnar and
    compressed (faster than a serialized RDD checkpoint), and the read-back
    carries file statistics for the planner.  The shuffle files of the write
    go when it is done: nothing reads them again."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with shuffles_deleted(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = spark.read.parquet(path)
    out._staged = path
    return out


def discard(df) -> None:
    """Delete the staged table that ``materialize`` returned as ``df``.  For
    tables that nothing reads any more: a job that still does would fail."""
    delete_path(df.sparkSession, df._staged)


_SHIPPED: set[str] = set()    # applications that have the package


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so
    that it need not be installed on the executors.  The driver serves the
    archive."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if not f.endswith(".pyc"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, path = _hadoop(spark, path)
    return fs.exists(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with its store's scheme."""
    fs, path = _hadoop(spark, path)
    return fs.makeQualified(path).toUri().toString()


def file_sizes(spark: SparkSession, uris: list[str]) -> list[int]:
    """Bytes of the files that ``DataFrame.inputFiles`` names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)) for u in uris]
    return [p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths]


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()), path

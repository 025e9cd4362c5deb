"""Session settings and the shared work folder.

Every operator takes a ``SparkSession`` (or a DataFrame) from the caller; this
module only builds one for tests, benches and the command-line pipelines, and
resolves the folder that durable intermediate results are written to.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours runs with: UTC event time (naive text is read
# as UTC), ANSI casts (bad text raises unless parsed with try_*), AQE on.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state (dedup keys) in RocksDB:
    # off-heap, spills to local disk, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_LOCAL_WORK_DIR: dict[str, str] = {}


def build_session(master: str = "local[*]", app: str = "sensorlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches. On a cluster, pass the cluster's
    own session to the operators instead."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Pin the SQL settings our semantics depend on (safe on any session),
    and make the package's Python code travel with the tasks."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    ship_code()


def ship_code() -> None:
    """Python workers (Pandas UDFs, foreachBatch functions) need this package. Pickle its functions and classes by value, so an
    executor runs them without the package installed or on its path (the
    alternative is shipping a zip with --py-files / addPyFile)."""
    from pyspark import cloudpickle
    import sensorlake
    cloudpickle.register_pickle_by_value(sensorlake)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised stages, stores and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; we only make our own
    (a local temporary folder) when that setting is absent, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        sc = None
    if configured:
        return configured.rstrip("/")
    if sc is not None and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = _LOCAL_WORK_DIR.get("dir")
    if base is None:
        base = tempfile.mkdtemp(prefix="sensorlake-")
        _LOCAL_WORK_DIR["dir"] = base
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base + "/rdd-checkpoints")
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def read_if_exists(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet. Every
    other error is raised."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def durable(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing a Parquet table in the shared work folder and
    reading it back.

    Used where a later step depends on a physical layout (range bounds come
    from sampling, positions from row order) that a recomputation after a lost
    executor could change: once written, every reader sees the same rows. A
    columnar table also lets later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for stages in _OPEN_STAGES.get():
        stages.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_OPEN_STAGES: ContextVar[tuple[list[str], ...]] = ContextVar("open_stages", default=())


@contextmanager
def temporary_stages(spark: SparkSession):
    """Deletes the ``durable`` stages written inside the block when it ends: for
    work whose results are all written by then, such as a micro-batch."""
    stages: list[str] = []
    token = _OPEN_STAGES.set((*_OPEN_STAGES.get(), stages))
    try:
        yield
    finally:
        _OPEN_STAGES.reset(token)
        for path in stages:
            delete_path(spark, path)


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file if nothing is at ``path`` (put-if-absent); False if
    something is. Of two callers at once one gets it, where the file system
    creates exclusively: local disks, HDFS and stores with that contract."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    try:
        if files.getUri().getScheme() == "file":
            # Hadoop's local file system checks first and creates then
            at = spark._jvm.java.io.File(target.toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createFile(at, spark.sparkContext._gateway.new_array(
                spark._jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            files.create(target, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False


def publish(spark: SparkSession, path: str, content: bytes) -> bool:
    """Puts a whole file at ``path`` if nothing is there; False if something is.
    Readers see all of it or nothing: it is written beside first and then
    linked (local disks) or renamed, which HDFS refuses where the target exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(beside)
    out.write(bytearray(content))
    out.close()
    try:
        if files.getUri().getScheme() != "file":
            return files.rename(beside, target)
        at = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, beside)]
        spark._jvm.java.nio.file.Files.createLink(*at)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(beside, False)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

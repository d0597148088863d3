"""Session defaults and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def default_conf(shuffle_partitions: int = 8) -> dict[str, str]:
    """Settings the engine is designed around.

    AQE re-plans joins at run time: a side whose *measured* shuffle output is
    under the broadcast threshold becomes a broadcast, a skewed partition of
    the large side is split. That is the size check behind every join whose
    small side has no type bound.
    """
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }


def build_session(master: str = "local[8]", app: str = "tollstream",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    # Python workers (and the driver-side runners of stateful processors)
    # inherit the JVM's environment: put this package on their path.
    parent = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if parent not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([parent, *paths])
    builder = SparkSession.builder.master(master).appName(app)
    conf = default_conf(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def spark_context(spark: SparkSession):
    """The SparkContext, or None in a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def app_id(spark: SparkSession) -> str:
    sc = spark_context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def task_slots(spark: SparkSession) -> int:
    sc = spark_context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", spark.conf.get("spark.sql.shuffle.partitions")))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent *and* the master is local (tests) a
    private folder is created; on a cluster an absent setting is an error,
    since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark_context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if not root:
        if sc is None:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="tollstream-")
        sc.setCheckpointDir(root)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_SCRATCH: dict[str, list[str]] = {}  # by application
_SCOPE = threading.local()  # innermost scratch_scope of a thread


def _fresh_path(spark: SparkSession, name: str) -> str:
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}tollstream/{name}-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    path = _fresh_path(spark, name)
    scope = getattr(_SCOPE, "paths", None)
    (_SCRATCH.setdefault(app_id(spark), []) if scope is None else scope).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders given out inside, by this thread, are deleted at the end: for
    steps of a long-running query that read nothing staged afterwards."""
    before, _SCOPE.paths = getattr(_SCOPE, "paths", None), []
    try:
        yield
    finally:
        paths, _SCOPE.paths = _SCOPE.paths, before
        for path in paths:
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Plans made inside see these runtime settings of the session."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API: works on any store Spark reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_scratch(spark: SparkSession) -> int:
    """Delete the folders :func:`scratch_path` gave out in this application,
    on whatever store they are; returns how many were there. For the end of a
    run, when nothing staged is read any more. Sources that are kept for the
    application are forgotten too: they may read such folders."""
    from .sources.events import forget_sources

    forget_sources(spark)
    dropped = 0
    for path in _SCRATCH.pop(app_id(spark), []):
        fs, p = hadoop_path(spark, path)
        dropped += bool(fs.delete(p, True))
    return dropped


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for tests that look at files directly."""
    return path[5:] if path.startswith("file:") else path


def ensure_dir(path: str) -> str:
    os.makedirs(local_path(path), exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make ``tollstream`` importable in Python workers: a zip of the package
    is written to the shared folder, on whatever store that is, and
    ``addPyFile`` hands it to the executors, once per application."""
    sc = spark_context(spark)
    app = app_id(spark)
    if sc is None or app in _SHIPPED:
        return
    import io
    import zipfile

    package = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for base, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    target = _fresh_path(spark, "code") + "/tollstream.zip"  # needed as long as the application runs
    fs, path = hadoop_path(spark, target)
    out = fs.create(path)
    try:
        out.write(packed.getvalue())
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)


def ship_package(spark: SparkSession) -> None:
    """:func:`ship_code`, and stateful processor classes travel by value, so
    that even a runner started without the package on its path (the
    driver-side state schema runner) can rebuild them."""
    from pyspark import cloudpickle

    from .streaming import exact, vehicle
    for mod in (vehicle, exact):
        cloudpickle.register_pickle_by_value(mod)
    ship_code(spark)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a lineage cut that survives executor loss, and a columnar copy that
    later scans read with column pruning and filter pushdown."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    # The schema is known: no footer-reading job to infer it.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_state_store(spark: SparkSession) -> None:
    """Streams here keep state in RocksDB (spills to disk, needed by
    ``transformWithStateInPandas``). The provider is a runtime setting read
    when a query first starts, so it is set for sessions that lack it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    # Commit a changelog per batch instead of a snapshot of every store.
    changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    if spark.conf.get(changelog, "false") != "true":
        spark.conf.set(changelog, "true")
    # A stream-stream join in one store a partition (column families) instead of four, each with its own commit.
    # A checkpoint keeps the format that it was made with.
    join = "spark.sql.streaming.join.stateFormatVersion"
    if spark.conf.get(join, "2") == "2":
        spark.conf.set(join, "3")

"""Spark session defaults and shared-folder helpers.

Everything that has to outlive a task (checkpoints, run folders of the
store, streaming state) goes under the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is only created when that
setting is missing and Spark runs in local mode (tests, bench).
"""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # documents can be long; keep Arrow batches handed to Python small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# streaming state (the seen headlines of a day) off the JVM heap; worth its
# start-up cost per state partition only when the state is large
ROCKSDB_STATE = {"spark.sql.streaming.stateStore.providerClass":
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def get_spark(master: str | None = None, app: str = "newsbeam",
              shuffle_partitions: int | None = None,
              extra: dict | None = None, state_store: str = "default") -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``state_store="rocksdb"`` keeps streaming state in RocksDB (production
    streams with a large seen-set); ``"default"`` is Spark's own provider.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if state_store == "rocksdb":
        conf.update(ROCKSDB_STATE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``newsbeam`` importable in Python workers in local mode: zip the
    package once per application and ``addPyFile`` it (what ``--py-files``
    does).  Python tasks (``mapInPandas``, UDTF) import helpers from it.  On
    a cluster the package is deployed with the job (``--py-files
    newsbeam.zip`` or an installed wheel), so nothing is written here."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or not sc.master.startswith("local"):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="newsbeam-pyfiles-"), "newsbeam.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, dirs, files in os.walk(pkg):
            dirs[:] = [x for x in dirs if x != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="newsbeam-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one run."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "runs", f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a parquet table into a fresh folder
    under the shared checkpoint folder and reading it back.

    One computation of the plan (``checkpoint()`` runs it once to count and
    again to write), columnar files, and the result no longer depends on the
    inputs, so they may be overwritten next.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_batches(spark, records: int, size: str):
    """Arrow batches handed to Python by the jobs of the block hold at most ``records`` rows (fewer where the session
    says fewer) and close once they reach ``size``."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": records, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in limits}
    own = before["spark.sql.execution.arrow.maxRecordsPerBatch"]
    if own and 0 < int(own) < records:
        limits["spark.sql.execution.arrow.maxRecordsPerBatch"] = int(own)
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextlib.contextmanager
def small_files(spark, cost: str = "128k"):
    """Scans run in the block weigh a file as its bytes and ``cost``: a task gets many small files, not 32 (at Spark's 4 MB each)."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, cost)
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def lean_parser(spark, states: int = 1000):
    """SQL text parsed in the block leaves at most ``states`` states in the parser's caches; else those of a long
    expression stay in the driver's heap for good."""
    limits = {"spark.sql.parser.manageParserCaches": "true", "spark.sql.parser.parserDfaCacheFlushThreshold": str(states)}
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def make_dir(spark: SparkSession, path: str) -> str:
    """Make the folder ``path``; returns it with the scheme of its Hadoop file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    return fs.makeQualified(p).toString()


def free_shuffles(spark: SparkSession) -> None:
    """Drop the shuffle files of plans that nothing refers to any more now, not when the driver's heap next fills up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of the session."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def staged(df, name: str = "stage"):
    """``materialize`` for one consumer: the staged table is deleted once the
    block (the write that reads it) has finished, so a job that runs every
    minute does not leave a copy behind per run."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)

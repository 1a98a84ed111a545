"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cores: str = "8", app: str = "tarmac") -> SparkSession:
    """A session for tests and single-machine benchmarks.

    On a cluster the session comes from the cluster's own configuration and nothing here applies.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "10g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # The JVM interprets generated methods above this size; smaller ones per operator get compiled.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder.
    """
    configured = _configured_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_ROOTS:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _LOCAL_ROOTS[app_id] = tempfile.mkdtemp(prefix="tarmac-")
        spark.sparkContext.setCheckpointDir(os.path.join(_LOCAL_ROOTS[app_id], "checkpoints"))
    return _LOCAL_ROOTS[app_id]


#: For wide projections: generated methods above 8000 bytes are interpreted by the JVM, smaller ones per operator compiled.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}
#: For writing them into a few folders: a file a folder is open at once, so the rows need not be sorted by folder.
WIDE_WRITES = COMPILED | {"spark.sql.maxConcurrentOutputFileWriters": "32"}

#: For reading many small files: tasks by the bytes in them. By default a file counts as 4 MB at least, so that a task
#: gets a few files however small they are, and writes as many small ones.
PACKED_READS = {"spark.sql.files.openCostInBytes": "262144"}

#: For texts on their way to Python. The default of 10,000 rows makes batches of some 20 MB, which the JVM's native
#: memory and the worker hold more than once and do not give back.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


#: What Spark leaves of a heap before it shares out the rest.
_RESERVED = 300 << 20


def task_memory(spark: SparkSession) -> int:
    """Bytes that each of an executor's tasks has for sorts, windows and joins when all of its cores are busy."""
    sc = spark.sparkContext
    conf = sc.getConf()
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        heap, tasks = sc._jvm.java.lang.Runtime.getRuntime().maxMemory(), sc.defaultParallelism
    else:
        heap = sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.executor.memory", "1g"))
        executors = len(sc._jsc.sc().statusTracker().getExecutorInfos()) - 1  # the driver is listed too
        tasks = int(conf.get("spark.executor.cores", "0")) or -(-sc.defaultParallelism // max(1, executors))
    shared = max(0, heap - _RESERVED) * float(conf.get("spark.memory.fraction", "0.6"))
    return int(shared / max(1, tasks))


@contextmanager
def settings(spark: SparkSession, **options: str):
    """Settings of the session that hold for the actions inside."""
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the scratch folder."""
    app_id = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app_id}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(spark: SparkSession, df, name: str):
    """Write ``df`` once to the scratch folder and continue from the files.

    The written files survive the loss of executors, and later readers see exact file sizes.
    """
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""SparkSession defaults for event-time work.

On a cluster the session is created by the platform; ``get_session`` only fills
in settings that are unset, so cluster-provided values (shuffle partitions,
``spark.checkpoint.dir``) always win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "eventide", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``.  Only in local mode, where the driver and
    the executors are one process, an unset value becomes a new temporary folder;
    elsewhere it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is unset and master is {master}: name a folder that the "
                             "driver and all executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-", dir=os.environ.get("EVENTIDE_SCRATCH"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Make ``eventide`` importable in Python workers (once per SparkContext).

    The package is zipped on the driver and registered with ``addPyFile``, which
    distributes it to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_eventide_shipped", False):
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    # Built on the driver; addPyFile uploads it to every executor, so the
    # shared checkpoint folder (possibly a remote filesystem) is not involved.
    base = os.path.join(tempfile.mkdtemp(prefix="eventide-py-"), f"eventide-{uuid.uuid4().hex[:8]}")
    archive = shutil.make_archive(base, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="eventide")
    sc.addPyFile(archive)
    # Stateful streaming workers read PYTHONPATH from the function environment,
    # which UDFs capture from ``sc.environment`` when they are created.
    paths = [archive, os.path.dirname(pkg_dir)]
    old = sc.environment.get("PYTHONPATH")
    sc.environment["PYTHONPATH"] = os.pathsep.join(paths + ([old] if old else []))
    sc._eventide_shipped = True


#: Rows with whole texts go to Python in batches of this size at most, unless the session sets it.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder + package shipping + batch size; call once before running eventide plans."""
    checkpoint_dir(spark)
    ship_package(spark)
    if not spark.sparkContext.getConf().contains(ARROW_BATCH[0]):
        spark.conf.set(*ARROW_BATCH)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``; Hadoop removes it when the driver ends."""
    sc = spark.sparkContext
    if not getattr(sc, "_eventide_scratch", None):
        folder = f"{checkpoint_dir(spark).rstrip('/')}/eventide-{sc.applicationId}-{uuid.uuid4().hex[:8]}"
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        sc._eventide_scratch = folder
    return sc._eventide_scratch


def materialize(df, **options: str):
    """Write ``df`` once as Parquet (with the writer's ``options``) in the shared scratch folder and read it back.

    The plan is computed a single time, the lineage ends at the written files, and
    executors that are lost later cost nothing but a re-read.
    """
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark removes a query's shuffle files when it ends, instead of when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize_alone(df, **options: str):
    """``materialize`` that leaves no shuffle files behind: the written table is all the disk that it keeps."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        # A frame is run as the setting was when it was made, so one is made now.
        return materialize(df.select("*"), **options)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def materialize_counted(df):
    """``materialize`` with the number of rows, counted while they are written."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    seen = Observation()
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, seen.get["n"]

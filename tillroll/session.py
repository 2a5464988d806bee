"""SparkSession helpers: settings the library relies on, and the shared
checkpoint folder used to cut lineage before overwriting a table."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings the library's semantics depend on.
REQUIRED_CONF = {
    # Wall-clock timestamps are parsed as session-zone instants and cast to
    # TIMESTAMP_NTZ; UTC makes that round trip exact (no DST gaps).
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for performance at scale; callers may override.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Post-shuffle partitions of ~128 MB; AQE coalesces small ones and splits
    # skewed join partitions (a hot key may hold a third of a table).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# A local master given by the caller runs everything in the driver JVM.
LOCAL_CONF = {
    "spark.driver.memory": "16g",
}


def submitted(key: str) -> bool:
    """Whether the deployment set ``key`` for this application already:
    spark-submit has started the JVM with it, or the submit arguments of a
    plain Python driver name it."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        from pyspark import SparkConf, SparkContext

        SparkContext._ensure_initialized()
        return SparkConf().contains(key)
    given = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    return f"{key}=" in given or (key == "spark.driver.memory" and "--driver-memory" in given)


def build_session(
    app_name: str = "tillroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    conf = {k: v for k, v in conf.items() if not submitted(k)}
    conf.update(REQUIRED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a folder every executor
    can reach). Only a local-mode session without one gets a private folder,
    as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    local = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


# Spark's setting that deletes a query's shuffle files as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping = {"lock": threading.Lock(), "blocks": 0, "before": None}


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that end in this block leave no shuffle files. Without it they
    stay on the executors' disks until the driver collects garbage, though
    nobody reads the shuffles of a finished write. Blocks may overlap
    (``run_concurrently``): the last one restores the session's setting."""
    with _dropping["lock"]:
        if not _dropping["blocks"]:
            _dropping["before"] = spark.conf.get(DROP_SHUFFLES, None)
            spark.conf.set(DROP_SHUFFLES, "true")
        _dropping["blocks"] += 1
    try:
        yield
    finally:
        with _dropping["lock"]:
            _dropping["blocks"] -= 1
            if not _dropping["blocks"]:
                if _dropping["before"] is None:
                    spark.conf.unset(DROP_SHUFFLES)
                else:
                    spark.conf.set(DROP_SHUFFLES, _dropping["before"])


def cut_lineage(df):
    """Materialise ``df`` reliably in the shared checkpoint folder.

    Used before a table is overwritten from data that was read from it, so the
    write never depends on files it is about to replace. Survives executor
    loss, unlike a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.checkpoint(eager=True)


@contextlib.contextmanager
def staged(df):
    """``df`` written to a folder of its own in the shared checkpoint folder
    and read back; the folder is deleted when the block ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    try:
        with shuffles_dropped(spark):
            df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def written(df, path: str, by: str | None = None):
    """``df`` added as Parquet to ``path``, a folder of its own all executors
    reach, and the folder read back: what follows plans over files, and a lost executor loses
    nothing. Hashed keys are most of these tables: an entropy coder halves
    them, which the default codec does not. Values of ``by``, the last column,
    get folders of their own."""
    writer = df.write.mode("append").option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):
        (writer if by is None else writer.partitionBy(by)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run_concurrently(actions) -> list:
    """Run independent Spark actions as concurrent jobs.

    Small jobs (a dimension write) leave most executors idle; submitting
    them together lets the scheduler fill the cluster. Each action is a
    zero-argument callable; errors propagate.
    """
    from concurrent.futures import ThreadPoolExecutor

    actions = list(actions)
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]

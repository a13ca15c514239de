"""Session settings and the shared scratch folder used to cut long lineages."""


import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "lexweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_marked: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder in the cluster's shared checkpoint folder; it is removed when the application ends.

    A temporary checkpoint folder is made only where none is configured, and only for local masters.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="lexweave-")
        spark.conf.set("spark.checkpoint.dir", configured)
    root = f"{configured.rstrip('/')}/lexweave-{spark.sparkContext.applicationId}"
    if root not in _marked:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _marked.add(root)
    return root


#: Has Spark remove the shuffle files of an action as soon as it is over, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables written within passing, by call.
_passing: list[list[str]] = []


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of actions inside are removed at their end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet in the shared scratch folder and read it back.

    Used where one result feeds several branches: it cuts the lineage, survives the loss of executors and gives
    the planner real sizes for its join choices. What was shuffled for it goes with the last row written.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _passing:
        _passing[-1].append(path)
    with without_leftovers(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def passing(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Result of make as a table; tables that make writes on its way are removed. make must not hand them to others."""
    _passing.append([])
    try:
        df = materialize(make(), label)
    finally:
        *steps, last = _passing.pop() or [None]
    if _passing:
        _passing[-1].append(last)
    for step in steps:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(step)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Even partitions for work that is heavy per row but small in bytes, which size-based coalescing would bunch up."""
    spark = df.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(wanted, key)

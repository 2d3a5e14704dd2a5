"""Session settings, settled intermediate results and working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. Join strategy is left to Catalyst and AQE:
# a side is broadcast only while its measured size is under Spark's threshold.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables are partitioned by site, of which there are two: there is nothing to prune, and where such a filter
    # ends above a union instead of in a scan it is asked before its subquery has run.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
}

# One root per application, so that a session without a shared folder (tests)
# does not make a new one for every call.
_fallback_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by someone else."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sitewise") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` where the cluster names one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _fallback_roots:
        _fallback_roots[app] = tempfile.mkdtemp(prefix="sitewise-")
    return _fallback_roots[app]


def workdir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder under the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, dense: bool = False) -> DataFrame:
    """Cut lineage: write the rows to the shared folder and go on from the files.

    Used where a result feeds many outputs, or where its partitioning must not be
    computed twice (range bounds come from a sample). The files survive the loss of
    executors, and their size is known when what follows is planned: a small batch of
    changes is broadcast to the large tables, a large one is not. ``dense``: as small as
    they get, for what is large and goes over the disk once or twice.
    """
    path = workdir(df.sparkSession, "settled")
    (df.write.option("compression", "zstd") if dense else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the working files, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(df: DataFrame) -> None:
    """Remove the files of a settled result that nothing will read any more.

    Call it only after everything derived from it has been settled or written itself.
    """
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/settled-" not in folder:
            raise ValueError(f"{folder} was not made by settle()")
        remove(df.sparkSession, folder)


def together(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent jobs side by side, so that small ones do not wait for large ones."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [done.result() for done in [pool.submit(inherit(job)) for job in jobs]]

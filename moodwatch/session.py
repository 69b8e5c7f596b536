"""Session-level helpers: time zone pinning and the shared work folder.

Nothing here builds a session for library users.  ``local_session`` exists for
tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"


def pin_utc(spark: SparkSession) -> None:
    """All wall-clock logic in this package is UTC (the reference used the JVM zone)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints, change logs and topic files.

    A folder registered with ``setCheckpointDir`` wins over ``spark.checkpoint.dir``, as
    in Spark itself.  Where neither is set, a session on one machine (``local[...]``) gets
    a new temporary folder; any other session must name a shared one."""
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a context handle (e.g. Spark Connect)
        sc = None
    path = sc.getCheckpointDir() if sc is not None else None
    path = path or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="moodwatch-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def parallelism(spark: SparkSession, default: int = 8) -> int:
    """Cores available to the session (``defaultParallelism``), with a fallback
    for sessions without a context handle."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", str(default)))


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in the
    shared folder (survives executor loss; never a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared folder for one run of one job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, state_store: str = "rocksdb") -> dict[str, str]:
    """Suggested settings for a large cluster (pass to ``SparkSession.builder.config``
    or spark-submit ``--conf``).  Shuffles start at 3x the cores and AQE
    coalesces them towards 256 MB; streams fix their state partitions at the
    first start, so those are sized to the cluster up front."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": UTC,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # upload per-batch changelogs instead of full snapshots every batch
        conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    return conf


def local_session(cores: int | str = "*", partitions: int | None = None, app: str = "moodwatch") -> SparkSession:
    """Session for tests and the benchmark (never used by library code)."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or max(8, n)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MOODWATCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session helpers: building a local session for tests/bench and
resolving the shared checkpoint folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "staffwise") -> SparkSession:
    """Session for tests and local benchmarking (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="staffwise-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized to the data.

    * shuffle partitions: enough for ~``target_partition_bytes`` per task of the
      input volume, and at least 3 waves of the cores, so a shuffle stage
      neither spills huge partitions nor idles cores; adaptive execution then
      coalesces small partitions and splits skewed ones at run time.
    * scan splits of ``target_partition_bytes`` for parquet/CSV.
    * broadcast threshold kept at a few tens of MB: size-estimated broadcasts
      above it fall back to shuffle joins.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used when present.  Only a local-mode session without the setting (tests,
    laptop runs) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="staffwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder.

    All of an application's paths sit in one folder named after its id, which
    the file system removes when the application ends (``deleteOnExit``), so
    nothing written by :func:`cut_lineage` outlives it.
    """
    base = f"{checkpoint_dir(spark).rstrip('/')}/staffwise-{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def drop_cut(df: DataFrame) -> None:
    """Remove the files behind a frame returned by :func:`cut_lineage`.

    For loops: call it on a state once the next state has been written from
    it and nothing else reads it.  Frames not made by ``cut_lineage`` are left
    alone.
    """
    path = getattr(df, "_staffwise_cut", None)
    if path:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame, name: str = "state", metrics: dict | None = None):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back.

    One job, no recomputation (a reliable ``checkpoint()`` would run the plan
    twice unless cached), columnar re-reads, and the written files survive the
    loss of any executor.  ``localCheckpoint`` is never used.

    ``metrics`` (``{name: aggregate column}``) are computed over the written
    table (a columnar scan of just the columns they use); then
    ``(df, {name: value})`` is returned.  ``DataFrame.observe`` is avoided on
    purpose: it leaves the session holding an object that cannot be
    serialized, and later ``pyspark.ml`` models that keep a training summary
    (logistic regression) then fail to transform.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staffwise_cut = path
    if not metrics:
        return out
    row = out.agg(*[c.alias(k) for k, c in metrics.items()]).first()
    return out, row.asDict()

"""Sinks (S17, S18): full-refresh tables and flat-file extracts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str | None = None, table: str | None = None, mode: str = "overwrite",
                partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full refresh of a table (S17), empty input included (an empty frame
    leaves an empty table, not the previous one).

    Catalog tables are refreshed through a staging table: the new data is
    written completely first, then the old table is renamed aside, the staging
    table takes its name, and the old one is dropped.  A failed load leaves
    the previous table in place, and a failed swap puts it back.
    ``partition_by`` (e.g. ``["eom"]``) lets later reads prune snapshots.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        spark = df.sparkSession
        if mode != "overwrite" or not spark.catalog.tableExists(table):
            w.saveAsTable(table)
            return
        staging = f"{table}__staging_{uuid.uuid4().hex[:8]}"
        w.saveAsTable(staging)
        old = f"{table}__old_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {old}")
    elif path is not None:
        w.save(path)
    else:
        raise ValueError("give path or table")


def _files(spark: SparkSession, path: str):
    """The file context of a path and a function that makes its paths."""
    fs = spark._jvm.org.apache.hadoop.fs
    root = fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return fs.FileContext.getFileContext(root.getFileSystem(conf).getUri(), conf), fs


def write_version(df: DataFrame, path: str, keep: int = 2, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Full refresh of a folder without a moment in which it is half written.

    The data goes to a new folder ``path/v-<number>-<id>``; once that is
    complete, the pointer file ``path/CURRENT`` is replaced by one rename, so
    a reader (:func:`read_version`) sees the old version or the new one, whole.
    A write that fails changes nothing that readers see.  The last ``keep``
    older versions stay for readers that are still busy with them; yet older
    ones and unfinished ones before them are removed.  One writer at a time.
    Returns the version.
    """
    spark = df.sparkSession
    context, fs = _files(spark, path)
    versions = _versions(spark, path)
    number = max([n for n, _ in versions], default=0) + 1
    version = f"v-{number:08d}-{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt)
    (w.partitionBy(*partition_by) if partition_by else w).save(f"{path}/{version}")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    draft, pointer = fs.Path(f"{path}/CURRENT-{version}"), fs.Path(f"{path}/CURRENT")
    out = draft.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(draft, True)
    out.write(bytearray(version.encode()))
    out.close()
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, pointer, how)
    for n, name in versions:
        if n < number - keep:
            context.delete(fs.Path(f"{path}/{name}"), True)
    return version


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs = spark._jvm.org.apache.hadoop.fs
    found = fs.Path(f"{path}/v-*").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(fs.Path(f"{path}/v-*"))
    names = [s.getPath().getName() for s in found or []]
    return sorted((int(n.split("-")[1]), n) for n in names)


def current_version(spark: SparkSession, path: str) -> str:
    """The version that readers of ``path`` get."""
    return spark.read.text(f"{path}/CURRENT").first()[0]


def read_version(spark: SparkSession, path: str, version: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The current version of a folder written by :func:`write_version`, or the one named."""
    return spark.read.format(fmt).load(f"{path}/{version or current_version(spark, path)}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", batchsize: int = 10000,
               num_partitions: int | None = None, **props) -> None:
    """Relational sink with batched inserts (S17).  ``num_partitions`` caps the
    number of concurrent connections."""
    out = df.repartition(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def write_extract(df: DataFrame, path: str, sep: str = ",") -> None:
    """Report extract as delimited text with a header."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)

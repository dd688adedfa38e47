"""Table sources (S11-S14): parquet folders, catalog tables and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The driver's table names.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def parquet_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (S14).  Column pruning and filter pushdown reach the scan."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM name`` on the session catalog."""
    return spark.read.table(name)


def catalog_query(spark: SparkSession, sql: str) -> DataFrame:
    """Query text over catalog views."""
    return spark.sql(sql)


def jdbc_table(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetchsize: int = 10000, **props) -> DataFrame:
    """A relational table or pushed-down query over JDBC.

    Give ``partition_column``/``lower``/``upper``/``num_partitions`` so the read
    is split across tasks instead of one connection reading everything.
    """
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()


def register_views(spark: SparkSession, base: str, names=DRIVER_TABLES) -> None:
    """Temp views over the parquet tables (for SQL-text queries)."""
    for n in names:
        parquet_table(spark, base, n).createOrReplaceTempView(n)

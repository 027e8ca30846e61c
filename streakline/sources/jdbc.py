"""A warehouse table over JDBC, as an optional source and sink.

Needs the database's driver on Spark's class path. Parquet is the default store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; with a column, its bounds and a count the read is split into ranges."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": "10000"}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partition column needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc_table(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(**options)).load()


def write_jdbc_table(df: DataFrame, url: str, table: str, user: str, password: str, mode: str = "append") -> None:
    options = {"url": url, "dbtable": table, "user": user, "password": password, "batchsize": "10000"}
    df.write.format("jdbc").options(**options).mode(mode).save()

"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitloom.operators.increment import PARTITION_COLUMNS
from hitloom.schemas import conform
from hitloom.sources.folders import qualified


def write_silver(requests: DataFrame, root: str, mode: str = "append") -> None:
    """Write silver below year/month/day folders.

    Rebalancing gathers each day for few files, yet lets AQE split a day that is
    far larger than the others, which a plain repartition would give to one task.
    Sorting by time inside a file narrows its row-group statistics.
    """
    (
        conform(requests, "silver")
        .hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, "timestamp")
        .write.mode(mode)
        .partitionBy(*PARTITION_COLUMNS)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static")
        .parquet(root)
    )


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a model's rows as Parquet, replacing earlier ones, and read them back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table at ``path`` whose files hold the rows of one bucket of ``key`` each, in
    its order; joins and aggregates by the key need no shuffle then.

    For rows that are few per key: a key's rows are written by one task.
    """
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a model as a view that stores nothing."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a catalog table keeps its files; None for a view or a missing table."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    row = described.where("col_name = 'Location'").first()
    return qualified(spark, row["data_type"]) if row else None


def _find_partitions(spark: SparkSession, name: str) -> None:
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def register_table(spark: SparkSession, name: str, path: str) -> str:
    """Point a catalog name at stored Parquet unless the name is already taken.

    A name that already points there is ``present`` and gets the partitions and files
    added since; one that points elsewhere is left alone and reported as ``conflict``.
    """
    if spark.catalog.tableExists(name):
        if table_location(spark, name) != qualified(spark, path):
            return "conflict"
        # Its files may have been replaced since this session listed them.
        spark.catalog.refreshTable(name)
        _find_partitions(spark, name)
        return "present"
    spark.catalog.createTable(name, path, "parquet")
    _find_partitions(spark, name)
    return "registered"


def publish_table(spark: SparkSession, name: str, path: str) -> str:
    """Point a model's catalog table at a new build; readers never see a part of one."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path, "parquet")
        return "registered"
    if table_location(spark, name) is None:
        return "conflict"
    stored = spark.read.parquet(path).schema
    if [(f.name, f.dataType) for f in spark.table(name).schema] == [
            (f.name, f.dataType) for f in stored]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{qualified(spark, path)}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path, "parquet")
    return "replaced"


def _each(spark: SparkSession, paths: dict[str, str], act) -> DataFrame:
    rows = [(name, act(spark, name, path)) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table STRING, status STRING")


def register_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Register each name; one row per table with what was done."""
    return _each(spark, paths, register_table)


def publish_tables(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Publish each model; one row per table with what was done."""
    return _each(spark, paths, publish_table)

"""Stored silver requests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitloom.schemas import SILVER
from hitloom.sources.commits import data_folders, loads_since, numbers, read_loads
from hitloom.sources.lookup import path_missing


def read_silver(spark: SparkSession, root: str,
                except_batch: int | None = None) -> DataFrame | None:
    """Silver with its partition columns, or None where nothing was ever written.

    Where loads were committed, the rows of just these are read. The schema is given, so no
    file is opened to infer it. Batches written by the stream lie below ``batch_id=``
    folders; one may be left out, and selecting by name hides that column.
    """
    if numbers(spark, root):
        return read_loads(spark, root, loads_since(spark, root))
    try:
        stored = spark.read.schema(SILVER).parquet(root)
    except AnalysisException as error:
        if path_missing(error):
            return None
        raise
    if except_batch is not None and "batch_id" in stored.columns:
        stored = stored.filter(F.col("batch_id") != except_batch)
    return stored.select(*SILVER.names)


def flat_silver_view(spark: SparkSession, root: str, view: str = "silver_files") -> DataFrame:
    """Register all of silver's files, however deep, as a view of the columns they hold.

    Folder names are not read, so the partition columns are not among them.
    """
    held = [field for field in SILVER if field.name not in ("year", "month", "day")]
    folders = data_folders(spark, root, loads_since(spark, root)) or [root]
    stored = spark.read.schema(StructType(held)).option(
        "recursiveFileLookup", True).parquet(*folders)
    stored.createOrReplaceTempView(view)
    return spark.table(view)


def silver_view(spark: SparkSession, root: str, view: str = "silver_requests") -> DataFrame:
    """Register silver as a view; the root is read, so partitions are discovered."""
    stored = read_silver(spark, root)
    if stored is None:
        raise FileNotFoundError(root)
    stored.createOrReplaceTempView(view)
    return spark.table(view)

"""Access-log text as eleven string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.schemas import LINE, RAW, RAW_WITH_LINE
from hitloom.sources.folders import matching

# Where logs land, and how a line is delimited.
LOG_GLOB = "*/*/logs/access.log"
LINE_OPTIONS = {"sep": " ", "quote": '"', "escape": "\\", "mode": "PERMISSIVE"}
# Fixed value: the characters of a blank line, space and everything below it.
BLANKS = "".join(map(chr, range(33)))


def log_paths(landing: str) -> str:
    return f"{landing.rstrip('/')}/{LOG_GLOB}"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified) of every landed log, from listings; none is opened."""
    if not matching(spark, log_paths(landing)):
        return spark.createDataFrame([], "path STRING, length BIGINT, modified BIGINT")
    listed = spark.read.format("binaryFile").load(log_paths(landing))
    return listed.select(
        "path", "length", F.unix_micros("modificationTime").alias("modified"))


def read_access_logs(spark: SparkSession, landing: str,
                     files: list[str] | None = None, with_line: bool = False) -> DataFrame:
    """All landed logs, or some of their files; short lines are padded with nulls, blank
    lines skipped.

    ``with_line`` adds the text of lines with more or fewer fields than the schema.
    """
    paths = log_paths(landing) if files is None else files
    reader = spark.read.options(**LINE_OPTIONS)
    if not with_line:
        return reader.schema(RAW).csv(paths)
    # A parser that skips fields does not notice how many there are.
    reader = reader.schema(RAW_WITH_LINE).option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", LINE).csv(paths)


def stream_access_logs(spark: SparkSession, landing: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """The same columns from files as they arrive, each file once."""
    reader = spark.readStream.schema(RAW).options(**LINE_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(log_paths(landing))


def fields_of_lines(lines: DataFrame, line: Column) -> DataFrame:
    """The same columns when lines already are a column of text.

    Blank lines are skipped, as the file reader does. Expanding through a generator
    keeps later filters above it; pushed below a plain projection, they would parse
    every line a second time.
    """
    parsed = F.from_csv(line, RAW.simpleString(), LINE_OPTIONS)
    present = F.btrim(line, F.lit(BLANKS)) != ""
    return lines.select(F.inline(F.when(present, F.array(parsed))))

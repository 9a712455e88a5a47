"""Landed logs to silver: one scan of the new files, one write, one commit."""

from __future__ import annotations

from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hitloom.operators.dedup import dedup_requests, not_yet_stored
from hitloom.operators.enrich import enrich_hostnames
from hitloom.operators.increment import newer_than
from hitloom.operators.parse import describe_requests, parse_requests
from hitloom.operators.quarantine import REASONS, bad_lines, reason_counts
from hitloom.operators.sinks import write_silver
from hitloom.schemas import TABLES, conform
from hitloom.sources import commits
from hitloom.sources.folders import scratch_folder
from hitloom.sources.lookup import read_lookup
from hitloom.sources.raw_logs import landed_files, read_access_logs
from hitloom.sources.silver import read_silver

# Counted stages of a load, in order.
STAGES = ("raw_lines", "with_address", "newer", "written")


def refine(requests: DataFrame, lookup: DataFrame | None,
           folder: str | None = None) -> DataFrame:
    """Deduplicate, name and describe typed requests.

    An address has one name, so naming after deduplication gives the same rows
    from a smaller input. ``folder`` is for what ``enrich_hostnames`` stores.
    """
    return describe_requests(enrich_hostnames(dedup_requests(requests), lookup, folder=folder))


def _counted(df: DataFrame, observation: Observation) -> DataFrame:
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def _rows(observation: Observation) -> int | None:
    metrics = _metrics(observation)
    return None if metrics is None else metrics["rows"]


def _metrics(observation: Observation) -> dict[str, int] | None:
    """The counts, or None when Spark dropped the counting step from an empty plan."""
    try:
        return observation.get
    except Py4JJavaError as error:
        # What Spark raises for a metric that no plan reported.
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None


def unread_files(spark: SparkSession, landing: str, silver: str,
                 before: commits.Commit | None) -> DataFrame:
    """Landed files that no load has read as they are now: new ones and changed ones."""
    landed = landed_files(spark, landing)
    if before is None:
        return landed
    known = commits.known_files(spark, silver, before)
    return landed.join(known, known.columns, "left_anti")


def new_requests(spark: SparkSession, landing: str, mark: datetime | None,
                 seen: dict[str, Observation], files: list[str] | None = None,
                 keep_late: bool = False, stored: DataFrame | None = None,
                 bad: Observation | None = None, folder: str | None = None) -> DataFrame:
    """Silver rows of the landed requests newer than the mark, counted on the way.

    With ``keep_late`` rows of any time are new, but for those whose key ``stored`` holds.
    ``bad`` counts unreadable lines by reason on the same scan.
    """
    raw = _counted(read_access_logs(spark, landing, files, bad is not None), seen["raw_lines"])
    if bad is not None:
        raw = raw.observe(bad, *reason_counts())
    parsed = _counted(parse_requests(raw), seen["with_address"])
    newer = _counted(newer_than(parsed, None if keep_late else mark), seen["newer"])
    refined = refine(newer, read_lookup(spark, landing), folder)
    if keep_late and stored is not None:
        refined = not_yet_stored(refined, stored)
    return refined


def write_quarantine(spark: SparkSession, landing: str, files: list[str], counts: Observation,
                     folder: str) -> dict[str, int]:
    """Store the bad lines of these files, if any were counted; returns lines by reason."""
    counted = _metrics(counts)
    if counted is not None and not any(counted.values()):
        return dict.fromkeys(REASONS, 0)
    raw = read_access_logs(spark, landing, files, with_line=True)
    conform(bad_lines(raw), "bad_lines").write.parquet(folder)
    stored = spark.read.schema(TABLES["bad_lines"]).parquet(folder).groupBy("reason").count()
    return {**dict.fromkeys(REASONS, 0), **{r["reason"]: r["count"] for r in stored.collect()}}


def load_increment(spark: SparkSession, landing: str, silver: str,
                   keep_late: bool = False, quarantine: bool = False) -> dict[str, int]:
    """Load the new and changed files of the landing folder; returns rows per stage and
    silver's total.

    Files that a load has read are not opened again unless they changed. Of the files at
    hand rows newer than silver's latest time are loaded; with ``keep_late`` older ones too,
    but for those whose key silver holds. The rows become visible in one commit, and a load
    that dies before it is simply run again (``hitloom.sources.commits``).

    With ``quarantine`` lines that could not be read in full are counted by reason, in
    ``bad_...``, and kept as they came (``commits.read_quarantine``); what could be read of
    them is loaded all the same. They are counted on the load's scan; only files with any
    are read once more for them.

    The counts of the stages before ``written`` ride on the scan. They are for monitoring: a
    task that is run again after an executor is lost may count twice. The rows written and
    silver's total come from the rows as stored.
    """
    before = commits.settle(spark, silver)
    files = unread_files(spark, landing, silver, before).collect()  # as many as Spark lists
    rows = dict.fromkeys(STAGES, 0)
    found = dict.fromkeys(REASONS if quarantine else (), 0)
    total = before.total_rows if before else 0
    if files:
        seen = {stage: Observation(stage) for stage in STAGES[:-1]}
        folder, paths = commits.new_folder(), [file["path"] for file in files]
        mark = before.mark if before else None
        stored = read_silver(spark, silver) if keep_late else None
        bad = Observation("bad_lines") if quarantine else None
        with scratch_folder(spark, "unnamed") as unnamed:
            write_silver(new_requests(spark, landing, mark, seen, paths, keep_late, stored, bad,
                                      unnamed), commits.staged(silver, folder))
        rows = {stage: _rows(observation) for stage, observation in seen.items()}
        if None in rows.values():
            lines = read_access_logs(spark, landing, paths).agg(F.count("*"), F.count("_c0"))
            rows = dict(zip(STAGES, (*lines.first(), 0)))
        if quarantine:
            found = write_quarantine(
                spark, landing, paths, bad, commits.quarantined(silver, folder))
        noted = spark.createDataFrame(files, commits.LEDGER)
        some = {name: n for name, n in found.items() if n}
        commit = commits.commit_load(spark, silver, before, folder, noted, some)
        rows["written"], total = commit.loads[-1].rows, commit.total_rows
    return {**rows, "silver_total": total, **{f"bad_{name}": n for name, n in found.items()}}

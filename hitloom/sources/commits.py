"""The loads that make up a silver folder.

A load writes its rows to a hidden folder and becomes visible by one small file, its
commit, written under the next number; a number is taken only once. Readers ask for the
folders of the commits, so they see a load whole or not at all. A load that dies before
its commit leaves rows nobody reads, and the next one loads them again; after it, nothing
is lost. A committed folder is then renamed to ``load=<number>``, so that tools that know
nothing of commits read the same rows; a load that died before that leaves the renaming
to the next one.

A commit also holds figures of its rows by day and the totals so far, so the newest one
tells how many rows silver has and their latest time without opening a data file. The
landed files that were read stand in ledgers, small tables that commits name. Every
``FOLD`` commits one lists all earlier loads and merges the ledgers, so a reader opens a
bounded number of commits.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.schemas import SILVER, TABLES
from hitloom.sources.folders import (
    exists,
    folder_bytes,
    matching,
    move,
    read_text,
    remove,
    write_text_once,
)

FOLD = 32
COMMITS, STAGING, LEDGERS = "_commits", "_staging", "_commits/_ledgers"
QUARANTINE = "_quarantine"
LEDGER = "path STRING, length BIGINT, modified BIGINT"


class ConcurrentLoad(RuntimeError):
    """Another load committed first; this one's rows were judged by what it replaced."""


@dataclass(frozen=True)
class Day:
    """Rows of one load on one day; no year for rows without a time."""

    year: int | None
    month: int | None
    day: int | None
    rows: int
    first: str | None
    last: str | None


@dataclass(frozen=True)
class Load:
    """One load: its number, its folder's name, and its rows by day."""

    number: int
    folder: str | None
    data_bytes: int = 0
    days: list[Day] = field(default_factory=list)
    bad: dict[str, int] = field(default_factory=dict)  # lines by reason
    quarantine: str | None = None

    @property
    def rows(self) -> int:
        return sum(day.rows for day in self.days)


@dataclass(frozen=True)
class Commit:
    """What one commit holds; ``loads`` ends with its own load."""

    loads: list[Load]
    folded: bool
    total_rows: int
    total_bytes: int
    last_time: str | None
    ledgers: list[str]

    @property
    def number(self) -> int:
        return self.loads[-1].number

    @property
    def mark(self) -> datetime | None:
        """The latest event time of all loads."""
        return datetime.fromisoformat(self.last_time) if self.last_time else None


def _of(text: str) -> Commit:
    values = json.loads(text)
    loads = [Load(**{**load, "days": [Day(**day) for day in load["days"]]})
             for load in values.pop("loads")]
    return Commit(loads=loads, **values)


def _file(root: str, number: int) -> str:
    return f"{root}/{COMMITS}/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commits, from their names."""
    names = (path.rsplit("/", 1)[1] for path in matching(spark, f"{root}/{COMMITS}/*.json"))
    return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit())


def newest(spark: SparkSession, root: str) -> Commit | None:
    """The newest commit; None for a folder that has none."""
    taken = numbers(spark, root)
    return _of(read_text(spark, _file(root, taken[-1]))) if taken else None


def loads_since(spark: SparkSession, root: str, after: int = 0) -> list[Load]:
    """All loads with a higher number, oldest first."""
    found: list[Load] = []
    for number in reversed(numbers(spark, root)):
        if number <= after:
            break
        commit = _of(read_text(spark, _file(root, number)))
        if commit.folded:
            found += [load for load in reversed(commit.loads) if load.number > after]
            break
        found.append(commit.loads[-1])
    return found[::-1]


def _published(root: str, number: int) -> str:
    return f"{root}/load={number:012d}"


def data_folders(spark: SparkSession, root: str, loads: list[Load]) -> list[str]:
    """Where the rows of these loads lie; loads that brought none have no folder."""
    renamed = {path.rsplit("=", 1)[1] for path in matching(spark, f"{root}/load=*")}
    return [
        _published(root, load.number) if f"{load.number:012d}" in renamed
        else f"{root}/{STAGING}/{load.folder}"
        for load in loads if load.folder
    ]


def read_loads(spark: SparkSession, root: str, loads: list[Load]) -> DataFrame | None:
    """Silver rows of these loads; None if they have none."""
    folders = data_folders(spark, root, loads)
    renamed = [folder for folder in folders if f"/{STAGING}/" not in folder]
    read = spark.read.schema(SILVER)
    parts = [read.parquet(folder) for folder in folders if folder not in renamed]
    if renamed:
        parts.insert(0, read.option("basePath", root).parquet(*renamed))
    parts = [part.select(*SILVER.names) for part in parts]
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """(load, reason, line, file) of the bad lines of all committed loads."""
    folders = [(load.number, f"{root}/{QUARANTINE}/{load.quarantine}")
               for load in loads_since(spark, root) if load.quarantine]
    schema = TABLES["bad_lines"]
    parts = [spark.read.schema(schema).parquet(folder).select(F.lit(number).alias("load"), "*")
             for number, folder in folders]
    empty = spark.createDataFrame([], schema).select(F.lit(0).alias("load"), "*")
    return reduce(DataFrame.unionByName, parts, empty)


def new_folder() -> str:
    return uuid.uuid4().hex


def staged(root: str, folder: str) -> str:
    return f"{root}/{STAGING}/{folder}"


def quarantined(root: str, folder: str) -> str:
    return f"{root}/{QUARANTINE}/{folder}"


def _days_of(spark: SparkSession, folder: str) -> list[Day]:
    """Figures of one load by day; a row per day it touches."""
    clock = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    by_day = spark.read.schema(SILVER).parquet(folder).groupBy("year", "month", "day").agg(
        F.count("*").alias("rows"), F.min(clock).alias("first"), F.max(clock).alias("last"))
    days = [Day(**row.asDict()) for row in by_day.collect()]  # as many as the load touches
    return sorted(days, key=lambda day: (day.year or 0, day.month or 0, day.day or 0))


def known_files(spark: SparkSession, root: str, commit: Commit | None) -> DataFrame:
    """(path, length, modified) of every landed file that a load has read."""
    if commit is None or not commit.ledgers:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(
        *(f"{root}/{LEDGERS}/{name}" for name in commit.ledgers))


def commit_load(spark: SparkSession, root: str, before: Commit | None, folder: str,
                files: DataFrame, bad: dict[str, int] | None = None) -> Commit:
    """Make the rows staged in ``folder`` part of silver, and ``files`` known.

    Only the staged files are opened, for their figures. ``bad`` counts the lines put into
    quarantine, which become visible by the same commit.
    """
    number = before.number + 1 if before else 1
    place = staged(root, folder)
    days = _days_of(spark, place) if matching(spark, f"{place}/*=*") else []
    load = Load(number, folder if days else None, folder_bytes(spark, place) if days else 0, days,
                bad or {}, folder if bad else None)
    fold = number % FOLD == 0
    ledger = new_folder()
    noted = known_files(spark, root, before).unionByName(files).coalesce(1) if fold else files
    noted.write.parquet(f"{root}/{LEDGERS}/{ledger}")
    kept = before.ledgers if before and not fold else []
    last = [day.last for day in days if day.last] + ([before.last_time] if before else [])
    commit = Commit(
        loads=[*(loads_since(spark, root) if fold else []), load], folded=fold,
        total_rows=(before.total_rows if before else 0) + load.rows,
        total_bytes=(before.total_bytes if before else 0) + load.data_bytes,
        last_time=max(filter(None, last), default=None), ledgers=[*kept, ledger])
    try:
        write_text_once(spark, _file(root, number), json.dumps(asdict(commit)))
    except FileExistsError as error:
        raise ConcurrentLoad(f"commit {number} of {root} is taken") from error
    finish(spark, root, [load])
    return commit


def finish(spark: SparkSession, root: str, loads: list[Load]) -> None:
    """Rename the folders of committed loads that still lie in staging."""
    for load in loads:
        if load.folder and exists(spark, staged(root, load.folder)):
            move(spark, staged(root, load.folder), _published(root, load.number))


def settle(spark: SparkSession, root: str) -> Commit | None:
    """The newest commit, after what a load that died has left was put right.

    Its number's folder is renamed if it was committed. Rows that were not committed stay
    in staging until ``remove_abandoned``, as another load may be writing them.
    """
    commit = newest(spark, root)
    if commit is None:
        held = (path.rsplit("/", 1)[1] for path in matching(spark, f"{root}/*"))
        if any(name[0] not in "_." for name in held):
            raise ValueError(f"{root} holds files that no commit knows")
        return None
    finish(spark, root, commit.loads[-1:])
    return commit


def remove_abandoned(spark: SparkSession, root: str) -> list[str]:
    """Delete staged rows that no commit names; returns the folders. Only while no load runs."""
    named = {name for load in loads_since(spark, root) for name in (load.folder, load.quarantine)}
    finish(spark, root, loads_since(spark, root))
    left = [path for part in (STAGING, QUARANTINE) for path in matching(spark, f"{root}/{part}/*")
            if path.rsplit("/", 1)[1] not in named]
    for path in left:
        remove(spark, path)
    return left

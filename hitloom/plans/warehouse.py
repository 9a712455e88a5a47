"""Silver to star and summaries, stored as tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession

from hitloom.operators import summaries
from hitloom.operators.quality import all_checks, gate
from hitloom.operators.sinks import (
    publish_tables,
    save_view,
    store,
    store_bucketed,
    table_location,
)
from hitloom.operators.star import STAR, stg_requests
from hitloom.sources.folders import exists, matching, qualified, remove


# Hit counts of the fact that the summaries share.
HITS = {
    "hits_by_hour": summaries.hits_by_hour,
    "hits_by_ip": summaries.hits_by_ip,
    "hits_by_request": summaries.hits_by_request,
}

# For a single summary, counts by its own key alone cost less than counts that are shared.
OWN_HITS = {
    "agg_status_breakdown": "status_sk",
    "agg_error_detail": "status_sk",
    "agg_day_of_week": "date_sk",
    "agg_daily_bytes": "date_sk",
}

# What each stored model is made from; the star comes from silver.
_FROM_FACT = {name: ("fact_requests",) for name in HITS}

# Each summary with the hit counts and the dimension it reads.
SUMMARIES = {
    "kpi_summary": (summaries.kpi_summary, "hits_by_ip", "dim_status"),
    "agg_hourly_traffic": (summaries.agg_hourly_traffic, "hits_by_hour", "dim_status"),
    "agg_status_breakdown": (summaries.agg_status_breakdown, "hits_by_hour", "dim_status"),
    "agg_top_endpoints": (summaries.agg_top_endpoints, "hits_by_request", "dim_request"),
    "agg_method_split": (summaries.agg_method_split, "hits_by_request", "dim_request"),
    "agg_error_detail": (summaries.agg_error_detail, "hits_by_hour", "dim_status"),
    "agg_day_of_week": (summaries.agg_day_of_week, "hits_by_hour", "dim_date"),
    "agg_daily_bytes": (summaries.agg_daily_bytes, "hits_by_hour", "dim_date"),
}


def star_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The star over silver, unstored."""
    staged = stg_requests(silver)
    return {name: model(staged) for name, model in STAR.items()}


def summary_over(name: str, silver: DataFrame) -> DataFrame:
    """One summary straight from silver, nothing stored on the way."""
    model, counted, dimension = SUMMARIES[name]
    staged = stg_requests(silver)
    key = OWN_HITS.get(name)
    count = HITS[counted] if key is None else (lambda fact: summaries.hits(fact, key))
    return model(count(STAR["fact_requests"](staged)), STAR[dimension](staged))


def needed_for(names: Iterable[str]) -> set[str]:
    """The models named and all that they are made from; KeyError for an unknown name."""
    made_from = {**dict.fromkeys(STAR, ()), **_FROM_FACT,
                 **{name: parts[1:] for name, parts in SUMMARIES.items()}}
    wanted, left = set(), list(names)
    while left:
        name = left.pop()
        if name not in wanted:
            wanted.add(name)
            left += made_from[name]
    return wanted


def build_warehouse(silver: DataFrame, root: str,
                    only: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Store every model below ``root``, a folder of its own for each build; returns the
    stored tables by name. ``only`` some models are stored with what they are made from.

    The fact is scanned three times, each for one to four columns, for the hit counts,
    which are stored first: several summaries and checks read them.
    """
    wanted = needed_for([*STAR, *HITS, *SUMMARIES] if only is None else only)
    save_view(stg_requests(silver), "stg_requests")
    star = {
        name: store(model, f"{root}/{name}") for name, model in star_tables(silver).items()
        if name in wanted
    }
    counts = {name: store(count(star["fact_requests"]), f"{root}/{name}")
              for name, count in HITS.items() if name in wanted}
    summary = {
        name: store(model(counts[counted], star[dimension]), f"{root}/{name}")
        for name, (model, counted, dimension) in SUMMARIES.items() if name in wanted
    }
    return {**star, **summary}


def build_bucketed(silver: DataFrame, root: str, database: str,
                   buckets: int) -> dict[str, DataFrame]:
    """Requests and their hit counts as bucketed tables, and the summaries over both.

    The counts hold one row per key, so no bucket is hot; the two summaries join them where
    they lie, without a shuffle.
    """
    staged, key = stg_requests(silver), "request_sk"
    models = {"dim_request": STAR["dim_request"](staged),
              "hits_by_request": HITS["hits_by_request"](STAR["fact_requests"](staged))}
    stored = {name: store_bucketed(model, f"{database}.{name}", f"{root}/{name}", key, buckets)
              for name, model in models.items()}
    return stored | {
        name: SUMMARIES[name][0](stored["hits_by_request"], stored["dim_request"])
        for name in ("agg_top_endpoints", "agg_method_split")
    }


# The stored hit counts that hold each key of the fact.
COUNTED_KEYS = {"ip_sk": "hits_by_ip", "status_sk": "hits_by_hour", "date_sk": "hits_by_hour",
                "request_sk": "hits_by_request"}


def check_warehouse(silver: DataFrame, tables: dict[str, DataFrame], root: str) -> list[Row]:
    """The results of the declared checks over one build, computed; of a build of some
    models those that they can be checked by."""
    spark = silver.sparkSession
    counted = {
        key: spark.read.parquet(f"{root}/{name}") for key, name in COUNTED_KEYS.items()
        if exists(spark, f"{root}/{name}")
    }
    return all_checks({"silver": silver, **tables}, counted).collect()


def build_checked(silver: DataFrame, root: str, severity: str = "error",
                  database: str | None = None, only: Iterable[str] | None = None,
                  ) -> tuple[dict[str, DataFrame], list[Row], DataFrame]:
    """A new build below ``root/builds``, its checks, and its tables as published.

    ``only`` some models, with what they are made from, are built, checked and published
    where named; the catalog's other tables stay at the build that made them.

    The catalog's tables point at the new build only after its checks passed (or
    ``severity`` is ``warn``); a build that dies or fails leaves the earlier one in place.
    Of the builds before it the last is kept for readers that still have it open, and those
    that a table still points at.
    """
    spark = silver.sparkSession
    build = f"{root}/builds/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    tables = build_warehouse(silver, build, only)
    results = check_warehouse(silver, tables, build)
    gate(results, severity)
    prefix = f"{database}." if database else ""
    published = publish_tables(
        spark, {f"{prefix}{name}": f"{build}/{name}" for name in tables})
    pointed_at = {table_location(spark, f"{prefix}{name}") for name in (*STAR, *SUMMARIES)}
    in_use = {place.rsplit("/", 1)[0] for place in pointed_at if place}
    for old in sorted(matching(spark, f"{root}/builds/*"))[:-2]:
        if qualified(spark, old) not in in_use:
            remove(spark, old)
    return tables, results, published


def newest_builds(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, str]:
    """Of each model the folder in the newest build below ``root`` that holds it."""
    found = {}
    for name in names:
        places = sorted(matching(spark, f"{root}/builds/*/{name}/_SUCCESS"))
        if not places:
            raise FileNotFoundError(f"{root}/builds/*/{name}")
        found[name] = places[-1].removesuffix("/_SUCCESS")
    return found


def check_stored(silver: DataFrame, root: str) -> list[Row]:
    """All declared checks over the newest stored models; nothing is built."""
    spark = silver.sparkSession
    places = newest_builds(spark, root, [*STAR, *HITS])
    tables = {name: spark.read.parquet(place) for name, place in places.items()}
    counted = {key: tables[name] for key, name in COUNTED_KEYS.items()}
    return all_checks({"silver": silver, **tables}, counted).collect()

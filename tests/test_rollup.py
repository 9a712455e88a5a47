"""Summaries kept up to date by day against a full build, and the bitmaps they count by."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fixtures import described, land, line, request, spoil
from hitloom.operators import addresses
from hitloom.operators.sinks import write_silver
from hitloom.operators.star import stg_requests
from hitloom.plans import rollup
from hitloom.plans.ingest import load_increment
from hitloom.plans.warehouse import SUMMARIES, summary_over
from hitloom.sources import commits
from hitloom.sources.silver import read_silver


def lines(day, hours, addr="1.2.3.4", **more):
    return [line(addr=f"{addr}{i % 3}", clock=f"{day}/Jan/2019:{h:02d}:00:00", size=str(10 * h + i),
                 request=f"GET /{i} HTTP/1.1", status=str(200 + 100 * (i % 4)), **more)
            for h in hours for i in range(5)]


@pytest.fixture
def places(tmp_path):
    return tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "rollup")


def assert_equals_full_build(spark, silver, root):
    stored = read_silver(spark, silver)
    tables = rollup.summary_tables(spark, root)
    assert set(tables) == set(SUMMARIES)
    for name, table in tables.items():
        assert table.dtypes == summary_over(name, stored).dtypes
        assert rows(table) == rows(summary_over(name, stored)), name


def test_increments_equal_one_full_build(spark, places):
    """A day in both loads, a day in one, requests without time, status or a request."""
    landing, silver, root = places
    land(landing, [*lines(20, range(4, 8)), *lines(21, range(4, 14)), line(clock="notatime"),
                   line(clock="20/Jan/2019:09:00:00", status="abc"),
                   line(clock="20/Jan/2019:09:00:01", request="GET", addr="8.8.8.8")])
    load_increment(spark, str(landing), silver)
    assert rollup.refresh(spark, silver, root) == [
        (None, None, None), (2019, 1, 20), (2019, 1, 21)]
    assert_equals_full_build(spark, silver, root)
    assert rollup.refresh(spark, silver, root) == []
    land(landing, [*lines(21, range(15, 20), addr="9.9.9.9"), *lines(23, range(4, 8))], month=2)
    load_increment(spark, str(landing), silver)
    assert rollup.refresh(spark, silver, root) == [(2019, 1, 21), (2019, 1, 23)]
    assert_equals_full_build(spark, silver, root)


def files_of(root):
    return {path: os.stat(path).st_mtime_ns
            for path in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def test_only_touched_days_are_read_and_replaced(spark, places):
    landing, silver, root = places
    land(landing, [*lines(20, range(4, 8)), *lines(21, range(4, 8))])
    load_increment(spark, str(landing), silver)
    rollup.refresh(spark, silver, root)
    before = files_of(root)
    spoil(f"{silver}/load=000000000001/year=2019/month=1/day=20")
    land(landing, lines(21, range(9, 12)), month=2)
    load_increment(spark, str(landing), silver)
    rollup.refresh(spark, silver, root)
    after = files_of(root)
    untouched = {p: t for p, t in before.items() if "day=20190120" in p}
    assert untouched and untouched.items() <= after.items()
    assert not any("day=20190121" in p and p in after for p in before)


@pytest.mark.parametrize("at", ["_replace", "number_new", "write_text_once"])
def test_a_refresh_that_dies_is_run_again(spark, places, monkeypatch, at):
    landing, silver, root = places
    land(landing, lines(20, range(4, 8)))
    load_increment(spark, str(landing), silver)
    rollup.refresh(spark, silver, root)
    land(landing, [*lines(20, range(9, 12), addr="7.7.7.7"), *lines(21, range(4, 8))], month=2)
    load_increment(spark, str(landing), silver)
    calls = []

    def dying(*given):
        calls.append(given)
        if at != "_replace" or len(calls) == 4:
            raise RuntimeError("died")
        return replace(*given)

    replace = rollup._replace
    with monkeypatch.context() as patch:
        patch.setattr(addresses if at == "number_new" else rollup, at, dying)
        with pytest.raises(RuntimeError, match="died"):
            rollup.refresh(spark, silver, root)
    assert len(rollup.refresh(spark, silver, root)) == 2
    assert_equals_full_build(spark, silver, root)


def test_bitmaps_merge_to_exact_counts(spark):
    """Days and two builds, with an address that holds a third of all rows."""
    seen = [(day, f"10.{day % 2}.{i % 40}.{i % 7}") for day in range(4) for i in range(200)]
    seen += [(day, "hot") for day in range(4) for _ in range(100)] + [(2, None)]
    frame = spark.createDataFrame(seen, "day int, remote_addr string").repartition(4)
    none = spark.createDataFrame([], "remote_addr string, number bigint")
    first = addresses.number_new(frame.where("day < 2"), none)
    both = first.unionByName(addresses.number_new(frame, first))
    assert both.count() == both.select("number").distinct().count() == len(
        {a for _, a in seen if a})
    assert rows(first) == rows(both.join(first, ["remote_addr", "number"], "left_semi"))
    one = addresses.address_bitmaps(frame.where("day < 2"), both, "day")
    other = addresses.address_bitmaps(frame.where("day >= 1"), both, "day")
    merged = addresses.count_addresses(one.unionByName(other), "day")
    exact = frame.groupBy("day").agg(F.countDistinct("remote_addr").alias("unique_ips"))
    assert rows(merged) == rows(exact)
    assert rows(addresses.count_addresses(one.unionByName(other))) == [
        (len({a for _, a in seen if a}),)]
    assert addresses.count_addresses(one.limit(0)).first()[0] == 0


def test_refresh_of_silver_without_rows(spark, places):
    landing, silver, root = places
    land(landing, [])
    load_increment(spark, str(landing), silver)
    assert rollup.refresh(spark, silver, root) == []
    assert commits.newest(spark, silver) is None or commits.newest(spark, silver).total_rows == 0


def add(spark, silver, *requests):
    """One more load of these rows, whatever silver holds."""
    folder = commits.new_folder()
    write_silver(described(spark, *requests), commits.staged(silver, folder))
    commits.commit_load(spark, silver, commits.newest(spark, silver), folder,
                        spark.createDataFrame([], commits.LEDGER))


def test_a_key_repeated_across_loads_is_found_on_its_day(spark, places):
    """Only days that the later load touches are read."""
    _, silver, root = places
    add(spark, silver, request(), request(at=1), request(at=86_400), request(url=None))
    rollup.refresh(spark, silver, root)
    check = rollup.unique_requests(spark, silver, root).first()
    assert (check["table"], check["column"], check["failures"], check["passed"]) == (
        "fact_requests", "request_id", 0, True)
    spoil(f"{silver}/load=000000000001/year=2024/month=1/day=6")
    add(spark, silver, request(at=86_400, size=7), request(at=86_401))
    rollup.refresh(spark, silver, root)
    assert rollup.unique_requests(spark, silver, root).first()["failures"] == 1


def test_an_address_that_holds_a_time_makes_ids_of_two_days_equal(spark, places):
    """Found over all days, as a full check finds it."""
    _, silver, root = places
    a = request(addr="x2024-01-07 10:00:00", at=0, method="G", url="/")  # x + its time + own time
    b = request(addr="x", at=86_400, method="2024-01-06 10:00:00G", url="/")
    add(spark, silver, a)
    rollup.refresh(spark, silver, root)
    add(spark, silver, b)
    rollup.refresh(spark, silver, root)
    staged = stg_requests(read_silver(spark, silver))
    assert staged.select("request_id").distinct().count() == 1
    assert rollup.unique_requests(spark, silver, root).first()["failures"] == 1


def test_thousands_of_days_are_picked(spark):
    """As conditions joined by ``or`` they overflowed the stack from some 1,800 days on."""
    days = [(2000 + n // 336, 1 + n // 28 % 12, 1 + n % 28) for n in range(5000)]
    silver = spark.createDataFrame(
        [(*day, i) for i, day in enumerate([*days, (1999, 1, 1), (None, None, None)])],
        "year INT, month INT, day INT, n INT")
    picked = rollup.on_days(silver, [(None, None, None), *days[1:]])
    assert sorted(r.n for r in picked.collect()) == [*range(1, 5000), 5001]
    assert [r.n for r in rollup.on_days(silver, [(1999, 1, 1)]).collect()] == [5000]


def test_many_days_are_written_by_several_tasks(spark):
    """One task wrote the folders of all small days one after the other."""
    rows_of = spark.range(3000).select((F.col("id") % 300).cast("int").alias("day"), "id")
    tasks = rollup._gathered(rows_of, 300).select("day", F.spark_partition_id().alias("task"))
    assert tasks.select("task").distinct().count() > 1
    assert tasks.distinct().count() == 300
    few = rollup._gathered(rows_of, 3).select(F.spark_partition_id().alias("task"))
    assert few.distinct().count() == 1

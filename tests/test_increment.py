from __future__ import annotations

import glob
import os
from datetime import datetime
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import plan, rows
from fixtures import described, land, land_lookup_csv, line, request, spoil
from hitloom.operators import enrich
from hitloom.operators.increment import (
    high_water_mark,
    newer_than,
    stored_days,
    stored_high_water_mark,
)
from hitloom.operators.sinks import write_silver
from hitloom.plans import ingest
from hitloom.plans.ingest import STAGES, load_increment, new_requests
from hitloom.session import shared_folder
from hitloom.sources import commits
from hitloom.sources.folders import matching
from hitloom.sources.silver import flat_silver_view, read_silver, silver_view

DAY1 = [line(clock=f"22/Jan/2019:10:00:{i:02d}", request=f"GET /{i} HTTP/1.1") for i in range(5)]
DAY2 = [line(clock=f"23/Jan/2019:10:00:{i:02d}", request=f"GET /{i} HTTP/1.1") for i in range(5)]
LATE = line(clock="22/Jan/2019:09:00:00", request="GET /late HTTP/1.1")
UNTIMED = line(addr="9.9.9.9", clock="notatime")


@pytest.fixture
def places(tmp_path):
    landing = tmp_path / "raw"
    landing.mkdir()
    land_lookup_csv(landing, "client_ip,hostname\n1.2.3.4,one.example\n")
    return landing, str(tmp_path / "silver")


def test_mark_of_missing_and_empty_silver(spark, tmp_path):
    assert read_silver(spark, str(tmp_path / "none")) is None
    assert high_water_mark(None) is None
    (tmp_path / "empty").mkdir()
    assert high_water_mark(read_silver(spark, str(tmp_path / "empty"))) is None


def test_other_read_errors_pass_through(spark):
    with pytest.raises(Exception) as error:
        read_silver(spark, "nosuchscheme://host/silver")
    assert not isinstance(error.value, AnalysisException) or (
        error.value.getCondition() != "PATH_NOT_FOUND")


def mark_of(spark, root):
    return stored_high_water_mark(spark, root, read_silver(spark, root))


def test_mark_opens_only_the_newest_day(spark, tmp_path):
    root = str(tmp_path / "silver")
    # Day 10 comes after day 9, whose folder name sorts after it.
    write_silver(described(spark, request(at=3 * 86_400), request(at=4 * 86_400),
                           request(at=4 * 86_400 + 5), request(addr="b", time=False)), root)
    for folder in glob.glob(f"{root}/*/*/*"):
        if not folder.endswith("/day=10"):
            spoil(folder)
    assert mark_of(spark, root) == datetime(2024, 1, 10, 10, 0, 5)


def test_mark_falls_back_and_sees_batches(spark, tmp_path):
    root = str(tmp_path / "silver")
    write_silver(described(spark, request(addr="b", time=False)), root)
    assert stored_days(spark, root) == [] and mark_of(spark, root) is None
    write_silver(described(spark, request(at=5)), root)
    write_silver(described(spark, request(at=86_400)).withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz")), root)
    assert mark_of(spark, root) == datetime(2024, 1, 6, 10, 0, 5)
    batches = str(tmp_path / "batches")
    for i in range(2):
        write_silver(described(spark, request(at=i)), f"{batches}/batch_id={i}", mode="overwrite")
    assert stored_days(spark, batches) == [(2024, 1, 6)]
    assert mark_of(spark, batches) == datetime(2024, 1, 6, 10, 0, 1)


def test_newer_is_strict_and_drops_untimed_only_with_a_mark(spark):
    log = described(spark, request(at=0), request(at=1), request(at=2), request(time=False))
    assert newer_than(log, None).count() == 4
    assert rows(newer_than(log, datetime(2024, 1, 6, 10, 0, 1)), "timestamp") == [
        (datetime(2024, 1, 6, 10, 0, 2),)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_mark_is_the_same_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        log = described(spark, request(at=0), request(at=1))
        assert newer_than(log, high_water_mark(log)).count() == 0
        assert newer_than(log, datetime(2024, 1, 6, 10, 0, 0)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_loads_append_only_newer_rows(spark, places):
    landing, silver = places
    land(landing, [*DAY1, DAY1[0], UNTIMED, ""])
    assert load_increment(spark, str(landing), silver) == {
        "raw_lines": 7, "with_address": 7, "newer": 7, "written": 6, "silver_total": 6}
    # The same files again add nothing.
    assert load_increment(spark, str(landing), silver)["written"] == 0
    assert read_silver(spark, silver).count() == 6
    # A second upload is read alone; its newer rows are added, the late and untimed stay out.
    land(landing, [*DAY2, LATE, UNTIMED], month=2)
    assert load_increment(spark, str(landing), silver) == {
        "raw_lines": 7, "with_address": 7, "newer": 5, "written": 5, "silver_total": 11}
    stored = read_silver(spark, silver)
    assert stored.count() == 11
    assert "/late" not in {r["url"] for r in stored.collect()}
    assert rows(stored.select("remote_addr", "client_hostname").distinct()) == [
        ("1.2.3.4", "one.example"), ("9.9.9.9", None)]


def test_untimed_rows_keep_null_partitions(spark, places):
    landing, silver = places
    land(landing, [DAY1[0], UNTIMED])
    load_increment(spark, str(landing), silver)
    view = silver_view(spark, silver, "silver_under_test")
    assert rows(view, "timestamp", "year", "month", "day") == [
        (None, None, None, None), (datetime(2019, 1, 22, 6, 30), 2019, 1, 22)]


def test_a_load_split_by_time_equals_a_full_load(spark, places, tmp_path):
    landing, silver = places
    land(landing, DAY1)
    load_increment(spark, str(landing), silver)
    land(landing, DAY2, month=2)
    load_increment(spark, str(landing), silver)
    full = str(tmp_path / "full")
    load_increment(spark, str(landing), full)
    assert rows(read_silver(spark, silver)) == rows(read_silver(spark, full))


def test_a_load_scans_the_log_once_and_shuffles_it_once(spark, places):
    landing, _ = places
    land(landing, DAY1)
    loaded = new_requests(spark, str(landing), datetime(2019, 1, 1),
                          {stage: Observation(stage) for stage in STAGES})
    text = plan(loaded)
    assert text.count("FileScan csv [_c0") == 1
    log, lookup = text.split("BroadcastExchange")
    assert log.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in log and "_c1" not in log


class Died(RuntimeError):
    """Stands for a driver that is lost."""


def dying(*_, **__):
    raise Died


@pytest.mark.parametrize("at", ["_days_of", "write_text_once", "move"])
@pytest.mark.parametrize("keep_late", [False, True])
def test_a_load_that_dies_is_run_again(spark, places, tmp_path, monkeypatch, at, keep_late):
    """Killed after the write, before the commit, or before the renaming: no row is lost
    and none stands twice, for readers of commits and for plain ones."""
    landing, silver = places
    land(landing, DAY1)
    load_increment(spark, str(landing), silver)
    land(landing, [*DAY2, DAY1[0]], month=2)
    with monkeypatch.context() as patch:
        patch.setattr(commits, at, dying)
        with pytest.raises(Died):
            load_increment(spark, str(landing), silver, keep_late)
    committed = at == "move"
    assert read_silver(spark, silver).count() == (10 if committed else 5)
    assert load_increment(spark, str(landing), silver, keep_late)["silver_total"] == 10
    assert rows(read_silver(spark, silver), "url") == sorted([(f"/{i}",) for i in range(5)] * 2)
    assert spark.read.parquet(silver).count() == 10  # a reader that knows no commits
    left = commits.remove_abandoned(spark, silver)
    assert len(left) == (0 if committed else 1)
    assert read_silver(spark, silver).count() == 10


def test_a_write_that_fails_half_way_leaves_nothing_to_readers(spark, places, monkeypatch):
    """Some tasks have written their files when the job fails."""
    landing, silver = places
    land(landing, [*DAY1, *DAY2])

    def half(requests, folder):
        from hitloom.operators.sinks import write_silver
        write_silver(requests.where("day = 22"), folder)
        raise Died

    with monkeypatch.context() as patch:
        patch.setattr("hitloom.plans.ingest.write_silver", half)
        with pytest.raises(Died):
            load_increment(spark, str(landing), silver)
    assert read_silver(spark, silver).count() == 0
    assert load_increment(spark, str(landing), silver)["silver_total"] == 10
    assert read_silver(spark, silver).count() == 10


def test_known_files_are_not_opened_again(spark, places):
    """Old logs and old silver files are made unreadable, and later loads still work."""
    landing, silver = places
    land(landing, DAY1)
    load_increment(spark, str(landing), silver)
    old = landing / "year=2024" / "month=01" / "logs" / "access.log"
    stat, text = old.stat(), old.read_bytes()
    old.write_bytes(b"\xff" * len(text))
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    for folder in glob.glob(f"{silver}/load=*/*/*/*"):
        spoil(folder)
    land(landing, DAY2, month=2)
    assert load_increment(spark, str(landing), silver) == {
        "raw_lines": 5, "with_address": 5, "newer": 5, "written": 5, "silver_total": 10}
    assert load_increment(spark, str(landing), silver) == {
        "raw_lines": 0, "with_address": 0, "newer": 0, "written": 0, "silver_total": 10}
    state = commits.newest(spark, silver)
    assert state.mark == datetime(2019, 1, 23, 6, 30, 4) and state.number == 2
    assert [(d.day, d.rows) for load in commits.loads_since(spark, silver) for d in load.days] == [
        (22, 5), (23, 5)]


def test_a_grown_file_is_read_again_for_its_new_rows(spark, places):
    landing, silver = places
    land(landing, DAY1)
    load_increment(spark, str(landing), silver)
    land(landing, [LATE, *DAY1, *DAY2])
    assert load_increment(spark, str(landing), silver)["written"] == 5


def test_late_rows_are_kept_on_demand_but_never_twice(spark, places):
    landing, silver = places
    land(landing, [*DAY1, UNTIMED])
    load_increment(spark, str(landing), silver)
    land(landing, [*DAY2, LATE, DAY1[0], LATE, UNTIMED], month=2)
    assert load_increment(spark, str(landing), silver, keep_late=True)["written"] == 6
    stored = read_silver(spark, silver)
    assert stored.count() == 12 and stored.where("url = '/late'").count() == 1
    assert stored.where("remote_addr = '9.9.9.9'").count() == 1


def test_many_loads_fold_into_one_commit(spark, places, monkeypatch):
    landing, silver = places
    monkeypatch.setattr(commits, "FOLD", 3)
    for i in range(7):
        land(landing, [line(clock=f"{10 + i}/Jan/2019:10:00:00")], month=i + 1)
        assert load_increment(spark, str(landing), silver)["silver_total"] == i + 1
    opened = []
    read = commits.read_text
    monkeypatch.setattr(commits, "read_text", lambda s, f: opened.append(f) or read(s, f))
    assert [load.number for load in commits.loads_since(spark, silver)] == [1, 2, 3, 4, 5, 6, 7]
    assert len(opened) == 2  # the last, and the fold before it
    assert [load.number for load in commits.loads_since(spark, silver, 4)] == [5, 6, 7]
    assert len(commits.newest(spark, silver).ledgers) == 2
    assert read_silver(spark, silver).count() == 7
    assert load_increment(spark, str(landing), silver)["raw_lines"] == 0


def test_of_two_loads_at_once_one_commits(spark, places, monkeypatch):
    landing, silver = places
    land(landing, DAY1)
    write = ingest.write_silver

    def overtaken(requests, folder):
        write(requests, folder)
        monkeypatch.setattr(ingest, "write_silver", write)
        load_increment(spark, str(landing), silver)

    monkeypatch.setattr(ingest, "write_silver", overtaken)
    with pytest.raises(commits.ConcurrentLoad):
        load_increment(spark, str(landing), silver)
    assert read_silver(spark, silver).count() == 5


def test_a_load_leaves_files_of_others_alone(spark, places):
    landing, silver = places
    land(landing, DAY1)
    write_silver(described(spark, request()), silver)
    with pytest.raises(ValueError, match="no commit"):
        load_increment(spark, str(landing), silver)


def test_a_load_without_rows_or_files(spark, places):
    landing, silver = places
    none = {"raw_lines": 0, "with_address": 0, "newer": 0, "written": 0, "silver_total": 0}
    assert load_increment(spark, str(landing), silver) == none
    land(landing, ["- - - [x +0330]"][:0])
    assert load_increment(spark, str(landing), silver) == none
    assert read_silver(spark, silver) is None
    land(landing, DAY1, month=3)
    assert load_increment(spark, str(landing), silver)["silver_total"] == 5


def test_the_flat_view_reads_files_of_loads_and_batches_alike(spark, places, tmp_path):
    landing, silver = places
    land(landing, [DAY1[0], UNTIMED])
    load_increment(spark, str(landing), silver)
    land(landing, DAY2, month=2)
    load_increment(spark, str(landing), silver)
    flat = flat_silver_view(spark, silver, "flat_under_test")
    assert flat.columns == [c for c in read_silver(spark, silver).columns
                            if c not in ("year", "month", "day")]
    assert rows(flat) == rows(read_silver(spark, silver).select(*flat.columns))
    plain = str(tmp_path / "plain")
    write_silver(described(spark, request(), request(at=86_400)), f"{plain}/batch_id=0")
    assert flat_silver_view(spark, plain, "flat_under_test").count() == 2


def test_counts_hold_when_the_lookup_is_too_large_to_broadcast(spark, tmp_path, monkeypatch):
    """The join by shuffle reads the requests three times; each line counts once."""
    join = ingest.enrich_hostnames
    monkeypatch.setattr(ingest, "enrich_hostnames", partial(join, broadcast_bytes=0))
    monkeypatch.setattr(enrich, "HOT_SHARE", 1)  # so no address is hot
    landing, silver = tmp_path / "landing", str(tmp_path / "silver")
    land(landing, [line(size=str(i // 2), request=f"GET /{i // 2} HTTP/1.1") for i in range(10)])
    land_lookup_csv(landing, "client_ip,hostname\n1.2.3.4,one\n5.6.7.8,two\n")
    before = matching(spark, f"{shared_folder(spark)}/hitloom/unnamed-*")
    counted = load_increment(spark, str(landing), silver)
    assert [counted[stage] for stage in STAGES] == [10, 10, 10, 5]
    assert rows(read_silver(spark, silver), "client_hostname") == [("one",)] * 5
    assert matching(spark, f"{shared_folder(spark)}/hitloom/unnamed-*") == before

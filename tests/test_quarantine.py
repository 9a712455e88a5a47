"""Unreadable lines: reasons, counts on the scan, and the lines as they came."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from fixtures import land, line
from hitloom.operators.quarantine import REASONS, bad_lines, reason_counts
from hitloom.plans.ingest import load_increment
from hitloom.sources import commits
from hitloom.sources.raw_logs import read_access_logs
from hitloom.sources.silver import read_silver

GOOD = [line(), line(size="-", request="GET /b HTTP/1.1"), line(request="GET /c HTTP/1.1")[:-4]]
BAD = {
    "no_address": '"" - - [22/Jan/2019:03:56:14 +0330] "GET /a HTTP/1.1" 200 1 "-" "ua" "-"',
    "short_line": "1.2.3.4 - - [22/Jan/2019:03:56:14 +0330]",
    "surplus_fields": line() + " more",
    "time": line(clock="notatime"),
    "request": line(request="GET"),
    "status": line(status="abc"),
    "size": line(size="x"),
}


def test_every_reason_and_no_good_line(spark, tmp_path):
    land(tmp_path, [*GOOD, "", *BAD.values()])
    raw = read_access_logs(spark, str(tmp_path), with_line=True)
    found = {r.reason: r.line for r in bad_lines(raw).collect()}
    assert set(found) == set(REASONS) == set(BAD)
    assert found["short_line"] == BAD["short_line"]
    assert found["surplus_fields"] == BAD["surplus_fields"]
    assert "abc" in found["status"] and "notatime" in found["time"]
    counts = raw.agg(*reason_counts("")).first().asDict()
    assert counts == dict.fromkeys(REASONS, 1)


def test_the_first_reason_counts_once(spark, tmp_path):
    land(tmp_path, [line(clock="notatime", request="GET", status="abc", size="x")])
    raw = read_access_logs(spark, str(tmp_path), with_line=True)
    assert rows(bad_lines(raw), "reason") == [("time",)]


def test_a_load_keeps_bad_lines_and_what_can_be_read_of_them(spark, tmp_path):
    landing, silver = tmp_path / "raw", str(tmp_path / "silver")
    land(landing, [*GOOD, *BAD.values()])
    result = load_increment(spark, str(landing), silver, quarantine=True)
    assert {name: result[f"bad_{name}"] for name in REASONS} == dict.fromkeys(REASONS, 1)
    plain = str(tmp_path / "plain")
    assert load_increment(spark, str(landing), plain)["silver_total"] == result["silver_total"]
    assert rows(read_silver(spark, silver)) == rows(read_silver(spark, plain))
    kept = commits.read_quarantine(spark, silver)
    assert rows(kept, "load", "reason") == sorted((1, name) for name in REASONS)
    assert all(r.file.endswith("access.log") for r in kept.collect())
    # Good files are not read twice, and leave no folder.
    land(landing, [line(clock="25/Jan/2019:10:00:00")], month=2)
    result = load_increment(spark, str(landing), silver, quarantine=True)
    assert sum(result[f"bad_{name}"] for name in REASONS) == 0
    assert commits.loads_since(spark, silver)[1].quarantine is None
    assert commits.read_quarantine(spark, silver).count() == len(REASONS)


def test_bad_lines_of_a_load_that_died_are_not_seen(spark, tmp_path, monkeypatch):
    landing, silver = tmp_path / "raw", str(tmp_path / "silver")
    land(landing, [*GOOD, *BAD.values()])

    def dying(*_):
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "write_text_once", dying)
        with pytest.raises(RuntimeError, match="died"):
            load_increment(spark, str(landing), silver, quarantine=True)
    assert commits.read_quarantine(spark, silver).count() == 0
    load_increment(spark, str(landing), silver, quarantine=True)
    assert commits.read_quarantine(spark, silver).count() == len(REASONS)
    assert len(commits.remove_abandoned(spark, silver)) == 2
    assert commits.read_quarantine(spark, silver).count() == len(REASONS)


def test_without_quarantine_the_line_is_not_built(spark, tmp_path):
    land(tmp_path, GOOD)
    assert "_line" not in plan(read_access_logs(spark, str(tmp_path)).select(F.col("_c0")))

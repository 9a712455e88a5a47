from __future__ import annotations

import random
from datetime import datetime

import pytest

from conftest import rows
from fixtures import land
from hitloom.operators.parse import describe_requests, parse_requests
from hitloom.schemas import RAW
from hitloom.sources.derived_logs import access_log, log_lines
from hitloom.sources.raw_logs import fields_of_lines, read_access_logs

LINES = [
    r'1.2.3.4 - - [22/Jan/2019:03:56:14 +0330] "GET /filter/a?x=1 HTTP/1.1" 200 30577 "-" '
    r'"Mozilla/5.0 (X11) \"q\"" "-"',
    '1.2.3.5 - - [22/Jan/2019:03:56:15 +0330] "-" 400 - "-" "-"',
    '1.2.3.6 - - [22/Jan/2019:03:56:16 +0330] "GET /a b HTTP/1.1" 499 0 "" "ua"',
    "",
    "garbage",
    '1.2.3.7 - - [notatime +0330] "GET / HTTP/1.1" abc 1 "-" "x"',
    '1.2.3.8 - bob smith [22/Jan/2019:03:56:16 +0330] "GET / HTTP/1.1" 200 1 "-" "x"',
]
EXPECTED = {
    "1.2.3.4": (datetime(2019, 1, 22, 0, 26, 14), "GET", "/filter/a?x=1", "HTTP/1.1", 200,
                30577, "-", 'Mozilla/5.0 (X11) "q"'),
    "1.2.3.5": (datetime(2019, 1, 22, 0, 26, 15), "-", None, None, 400, None, "-", "-"),
    "1.2.3.6": (datetime(2019, 1, 22, 0, 26, 16), "GET", "/a", "b", 499, 0, None, "ua"),
    "garbage": (None, None, None, None, None, None, None, None),
    "1.2.3.7": (None, "GET", "/", "HTTP/1.1", None, 1, "-", "x"),
}


@pytest.fixture(params=["UTC", "Asia/Tehran", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def check(parsed):
    by_address = {r["remote_addr"]: tuple(r)[1:] for r in parsed.collect()}
    shifted = by_address.pop("1.2.3.8")
    assert by_address == EXPECTED
    # A space in the user name moves every later field by one.
    assert shifted[4] is None and shifted[0] is None


def test_lines_in_a_file(spark, tmp_path, zone):
    land(tmp_path, LINES)
    raw = read_access_logs(spark, str(tmp_path))
    assert raw.schema == RAW
    assert raw.count() == 6  # the blank line is no row
    check(parse_requests(raw))


def test_lines_in_a_column(spark, zone):
    lines = spark.createDataFrame([(text,) for text in LINES], "line STRING")
    raw = fields_of_lines(lines, lines["line"])
    assert raw.count() == 6
    check(parse_requests(raw))


def test_short_first_line_keeps_all_columns(spark, tmp_path):
    land(tmp_path, ["x y", LINES[0]])
    parsed = parse_requests(read_access_logs(spark, str(tmp_path)))
    assert {r["remote_addr"] for r in parsed.collect()} == {"x", "1.2.3.4"}


def test_render_then_parse_is_identity(spark, sf_dir):
    log = access_log(spark, sf_dir)
    lines = log_lines(log)
    parsed = parse_requests(fields_of_lines(lines, lines["value"]))
    assert parsed.columns == log.columns
    assert rows(parsed) == rows(log)


def test_described_columns(spark, tmp_path):
    land(tmp_path, LINES)
    described = describe_requests(parse_requests(read_access_logs(spark, str(tmp_path))))
    got = {r["remote_addr"]: tuple(r)[9:] for r in described.collect()}
    assert got["1.2.3.4"] == (2019, 1, 22, 0, False, "2xx")
    assert got["1.2.3.6"] == (2019, 1, 22, 0, True, "4xx")
    assert got["garbage"] == (None, None, None, None, None, None)


def test_any_text_parses_and_both_readers_agree(spark, tmp_path):
    pick = random.Random(5)
    pieces = ['"', "\\", " ", "  ", "-", "[22/Jan/2019:03:56:14", "+0330]", "GET /a HTTP/1.1",
              "200", "99999999999", "1.5", "é", "\t", "x" * 50, "[31/Feb/2019:25:61:61", ",", "#"]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randrange(1, 25)))
             for _ in range(600)] + LINES
    land(tmp_path, texts)
    from_file = parse_requests(read_access_logs(spark, str(tmp_path)))
    lines = spark.createDataFrame([(text,) for text in texts], "line STRING")
    from_column = parse_requests(fields_of_lines(lines, lines["line"]))
    found = rows(from_file)
    assert found == rows(from_column)
    assert len(found) > 300

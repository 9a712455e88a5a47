from __future__ import annotations

from datetime import date
from hashlib import md5

import pytest

from conftest import plan, rows
from fixtures import described, request
from hitloom.operators import star
from hitloom.schemas import conform


def key(text):
    return md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def staged(spark):
    return star.stg_requests(described(
        spark, request(), request(at=1, status=404), request(at=86_400, method="POST"),
        request(addr="b", url=None, protocol=None), request(addr="c", status=None),
        request(addr="d", time=False),
    ))


def test_staging_ids_and_dates(staged):
    got = {r["remote_addr"]: r for r in staged.filter("status is null or status = 200").collect()}
    assert got["b"]["request_id"] is None
    assert got["d"]["request_id"] is None and got["d"]["request_date"] is None
    assert got["c"]["request_id"] == key("c2024-01-06 10:00:00GET/a")
    assert got["c"]["request_date"] == date(2024, 1, 6)


def test_keys_hash_the_text_of_their_parts(staged):
    fact = star.fact_requests(staged).filter("request_timestamp = '2024-01-06 10:00:01'").first()
    assert fact["ip_sk"] == key("10.0.0.1")
    assert fact["date_sk"] == key("2024-01-06")
    assert fact["status_sk"] == key("404")
    assert fact["request_sk"] == key("GET/aHTTP/1.1")


def test_null_parts_make_null_keys(staged):
    fact = star.fact_requests(staged)
    assert fact.filter("request_sk is null").count() == 1
    assert fact.filter("status_sk is null").count() == 1
    assert fact.filter("date_sk is null").count() == 1
    assert fact.count() == 6


def test_dimensions_hold_distinct_values(staged):
    assert rows(star.dim_status(staged), "status_code", "status_class", "is_error") == [
        (200, "2xx", False), (404, "4xx", True), (None, None, None)]
    assert rows(star.dim_request(staged), "method", "url") == [
        ("GET", "/a"), ("GET", None), ("POST", "/a")]
    assert star.dim_ip(staged).count() == 4


def test_calendar_attributes(staged):
    got = rows(star.dim_date(staged), "full_date", "year", "month", "day", "day_name",
               "is_weekend")
    assert got == [
        (None, None, None, None, None, False),
        (date(2024, 1, 6), 2024, 1, 6, "Saturday", True),
        (date(2024, 1, 7), 2024, 1, 7, "Sunday", True),
    ]


def test_fact_needs_no_shuffle(staged):
    assert "Exchange" not in plan(star.fact_requests(staged))


def test_conform_rejects_other_types(spark):
    with pytest.raises(ValueError, match="dim_request"):
        conform(spark.createDataFrame([(1,)], "request_sk INT"), "dim_request")

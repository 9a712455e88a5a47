from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from fixtures import described, request
from hitloom.operators import summaries
from hitloom.operators.star import STAR, stg_requests
from hitloom.plans.ingest import refine
from hitloom.plans.warehouse import HITS, SUMMARIES, summary_over
from hitloom.sources.derived_logs import access_log, hostname_lookup


def over(spark, name, *data):
    return summary_over(name, described(spark, *data))


MIXED = (
    request(addr="a", status=200, size=1024), request(addr="a", at=1, status=404, size=1024),
    request(addr="b", at=3600, status=500, size=None), request(addr="c", status=None, size=9),
    request(addr="d", at=2, url=None, protocol=None, method="-", status=302, size=4096),
)


def test_key_figures_leave_out_rows_without_a_status(spark):
    assert rows(over(spark, "kpi_summary", *MIXED)) == [(4, 3, 50.0, 2.0)]


def test_endpoints_and_methods_leave_out_rows_without_a_url(spark):
    assert rows(over(spark, "agg_top_endpoints", *MIXED)) == [("/a", "GET", 4)]
    assert rows(over(spark, "agg_method_split", *MIXED)) == [("GET", 4, 100.0)]


def test_hours_and_classes(spark):
    assert rows(over(spark, "agg_hourly_traffic", *MIXED)) == [
        (datetime(2024, 1, 6, 10), 3, 1, 1), (datetime(2024, 1, 6, 11), 1, 0, 1)]
    assert rows(over(spark, "agg_status_breakdown", *MIXED)) == [
        ("2xx", 1), ("3xx", 1), ("4xx", 1), ("5xx", 1)]


def test_days(spark):
    assert rows(over(spark, "agg_day_of_week", *MIXED)) == [("Saturday", 6, True, 5, 0.21)]
    (row,) = rows(over(spark, "agg_daily_bytes", *MIXED))
    total = 1024 + 1024 + 9 + 4096
    assert row[1:] == (True, "Weekend", total / 1024**3, 5, total / 4 / 1024)


def test_no_requests(spark):
    assert rows(over(spark, "kpi_summary", request(status=None))) == [(0, 0, None, None)]
    for name in ("agg_hourly_traffic", "agg_error_detail", "agg_status_breakdown"):
        assert over(spark, name, request(status=None)).count() == 0


def test_share_of_errors_counts_errors_beyond_the_limit(spark):
    data = [request(at=i, status=400 + i % 12) for i in range(24)]
    detail = over(spark, "agg_error_detail", *data)
    assert detail.count() == 10
    assert {r["pct"] for r in detail.collect()} == {8.33}
    # Ties are broken by code.
    assert {r["status_code"] for r in detail.collect()} == set(range(400, 410))


def test_top_endpoints_break_ties_by_url(spark):
    data = [request(at=i, url=f"/{i % 12:02d}") for i in range(24)]
    assert [r["url"] for r in over(spark, "agg_top_endpoints", *data).orderBy("url").collect()] \
        == [f"/{i:02d}" for i in range(8)]


def test_a_key_shared_by_two_requests_counts_for_both(spark):
    # "GET" + "/ab" + "c" and "GET" + "/a" + "bc" run together alike.
    data = [request(url="/ab", protocol="c"), request(at=1, url="/a", protocol="bc")]
    assert rows(over(spark, "agg_top_endpoints", *data)) == [
        ("/a", "GET", 2), ("/ab", "GET", 2)]


def test_huge_sizes_do_not_overflow(spark):
    big = 2**63 - 1
    data = [request(at=i, size=big) for i in range(4)]
    (row,) = rows(over(spark, "agg_daily_bytes", *data), "total_gb", "avg_kb_per_req")
    assert row == (4.0 * big / 1024**3, big / 1024)


@pytest.fixture(scope="module")
def silver(spark):
    sf_dir = "/root/testdata/sf0.001"
    return refine(access_log(spark, sf_dir), hostname_lookup(spark, sf_dir))


def test_totals_agree(silver):
    total = summary_over("kpi_summary", silver).first()["total_requests"]
    for name, column in (("agg_hourly_traffic", "total_requests"),
                         ("agg_status_breakdown", "request_count")):
        assert summary_over(name, silver).agg(F.sum(column)).first()[0] == total
    share = summary_over("agg_method_split", silver).agg(F.sum("pct")).first()[0]
    assert abs(share - 100) < 0.05


def test_summaries_read_few_fact_columns(silver, tmp_path):
    fact_path = str(tmp_path / "fact")
    STAR["fact_requests"](stg_requests(silver)).write.parquet(fact_path)
    fact = silver.sparkSession.read.parquet(fact_path)
    wanted = {
        "hits_by_hour": {"date_sk", "status_sk", "request_timestamp", "body_bytes_sent"},
        "hits_by_ip": {"ip_sk", "status_sk", "body_bytes_sent"},
        "hits_by_request": {"request_sk"},
    }
    for name, columns in wanted.items():
        text = plan(HITS[name](fact))
        schema = text.split("ReadSchema: struct<")[1].split(">")[0]
        assert {field.split(":")[0] for field in schema.split(",")} == columns
        assert "partial_count" in text


@pytest.mark.parametrize("name", ["agg_top_endpoints", "agg_error_detail"])
def test_top_k_is_not_a_full_sort(silver, name):
    assert "TakeOrderedAndProject" in plan(summary_over(name, silver))


@pytest.mark.parametrize("name", sorted(SUMMARIES))
def test_no_summary_gathers_groups_or_leaves_the_jvm(silver, name):
    text = plan(summary_over(name, silver))
    assert "windowspecdefinition(unspecifiedframe" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text


def test_reading_order(spark):
    hourly = summaries.presented(over(spark, "agg_hourly_traffic", *MIXED), "agg_hourly_traffic")
    assert [r["hour"].hour for r in hourly.collect()] == [10, 11]
    kpi = over(spark, "kpi_summary", *MIXED)
    assert summaries.presented(kpi, "kpi_summary") is kpi

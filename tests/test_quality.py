from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from fixtures import described, request, spoil
from hitloom.operators import quality
from hitloom.operators.sinks import write_silver
from hitloom.plans.ingest import refine
from hitloom.plans.warehouse import star_tables
from hitloom.sources.derived_logs import access_log, hostname_lookup


def tables(spark, *data):
    silver = described(spark, *data)
    return {"silver": silver, **star_tables(silver)}


def failures(checks):
    return {(r["check"], r["table"], r["column"]): r["failures"]
            for r in checks.collect() if not r["passed"]}


def test_clean_tables_pass_all_checks(spark, sf_dir):
    silver = refine(access_log(spark, sf_dir, clean=True), hostname_lookup(spark, sf_dir))
    checks = quality.all_checks({"silver": silver, **star_tables(silver)})
    assert checks.count() == 5 + 9 + 3 + 4
    assert failures(checks) == {}


def test_dirty_tables_fail_with_known_counts(spark):
    silver = refine(access_log(spark, "/root/testdata/sf0.01"),
                    hostname_lookup(spark, "/root/testdata/sf0.01"))
    checks = quality.not_null_checks({"silver": silver, **star_tables(silver)})
    assert failures(checks) == {
        ("not_null", "dim_request", "request_sk"): 3,
        ("not_null", "dim_status", "status_sk"): 1,
        ("not_null", "fact_requests", "request_id"): 104,
        ("not_null", "fact_requests", "request_sk"): 104,
        ("not_null", "fact_requests", "status_sk"): 100,
        ("source_not_null", "silver", "status"): 100,
    }


def test_unique_ignores_nulls_and_counts_values(spark):
    star = tables(spark, request(), request(), request(), request(at=1), request(at=1),
                  request(url=None), request(url=None))
    assert failures(quality.unique_checks(star)) == {
        ("unique", "fact_requests", "request_id"): 2}


def test_one_address_with_two_names_is_not_unique(spark):
    names = spark.createDataFrame([("k", "a", "x"), ("k", "a", "y")],
                                  "ip_sk STRING, ip_address STRING, client_hostname STRING")
    assert failures(quality.check_unique(names, "dim_ip", "ip_sk")) == {
        ("unique", "dim_ip", "ip_sk"): 1}


def test_orphans_count_child_rows(spark):
    star = tables(spark, request(), request(at=1), request(at=2, status=500),
                  request(at=3, status=None))
    some = star["dim_status"].filter("status_code = 500")
    check = quality.check_relationship(star["fact_requests"], "fact_requests", "status_sk", some)
    assert rows(check) == [("relationships", "fact_requests", "status_sk", 2, False)]
    assert failures(quality.relationship_checks(star)) == {}


def test_null_checks_of_a_table_are_one_pass(spark):
    star = tables(spark, request())
    columns = quality.NOT_NULL["fact_requests"]
    checks = quality.check_not_null(star["fact_requests"], "fact_requests", columns)
    assert plan(checks).count("Scan") == 1 and checks.count() == 5


def test_audit_of_no_files_fails(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "none"):
        files = quality.silver_files(spark, str(tmp_path / folder))
        assert rows(quality.silver_audit(files)) == [(0, 0, False)]


def test_audit_sees_every_file_and_opens_none(spark, tmp_path):
    root = str(tmp_path / "silver")
    write_silver(described(spark, request(), request(at=86_400), request(time=False)), root)
    paths = glob.glob(f"{root}/*/*/*/*.parquet")
    for path in paths:
        spoil(os.path.dirname(path))
    files = quality.silver_files(spark, root)
    assert rows(quality.silver_audit(files)) == [(3, 3 * len(b"not parquet"), True)]
    assert rows(quality.audited_days(files)) == [
        (2024, 1, 6, True), (2024, 1, 7, True), (None, None, None, True)]


def test_relationships_over_counts_equal_those_over_rows(spark):
    star = tables(spark, request(), request(at=1, status=500), request(at=2, status=500))
    some = {**star, "dim_status": star["dim_status"].filter("status_code = 200")}
    counted = {"status_sk": star["fact_requests"].groupBy("status_sk", "date_sk")
               .agg(F.count("*").alias("n"))}
    assert rows(quality.relationship_checks(some, counted)) == rows(
        quality.relationship_checks(some))
    assert failures(quality.relationship_checks(some, counted)) == {
        ("relationships", "fact_requests", "status_sk"): 2}


def test_gate(spark):
    star = tables(spark, request(status=None))
    results = quality.all_checks(star).collect()
    with pytest.raises(quality.QualityError):
        quality.gate(results)
    assert {r["column"] for r in quality.gate(results, "warn")} == {"status", "status_sk"}


@pytest.mark.parametrize("count, expected", [(0, (0, None, None)), (2, None)])
def test_time_range(spark, count, expected):
    log = described(spark, *(request(at=i) for i in range(2))).limit(count)
    got = rows(quality.time_range(log))[0]
    assert got == expected if expected else got[0] == 2 and got[1] < got[2]

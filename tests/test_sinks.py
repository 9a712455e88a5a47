from __future__ import annotations

import glob
import os
from types import SimpleNamespace

import pytest

from conftest import plan, rows
from fixtures import described, land, land_lookup_csv, line, request
from pyspark.sql import functions as F

from hitloom import session
from hitloom.operators import quality, sinks
from hitloom.plans import full_run, warehouse
from hitloom import __main__ as cli
from hitloom.sources import folders
from hitloom.sources.silver import read_silver


def test_silver_layout(spark, tmp_path):
    root = str(tmp_path / "silver")
    sinks.write_silver(described(spark, *(request(at=i) for i in range(50)),
                                 request(at=86_400)).repartition(8), root)
    days = sorted(p.split("silver/")[1].rsplit("/", 1)[0]
                  for p in glob.glob(f"{root}/*/*/*/*.snappy.parquet"))
    # Each day is gathered in one file although eight tasks held it.
    assert days == ["year=2024/month=1/day=6", "year=2024/month=1/day=7"]
    sinks.write_silver(described(spark, request(at=99)), root)
    assert read_silver(spark, root).count() == 52


def test_a_large_day_is_split(spark, tmp_path):
    """One day far above the advisory size is written by several tasks."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
                "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        data = described(spark, *(request(at=i, url=f"/{i * 7919}", agent=f"ua{i * 31}")
                                  for i in range(8000))).repartition(8)
        sinks.write_silver(data, str(tmp_path / "silver"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/silver/*/*/*/*.parquet")) > 1
    assert read_silver(spark, str(tmp_path / "silver")).count() == 8000


def test_partition_filter_prunes(spark, tmp_path):
    root = str(tmp_path / "silver")
    sinks.write_silver(described(spark, request(), request(at=86_400)), root)
    one_day = read_silver(spark, root).filter("year = 2024 and month = 1 and day = 7")
    assert one_day.count() == 1
    assert "day#" in plan(one_day).split("PartitionFilters: [")[1].split("]")[0]


def test_register_skips_known_tables_and_finds_partitions(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    root, flat = str(tmp_path / "silver"), str(tmp_path / "flat")
    sinks.write_silver(described(spark, request(), request(at=86_400)), root)
    sinks.store(spark.range(3), flat)
    paths = {"reg_test.requests": root, "reg_test.numbers": flat}
    assert rows(sinks.register_tables(spark, paths)) == [
        ("reg_test.numbers", "registered"), ("reg_test.requests", "registered")]
    assert rows(sinks.register_tables(spark, paths), "status") == [("present",), ("present",)]
    assert spark.table("reg_test.requests").count() == 2
    assert spark.table("reg_test.numbers").count() == 3
    # A day loaded since is found, and a name taken by another folder is reported.
    sinks.write_silver(described(spark, request(at=2 * 86_400)), root)
    elsewhere = str(tmp_path / "elsewhere")
    sinks.store(spark.range(9), elsewhere)
    again = sinks.register_tables(spark, {**paths, "reg_test.numbers": elsewhere})
    assert rows(again, "status") == [("conflict",), ("present",)]
    assert spark.table("reg_test.requests").count() == 3
    assert spark.table("reg_test.numbers").count() == 3


def test_published_tables_follow_the_newest_build(spark, tmp_path):
    for build, table in (("a", spark.range(3)), ("b", spark.range(2)),
                         ("c", spark.range(4).withColumn("more", F.lit(1)))):
        sinks.store(table, str(tmp_path / build))
        done = sinks.publish_tables(spark, {"a_model": str(tmp_path / build)})
        assert rows(done, "status") == [("registered" if build == "a" else "replaced",)]
        assert spark.table("a_model").columns == table.columns
        assert spark.table("a_model").count() == table.count()
    sinks.save_view(spark.range(1), "a_taken_name")
    assert rows(sinks.publish_tables(spark, {"a_taken_name": str(tmp_path / "a")}),
                "status") == [("conflict",)]


def test_a_failed_build_leaves_the_last_one_readable(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    silver = described(spark, request(), request(at=1))
    warehouse.build_checked(silver, root)
    before = rows(spark.table("kpi_summary"))
    dirty = described(spark, request(), request(at=1, status=None))
    with pytest.raises(quality.QualityError, match="status_sk: 1"):
        warehouse.build_checked(dirty, root)
    assert rows(spark.table("kpi_summary")) == before

    def broken(*_):
        raise OSError("disk")

    monkeypatch.setitem(warehouse.SUMMARIES, "agg_daily_bytes", (broken, "hits_by_hour", "dim_date"))
    with pytest.raises(OSError):
        warehouse.build_checked(described(spark, request()), root)
    monkeypatch.undo()
    assert rows(spark.table("kpi_summary")) == before
    warehouse.build_checked(dirty, root, "warn")
    assert spark.table("fact_requests").filter("status_sk IS NULL").count() == 1
    # The builds before the last two are gone.
    assert len(glob.glob(f"{root}/builds/*")) == 2


def test_models_as_views(spark):
    assert sinks.save_view(spark.range(2), "a_view").count() == 2
    assert spark.table("a_view").count() == 2


def test_the_whole_run(spark, tmp_path):
    landing = tmp_path / "raw"
    landing.mkdir()
    land_lookup_csv(landing, "client_ip,hostname\n1.2.3.4,one.example\n")
    land(landing, [line(clock=f"22/Jan/2019:10:00:{i:02d}", status=str(200 + 204 * (i % 2)))
                   for i in range(10)])
    places = (str(landing), str(tmp_path / "silver"), str(tmp_path / "warehouse"))
    first = full_run.run(spark, *places)
    assert first.rows_by_stage["written"] == 10
    assert len(first.tables) == 13
    assert len(first.checks) == 21 and all(row["passed"] for row in first.checks)
    before = rows(first.tables["kpi_summary"])
    assert before[0][0] == 10 and before[0][2] == 50.0
    assert {r["status"] for r in first.published.collect()} <= {"registered", "replaced"}
    again = full_run.run(spark, *places)
    assert again.rows_by_stage["written"] == 0
    assert rows(again.tables["kpi_summary"]) == before
    assert rows(spark.table("kpi_summary")) == before
    assert {r["status"] for r in again.published.collect()} == {"replaced"}
    assert spark.table("stg_requests").count() == 10
    streamed = full_run.run(spark, str(landing), str(tmp_path / "streamed"),
                            str(tmp_path / "other"), checkpoint=str(tmp_path / "state"))
    assert streamed.rows_by_stage == {"batches": 1}
    assert rows(streamed.tables["kpi_summary"]) == before


@pytest.mark.parametrize("size, split, partitions", [
    (session.GIB, 128 * session.MIB, 8),
    (100 * session.GIB, 128 * session.MIB, 400),
    (100 * 1024 * session.GIB, 512 * session.MIB, 25_600),
])
def test_sizing(size, split, partitions):
    conf = session.sizing(size)
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == split
    assert int(conf["spark.sql.shuffle.partitions"]) == partitions


def test_no_size_leaves_the_settings_alone():
    assert session.sizing(0) == {}


def test_jobs_are_sized_by_the_folder_they_read(spark, tmp_path, monkeypatch):
    args = cli._parser().parse_args(["build", "some/silver", "some/warehouse"])
    asked = []
    monkeypatch.setattr(cli, "folder_bytes",
                        lambda _, folder: asked.append(folder) or 100 * 1024 * session.GIB)
    set_to = {}
    given = {"spark.sql.shuffle.partitions"}
    stub = SimpleNamespace(
        conf=SimpleNamespace(set=set_to.__setitem__),
        sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(
            contains=lambda key: key in given)))
    cli.size_session(stub, args)
    # The user's own setting wins.
    assert asked == ["some/silver"] and not given & set(set_to)
    given.clear()
    cli.size_session(stub, args)
    assert set_to["spark.sql.shuffle.partitions"] == "25600"
    assert folders.folder_bytes(spark, str(tmp_path / "none")) == 0
    (tmp_path / "some").write_bytes(b"12345")
    assert folders.folder_bytes(spark, str(tmp_path)) == 5


def test_shared_folder_is_the_configured_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    a, b = session.fresh_folder(spark, "x"), session.fresh_folder(spark, "x")
    assert a != b and a.startswith(session.shared_folder(spark))


def test_a_cluster_needs_a_shared_folder():
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)
    cluster.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert session.shared_folder(cluster) == "hdfs://shared"


def test_local_mode_falls_back_to_one_temporary_folder():
    local = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="local[2]"))
    assert session.shared_folder(local) == session.shared_folder(local)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    silver = described(spark, *(request(at=i, url=f"/{i % 7}", method=("GET", "PUT")[i % 2])
                                for i in range(60)), request(at=99, url=None))
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = warehouse.build_bucketed(silver, str(tmp_path / "out"), "bucketed", 3)
        assert len(glob.glob(f"{tmp_path}/out/dim_request/*.parquet")) <= 3
        joined = tables["hits_by_request"].join(tables["dim_request"], "request_sk")
        joined.collect()
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        counted = joined.groupBy("request_sk").count()
        assert "Exchange" not in plan(counted)
        for name in ("agg_top_endpoints", "agg_method_split"):
            text = plan(tables[name])
            # The shared total is a subquery with a plan of its own.
            for part in text.split("Subquery")[0].split("SortMergeJoin")[1:]:
                assert "Exchange" not in part
            assert rows(tables[name]) == rows(warehouse.summary_over(name, silver))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_a_build_of_some_models_leaves_the_others_alone(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    silver = described(spark, request(), request(at=1))
    warehouse.build_checked(silver, root)
    more = described(spark, *(request(at=i) for i in range(5)))
    for _ in range(3):  # builds that would push the full one out
        tables, checks, published = warehouse.build_checked(more, root, only=["agg_daily_bytes"])
    assert set(tables) == {"fact_requests", "dim_date", "agg_daily_bytes"}
    assert {r["table"] for r in checks} == {"fact_requests", "dim_date", "silver"}
    assert any(r["check"] == "relationships" for r in checks)
    assert spark.table("agg_daily_bytes").first()["request_count"] == 5
    assert spark.table("kpi_summary").first()["total_requests"] == 2
    assert len(glob.glob(f"{root}/builds/*")) == 3
    with pytest.raises(KeyError):
        warehouse.needed_for(["no_such_model"])
    assert warehouse.needed_for(["agg_method_split"]) == {
        "agg_method_split", "hits_by_request", "dim_request", "fact_requests"}


def test_checks_by_themselves_find_what_changed(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    silver = described(spark, request(), request(at=1))
    warehouse.build_checked(silver, root)
    assert all(row["passed"] for row in warehouse.check_stored(silver, root))
    place = warehouse.newest_builds(spark, root, ["dim_status"])["dim_status"]
    empty = spark.read.parquet(place).schema
    for file in glob.glob(f"{place.removeprefix('file:')}/*.parquet"):
        os.remove(file)
    spark.createDataFrame([], empty).write.mode("append").parquet(place)
    failed = [r for r in warehouse.check_stored(silver, root) if not r["passed"]]
    assert [(r["check"], r["column"], r["failures"]) for r in failed] == [
        ("relationships", "status_sk", 2)]

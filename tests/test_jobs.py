from __future__ import annotations

from conftest import rows
from fixtures import land, line
from hitloom.__main__ import main
from hitloom.sources.silver import read_silver


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    landing = tmp_path / "raw"
    landing.mkdir()
    land(landing, [line(clock=f"22/Jan/2019:10:00:{i:02d}") for i in range(3)])
    silver, streamed = str(tmp_path / "silver"), str(tmp_path / "streamed")
    main(["load", str(landing), silver])
    assert "'written': 3" in capsys.readouterr().out
    main(["stream", str(landing), streamed, str(tmp_path / "state"),
          "--dedup-across-batches", "--max-files", "1"])
    assert rows(read_silver(spark, streamed)) == rows(read_silver(spark, silver))
    warehouse = str(tmp_path / "warehouse")
    assert main(["build", silver, warehouse]) == 0
    assert "relationships" in capsys.readouterr().out
    assert spark.table("kpi_summary").first()[0] == 3
    assert main(["show", warehouse, "agg_method_split"]) == 0
    assert "GET" in capsys.readouterr().out
    assert main(["check", silver, warehouse]) == 0
    assert "relationships" in capsys.readouterr().out
    assert main(["build", silver, warehouse, "--only", "agg_method_split"]) == 0
    assert main(["show", warehouse, "kpi_summary"]) == 0
    assert main(["refresh", silver, str(tmp_path / "rollup")]) == 0
    assert "kpi_summary" in capsys.readouterr().out
    assert main(["load", str(landing), silver, "--keep-late", "--quarantine"]) == 0
    assert "'bad_time': 0" in capsys.readouterr().out


def test_failed_checks_fail_the_job(spark, tmp_path, capsys):
    landing = tmp_path / "raw"
    landing.mkdir()
    land(landing, [line(), line(clock="22/Jan/2019:10:00:01", status="abc")])
    places = [str(landing), str(tmp_path / "silver"), str(tmp_path / "warehouse")]
    assert main(["run", *places]) == 1
    assert "status_sk 1 FAILED" in capsys.readouterr().out
    assert main(["run", *places, "--severity", "warn"]) == 0
    assert "status_sk 1 FAILED" in capsys.readouterr().out
    assert spark.table("fact_requests").count() == 2

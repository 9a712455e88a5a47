from __future__ import annotations

import glob
import os
from functools import partial

import pytest

from conftest import plan, rows
from fixtures import land, land_lookup_csv, line, spoil
from hitloom.operators import enrich
from hitloom.operators.dedup import dedup_requests, not_yet_stored
from hitloom.operators.parse import parse_requests
from hitloom.operators.sinks import write_silver
from hitloom.plans import ingest
from hitloom.plans.ingest import load_increment, refine
from hitloom.sources.lookup import read_lookup
from hitloom.sources.raw_logs import read_access_logs
from hitloom.sources.silver import read_silver
from hitloom.streaming.file_ingest import ingest_new_files, ingest_within

NEW = [line(clock=f"23/Jan/2019:10:00:{i:02d}") for i in range(4)]
LATE = [line(clock=f"22/Jan/2019:10:00:{i:02d}") for i in range(3)]
UNTIMED = line(addr="9.9.9.9", clock="notatime")


@pytest.fixture
def places(tmp_path):
    landing = tmp_path / "raw"
    landing.mkdir()
    land_lookup_csv(landing, "client_ip,hostname\n1.2.3.4,one.example\n")
    return landing, str(tmp_path / "silver"), str(tmp_path / "state")


def test_each_file_once_and_late_rows_kept(spark, places, tmp_path):
    landing, silver, state = places
    land(landing, [*NEW, NEW[0], UNTIMED])
    assert ingest_new_files(spark, str(landing), silver, state) == 1
    land(landing, LATE, month=2)
    assert ingest_new_files(spark, str(landing), silver, state) == 1
    assert ingest_new_files(spark, str(landing), silver, state) == 0
    stored = rows(read_silver(spark, silver))
    assert len(stored) == 8
    # The batch load over the same files sees the same rows in one go.
    load_increment(spark, str(landing), str(tmp_path / "batch"))
    assert stored == rows(read_silver(spark, str(tmp_path / "batch")))


def test_a_retried_batch_replaces_itself(spark, places):
    landing, silver, state = places
    land(landing, NEW)
    ingest_new_files(spark, str(landing), silver, state)
    before = rows(read_silver(spark, silver))
    again = refine(parse_requests(read_access_logs(spark, str(landing))),
                   read_lookup(spark, str(landing)))
    write_silver(again, f"{silver}/batch_id=0", mode="overwrite")
    assert rows(read_silver(spark, silver)) == before


def test_batches_follow_the_file_limit(spark, places):
    landing, silver, state = places
    for month in (1, 2, 3):
        land(landing, [line(clock=f"2{month}/Jan/2019:10:00:00")], month=month)
    assert ingest_new_files(spark, str(landing), silver, state, max_files_per_trigger=1) == 3
    assert read_silver(spark, silver).count() == 3


@pytest.mark.parametrize("across, expected", [(False, 11), (True, 6)])
def test_duplicates_in_a_later_batch(spark, places, across, expected):
    landing, silver, state = places
    land(landing, [*NEW, UNTIMED])
    ingest_new_files(spark, str(landing), silver, state, dedup_across_batches=across)
    first = rows(read_silver(spark, silver))
    # The same rows once more, one with another agent, and a new one.
    land(landing, [*NEW[:3], line(clock="23/Jan/2019:10:00:03", agent="zz"), UNTIMED,
                   line(clock="23/Jan/2019:10:00:04")], month=2)
    ingest_new_files(spark, str(landing), silver, state, dedup_across_batches=across)
    stored = rows(read_silver(spark, silver))
    assert len(stored) == expected
    assert set(first) <= set(stored)


def test_a_retried_batch_does_not_count_itself_as_stored(spark, places):
    landing, silver, state = places
    land(landing, NEW)
    ingest_new_files(spark, str(landing), silver, state, dedup_across_batches=True)
    before = rows(read_silver(spark, silver))
    # A lost checkpoint makes the same files batch 0 again.
    ingest_new_files(spark, str(landing), silver, f"{state}-new", dedup_across_batches=True)
    assert rows(read_silver(spark, silver)) == before


def test_only_the_days_at_hand_are_read(spark, places):
    landing, silver, state = places
    land(landing, [*NEW, *LATE, UNTIMED])
    ingest_new_files(spark, str(landing), silver, state)
    spoil(f"{silver}/batch_id=0/year=2019/month=1/day=23")
    stored = read_silver(spark, silver)
    batch = dedup_requests(stored.filter("day = 22 or day is null"))
    left = not_yet_stored(batch, stored)
    assert left.count() == 0
    schema = [part.split(">")[0] for part in plan(left).split("ReadSchema: struct<")[1:]]
    assert any("user_agent" not in columns and "timestamp" in columns for columns in schema)


def test_state_remembers_keys_within_the_delay(spark, places):
    """Duplicates inside the delay are told by state, older rows are too late; the third
    run takes the state up from the checkpoint, and silver is never read."""
    landing, silver, state = places
    at = "{}/Jan/2019:{}:00:00".format
    land(landing, [line(clock=at(22, 10)), line(clock=at(22, 11)), line(clock=at(22, 11), agent="b"),
                   line(clock=at(23, 10)), UNTIMED])
    assert ingest_within(spark, str(landing), silver, state, "2 hours").batches == 1
    assert read_silver(spark, silver).count() == 4
    for folder in glob.glob(f"{silver}/*/*/*/*"):
        spoil(folder)
    land(landing, [line(clock=at(23, 10), agent="c"), line(clock=at(23, "09")), line(clock=at(22, 11)),
                   line(clock=at(22, 12)), line(clock=at(23, 11))], month=2)
    second = ingest_within(spark, str(landing), silver, state, "2 hours")
    assert (second.batches, second.too_late) == (1, 2)
    kept = spark.read.parquet(f"{silver}/batch_id=2")
    assert sorted(r.timestamp.hour for r in kept.collect()) == [5, 7]  # 9 and 11 o'clock at +0330
    land(landing, [line(clock=at(23, 11)), line(clock=at(23, 10)), line(clock=at(25, 10))], month=3)
    third = ingest_within(spark, str(landing), silver, state, "2 hours")
    assert third.batches == 1 and third.remembered == 1
    names = sorted(os.listdir(silver))
    assert sum(spark.read.parquet(f"{silver}/{n}").count() for n in names[-1:]
               if glob.glob(f"{silver}/{n}/*=*")) <= 1


def test_a_batch_runs_once_when_the_lookup_is_too_large_to_broadcast(spark, places, monkeypatch):
    """The join by shuffle reads the requests three times, the state of the stream does not."""
    join, taken = ingest.enrich_hostnames, []
    monkeypatch.setattr(ingest, "enrich_hostnames", partial(join, broadcast_bytes=0))
    shuffled = enrich.shuffled_names
    monkeypatch.setattr(enrich, "shuffled_names", lambda requests, names, share: (
        taken.append(plan(requests)), shuffled(requests, names, share))[1])
    landing, silver, state = places
    land(landing, NEW + LATE)
    assert ingest_within(spark, str(landing), silver, state, "2 days").batches == 1
    assert taken and not any("Deduplicate" in text or "csv" in text for text in taken)
    assert len(rows(read_silver(spark, silver))) == 7

from __future__ import annotations

import pytest

from conftest import plan, rows
from fixtures import land_lookup_csv, lookup, request, requests
from hitloom.operators import enrich
from hitloom.operators.enrich import enrich_hostnames, hot_addresses, measure
from hitloom.sources.lookup import address_names, read_lookup, resolve_lookup_columns


@pytest.mark.parametrize("columns, expected", [
    (["client_ip", "hostname"], ("client_ip", "hostname")),
    (["addr", "name"], ("addr", "name")),
    (["client_ip", "hostname", "other_addr"], ("other_addr", "hostname")),
    (["description", "host"], ("description", "host")),
    (["IP", "Host"], ("IP", "Host")),
    (["a", "b"], None),
    (["ip", "b"], None),
])
def test_columns_by_name(columns, expected):
    assert resolve_lookup_columns(columns) == expected


def test_left_join_keeps_unmatched(spark):
    log = requests(spark, request("a"), request("b"), request("c"))
    named = enrich_hostnames(log, lookup(spark, ("a", "host-a"), ("b", None)))
    assert rows(named, "remote_addr", "client_hostname") == [
        ("a", "host-a"), ("b", None), ("c", None)]
    assert "BroadcastHashJoin" in plan(named)


def test_duplicate_names_do_not_multiply(spark):
    log = requests(spark, request("a"), request("a", at=1))
    named = enrich_hostnames(log, lookup(spark, ("a", "z"), ("a", "b"), ("a", "b")))
    assert rows(named, "client_hostname") == [("b",), ("b",)]


def test_unusable_lookup_gives_null(spark):
    log = requests(spark, request("a"))
    unknown = lookup(spark, ("a", "x"), columns=("p", "q"))
    for table in (None, unknown):
        named = enrich_hostnames(log, table)
        assert dict(named.dtypes)["client_hostname"] == "string"
        assert rows(named, "client_hostname") == [(None,)]
    assert rows(enrich_hostnames(log, unknown, "p", "q"), "client_hostname") == [("x",)]


def test_missing_lookup_is_none_but_present_is_read(spark, tmp_path):
    assert read_lookup(spark, str(tmp_path)) is None
    land_lookup_csv(tmp_path, "client_ip,hostname\n1.1.1.1,one\n")
    assert rows(read_lookup(spark, str(tmp_path))) == [("1.1.1.1", "one")]


def test_lookups_of_different_header_orders(spark, tmp_path):
    land_lookup_csv(tmp_path, "client_ip,hostname\n1.1.1.1,one\n")
    land_lookup_csv(tmp_path, "hostname,client_ip\ntwo,2.2.2.2\n", month=2)
    land_lookup_csv(tmp_path, "a,b\n3.3.3.3,three\n", month=3)
    names = address_names(read_lookup(spark, str(tmp_path)))
    assert rows(names) == [("1.1.1.1", "one"), ("2.2.2.2", "two")]


def test_size_decides_between_broadcast_and_shuffle(spark):
    log = requests(spark, request("a"))
    table = lookup(spark, ("a", "one"), ("b", "two"))
    measured = measure(address_names(table))
    width = enrich.ROW_OVERHEAD + 1 + 3
    size = measured.total
    assert (size, measured.widest) == (2 * width, width)
    assert measure(address_names(table).limit(0)).total == 0
    small = plan(enrich_hostnames(log, table, broadcast_bytes=size))
    large = plan(enrich_hostnames(log, table, broadcast_bytes=size - 1))
    assert "SortMergeJoin" not in small
    assert "SortMergeJoin" in large


def test_shuffle_join_gives_the_same_rows_on_hot_addresses(spark, monkeypatch):
    monkeypatch.setattr(enrich, "HOT_SHARE", 4)
    garbage = "x" * 500
    log = requests(spark, *(
        [request("hot", at=i) for i in range(90)]
        + [request(f"10.0.0.{i % 30}", at=i) for i in range(60)]
        + [request("unknown", at=i) for i in range(45)]
        + [request(garbage, at=i) for i in range(80)]
        + [request(None, at=i) for i in range(5)]
    ))
    table = lookup(spark, ("hot", "h"), (garbage, "long"), ("other", "o"),
                   *((f"10.0.0.{i}", f"h{i}") for i in range(20)))
    assert hot_addresses(log, 4).count() == 2
    fast = enrich_hostnames(log, table)
    slow = enrich_hostnames(log, table, broadcast_bytes=0)
    assert slow.columns == fast.columns
    assert rows(slow) == rows(fast) and slow.count() == 280


def test_no_address_is_hot_when_names_are_too_wide_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(enrich, "BROADCAST_BYTES", 10)
    log = requests(spark, *[request("hot", at=i) for i in range(9)])
    table = lookup(spark, ("hot", "h" * 50))
    assert rows(enrich_hostnames(log, table, broadcast_bytes=0), "client_hostname") == [
        ("h" * 50,)] * 9

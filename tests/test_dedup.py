from __future__ import annotations

import random

from conftest import plan, rows
from fixtures import request, requests
from hitloom.operators.dedup import SURVIVOR_ORDER, dedup_requests


def brute_force(columns, data):
    order = [c for c in SURVIVOR_ORDER if c in columns]
    best = {}
    for row in data:
        named = dict(zip(columns, row))
        key = tuple(named[c] for c in ("remote_addr", "timestamp", "method", "url"))
        rank = tuple((named[c] is None, named[c] if named[c] is not None else 0) for c in order)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def random_requests(seed, n=400):
    pick = random.Random(seed)
    return [request(
        addr=pick.choice("ab"), at=pick.randrange(3), method=pick.choice(["GET", None]),
        url=pick.choice(["/a", None]), protocol=pick.choice(["p", "q", None]),
        status=pick.choice([200, 404, None]), size=pick.choice([1, 2, None]),
        referer=pick.choice(["r", None]), agent=pick.choice(["u", "v", None]),
        time=pick.random() > 0.3,
    ) for _ in range(n)]


def test_smallest_row_per_key_survives(spark):
    for seed in range(3):
        data = random_requests(seed)
        log = requests(spark, *data).repartition(5)
        assert rows(dedup_requests(log)) == brute_force(log.columns, data)


def test_twice_is_once(spark):
    once = dedup_requests(requests(spark, *random_requests(9)))
    assert rows(dedup_requests(once)) == rows(once)


def test_a_key_with_most_rows_leaves_each_task_as_one_row(spark):
    data = [request() for _ in range(3000)] + [request(at=i) for i in range(1, 1001)]
    kept = dedup_requests(requests(spark, *data).repartition(4))
    assert kept.count() == 1001
    text = plan(kept)
    partial, final = text.count("row_number(), 1, Partial"), text.count("row_number(), 1, Final")
    assert partial and final
    assert "Python" not in text

"""Hash keys: hex MD5 of text, so both sides of a join compute them alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column) -> Column:
    """MD5 of the parts' text run together; null if any part is null."""
    return F.md5(F.concat(*(part.cast("string") for part in parts)))


def ip_key(address: Column) -> Column:
    return hash_key(address)


def date_key(date: Column) -> Column:
    return hash_key(date)


def status_key(status: Column) -> Column:
    return hash_key(status)


def request_key(method: Column, url: Column, protocol: Column) -> Column:
    return hash_key(method, url, protocol)


def request_id(address: Column, ts: Column, method: Column, url: Column) -> Column:
    return hash_key(address, ts, method, url)

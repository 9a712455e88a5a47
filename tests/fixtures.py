"""Small hand-written inputs."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

from hitloom.operators.parse import describe_requests

REQUEST_DDL = (
    "remote_addr STRING, timestamp TIMESTAMP_NTZ, method STRING, url STRING, protocol STRING, "
    "status INT, body_bytes_sent BIGINT, http_referer STRING, user_agent STRING"
)
T0 = datetime(2024, 1, 6, 10, 0, 0)  # a Saturday


def request(addr="10.0.0.1", at=0, method="GET", url="/a", protocol="HTTP/1.1", status=200,
            size=100, referer="-", agent="ua", time=True):
    ts = T0 + timedelta(seconds=at) if time else None
    return (addr, ts, method, url, protocol, status, size, referer, agent)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST_DDL)


def lookup(spark, *pairs, columns=("client_ip", "hostname")):
    ddl = ", ".join(f"{c} STRING" for c in columns)
    return spark.createDataFrame([tuple(p) for p in pairs], ddl)


def described(spark, *rows):
    from hitloom.operators.enrich import without_names
    return describe_requests(without_names(requests(spark, *rows)))


def line(addr="1.2.3.4", clock="22/Jan/2019:03:56:14", request="GET /a HTTP/1.1",
         status="200", size="1", agent="ua"):
    return f'{addr} - - [{clock} +0330] "{request}" {status} {size} "-" "{agent}" "-"'


def land(path, lines, year=2024, month=1):
    folder = path / f"year={year}" / f"month={month:02d}" / "logs"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "access.log").write_text("".join(f"{text}\n" for text in lines))


def land_lookup_csv(path, text, year=2024, month=1):
    folder = path / f"year={year}" / f"month={month:02d}" / "lookup"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "client_hostname.csv").write_text(text)


def spoil(folder):
    """Make every data file below a folder unreadable; it can still be listed."""
    files = glob.glob(f"{folder}/*.parquet")
    assert files
    for file in files:
        with open(file, "wb") as out:
            out.write(b"not parquet")
        checksum = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
        if os.path.exists(checksum):
            os.remove(checksum)

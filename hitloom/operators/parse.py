"""Raw string columns to typed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import measures, request_text


def parse_requests(raw: DataFrame) -> DataFrame:
    """Typed requests of raw log fields, by position.

    Lines without an address are dropped; values that cannot be read become null.
    """
    address, clock, offset, request, status, size, referer, agent = (
        F.col(f"_c{position}") for position in (0, 3, 4, 5, 6, 7, 8, 9)
    )
    instant = request_text.log_instant(request_text.bracketed_time(clock, offset))
    columns = {
        "remote_addr": address,
        "timestamp": request_text.utc_wall_clock(instant),
        "method": request_text.request_part(request, 0),
        "url": request_text.request_part(request, 1),
        "protocol": request_text.request_part(request, 2),
        "status": request_text.number(status, "int"),
        "body_bytes_sent": request_text.number(size, "bigint"),
        "http_referer": referer,
        "user_agent": agent,
    }
    present = raw.filter(address.isNotNull())
    return present.select(*(column.alias(name) for name, column in columns.items()))


def describe_requests(requests: DataFrame) -> DataFrame:
    """Add calendar parts, the error flag and the status class."""
    ts = F.col("timestamp")
    status = F.col("status")
    return requests.withColumns({
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "is_error": measures.is_error(status),
        "status_class": measures.status_class(status),
    })

"""Schemas of every table read or published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, INT, BIGINT, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOLEAN, DATE, CLOCK = BooleanType(), DateType(), TimestampNTZType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Ten fields are used; the eleventh takes a trailing field some log formats add.
RAW = _schema(**{f"_c{i}": STRING for i in range(11)})

# The text of a line whose number of fields is another than the schema's.
LINE = "_line"
RAW_WITH_LINE = _schema(**{field.name: STRING for field in RAW}, **{LINE: STRING})

SILVER = _schema(
    remote_addr=STRING, timestamp=CLOCK, method=STRING, url=STRING, protocol=STRING,
    status=INT, body_bytes_sent=BIGINT, http_referer=STRING, user_agent=STRING, year=INT,
    month=INT, day=INT, hour=INT, is_error=BOOLEAN, status_class=STRING,
    client_hostname=STRING,
)

TABLES: dict[str, StructType] = {
    "silver": SILVER,
    "stg_requests": _schema(
        request_id=STRING, remote_addr=STRING, client_hostname=STRING, request_timestamp=CLOCK,
        request_date=DATE, method=STRING, url=STRING, protocol=STRING, status=INT,
        status_class=STRING, is_error=BOOLEAN, body_bytes_sent=BIGINT, http_referer=STRING,
        user_agent=STRING,
    ),
    "dim_ip": _schema(
        ip_sk=STRING, ip_address=STRING, client_hostname=STRING,
    ),
    "dim_status": _schema(
        status_sk=STRING, status_code=INT, status_class=STRING, is_error=BOOLEAN,
    ),
    "dim_request": _schema(
        request_sk=STRING, method=STRING, url=STRING, protocol=STRING,
    ),
    "dim_date": _schema(
        date_sk=STRING, full_date=DATE, year=BIGINT, month=BIGINT, day=BIGINT, day_name=STRING,
        is_weekend=BOOLEAN,
    ),
    "fact_requests": _schema(
        request_id=STRING, ip_sk=STRING, date_sk=STRING, status_sk=STRING, request_sk=STRING,
        request_timestamp=CLOCK, body_bytes_sent=BIGINT, http_referer=STRING,
        user_agent=STRING,
    ),
    "kpi_summary": _schema(
        total_requests=BIGINT, unique_ips=BIGINT, error_rate_pct=DOUBLE, avg_kb_per_req=DOUBLE,
    ),
    "agg_hourly_traffic": _schema(
        hour=CLOCK, total_requests=BIGINT, success_2xx=BIGINT, errors_4xx5xx=BIGINT,
    ),
    "agg_status_breakdown": _schema(
        status_class=STRING, request_count=BIGINT,
    ),
    "agg_top_endpoints": _schema(
        url=STRING, method=STRING, request_count=BIGINT,
    ),
    "agg_method_split": _schema(
        method=STRING, request_count=BIGINT, pct=DOUBLE,
    ),
    "agg_error_detail": _schema(
        status_code=INT, status_class=STRING, error_count=BIGINT, pct=DOUBLE,
    ),
    "agg_day_of_week": _schema(
        day_name=STRING, day_order=INT, is_weekend=BOOLEAN, total_requests=BIGINT,
        avg_req_per_hour=DOUBLE,
    ),
    "agg_daily_bytes": _schema(
        full_date=DATE, is_weekend=BOOLEAN, day_type=STRING, total_gb=DOUBLE,
        request_count=BIGINT, avg_kb_per_req=DOUBLE,
    ),
    "bad_lines": _schema(reason=STRING, line=STRING, file=STRING),
    "quality": _schema(
        check=STRING, table=STRING, column=STRING, failures=BIGINT, passed=BOOLEAN,
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Check names and types against the published schema, then fix the column order."""
    wanted = TABLES[table]
    found = {field.name: field.dataType for field in df.schema}
    expected = {field.name: field.dataType for field in wanted}
    if found != expected:
        raise ValueError(f"{table}: expected {expected}, found {found}")
    return df.select(*wanted.names)

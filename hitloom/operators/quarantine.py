"""Log lines that could not be read in full, with the reason.

Parsing is permissive: what cannot be read becomes null and a line without an address is
dropped. Here such lines are told from good ones, counted and kept as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import request_text
from hitloom.schemas import LINE, RAW

FIELDS = len(RAW)
#: Reasons in the order in which they are looked for; a line has the first that applies.
REASONS = ("no_address", "short_line", "surplus_fields", "time", "request", "status", "size")
# Fixed value: how a log writes that there is no size.
NO_SIZE = "-"


def reason() -> Column:
    """Why a raw line with ``LINE`` is not read in full; null for a good one.

    The reader keeps the text of a line whose number of fields differs from the schema's,
    and pads short ones with nulls; ten fields are enough.
    """
    field = [F.col(f"_c{i}") for i in range(FIELDS)]
    instant = request_text.log_instant(request_text.bracketed_time(field[3], field[4]))
    parts = F.size(F.split(field[5], " "))
    broken = {
        "no_address": field[0].isNull(),
        "short_line": field[9].isNull(),
        "surplus_fields": field[10].isNotNull() & F.col(LINE).isNotNull(),
        "time": instant.isNull(),
        "request": field[5].isNull() | (parts != 3),
        "status": request_text.number(field[6], "int").isNull(),
        "size": ~field[7].eqNullSafe(NO_SIZE) & request_text.number(field[7], "bigint").isNull(),
    }
    return F.coalesce(*(F.when(broken[name], F.lit(name)) for name in REASONS))


def reason_counts(prefix: str = "bad_") -> list[Column]:
    """A count of lines for each reason, to observe on a scan with ``LINE``."""
    return [F.count_if(reason() == name).alias(f"{prefix}{name}") for name in REASONS]


def bad_lines(raw: DataFrame) -> DataFrame:
    """(reason, line, file) of every line of a scan with ``LINE`` that has a reason.

    Lines whose fields are as many as the schema's are joined again from these, so quotes
    around fields are gone from them.
    """
    fields = F.concat_ws(" ", *(F.col(f"_c{i}") for i in range(FIELDS)))
    return raw.select(
        reason().alias("reason"), F.coalesce(LINE, fields).alias("line"),
        F.col("_metadata.file_path").alias("file")).where("reason IS NOT NULL")

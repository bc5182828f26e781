"""Column expressions used by the normaliser and the log reader.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from mirrorkit.functions.fixed import (
    LOG_LOCAL_SECONDS_FORMAT,
    LOG_SECONDS_FORMAT,
    LOG_TIMESTAMP_FORMAT,
    LOG_TIMESTAMP_PATTERN,
    NARROWED_DECIMAL,
    TIMESTAMP_TEXT_FORMAT,
)


def source_column(name: str) -> Column:
    """A column by its exact name, even when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def timestamp_text(column: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss.SSS``; sub-millisecond digits are cut, null stays null."""
    return F.date_format(column, TIMESTAMP_TEXT_FORMAT)


def narrow_decimal(column: Column) -> Column:
    """DECIMAL(38,10) to DECIMAL(10,0), rounding half up; overflow gives null, not an error."""
    precision, scale = NARROWED_DECIMAL
    return column.try_cast(DecimalType(precision, scale))


def narrowing_overflowed(column: Column) -> Column:
    """True where a non-null value does not fit the narrowed type."""
    return column.isNotNull() & narrow_decimal(column).isNull()


def load_stamp() -> Column:
    """Load time as text; ``current_timestamp`` is folded to one value per query."""
    return F.date_format(F.current_timestamp(), TIMESTAMP_TEXT_FORMAT)


def log_line_time_ms(text: Column, zone: str | None = None) -> Column:
    """Epoch milliseconds of a log timestamp, null when the text is not one.

    One to six fraction digits are accepted (cut to milliseconds). The time is
    a wall clock in ``zone``; without one, in the session's time zone.
    """
    found = F.regexp_extract(text, LOG_TIMESTAMP_PATTERN, 0)
    parts = F.split(found, r"\.", 2)  # seconds and fraction apart: the fraction's length varies
    if zone is None:  # no zone name to parse in every line
        instant = F.try_to_timestamp(parts.getItem(0), F.lit(LOG_LOCAL_SECONDS_FORMAT))
    else:
        instant = F.try_to_timestamp(F.concat(parts.getItem(0), F.lit(" "), F.lit(zone)), F.lit(LOG_SECONDS_FORMAT))
    millis = F.rpad(F.substring(parts.getItem(1), 1, 3), 3, "0").cast("bigint")
    return F.when(found != "", F.unix_millis(instant) + millis)


def log_line_text(ts: Column, level: Column, logger: Column, message: Column) -> Column:
    """Render one log line in the job log layout ``<ts> <LEVEL> <logger>: <message>``."""
    return F.concat(
        F.date_format(ts, LOG_TIMESTAMP_FORMAT), F.lit(" "), level, F.lit(" "),
        logger, F.lit(": "), message,
    )

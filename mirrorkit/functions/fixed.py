"""Fixed values shared by every mirror.

These are conventions of the mirrored output (text formats, default job
parameters, file sizing). A mirror built with different values would not be
interchangeable with one built by the original job, so they live together
here and nowhere else.
"""

from __future__ import annotations

# --- Fixed values: output conventions of a mirror -------------------------
# Text form of every converted timestamp and of the load stamp.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# Timestamp at the start of every job log line (underscore between date and time).
LOG_TIMESTAMP_FORMAT = "yyyy-MM-dd_HH:mm:ss.SSS"
# The same for reading: its shape (one to six fraction digits), and the part
# before the fraction, alone or followed by a zone name.
LOG_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2}\.\d{1,6}$"
LOG_LOCAL_SECONDS_FORMAT = "yyyy-MM-dd_HH:mm:ss"
LOG_SECONDS_FORMAT = "yyyy-MM-dd_HH:mm:ss VV"
# Source numbers that arrive as DECIMAL(38,10) are unscaled integers and are
# narrowed to DECIMAL(10,0); no other decimal is touched.
UNSCALED_SOURCE_DECIMAL = (38, 10)
NARROWED_DECIMAL = (10, 0)
# Job defaults for an absent key (an explicit null disables the feature).
DEFAULT_MIN_YEAR = 1800
DEFAULT_CUR = ("Y", "N", "D")
# Global per-column type overrides, applied to every table that has the column.
GLOBAL_SCHEMA_OVERRIDES = {"deactivat": "STRING", "taxyr": "INTEGER"}
# Rows per JDBC round trip.
FETCH_SIZE = 10_000
# Upper bound of rows in one final file.
MAX_ROWS_PER_FILE = 5_000_000
# Codec of staged files and of final (compacted) files.
STAGED_COMPRESSION = "snappy"
FINAL_COMPRESSION = "zstd"
# Jobs of one batch that run at the same time on the shared session.
PARALLEL_JOBS = 4
# Column names with a meaning for filtering, partitioning and chunking.
YEAR_COLUMN = "taxyr"
STATUS_COLUMN = "cur"
KEY_COLUMN = "parid"
LOADED_AT_COLUMN = "loaded_at"
# Partition columns, always in this order.
PARTITION_ORDER = (YEAR_COLUMN, STATUS_COLUMN)
# --------------------------------------------------------------------------

"""Column expressions: pure Spark functions, no UDF."""

from playline.functions.columns import (
    PERCENT_SCALE,
    parse_number,
    parse_time,
    raw_key,
    run_stamp,
    utc_day,
    watch_cents,
    watch_time,
)

__all__ = [
    "PERCENT_SCALE",
    "parse_number",
    "parse_time",
    "raw_key",
    "run_stamp",
    "utc_day",
    "watch_cents",
    "watch_time",
]

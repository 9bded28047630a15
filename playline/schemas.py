"""Fixed schemas of every raw file and table.

Nothing is inferred. Raw fields that may arrive dirty (numbers, times) are read as text and
cast with ``try_cast`` afterwards, so that one bad value costs one value and not a whole file.
"""

RAW_MEDIA = (
    "id STRING, name STRING, thumbnail STRUCT<url: STRING>, duration STRING, "
    "created STRING, updated STRING, hashed_id STRING"
)
RAW_EVENTS = (
    "visitor_key STRING, event_key STRING, received_at STRING, percent_viewed STRING, "
    "ip STRING, country STRING, media_id STRING, media_url STRING"
)
RAW_ENGAGEMENT = "media_id STRING, engagement VARIANT"
POINTER = "latest_s3_key STRING"

DIM_MEDIA = (
    "media_id BIGINT, title STRING, url STRING, duration DOUBLE, created_at TIMESTAMP, "
    "updated_at TIMESTAMP, hashed_id STRING, load_date DATE"
)
FACT_EVENTS = (
    "visitor_key STRING, event_key STRING, received_at TIMESTAMP, percent_viewed DOUBLE, "
    "ip STRING, country STRING, media_id STRING, media_url STRING, load_date DATE"
)
FACT_MEDIA_ENGAGEMENT = (
    "media_id STRING, percent_viewed DOUBLE, visitor_key STRING, event_key STRING, "
    "received_at TIMESTAMP, title STRING, duration DOUBLE, watch_time_seconds DOUBLE, "
    "load_date DATE"
)
REJECTED_EVENTS = (
    "visitor_key STRING, event_key STRING, received_at TIMESTAMP, percent_viewed DOUBLE, "
    "ip STRING, country STRING, media_id STRING, media_url STRING, _corrupt_record STRING, "
    "reason STRING, load_date DATE"
)
# first_at and last_at: least and greatest usable time of the batch's events; timeless: events
# without one. Null where they are not known.
LANDED_BATCHES = (
    "dataset STRING, path STRING, run_ts STRING, rows BIGINT, first_at TIMESTAMP, "
    "last_at TIMESTAMP, timeless BIGINT"
)
# The same for each file of a batch that was landed in ranges of time.
LANDED_FILES = (
    "dataset STRING, path STRING, file STRING, rows BIGINT, first_at TIMESTAMP, "
    "last_at TIMESTAMP, timeless BIGINT"
)
LOADED_BATCHES = "dataset STRING, path STRING, load_date DATE"
AUDIT = "step STRING, run_date DATE, status STRING, rows BIGINT, finished_at TIMESTAMP"
# Of a micro-batch: the raw rows, those too late for the state (none, as long as it goes by the
# time of arrival), the copies it took out, the rows behind it; of those the ones stored, known
# already, or without a usable time.
STREAM_AUDIT = (
    "step STRING, run_date DATE, run_id STRING, batch BIGINT, raw_rows BIGINT, late BIGINT, copies BIGINT, "
    "handed_on BIGINT, known BIGINT, rejected BIGINT, stored BIGINT, finished_at TIMESTAMP"
)
DAILY_ENGAGEMENT = (
    "event_date DATE, events BIGINT, visitors BIGINT, total_watch_time_seconds DOUBLE, load_date DATE"
)
AUDIENCE_SKETCHES = (
    "dimension STRING, value STRING, events BIGINT, percent_sum DECIMAL(38,9), percents BIGINT, "
    "visitors BINARY, load_date DATE"
)

TABLES = {
    "dim_media": DIM_MEDIA,
    "fact_events": FACT_EVENTS,
    "fact_media_engagement": FACT_MEDIA_ENGAGEMENT,
}

# Times in JSON text that we write, to the microsecond.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

"""The registered queries in plain SQL, for the comparison with a second engine."""

from __future__ import annotations

# Whole inputs as in bindings.py; unused ones cost nothing.
INPUTS = """
WITH media AS (
  SELECT p_partkey AS media_id, p_name AS title,
         'https://cdn.example.com/' || p_partkey || '.jpg' AS url,
         p_retailprice AS duration, left(md5(CAST(p_partkey AS VARCHAR)), 10) AS hashed_id,
         p_size, p_brand
  FROM part
), ev AS (
  SELECT CAST(user_id AS VARCHAR) AS visitor_key, CAST(event_id AS VARCHAR) AS event_key,
         ts AS received_at,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS percent_viewed,
         '10.0.0.' || (user_id % 256) AS ip, n_name AS country,
         left(md5(CAST(event_id % 2500 AS VARCHAR)), 10) AS media_id,
         'https://media.example.com/' || (event_id % 2500) AS media_url,
         event_type AS source
  FROM events LEFT JOIN customer ON user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
), joined AS (
  SELECT ev.*, title, duration,
         CAST(round(CAST(CAST(percent_viewed / 100 * duration AS VARCHAR) AS DECIMAL(38,18)), 2)
              AS DOUBLE) AS watch_time_seconds
  FROM ev JOIN media ON ev.media_id = media.hashed_id
), fact AS (
  SELECT media_id, percent_viewed, visitor_key, event_key, received_at, title, duration,
         watch_time_seconds, DATE '2024-01-30' AS load_date
  FROM joined
), gaps AS (
  SELECT media_id, CASE WHEN p_size < 6 THEN ''
                        WHEN p_size < 12 THEN left(md5(CAST(-media_id AS VARCHAR)), 10)
                        WHEN p_size <= 45 THEN hashed_id END AS hashed_id
  FROM media
), keyed AS (
  SELECT * FROM gaps WHERE hashed_id IS NOT NULL AND hashed_id <> ''
), stats AS (
  SELECT media_id, count(*) AS plays, count(DISTINCT visitor_key) AS visitors
  FROM ev GROUP BY media_id
), found AS (
  SELECT hashed_id AS media_id, plays,
         '{"plays":' || plays || ',"visitors":' || visitors || '}' AS engagement,
         CASE WHEN stats.media_id IS NULL THEN 'no statistics for media ' || hashed_id END AS error
  FROM keyed LEFT JOIN stats ON hashed_id = stats.media_id
), paged AS (
  SELECT source, event_key, received_at,
         CAST(floor((row_number() OVER (PARTITION BY source ORDER BY md5(event_key)) - 1) / 100)
              AS BIGINT) + 1 AS page
  FROM ev
), stops AS (
  SELECT source, min(page) AS stop
  FROM (SELECT source, page, max(received_at > TIMESTAMP '2024-01-30') AS hit
        FROM paged GROUP BY source, page)
  WHERE NOT hit GROUP BY source
), kept AS (
  SELECT paged.* FROM paged LEFT JOIN stops USING (source)
  WHERE received_at > TIMESTAMP '2024-01-30' AND (stop IS NULL OR page < stop)
)
"""

EVENT = "visitor_key, event_key, received_at, percent_viewed, ip, country, media_id, media_url"
LOADED = f"SELECT {EVENT}, DATE '2024-01-30' AS load_date FROM ev"
SUMMARY = """
  count(*) AS events, count(DISTINCT visitor_key) AS visitors,
  CAST(sum(CAST(watch_time_seconds AS DECIMAL(18,2))) AS DOUBLE) AS total_watch_time_seconds"""
AVERAGE = """
  CAST(round(CAST(CAST(avg(percent_viewed) AS VARCHAR) AS DECIMAL(38,18)), 6) AS DOUBLE)
    AS avg_percent_viewed"""

RANGE_REJECTS = """
  SELECT event_key, 'no usable received_at' AS kept_as
  FROM ev WHERE source IN ('error', 'signup')
  UNION ALL SELECT event_key, 'stored' FROM ev
  WHERE source NOT IN ('error', 'signup') AND received_at <= TIMESTAMP '2024-01-16'"""

BODIES = {
    "dim_media": "SELECT media_id, title, url, duration, hashed_id, DATE '2024-01-30' AS load_date FROM media",
    "fact_events": LOADED,
    "fact_media_engagement": "SELECT * FROM fact",
    "dim_visitor": """
        SELECT visitor_key, event_key, ip AS ip_address, country FROM ev
        QUALIFY row_number() OVER
          (PARTITION BY visitor_key ORDER BY received_at DESC, event_key DESC) = 1""",
    "events_received_after": """
        SELECT event_key, received_at, media_id FROM ev
        WHERE received_at > TIMESTAMP '2024-01-16' AND received_at <= TIMESTAMP '2024-01-30'""",
    "events_for_media": """
        SELECT event_key, media_id, received_at FROM ev
        WHERE media_id IN ('c4ca4238a0', 'c81e728d9d')""",
    "events_for_listed_media": """
        SELECT event_key, media_id, received_at FROM ev
        WHERE media_id IN (SELECT hashed_id FROM media WHERE p_brand = 'Brand#10')""",
    "media_with_key": "SELECT * FROM keyed",
    "events_paged": "SELECT * FROM paged",
    "events_until_empty_page": "SELECT * FROM kept",
    "events_union_media": """
        SELECT source, event_key, media_id FROM ev
        UNION ALL SELECT source, event_key, media_id FROM ev WHERE source = 'view'""",
    "unmatched_events": """
        SELECT event_key, media_id, visitor_key, received_at FROM ev
        WHERE NOT EXISTS (SELECT 1 FROM media WHERE hashed_id = ev.media_id)""",
    "media_engagement_lookup": "SELECT media_id, engagement, error FROM found",
    "engagement_envelopes": "SELECT media_id, engagement FROM found WHERE error IS NULL",
    "engagement_errors": """
        SELECT media_id, error,
               '{"media_id":"' || media_id || '","error":"' || error || '"}' AS engagement
        FROM found WHERE error IS NOT NULL""",
    "engagement_by_media": f"SELECT media_id, title, {SUMMARY}, {AVERAGE} FROM fact GROUP BY media_id, title",
    "engagement_by_country": f"SELECT country, {SUMMARY}, {AVERAGE} FROM joined GROUP BY country",
    "engagement_by_visitor": f"""
        SELECT visitor_key, events, media, total_watch_time_seconds, avg_percent_viewed FROM (
          SELECT visitor_key, {SUMMARY}, {AVERAGE}, count(DISTINCT media_id) AS media
          FROM fact GROUP BY visitor_key)""",
    "daily_events": f"""
        SELECT CAST(received_at AS DATE) AS event_date, {SUMMARY}
        FROM fact GROUP BY CAST(received_at AS DATE)""",
    "media_details": "SELECT hashed_id, media_id, title, url, duration FROM media",
    "event_interactions": """
        SELECT CAST(received_at AS DATE) AS event_date, event_key, visitor_key, media_id,
               received_at, country, percent_viewed, title, watch_time_seconds
        FROM joined""",
    "latest_landed_batch": """
        SELECT 'raw_data/events/player_events_' || run_ts || '.json' AS path, run_ts, rows FROM (
          SELECT strftime(max(received_at), '%Y%m%d_%H%M%S') AS run_ts, count(*) AS rows
          FROM ev GROUP BY CAST(received_at AS DATE))
        ORDER BY run_ts DESC LIMIT 1""",
    "landed_events": f"SELECT {EVENT} FROM ev WHERE received_at > TIMESTAMP '2024-01-16'",
    "landed_media": "SELECT media_id, title, url, duration, hashed_id FROM media",
    "landed_batch_log": """
        SELECT 'events' AS dataset,
               CASE WHEN received_at <= TIMESTAMP '2024-01-16' THEN '20240116_000000'
                    ELSE '20240130_235000' END AS run_ts, count(*) AS rows
        FROM ev GROUP BY 2
        UNION ALL SELECT 'events', '20240131_235000', 0""",
    "landed_pages": "SELECT source, page, event_key, received_at FROM kept",
    "landed_engagement": "SELECT media_id, plays FROM found WHERE error IS NULL",
    "landed_visitors": """
        SELECT visitor_key, count(*) AS load_count, max(percent_viewed) AS best_percent
        FROM ev GROUP BY visitor_key""",
    "accepted_events": """
        SELECT event_key, received_at,
               CASE WHEN source <> 'click' THEN percent_viewed END AS percent_viewed
        FROM ev WHERE source NOT IN ('error', 'signup')""",
    "rejected_events": """
        SELECT event_key, source = 'error' AS kept_in_full
        FROM ev WHERE source IN ('error', 'signup')""",
    "keyless_events": """
        SELECT CASE source WHEN 'error' THEN '' WHEN 'click' THEN NULL ELSE event_key END
                 AS event_key, received_at, media_id
        FROM ev, unnest([1, 2]) AS t(copy)
        WHERE copy = 1 OR source IN ('click', 'error')""",
    "percent_rejects": """
        SELECT event_key, DATE '2024-01-30' AS load_date,
               CASE WHEN source = 'click' THEN 'unusable value'
                    ELSE 'no usable received_at' END AS reason
        FROM ev WHERE source IN ('error', 'signup', 'click')""",
    "range_load_rejects": RANGE_REJECTS,
    "range_load_indexed": RANGE_REJECTS,
    "landed_event_arrays": f"SELECT {EVENT} FROM ev",
    "stream_dedup_rejects": """
        SELECT event_key, 'no usable received_at' AS reason
        FROM ev WHERE source IN ('error', 'signup')""",
    "two_batches_one_run": LOADED,
    "paged_null_source": """
        SELECT CASE WHEN source <> 'error' THEN source END AS source, event_key, page FROM paged""",
    "landed_media_pages": """
        SELECT media_id AS id, title AS name, url, duration, hashed_id,
               CAST(floor((row_number() OVER (ORDER BY media_id) - 1) / 100) AS BIGINT) + 1 AS page
        FROM media""",
    "landed_visitor_pages": """
        SELECT visitor_key, load_count, CAST(floor(
                 (row_number() OVER (ORDER BY visitor_key) - 1) / 100) AS BIGINT) + 1 AS page
        FROM (SELECT visitor_key, count(*) AS load_count FROM ev GROUP BY visitor_key)""",
    "pointer_load": f"""
        SELECT {EVENT}, DATE '2024-01-30' AS load_date, true AS others_skipped FROM ev""",
    "events_of_last_day": """
        SELECT event_key, received_at FROM ev
        WHERE received_at > (SELECT date_trunc('day', max(received_at)) FROM ev)""",
    "media_of_today": "SELECT media_id, true AS is_today FROM media",
    "empty_append": """
        SELECT DATE '2024-01-30' AS load_date, count(*) AS events FROM ev""",
    "events_append": """
        SELECT event_key, DATE '2024-01-30' AS load_date FROM ev
        UNION ALL
        SELECT event_key, DATE '2024-01-16' FROM ev WHERE received_at <= TIMESTAMP '2024-01-16'""",
    "events_append_new": """
        SELECT event_key, CASE WHEN received_at <= TIMESTAMP '2024-01-16' THEN DATE '2024-01-16'
                               ELSE DATE '2024-01-30' END AS load_date
        FROM ev""",
    "media_snapshots": """
        SELECT media_id, title, DATE '2024-01-30' AS load_date FROM media WHERE duration < 950""",
    "media_versions": """
        SELECT media_id, title, DATE '2024-01-29' AS load_date FROM media
        UNION ALL
        SELECT media_id, title, DATE '2024-01-30' FROM media WHERE duration < 950""",
    "engagement_by_delta": """
        SELECT ev.media_id, percent_viewed, visitor_key, event_key, received_at, title, m.duration,
               CAST(round(CAST(CAST(percent_viewed / 100 * m.duration AS VARCHAR)
                    AS DECIMAL(38,18)), 2) AS DOUBLE) AS watch_time_seconds,
               DATE '2024-01-30' AS load_date
        FROM ev JOIN (SELECT hashed_id, title, CASE WHEN media_id % 10 = 1 THEN duration * 2
                             ELSE duration END AS duration
                      FROM media WHERE media_id % 3 <> 0) m ON ev.media_id = m.hashed_id""",
    "daily_load": "SELECT * FROM fact",
    "registered_tables": """
        SELECT hashed_id, title, duration, DATE '2024-01-30' AS load_date FROM media""",
    "run_audit": """
        SELECT step, run_date, 'ok' AS status, rows FROM (
          SELECT 'dim_media' AS step, unnest([DATE '2024-01-16', DATE '2024-01-30']) AS run_date,
                 count(*) AS rows FROM media
          UNION ALL SELECT 'fact_events', DATE '2024-01-16',
                 count(*) FILTER (WHERE received_at <= TIMESTAMP '2024-01-16') FROM ev
          UNION ALL SELECT 'fact_events', DATE '2024-01-30',
                 count(*) FILTER (WHERE received_at > TIMESTAMP '2024-01-16') FROM ev
          UNION ALL SELECT 'fact_media_engagement', DATE '2024-01-16',
                 count(*) FILTER (WHERE received_at <= TIMESTAMP '2024-01-16') FROM fact
          UNION ALL SELECT 'fact_media_engagement', DATE '2024-01-30', count(*) FROM fact)""",
    "date_range_load": f"""{LOADED}
        WHERE received_at > TIMESTAMP '2024-01-10' AND received_at <= TIMESTAMP '2024-01-20'""",
    "ad_hoc_sql": """
        SELECT title, country, count(*) AS events, max(percent_viewed) AS best_percent
        FROM joined WHERE percent_viewed >= 25 GROUP BY title, country""",
    "streamed_events": LOADED,
    "stream_deduplicated_events": """
        SELECT event_key, received_at, DATE '2024-01-30' AS load_date FROM ev""",
    "stream_audit": """
        SELECT count(*) + count_if(received_at > TIMESTAMP '2024-01-16') AS raw_rows, CAST(0 AS BIGINT) AS late,
               count_if(received_at > TIMESTAMP '2024-01-16') AS copies, count(*) AS handed_on,
               CAST(0 AS BIGINT) AS known, CAST(0 AS BIGINT) AS rejected, count(*) AS stored
        FROM ev""",
}

BODIES["audience_by_country"] = f"""
    SELECT country, count(*) AS events, count(DISTINCT visitor_key) AS visitors, {AVERAGE},
           true AS sketch_is_near
    FROM ev GROUP BY country"""
BODIES["engagement_statistics_load"] = """
    SELECT media_id, plays, error,
           (SELECT count(*) FROM found WHERE error IS NOT NULL) AS all_failed FROM found"""
BODIES["visitors_load"] = """
    SELECT visitor_key, count(*) OVER () AS audited_rows FROM (
      SELECT visitor_key, row_number() OVER (ORDER BY visitor_key) AS place
      FROM (SELECT DISTINCT visitor_key FROM ev)) WHERE place <= 600"""
BODIES["streamed_daily"] = BODIES["daily_events"]
BODIES["events_append_indexed"] = BODIES["events_append_new"]

ORACLES = {name: INPUTS + body for name, body in BODIES.items()}

# The exact report, and that the sketch lies near it.
ORACLES["engagement_by_media_approx"] = (
    f"SELECT *, true AS sketch_is_near FROM ({ORACLES['engagement_by_media']})"
)

"""The given test tables seen as raw media and raw events.

``part`` stands for media and ``events`` for viewer events. Times stay zone-less, as stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.operators.lookup import lookup_join
from playline.operators.windows import paginate

RUN_DATE = "2024-01-30"
RUN_TS = "20240130_235000"
CUTOFF = "2024-01-30 00:00:00"
MIDDLE = "2024-01-16 00:00:00"
# Events spread over this many media, more than some of the given part tables hold.
MEDIA_SPREAD = 2500


SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def hashed(number: str) -> str:
    """SQL expression of the hashed id of a media number."""
    return f"substring(md5(CAST({number} AS STRING)), 1, 10)"


def raw_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        "p_name AS name",
        "named_struct('url', 'https://cdn.example.com/' || p_partkey || '.jpg') AS thumbnail",
        "p_retailprice AS duration",
        "CAST(NULL AS TIMESTAMP) AS created",
        "CAST(NULL AS TIMESTAMP) AS updated",
        f"{hashed('p_partkey')} AS hashed_id",
    )


def raw_events(spark: SparkSession, sf_dir: str, country: bool = False) -> DataFrame:
    """All events; ``country`` costs a join with the customers, so only where it is asked for."""
    events = table(spark, sf_dir, "events")
    if country:
        # nation is a fixed list of countries.
        nation = table(spark, sf_dir, "nation").selectExpr(
            "n_nationkey AS c_nationkey", "n_name AS country"
        )
        customer = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
        homes = customer.selectExpr("c_custkey AS user_id", "country")
        events = lookup_join(events, homes, ["user_id"], "left")
    media = f"event_id % {MEDIA_SPREAD}"
    return events.selectExpr(
        "CAST(user_id AS STRING) AS visitor_key",
        "CAST(event_id AS STRING) AS event_key",
        "ts AS received_at",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS percent_viewed",
        "'10.0.0.' || user_id % 256 AS ip",
        "country" if country else "CAST(NULL AS STRING) AS country",
        f"{hashed(media)} AS media_id",
        f"'https://media.example.com/' || {media} AS media_url",
        "event_type AS source",
    )


def media_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media of which the small ones have an empty hashed_id and the large ones none; of the others
    some have one that no event carries."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS media_id",
        f"CASE WHEN p_size < 6 THEN '' WHEN p_size < 12 THEN {hashed('-p_partkey')}"
        f" WHEN p_size <= 45 THEN {hashed('p_partkey')} END AS hashed_id",
    )


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per media, as the raw JSON object."""
    counts = raw_events(spark, sf_dir).groupBy("media_id").agg(
        F.count(F.lit(1)).alias("plays"), F.count_distinct("visitor_key").alias("visitors")
    )
    return counts.select("media_id", F.to_json(F.struct("plays", "visitors")).alias("engagement"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in pages of 100 per source, in an order that does not follow the time."""
    events = raw_events(spark, sf_dir).select("source", "event_key", "received_at")
    return paginate(events, ["source"], [F.md5("event_key")])

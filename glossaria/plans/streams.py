"""Streaming queries over the event table; each is compared with its batch twin in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaria.plans.warehouse import ORACLE as BATCH
from glossaria.streaming import events as S


def _ntz(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    # a watermark of years: the twin drops no late events either
    out = S.to_table(S.tumbling(S.event_stream(spark, f"{sf}/events.parquet"), late="3650 days"), "tumbling")
    return _ntz(out, "hour").withColumn("value", F.round("value", 4))


def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _ntz(S.to_table(S.sessions(S.event_stream(spark, f"{sf}/events.parquet"), late="3650 days"), "sessions"), "start")


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_table(S.event_stream(spark, f"{sf}/events.parquet"), ["user_id", "event_type"], "event_id", ["value"], "latest")


QUERIES = {"stream_tumbling": stream_tumbling, "stream_sessions": stream_sessions, "stream_latest": stream_latest}
ORACLE = {
    "stream_tumbling": BATCH["event_windows"],
    "stream_sessions": BATCH["event_sessions"],
    "stream_latest": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL",
}

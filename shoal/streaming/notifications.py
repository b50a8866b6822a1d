"""Change notifications as a stream: NDJSON lines to rows, filters, and counters over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of a line; names as they are on the wire.
RECORDS = (
    "struct<Records:array<struct<eventVersion:string,eventSource:string,awsRegion:string,eventTime:string,eventName:string,userIdentity:struct<principalId:string>,"
    "requestParameters:map<string,string>,responseElements:map<string,string>,"
    "s3:struct<s3SchemaVersion:string,configurationId:string,bucket:struct<name:string,arn:string,ownerIdentity:struct<principalId:string>>,"
    "object:struct<key:string,size:bigint,eTag:string,contentType:string,userMetadata:map<string,string>,versionId:string,sequencer:string>>,"
    "source:struct<host:string,port:string,userAgent:string>>>>"
)


def lines(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """The text lines of a landing folder."""
    return spark.readStream.schema("value string").text(path) if streaming else spark.read.text(path)


def records(text: DataFrame, *, value: str = "value") -> DataFrame:
    """A row for each record of each line; blank lines are skipped, a malformed line ends the job, a malformed key is null. A missing version or sequencer is empty."""
    from shoal.functions.text import parse_iso8601

    parsed = text.where(F.trim(value) != "").select(F.explode(F.from_json(F.trim(value), RECORDS, {"mode": "FAILFAST"})["Records"]).alias("r"))
    return parsed.select(
        F.col("r.eventVersion").alias("event_version"), F.col("r.eventSource").alias("event_source"), F.col("r.awsRegion").alias("aws_region"),
        parse_iso8601("r.eventTime").alias("event_time"), F.col("r.eventName").alias("event_name"), F.col("r.userIdentity.principalId").alias("principal_id"),
        F.col("r.requestParameters").alias("request_parameters"), F.col("r.responseElements").alias("response_elements"),
        F.col("r.s3.bucket.name").alias("bucket"), F.try_url_decode("r.s3.object.key").alias("key"), F.col("r.s3.object.size").alias("size"), F.col("r.s3.object.eTag").alias("etag"),
        F.coalesce("r.s3.object.versionId", F.lit("")).alias("version_id"), F.coalesce("r.s3.object.sequencer", F.lit("")).alias("sequencer"),
    )


def last_by_sequencer(events: DataFrame) -> DataFrame:
    """The newest event of each key, by its ordering token, which is compared by length first."""
    order = F.struct(F.length("sequencer"), F.col("sequencer"))
    return events.groupBy("bucket", "key").agg(F.max_by(F.struct("event_name", "event_time", "sequencer"), order).alias("x")).select("bucket", "key", "x.*")


def counters(events: DataFrame, window: Column, *by: str, time: str = "event_time", late: str | None = None) -> DataFrame:
    """Events in each window of time. ``late``: how long a stream waits for late events before a window is final."""
    rows = events.withWatermark(time, late) if late else events
    return rows.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.count_if(F.col("event_name").contains("Removed")).alias("removed")).select(F.col("w.start").alias("window_start"), *by, "n", "removed")


def tumbling(events: DataFrame, length: str = "1 minute", **options) -> DataFrame:
    return counters(events, F.window("event_time", length), "event_name", **options)


def sliding(events: DataFrame, length: str = "1 hour", step: str = "30 minutes", **options) -> DataFrame:
    return counters(events, F.window("event_time", length, step), "event_name", **options)

"""Event files: comma-separated streams, access logs, and parquet event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline import schemas
from eddyline.functions.times import required

_TIME_FIELD = {"orders": "eventTime"}
_SCHEMAS = {
    "user_behavior": schemas.USER_BEHAVIOR,
    "ad_clicks": schemas.AD_CLICK,
    "logins": schemas.LOGIN,
    "orders": schemas.ORDER,
    "receipts": schemas.RECEIPT,
}
# The watermark of streams in time order trails by the clock's tick, so that further rows at the
# largest time seen so far are not taken for late ones.
ASCENDING = "1 millisecond"
# Fixed value: how the access log writes its times.
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def _reader(spark: SparkSession, streaming: bool, options: dict[str, str] | None):
    reader = spark.readStream if streaming else spark.read
    return reader.options(**(options or {}))


def _watermark(df: DataFrame, streaming: bool, delay: str) -> DataFrame:
    return df.withWatermark("ts", delay) if streaming else df


def event_csv(
    spark: SparkSession,
    path: str,
    kind: str,
    streaming: bool = False,
    delay: str = ASCENDING,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One of the five event files, with event time ``ts``; a malformed field fails the read.

    ``kind``: user_behavior, ad_clicks, logins, orders or receipts.  Streams get a watermark that
    trails the largest event time by ``delay``.  Fields are what stands between commas, quotes
    included.  An empty text field stays an empty text; an empty number fails the read, as a row
    without its time or key would be lost silently further on.
    """
    schema = _SCHEMAS[kind]
    raw = (
        _reader(spark, streaming, options)
        .schema(schema)
        .option("mode", "FAILFAST")
        .option("quote", "")
        .csv(path)
    )
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    whole = raw.withColumns(
        {
            f.name: F.coalesce(f.name, F.lit("")) if f.name in texts else required(f.name)
            for f in schema
        }
    )
    seconds = F.col(_TIME_FIELD.get(kind, "timestamp"))
    return _watermark(whole.withColumn("ts", F.timestamp_seconds(seconds)), streaming, delay)


def access_log_columns(line: Column) -> list[Column]:
    """Fields of one access-log line, by position between blanks."""
    part = F.split(line, " ")
    return [
        part[0].alias("ip"),
        part[1].alias("userId"),
        required(F.to_timestamp(part[3], ACCESS_LOG_TIME), "the time of an access-log line").alias("ts"),
        part[5].alias("method"),
        part[6].alias("url"),
    ]


def access_log(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    delay: str = "1 minute",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Web-server access log: ip, userId, ts, method, url; a line without a time fails the read."""
    lines = _reader(spark, streaming, options).text(path)
    return _watermark(lines.select(*access_log_columns(F.col("value"))), streaming, delay)


def event_table(spark: SparkSession, folder: str) -> DataFrame:
    """The parquet ``events`` table of a folder; the schema is given, so no footer is read."""
    return spark.read.schema(schemas.EVENTS).parquet(f"{folder}/events.parquet")


def event_stream(
    spark: SparkSession, folder: str, delay: str = ASCENDING, glob: str = "events.parquet"
) -> DataFrame:
    """The same table as a stream.  Watermarks need an instant, so ``ts`` becomes TIMESTAMP."""
    raw = (
        spark.readStream.schema(schemas.EVENTS).option("pathGlobFilter", glob).parquet(folder)
    )
    return raw.withColumn("ts", required("ts").cast("timestamp")).withWatermark("ts", delay)

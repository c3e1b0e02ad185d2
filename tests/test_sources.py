from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eddyline.functions.hashing import bitmap_offset
from eddyline.functions.times import bucket, local_day, span
from eddyline.operators import orders
from eddyline.session import shared_folder
from eddyline.sources import files, market


def write(path, *lines):
    path.write_text("\n".join(lines))
    return str(path)


def test_event_csv_by_position(spark, tmp_path):
    path = write(tmp_path / "orders.csv", "34729,create,,1558430842", "34729,pay,sd76f87d6,1558430844")
    rows = files.event_csv(spark, path, "orders").orderBy("eventTime").collect()
    assert [(r.orderId, r.eventType, r.txId) for r in rows] == [
        (34729, "create", ""), (34729, "pay", "sd76f87d6"),
    ]
    assert rows[0].ts.timestamp() - rows[1].ts.timestamp() == -2


@pytest.mark.parametrize(
    "kind, line, columns",
    [
        ("user_behavior", "543462,1715,1464116,pv,1511658000", 5),
        ("ad_clicks", "543462,1715,beijing,beijing,1511658000", 5),
        ("logins", "5402,83.149.11.115,success,1558430815", 4),
        ("receipts", "ewr342as4,wechat,1558430845", 3),
    ],
)
def test_every_event_file(spark, tmp_path, kind, line, columns):
    df = files.event_csv(spark, write(tmp_path / "in.csv", line), kind)
    row = df.first()
    assert len(row) == columns + 1 and None not in tuple(row)


def test_malformed_field_fails(spark, tmp_path):
    path = write(tmp_path / "logins.csv", "5402,83.149.11.115,success,soon")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.event_csv(spark, path, "logins").collect()


def test_access_log(spark, tmp_path):
    path = write(tmp_path / "access.log", "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /page")
    row = files.access_log(spark, path).first()
    assert (row.ip, row.userId, row.method, row.url) == ("83.149.9.216", "-", "GET", "/page")
    assert row.ts.strftime("%Y-%m-%d %H:%M:%S") == "2015-05-17 10:05:03"


def test_market_events_cover_all_values_and_repeat(spark):
    numbers = spark.range(4000).withColumn("ts", F.timestamp_seconds("id"))
    made = market.market_events(numbers, "id", "ts")
    counts = {(r.behavior, r.channel): r["count"] for r in made.groupBy("behavior", "channel").count().collect()}
    assert {b for b, _ in counts} == set(market.BEHAVIORS)
    assert {c for _, c in counts} == set(market.CHANNELS)
    assert market.market_events(numbers, "id", "ts").exceptAll(made).count() == 0


def test_market_stream_has_the_same_columns(spark):
    stream = market.market_stream(spark)
    batch = market.market_events(spark.range(1).withColumn("ts", F.now()), "id", "ts")
    assert stream.isStreaming and stream.columns == batch.columns


def test_span_and_bucket(spark):
    assert span("1 hour") == 3_600_000_000 and span("2 seconds") == 2_000_000
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,), (2**52 * 10 - 1,)], "us long")
    assert [r[0] for r in df.select(bucket(F.col("us"), 10)).collect()] == [-1, 0, 0, 1, 2**52 - 1]


def test_local_day_changes_at_sixteen_utc(spark):
    times = [dt.datetime(2024, 1, 1, 15, 59, 59), dt.datetime(2024, 1, 1, 16, 0, 0)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    days = [r[0] for r in df.select(local_day(F.unix_micros(F.col("ts").cast("timestamp")))).collect()]
    assert days[1] - days[0] == 1


def test_bitmap_offset(spark):
    value = spark.range(1).select(bitmap_offset(F.lit(543462))).first()[0]
    assert value == 493197308


@pytest.mark.parametrize("line", ["1,a,success,", ",a,success,5"])
def test_empty_number_fails(spark, tmp_path, line):
    rows = files.event_csv(spark, write(tmp_path / "in.csv", line), "logins")
    with pytest.raises(Exception, match="must not be null"):
        rows.collect()


def test_quotes_are_text(spark, tmp_path):
    path = write(tmp_path / "in.csv", '1,"a",success,5', '2,"a,success,5', "3,b,success,5")
    rows = files.event_csv(spark, path, "logins").orderBy("userId").collect()
    assert [r.ip for r in rows] == ['"a"', '"a', "b"]


def test_orders_with_a_transaction(spark):
    rows = spark.createDataFrame([("a",), ("",), (None,)], "txId string")
    assert [r.txId for r in orders.with_transaction(rows).collect()] == ["a"]


def test_no_folder_of_one_machine_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())

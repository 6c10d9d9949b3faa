from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.support import at, rows_of
from tidemark import schemas
from tidemark.functions import choice, local_day, message
from tidemark.sources import parse_access_log, parse_lines, publish, read_access_log, read_events


def write(path, text):
    path.write_text(text)
    return str(path)


def test_delimited_events(spark, tmp_path):
    path = write(tmp_path / "orders.csv", "5,create,,1700000000\n5,pay,a-b,1700000300\n6,create,,1700000007")
    rows = read_events(spark, path, schemas.ORDER).orderBy("ts").collect()
    assert [(r.order_id, r.event_type, r.tx_id, r.ts) for r in rows] == [
        (5, "create", "", at(1700000000)),
        (6, "create", "", at(1700000007)),
        (5, "pay", "a-b", at(1700000300)),
    ]


def test_milliseconds(spark, tmp_path):
    path = write(tmp_path / "m.csv", "u1,CLICK,mail,1700000000123\n")
    assert read_events(spark, path, schemas.MARKETING, unit="ms").first().ts == datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_malformed_event_fails_or_is_kept(spark, tmp_path):
    path = write(tmp_path / "bad.csv", "1,192.0.2.1,success,1700000000\nx,192.0.2.9,fail,1700000090\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_events(spark, path, schemas.LOGIN).collect()
    kept = read_events(spark, path, schemas.LOGIN, quarantine=True).where("_corrupt_record is not null").collect()
    assert [r._corrupt_record for r in kept] == ["x,192.0.2.9,fail,1700000090"]
    lines = spark.read.text(path)
    with pytest.raises(Exception, match="MALFORMED"):
        parse_lines(lines, schemas.LOGIN).collect()
    assert parse_lines(lines, schemas.LOGIN, quarantine=True).where("_corrupt_record is not null").count() == 1


LOG = (
    "192.0.2.44 - - 29/02/2024:08:00:01 +0000 GET /charts/one.svg\n"
    "10.0.0.1 u7 - 7/05/2015:23:59:59 +0000 POST /a?b=c extra\n"
)


def test_access_log(spark, tmp_path):
    rows = rows_of(read_access_log(spark, write(tmp_path / "log", LOG)))
    assert rows == [
        ("10.0.0.1", "u7", datetime(2015, 5, 7, 23, 59, 59), "POST", "/a?b=c"),
        ("192.0.2.44", "-", datetime(2024, 2, 29, 8, 0, 1), "GET", "/charts/one.svg"),
    ]


@pytest.mark.parametrize("line", ["too short", "1.1.1.1 - - 31/02/2015:10:05:03 +0000 GET /x", "1.1.1.1 - - noon +0000 GET /x"])
def test_malformed_log_line_fails_or_is_kept(spark, tmp_path, line):
    path = write(tmp_path / "log", LOG + line + "\n")
    with pytest.raises(Exception):
        read_access_log(spark, path).collect()
    rows = read_access_log(spark, path, quarantine=True)
    assert rows.where("_corrupt_record is null").count() == 2
    assert [r._corrupt_record for r in rows.where("_corrupt_record is not null").collect()] == [line]


def test_publish_and_read_back(spark, tmp_path):
    """A parquet folder stands in for the topic."""
    df = spark.createDataFrame([(1, "create", "", 10), (2, "pay", 'a,"b"', 11)], schemas.ORDER)
    publish(df, "parquet", key="order_id", path=str(tmp_path / "topic"))
    topic = spark.read.parquet(str(tmp_path / "topic"))
    assert {r.key for r in topic.collect()} == {"1", "2"}
    back = parse_lines(topic.select("value"), schemas.ORDER)
    assert rows_of(back) == [(1, "create", "", at(10)), (2, "pay", 'a,"b"', at(11))]


def test_published_text_and_times_come_back(spark, tmp_path):
    rows = [(1, "  padded ", "", at(1700000000)), (2, "\ttab", " x", at(-5))]
    df = spark.createDataFrame(rows, "order_id bigint, event_type string, tx_id string, ts timestamp_ntz")
    publish(df, "parquet", path=str(tmp_path / "s"))
    assert rows_of(parse_lines(spark.read.parquet(str(tmp_path / "s")).select("value"), schemas.ORDER)) == rows
    publish(df, "parquet", unit="ms", path=str(tmp_path / "ms"))
    assert rows_of(parse_lines(spark.read.parquet(str(tmp_path / "ms")).select("value"), schemas.ORDER, unit="ms")) == rows


def test_malformed_log_line_fails_without_ansi(spark, tmp_path):
    path = write(tmp_path / "log", LOG + "too short\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="MALFORMED"):
            read_access_log(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_scalars(spark):
    df = spark.createDataFrame([(1, at(1511710200)), (2, at(1511712000))], "id bigint, ts timestamp_ntz")
    days = [str(r[0]) for r in df.orderBy("id").select(local_day(df, "ts", "8 hours")).collect()]
    assert days == ["2017-11-26", "2017-11-27"]
    picked = df.select(choice("id", ["a", "b"])).collect()
    assert {r[0] for r in picked} <= {"a", "b"} and picked == df.select(choice("id", ["a", "b"])).collect()
    assert df.where("id = 1").select(message("user %d", F.col("id"))).first()[0] == "user 1"


def test_parser_takes_columns_next_to_value(spark):
    df = spark.createDataFrame([("k", LOG.splitlines()[0])], "key string, value string")
    assert parse_access_log(df).columns == ["key", "ip", "user_id", "ts", "method", "url"]

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.functions import scalars as s


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("ms", "day", "hour", "slot"), [(0, 1, 8, 16), (57_599_999, 1, 23, 47), (57_600_000, 2, 0, 0)])
def test_days_begin_at_utc_plus_8(spark, ms, day, hour, slot):
    assert [one(spark, f(F.col("t")), t=ms) for f in (s.day_number, s.hour_of_day, s.half_hour_slot)] == [day, hour, slot]


@pytest.mark.parametrize(("imei", "full"), [("49015420323751", "490154203237518"), ("490154203237518", "490154203237518"), ("ab12", "AB120")])
def test_imei_check_digit(spark, imei, full):
    assert one(spark, s.imei_complete(F.col("i")), i=imei) == full


def test_device_ids(spark):
    assert len(one(spark, s.device_uuid(F.lit("cookie"), F.col("c")), c="0" * 31 + "a")) == 32
    assert one(spark, s.device_uuid(F.lit("cookie"), F.col("c")), c="a=b") == ""
    assert one(spark, s.device_uuid(F.lit("idfa"), F.col("c")), c="00000000-0000-0000-0000-000000000000") == ""
    assert one(spark, s.device_uuid(F.lit("android"), F.col("c")), c=None) == ""


@pytest.mark.parametrize(("ip", "n"), [("1.2.3.4", 16909060), ("256.1.1.1", None), ("1.2.3", None), (None, None)])
def test_ip_number(spark, ip, n):
    assert one(spark, s.ip_number(F.col("i")), i=ip) == n


def test_query_map_keeps_the_last_of_a_key(spark):
    assert one(spark, s.query_map(F.col("u")), u="http://a/b?x=1&y=&x=2&z#f?q=1") == {"y": "", "x": "2"}
    assert one(spark, s.query_map(F.col("u")), u="http://a/b") == {}


@pytest.mark.parametrize(("url", "words"), [("https://www.baidu.com/s?wd=%E4%BD%A0", "你"), ("https://www.google.com/search?q=a", None), ("http://x.example.com/?q=a", None)])
def test_search_keyword(spark, url, words):
    assert one(spark, s.search_keyword(F.col("u")), u=url) == words


@pytest.mark.parametrize(("kind", "rule", "held"), [(1, "b", True), (2, "b", False), (3, "ab", True), (4, "bc", True), (5, "^a.c$", True), (5, "x+", False), (6, "abc", False), (7, "abc", True)])
def test_rules(spark, kind, rule, held):
    assert one(spark, s.rule_holds(F.col("k"), F.col("t"), F.col("r")), k=kind, t="abc", r=rule) is held


def test_decay(spark):
    assert [one(spark, s.decayed(F.lit(60.0), F.col("a")), a=a) for a in (0, 59, 60, -1)] == [60.0, 1.0, 0.0, 0.0]


def test_coordinates_there_and_back(spark):
    lon, lat = s.bd_to_gcj(*s.gcj_to_bd(F.col("x"), F.col("y")))
    assert abs(one(spark, lon, x=116.4, y=39.9) - 116.4) < 1e-5
    assert abs(one(spark, lat, x=116.4, y=39.9) - 39.9) < 1e-5
    assert 0 < one(spark, s.wgs_to_gcj(F.col("x"), F.col("y"))[0], x=116.4, y=39.9) - 116.4 < 0.01


def test_phones_and_texts(spark):
    assert one(spark, s.phones(F.col("t")), t="call 13800138000, not 138001380001 or 12800138000") == ["13800138000"]
    assert one(spark, s.unhex_escapes(F.col("t")), t="a\\xE4\\xBD\\xA0+%") == "a你+%"
    assert one(spark, s.without_wide(F.col("t")), t="a😀") == "a0000"


def test_sql_functions(spark):
    s.register(spark)
    assert spark.sql("SELECT label_decay(60D, 30) a, every_channel() b").first() == (30.0, "all")

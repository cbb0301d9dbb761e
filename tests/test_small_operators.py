"""Operators that no registered query runs, on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.functions import scalars
from trailmark.operators import clean, documents, lookup, probe, profile, recommend, reports, sessions, state
from trailmark.sources import tables


def test_denied_addresses(spark, tmp_path, rows):
    (tmp_path / "deny.txt").write_text("1.1.1.1\n10.0.*\n192.168.\n\n")
    exact, short = tables.denied_addresses(spark, str(tmp_path / "deny.txt"))
    df = spark.createDataFrame([("1.1.1.1",), ("1.1.1.2",), ("10.0.3.4",), ("192.168.9.9",), ("192.16.9.9",)], "ip string")
    assert sorted(rows(lookup.not_denied(df, exact, short))) == [("1.1.1.2",), ("192.16.9.9",)]


def test_brands_need_six_characters(spark, tmp_path, rows):
    (tmp_path / "b.txt").write_text("AABBCC|Acme\nAABB|short\n")
    df = spark.createDataFrame([("aa:bb:cc:01:02:03",), ("00:00:00:00:00:00",)], "mac string")
    assert dict(rows(lookup.brands(df, tables.mac_brands(spark, str(tmp_path / "b.txt"))).select("mac", "brand"))) == {"aa:bb:cc:01:02:03": "Acme", "00:00:00:00:00:00": None}


def test_dimension_order_and_activity(spark, tmp_path, rows):
    spark.createDataFrame([(1, 5, 1), (2, 9, 1), (3, 9, 0)], "id int, weight int, active int").write.parquet(str(tmp_path / "source"))
    assert [r[0] for r in rows(tables.dimension(spark, "source", str(tmp_path)).select("id"))] == [2, 1]


def test_mobile_v2(spark, rows):
    ok = '{"ja_version":"2","app_version":"1","app_packagename":"p","appid":"a","logtype":"50","subtype":"s","pageid":"7","time":"9","userid":"","device_info":{"idfa":"12345678-1234-1234-1234-123456789012"}}'
    lines = [ok, ok.replace('"pageid":"7",', ""), "{", ok.replace("12345678-1234-1234-1234-123456789012", "0")]
    out = clean.mobile_v2(spark.createDataFrame([("i", 5, x) for x in lines], "ip string, time long, json string"))
    assert [r[0] for r in rows(out.select("status"))] == [200, 105, 102, 120]


def test_mini_program(spark, rows):
    body = '{"device_info": {"ja_uuid": "u"}, "app_identifier": "a", "logtype": "50", "subtype": "s", "time": "5", "data": "{}", "pad": "' + "x" * 60 + '"}'
    lines = [f'1.1.1.1 - - ""{body} EOF"', f'1.1.1.1 - - ""{body.replace(chr(34) + "a" + chr(34), chr(34) + "z" + chr(34))} EOF"', '""{"a": 1} EOF"', "junk"]
    out = clean.mini_program(spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame([("a",)], "appid string"))
    assert dict(rows(out.select("value", "status"))) == dict(zip(lines, [200, 104, 101, 101], strict=True))


def test_installed_apps(spark, rows):
    e = spark.createDataFrame([("u", 1, "applist", '[{"pkg":"p","name":"n"},{"pkg":"q","name":""}]'), ("u", 1, "view", "[]"), ("v", 1, "applist", "junk")], "uuid string, time long, subtype string, data string")
    assert rows(clean.installed_apps(e)) == [("u", 1, "p", "n")]


def test_flags_and_funnel_and_users(spark, rows):
    e = spark.createDataFrame([("u", "a"), ("u", "b"), ("v", "b")], "uuid string, subtype string")
    assert dict((u, (x, y)) for u, x, y in rows(profile.flags(e, {"x": F.col("subtype") == "a", "y": F.col("subtype") == "b"}))) == {"u": (1, 1), "v": (0, 1)}
    assert sorted(rows(recommend.users_by(e, F.col("subtype")))) == [("a", 1), ("b", 2)]


def test_probe_minutes_and_lists(spark, rows):
    r = spark.createDataFrame([(1, "v", "m", 0, "b"), (2, "v", "m", 59_999, "b"), (3, "v", "m", 60_000, "b")], "event_id long, venue string, mac string, time long, brand string")
    assert sorted(r[0] for r in rows(probe.per_minute(r).select("time"))) == [59_999, 60_000]
    assert rows(probe.mac_list(r)) == [("v", "m", 60_000, "b")]
    old = spark.createDataFrame([("v", "m", -5)], "venue string, mac string, first_time long")
    assert rows(probe.first_seen(r, old)) == [("v", "m", -5)]


def test_device_documents_and_newest(spark, rows):
    ids = state.device_ids(spark.createDataFrame([("u", 5, "x", None), ("u", 3, "x", "p")], "uuid string, time long, a string, b string"), {"a": F.col("a"), "b": F.col("b")})
    assert sorted(rows(ids)) == [("u", "a", "x", 3), ("u", "b", "p", 3)]
    doc = state.device_documents(spark.createDataFrame([("u",), ("w",)], "uuid string"), ids)
    assert dict(rows(doc.select("uuid", "ids"))) == {"u": {"a": ["x"], "b": ["p"]}, "w": None}
    t = spark.createDataFrame([("u", i, i * 10) for i in range(5)], "uuid string, event_id long, time long")
    assert [r[0] for r in rows(state.newest(t, spark.createDataFrame([("u",)], "uuid string"), 10, 30, 2).orderBy("rank").select("time"))] == [30, 20]


def test_visits_without_pages_and_their_documents(spark, rows):
    e = spark.createDataFrame([(1, "u", "a", 5, "40", "x", 9, 0, 1, "1.1.1.1", "c")], "event_id long, uuid string, appid string, time long, logtype string, subtype string, pageid long, staytime long, visitindex int, ip string, channel string")
    v = sessions.visits(e)
    assert rows(sessions.visit_summary(v).select("n_pages", "n_events", "entry")) == [(0, 1, None)]
    assert rows(documents.visit_features(v, [1]).select("pages", "first_visit")) == [(0, 5)]
    assert documents.visit_ips(v).count() == 1
    ranges = spark.createDataFrame([(0, 1 << 31, "C", "P", "Q", "R")], "start_ip long, end_ip long, country string, province string, city string, area string")
    assert '"country":"C"' in documents.visit_documents(v, ranges).first()["doc"]


def test_quality_counts_lines(spark, rows):
    q = reports.quality(spark.createDataFrame([(200,), (200,), (105,)], "status int")).first()
    assert (q["total"], q["errors"], q["ok"], q["statuses"]) == (3, 1, 2, '{"105":1,"200":2}')


def test_documents_are_json_lines(spark, tmp_path):
    tables.write_documents(spark.createDataFrame([(1, [2])], "a int, b array<int>"), str(tmp_path / "d"))
    assert tables.lines(spark, str(tmp_path / "d")).first()[0] == '{"a":1,"b":[2]}'
    tables.log_run(spark, str(tmp_path / "log"), "job", 5, 9)
    assert spark.read.json(str(tmp_path / "log")).first()["took_ms"] == 4


def test_time_guards(spark, rows):
    day = 86_400_000
    t = spark.createDataFrame([(0,), (day - 28_800_000,), (day,)], "t long")
    assert [r[0] for r in rows(t.select(scalars.today_and_not_later(F.col("t"), F.lit(day))))] == [False, True, True]
    assert [r[0] for r in rows(t.select(scalars.within_day(F.col("t"), F.lit(0))))] == [True, True, False]
    assert [r[0] for r in rows(t.select(scalars.same_day(F.col("t"), F.lit(0))))] == [True, False, False]


def test_kafka_source_options():
    """The stream starts at the latest offsets and takes so many at a time; there is no broker to read from here."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            raise ConnectionError

    for most, want in ((None, {}), (500, {"maxOffsetsPerTrigger": "500"})):
        seen.clear()
        with pytest.raises(ConnectionError):
            tables.kafka(type("Session", (), {"readStream": Reader()})(), "a:9092,b:9092", "web,app", most)
        assert seen == {"format": "kafka", "kafka.bootstrap.servers": "a:9092,b:9092", "subscribe": "web,app", "startingOffsets": "latest", **want}


def test_bytes_are_xored_several_at_once(spark):
    from pyspark.sql import functions as F

    from trailmark.operators import clean

    texts = [bytes((7 * i + n) % 256 for i in range(n)) for n in range(40)]
    df = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(texts)], "i int, b binary")
    for key in ("k", "sécret", "0123456789abc"):
        made = clean.xored(F.hex("b"), key)
        got = {r["i"]: bytes(r["x"]) for r in df.select("i", made.alias("x")).collect()}
        k = key.encode()
        assert got == {i: bytes(c ^ k[j % len(k)] for j, c in enumerate(x)) for i, x in enumerate(texts)}
    # One XOR for several bytes: one key number for each byte of the key, of so many bytes.
    assert clean.XORED > 1

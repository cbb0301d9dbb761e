"""Streams: typed state over several batches, tables of buckets, refreshed dimensions; the queries' results are in test_registry."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trailmark.plans import streams
from trailmark.streaming import flows, processors, tables

DIR = "/root/testdata/sf0.001"
M = 60_000
SCHEMA = "event_id long, uuid string, appid string, time long, logtype string, subtype string"


def batches(spark, tmp_path, parts, schema=SCHEMA):
    """A stream of one batch for each part; ts follows time."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/part{i}"))
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    return raw.withColumn("ts", F.timestamp_millis("time"))


def end(t):
    return [(0, "", "", t, "", "")]


def test_sessions_of_the_stream_match_the_batch(spark):
    e = streams.event_batch(spark, DIR)
    got = streams.stream_sessions(spark, DIR)
    assert got.agg(F.sum("n")).first()[0] == e.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flows.sessions(e).collect()))


@pytest.mark.parametrize("cut", [(3, 6), (1, 2, 8), ()])
def test_rolling_counts_do_not_depend_on_batches(spark, tmp_path, rows, cut):
    base = 10_000 * M
    e = [(i, f"u{i % 3}", "a", base + t, "50" if i % 2 else "40", "x") for i, t in enumerate([0, 1, 2 * M, 3 * M, 3 * M, 7 * M, 4 * M, 9 * M, 30 * M])]
    at = [0, *cut, len(e)]
    stream = batches(spark, tmp_path, [*[e[i:j] for i, j in zip(at, at[1:], strict=False)], end(base + 500 * M)])
    changes = flows.run_to_end(processors.rolling(stream, "appid", {"uv": "uuid"}, 5 * M, M, F.col("logtype") == "50"), str(tmp_path / "o"), typed=True)
    got = {r["end"]: (r["n"], r["uv"]) for r in processors.totals(changes.where("key <> ''"), ["uv"]).collect()}
    steps = [(-(-t // M) * M, u, k) for _, u, _, t, k, _ in e]
    ends = {s for s, _, _ in steps} | {s + 5 * M for s, _, _ in steps}
    assert got == {x: (sum(k == "50" for s, _, k in steps if x - 5 * M < s <= x), len({u for s, u, _ in steps if x - 5 * M < s <= x})) for x in ends}


def test_presence_over_batches(spark, tmp_path, rows):
    s, base = 10 * M, 1_000 * M
    reads = [[(1, base + 1, "v", "m"), (1, base + 2, "v", "n")], [(1, base + s + 5, "v", "m")], [(1, base + 4 * s, "v", "m"), (1, base + 500 * M, "", "")]]
    stream = batches(spark, tmp_path, reads, "event_id long, time long, venue string, mac string")
    got = flows.run_to_end(processors.presence(stream, s), str(tmp_path / "o"), typed=True)
    assert sorted(rows(got.select("mac", "end", "entered", "time"))) == sorted([("m", base + s, 1, base + 1), ("n", base + s, 1, base + 2), ("n", base + 2 * s, -1, base + 2), ("m", base + 3 * s, -1, base + 1), ("m", base + 4 * s, 1, base + 4 * s), ("m", base + 5 * s, -1, base + 4 * s)])
    assert sorted(rows(processors.online(got))) == sorted([("v", base + s, 2, 0, 2), ("v", base + 2 * s, 0, 1, 1), ("v", base + 3 * s, 0, 1, 0), ("v", base + 4 * s, 1, 0, 1), ("v", base + 5 * s, 0, 1, 0)])


def test_rolling_steps_and_presence_are_told_once(spark, tmp_path, rows):
    """Rows of one id and step are one row of state and output, and a device that has many steps is called once when all have passed."""
    base, s = 10_000 * M, 10 * M
    e = [(i, f"u{i % 2}", "a", base + (i % 4) * M, "50", "x") for i in range(400)]
    steps = flows.run_to_end(processors.rolling(batches(spark, tmp_path / "r", [e, end(base + 500 * M)]), "appid", {"uv": "uuid"}, 5 * M, M), str(tmp_path / "ro"), typed=True)
    assert sorted(rows(steps.where("key <> ''").select("id", "end", "n"))) == [(f"u{i % 2}", base + i * M, 100) for i in (0, 2, 1, 3)]
    assert processors.totals(steps.where("key <> ''"), ["uv"]).where(F.col("end") == base + 3 * M).select("n", "uv").first() == (400, 2)
    device = processors.Presence(s)
    calls, waiting, stay = [], [], []

    class State:
        def __init__(self, of):
            self.of = of

        exists = lambda self: bool(self.of)
        clear = lambda self: self.of.clear()
        get = lambda self: list(self.of) if self.of is waiting else self.of[0]

        def put(self, rows):
            self.of[:] = rows

        def update(self, row):
            self.of[:] = [row]

    device.waiting, device.stay, device.call_after = State(waiting), State(stay), lambda *p: calls.extend(p)
    list(device.handleInputRows(("v", "m"), iter([pd.DataFrame({"end": [s * i for i in range(1, 51)] + [s * 60], "time": [s * i for i in range(1, 51)] + [s * 60]})]), None))
    assert calls == [s]
    assert device.passed(("v", "m"), s, 55 * s) == [("v", "m", s, 1, s), ("v", "m", 51 * s, -1, s)] and calls == [s, 60 * s]
    assert device.passed(("v", "m"), 60 * s, 60 * s + 1) == [("v", "m", 60 * s, 1, 60 * s)] and calls[-1] == 61 * s
    assert device.passed(("v", "m"), 61 * s, 99 * s) == [("v", "m", 61 * s, -1, 60 * s)] and not waiting and not stay


def test_visits_time_pages_when_they_open_or_close(spark, tmp_path, rows):
    at = 1_000 * M  # a watermark begins at 0
    row = lambda i, app, t, kind: (i, "u", app, at + t, kind, "")
    e = [row(1, "open", 0, "50"), row(2, "open", 2 * M, "50"), row(3, "open", 20 * M, "40"), row(4, "close", 0, "10"), row(5, "close", M, "50"), row(6, "close", 4 * M, "50")]
    late = [row(7, "open", 21 * M, "50"), row(8, "open", 22 * M, "50")]
    out = flows.run_to_end(processors.visits(batches(spark, tmp_path, [e, late, end(at + 900 * M)]), F.col("appid") == "close"), str(tmp_path / "o"), typed=True)
    done = out.where("appid <> '' and not changed").select("appid", "visit", "start", "end", "pages", "stay")
    # The last visit of a user ends it; its first one was given in the first batch.
    assert sorted(rows(done)) == [("close", 1, at, at + 4 * M, 2, 4 * M), ("open", 2, at + 20 * M, at + 22 * M, 2, M)]
    assert rows(out.where("appid = 'open' and visit = 1 and changed").select("pages", "stay")) == [(2, 2 * M)]


def test_idle_users_are_pushed_once_on_their_first_day(spark, tmp_path, rows):
    noon, day = 4 * 3_600_000, 86_400_000  # 12:00 in UTC+8
    e = [(1, "u", "a", noon, "50", "view"), (2, "u", "a", noon + 11 * M, "50", "view"), (3, "u", "a", noon + 30 * M, "50", "view"), (4, "v", "a", noon, "40", "purchase"), (5, "w", "a", noon + 600 * M, "50", "view"), (6, "old", "a", noon, "50", "view")]
    seen = spark.createDataFrame([("a", "u", noon), ("a", "v", noon), ("a", "w", noon), ("a", "old", noon - day), ("", "", 0)], "appid string, uuid string, first_time long")
    for name, parts in (("one", [e]), ("two", [e[:1], e[1:]])):
        stream = batches(spark, tmp_path / name, [*parts, end(noon + 5 * day)])
        out = flows.run_to_end(processors.idle(stream, seen, F.col("subtype") == "purchase"), str(tmp_path / name / "o"), typed=True)
        assert sorted(rows(out.where("appid <> ''").select("uuid", "pages", "last_time"))) == [("u", 1, noon)]


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path, rows):
    kept = tables.Keyed(str(tmp_path / "t"), ["k"], {"n": F.sum("n")}, buckets=8)
    batch = lambda *ks: spark.createDataFrame([(k, 1) for k in ks], "k string, n long")
    current = lambda: dict(rows(kept.current(spark, "k string, n long")))
    assert current() == {}
    every = [f"k{i}" for i in range(50)]
    kept.put(batch(*every), 0)
    before = files(tmp_path / "t/data/batch=0")
    for _ in range(2):  # a batch that runs again gives the same table
        kept.put(batch("k3", "k3", None), 1)
        assert current() == {**dict.fromkeys(every, 1), "k3": 3, None: 1}
    assert files(tmp_path / "t/data/batch=0") == before
    assert len(list((tmp_path / "t/data/batch=1").glob("bucket=*"))) <= 2
    for i in range(2, 9):
        kept.put(batch(*every), i)
    assert current() == {**dict.fromkeys(every, 8), "k3": 10, None: 1}
    # Only the files of the newest batches, and those that they still name, are left.
    assert len(list((tmp_path / "t/manifest").glob("batch=*"))) == 1 + tables.KEPT
    assert sum(1 for _ in (tmp_path / "t/data").glob("batch=*/bucket=*")) <= 8 * (1 + tables.KEPT) + 1
    kept.put(batch(), 9)
    assert current() == {**dict.fromkeys(every, 8), "k3": 10, None: 1}


def test_a_dimension_is_loaded_again_when_it_is_old(spark, tmp_path):
    loads = []

    def load(spark, now):
        loads.append(now)
        return spark.createDataFrame([(now,)], "v long")

    dim = tables.Refreshing(str(tmp_path / "d"), load, 100)
    read = lambda batch, now: tuple(dim.at(spark, batch, now).first())
    assert [read(0, 1000), read(1, 1050), read(2, 1100), read(3, 1150)] == [(1000, 0), (1000, 0), (1100, 2), (1100, 2)]
    assert [read(2, 5000), read(1, 5000)][0] == (1100, 2)  # a batch that runs again
    for i in range(4, 12):
        read(i, 2000 + 100 * i)
    assert len(list((tmp_path / "d/rows").glob("version=*"))) <= 2 + tables.KEPT
    assert loads[:2] == [1000, 1100]


def test_a_piece_is_one_batch_of_many_files(spark, tmp_path, monkeypatch):
    many, seen = streams.event_batch(spark, DIR).repartition(3), []
    monkeypatch.setattr(streams, "event_batch", lambda *_: many)

    def put(batch, batch_id):
        files_ = batch.select(F.input_file_name().alias("f")).distinct().count()
        seen.append((batch_id, [r[0] for r in batch.select("piece").distinct().collect()], files_, batch.count()))

    streams.fed_by_pieces(spark, DIR, lambda e: e, put, str(tmp_path / "c"))
    assert [s[:3] for s in seen] == [(i, [i], 3) for i in range(streams.PIECES)]
    assert sum(s[3] for s in seen) == many.count()

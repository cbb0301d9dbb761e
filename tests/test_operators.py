from __future__ import annotations

import base64

from pyspark.sql import functions as F

from trailmark.operators import clean, documents, lookup, places, probe, profile, recommend, sessions, state
from trailmark.sources import tables
from trailmark.streaming import flows

M = 60_000


def events(spark, *rows):
    """(uuid, time in minutes, logtype, subtype, pageid)"""
    return spark.createDataFrame([(i, u, "1200", int(t * M), k, s, p) for i, (u, t, k, s, p) in enumerate(rows)], "event_id long, uuid string, appid string, time long, logtype string, subtype string, pageid long")


def test_web_visit_starts_after_a_long_page(spark, rows):
    e = events(spark, ("u", 0, "50", "p", 1), ("u", 9.99, "50", "p", 2), ("u", 19.99, "40", "e", 0), ("u", 20, "50", "p", 3))
    out = sessions.web_visit_index(sessions.web_stay(e)).orderBy("event_id").select("staytime", "visitindex")
    assert rows(out) == [(int(9.99 * M), 1), (0, 1), (0, 2), (0, 2)]


def test_open_page_is_closed_by_background(spark, rows):
    e = events(spark, ("u", 0, "40", "enter_background", 0), ("u", 1, "50", "p", 1), ("u", 2, "40", "e", 0), ("u", 3, "40", "enter_background", 0), ("u", 4, "40", "e", 0), ("u", 5, "50", "p", 2))
    out = sessions.app_stay_on_open(e).orderBy("event_id").select("staytime", "recent_page")
    assert rows(out) == [(0, None), (2 * M, None), (0, 1), (0, 1), (0, None), (0, None)]


def test_page_logged_on_close(spark, rows):
    e = events(spark, ("u", 0, "40", "enter_foreground", 0), ("u", 2, "50", "p", 1), ("u", 3, "40", "e", 0), ("u", 5, "50", "p", 2))
    out = sessions.app_stay_on_close(e).orderBy("event_id").select("time", "staytime", "recent_page")
    assert rows(out) == [(0, 0, 1), (0, 2 * M, None), (3 * M, 0, 2), (2 * M, 3 * M, 1)]


def test_app_visit_switch_waits_for_a_page(spark, rows):
    e = events(spark, ("u", 0, "50", "p", 1), ("u", 15, "40", "e", 0), ("u", 16, "40", "e", 0), ("u", 17, "50", "p", 2), ("u", 18, "50", "p", 3), ("v", 1, "50", "p", 1)).withColumn("staytime", F.lit(0).cast("long"))
    assert [r[0] for r in rows(sessions.app_visit_index(e).orderBy("event_id").select("visitindex"))] == [1, 1, 1, 2, 2, 1]
    assert [r[0] for r in rows(sessions.app_visit_index(e, gap_rule=False).orderBy("event_id").select("visitindex"))] == [1] * 6


def test_sessions_split_at_longer_gaps_only(spark, rows):
    r = spark.createDataFrame([("v", "m", t) for t in (0, 7_200_000, 14_400_001, 14_460_001)], "venue string, mac string, time long")
    assert rows(probe.visits(r).orderBy("start").select("start", "end", "n")) == [(0, 7_200_000, 2), (14_400_001, 14_460_001, 2)]


def test_probe_devices(spark, rows):
    r = spark.createDataFrame([(i, "v", m, t) for i, (m, t) in enumerate([("a", 0), ("a", 30_000), ("b", 0), ("b", 30_000), ("b", 61_000), ("c", 0), ("c", 1), ("c", 60_000)])], "event_id long, venue string, mac string, time long")
    assert {m for (m,) in rows(probe.real_devices(r).select("mac"))} == {"b"}


def test_thinning_measures_from_the_last_kept(spark, rows):
    p = spark.createDataFrame([("u", i, i, x, 0.0) for i, x in enumerate([0.0, 0.0008, 0.0010, 0.0018, 0.0020])], "uuid string, event_id long, time long, lon double, lat double")
    assert [r[0] for r in rows(places.thinned(p).orderBy("time").select("lon"))] == [0.0, 0.0010, 0.0020]


def test_clusters_and_labels(spark, rows):
    day, hour = 86_400_000, 3_600_000
    at = [(d * day + 14 * hour, 0.0) for d in range(3)] + [(d * day + 2 * hour, 1.0) for d in range(2)] + [(5 * day + 2 * hour, 2.0)]
    p = spark.createDataFrame([("u", i, t, x, 0.0) for i, (t, x) in enumerate(at)], "uuid string, event_id long, time long, lon double, lat double")
    c = places.clusters(p)
    hours = spark.createDataFrame([(22, 1.0)], "hour int, night double")
    calendar = spark.createDataFrame([(d, d == 6) for d in range(1, 9)], "day_num long, day_off boolean")
    assert rows(places.place_labels(c, hours, calendar).orderBy("lon").select("lon", "label", "n")) == [(0.0, "home", 3), (1.0, "work", 2), (2.0, "travel", 1)]


def test_ip_area_of_boundaries_and_unknown(spark, rows):
    ends = spark.createDataFrame([(16777215, "A"), (16909060, "B")], "end_ip long, country string").select("*", *[F.lit("x").alias(c) for c in ("province", "city", "area")])
    asked = spark.createDataFrame([("0.255.255.255",), ("1.0.0.0",), ("1.2.3.4",), ("1.2.3.5",), (None,), ("bad",)], "ip string")
    out = dict(rows(lookup.ip_area(asked, lookup.ranges_from_ends(ends)).select("ip", "country")))
    assert out == {"0.255.255.255": "A", "1.0.0.0": "B", "1.2.3.4": "B", "1.2.3.5": "--", None: "--", "bad": "--"}


def test_keywords_in_gbk(spark, rows):
    urls = ["http://www.sogou.com/web?query=%C4%E3", "https://www.baidu.com/s?wd=%E4%BD%A0", "https://www.google.com/search?q=a", None]
    out = lookup.keywords(spark.createDataFrame([(u,) for u in urls], "url string"), "url")
    assert dict(rows(out)) == dict(zip(urls, ["你", "你", None, None], strict=True))


def test_items_by_regex_and_path(spark, rows):
    rules = spark.createDataFrame([(1, 1, "photo", "p", 5, "a", 7, 1, "id-([0-9]+)"), (2, 1, "o", "q", 9, "a", 8, 2, "$.item")], "id int, rType int, rules string, name string, weight int, appid string, item_type int, data_type int, data_rule string")
    e = spark.createDataFrame([(1, "a", "photo", '{"item": "x"}'), (2, "a", "phot", "id-5"), (3, "b", "photo", "id-5")], "event_id int, appid string, subtype string, data string")
    assert rows(lookup.items(e, rules, "subtype", "data", ["appid"], ["event_id"]).select("event_id", "item_type", "item_id")) == [(1, 8, "x")]


def test_prefix_anti_join(spark, rows):
    df = spark.createDataFrame([("a#1",), ("b",), ("c#2",), ("c#3",)], "id string")
    assert rows(lookup.not_listed(df, spark.createDataFrame([("a",), ("b",), ("c#2",)], "k string"), "id")) == [("c#3",)]


def test_mobile_envelope_and_payload(spark, rows):
    key, text = "made-up", '{"a": "你"}'
    raw = bytes(b ^ key.encode()[i % len(key)] for i, b in enumerate(text.encode()))
    line = f'1.2.3.4 - - [01/Jan/2024:08:00:00 +0800] [1704067200.5] "POST data=TGR{base64.b64encode(raw).decode()} HTTP"'
    out = clean.envelope(spark.createDataFrame([(line,), ("junk",)], "value string")).select("ip", "time", clean.payload(F.col("body"), key))
    assert rows(out) == [("1.2.3.4", 1704067200005, text), ("", None, None)]


def test_mobile_v1_explodes_and_checks(spark, rows):
    j = '{"common": {"app_id": "a", "device_uuid": "12345678-1234-1234-1234-123456789012"}, "events": [{"time": 100, "type": "10", "sub_type": "1"}, {"time": 900, "type": "50", "sub_type": "1", "open_time": 100, "id": "p"}, {"time": 900000, "type": "50", "sub_type": "1", "open_time": 100}]}'
    out = clean.mobile_v1(spark.createDataFrame([("i", 5, j), ("i", 5, "{")], "ip string, time long, json string"))
    assert sorted(rows(out.select("status", "subtype", "time", "staytime")), key=str) == sorted([(200, "enter_foreground", 100, 0), (200, "page", 100, 800), (121 + 283, None, 900000, 0), (102, None, None, 0)], key=str)


def test_probe_lines(spark, rows):
    probes = spark.createDataFrame([("p", "1", "u", 9)], "probeId string, id string, uuid string, venueId int")
    lines = ["p|m|-50|f|2024-01-01 00:00:00", "p|m|000|f|2024-01-01 00:00:00", "q|m|-50|f|2024-01-01 00:00:00", "p|m|-90|f|2024-01-01 00:00:00", "p|m"]
    out = clean.probe(spark.createDataFrame([(x,) for x in lines], "value string"), probes, 80)
    assert dict(rows(out.select("value", "status"))) == dict(zip(lines, [200, 121, 404, 121, 105], strict=True))


def test_odd_ids_go_around_the_cleaner(spark, rows):
    e = spark.createDataFrame([("x" * 32, 1), ("x" * 31, 1), (None, 1)], "uuid string, n int")
    assert sorted(n for (n,) in rows(clean.with_odd_ids(e, lambda d: d.withColumn("n", F.lit(2))).select("n"))) == [1, 1, 2]


def test_state_tables(spark, rows):
    old = spark.createDataFrame([("a", 5), ("b", 7)], "k string, t long")
    new = spark.createDataFrame([("a", 3), ("c", 1)], "k string, t long")
    assert sorted(rows(state.merged(old, new, ["k"], {"t": F.min("t")}))) == [("a", 3), ("b", 7), ("c", 1)]
    assert sorted(rows(state.replaced(old, new, ["k"]))) == [("a", 3), ("b", 7), ("c", 1)]
    assert sorted(rows(state.added(old, new, ["k"]))) == [("a", 5), ("b", 7), ("c", 1)]
    assert state.gated(old, 3) is None and state.gated(old, 2) is old


def test_identity_learns_missing_edges(spark, rows):
    asked = spark.createDataFrame([("i1", "s1"), ("i2", "s1"), ("", "s1")], "imei string, system_id string")
    out, learned = state.resolved(asked, spark.createDataFrame([("i1", "u1")], "imei string, uuid string"), spark.createDataFrame([("s1", "u9")], "system_id string, uuid string"))
    assert sorted(rows(out.select("imei", "uuid"))) == [("", "u9"), ("i1", "u1"), ("i2", "u9")]
    assert rows(learned) == [("i2", "u9")]


def test_potential_bands(spark, rows):
    f = spark.createDataFrame([(7, 0, 0, 0.0, 0, 0), (8, 154, 0, 0.0, 1, 4), (8, 154, 0, 0.0, 0, 4), (32, 154, 0, 0.0, 1, 5), (92, 173, 0, 0.0, 1, 5), (93, 999, 99, 9.0, 1, 9), (-1, 0, 0, 0.0, 0, 0)], "tenure int, pages int, special int, stay double, actions int, days int")
    assert [r[0] for r in rows(profile.potential(f).select("potential"))] == [1, 1, 0, 0, 1, 0, 1]


def test_label_ages(spark, rows):
    d = spark.createDataFrame([("u", 1, day, "x", 1, 0, 1.0, 0.0) for day in (100, 41, 40)], "uuid string, company_id int, day long, name string, times long, stay long, weight double, base_weight double")
    ((value,),) = rows(profile.label_sum(d, 100).select("value"))
    assert abs(value - 0.7 * (1 + 1 / 60)) < 1e-9


def test_labels_are_added_day_by_day(spark, rows):
    days = [(day, times, stay) for day, times, stay in zip(range(41, 101), [1, 7, 3, 12, 5] * 12, [1234, 77_771, 13, 600_000] * 15, strict=True)]
    want = 0.0
    for day, times, stay in days:
        want += (times * 0.7 + stay / 20000.0 * 0.3) * 1.5 * (60 - (100 - day)) / 60.0
    for order in (days, days[::-1], days[::2] + days[1::2]):
        d = spark.createDataFrame([("u", 1, day, "x", times, stay, 1.0, 0.5) for day, times, stay in order], "uuid string, company_id int, day long, name string, times long, stay long, weight double, base_weight double")
        assert rows(profile.label_sum(d.coalesce(1), 100).select("value")) == [(want,)]  # to the last bit


def test_search_and_pages(spark):
    t = spark.createDataFrame([(i, f"n{i}", ["a", "b"][: i % 3]) for i in range(10)], "id int, name string, tags array<string>")
    assert profile.search(t, id__min=2, id__max=8, tags__holds="a", name__has="n", id__any=None).count() == 5
    assert profile.search(t, tags__all=["a", "b"]).count() == 3
    page, hits, pages = profile.paged(t, [F.col("id").desc()], 1, 4)
    assert ([r["id"] for r in page.collect()], hits, pages) == ([5, 4, 3, 2], 10, 3)


def test_documents_and_shapes(spark, rows):
    labels = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 3.0)], "uuid string, name string, value double")
    assert rows(profile.label_documents(labels)) == [("u", '{"tags":[{"tag":"b","weight":3.0},{"tag":"a","weight":1.0}]}')]
    p = spark.createDataFrame([({"a": 1.0, "b": 2.0}, -0.5)], "tags map<string,double>, sex double")
    assert rows(profile.shaped(p, "tags", "sex").select("tag_keys", "sex_code")) == [(["b", "a"], 1)]
    answers = spark.createDataFrame([("u", '{"q1": "7", "q2": "9"}')], "uuid string, answers string")
    assert rows(profile.guide_labels(answers, spark.createDataFrame([("7", "sofa")], "attribute string, name string"))) == [("u", "sofa", 5.0)]


def test_similarity_of_single_item_users(spark, rows):
    r = spark.createDataFrame([(1, 1, 5.0), (2, 1, 1.0), (2, 2, 3.0)], "user int, item int, score double")
    assert rows(recommend.cosine(r, least=-1.0)) == [(1, 2, -1.0)]
    assert rows(recommend.pearson(r)) == [(1, 2, 1, 0.0)]


def test_fan_out(spark, rows):
    t = spark.createDataFrame([(1, 9), (2, 9)], "user int, item int")
    assert rows(recommend.fanned_out(t, spark.createDataFrame([(1, 86), (2, 85)], "user int, day long"), 100)) == [(1, 9)]


def test_clean_files_round_trip(spark, tmp_path, rows):
    line = ["1", "app", "u" * 32, "", "50", "p", "", "http://a", "100", "t", "", "5", "1", "1.1.1.1", "1", '{"sw":"1"}']
    df = tables.web_events(spark.createDataFrame([("\t".join(line),), ("broken",), ("\t".join([*line[:8], "x", *line[9:]]),)], "value string"))
    assert df.count() == 1
    tables.write_clean(df, str(tmp_path / "out"), tables.WEB)
    again = tables.web_events(tables.lines(spark, str(tmp_path / "out")), people_only=True)
    assert rows(again.select("appid", "time", "device")) == [("app", 100, {"sw": "1"})]


def test_tagged_paths_and_days(spark, tmp_path):
    for k in "ab":
        spark.range(2).write.parquet(str(tmp_path / k))
    load = lambda s, p: s.read.parquet(p)
    assert tables.tagged(spark, f"x,{tmp_path}/a|y,{tmp_path}/b", {"x": load, "y": load}).count() == 4
    t = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05")], "id int, day string").withColumn("day", F.col("day").cast("date"))
    tables.write_day(t, str(tmp_path / "d"), "day")
    tables.write_day(t.where("id = 2").withColumn("id", F.lit(3)), str(tmp_path / "d"), "day")
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [1, 3]
    assert tables.days(spark, str(tmp_path / "d"), "2024-01-05", 4).count() == 1


def test_score_files_drop_broken_lines(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("u\t1\t2\t0.5\nbroken\tx\ty\tz\n")
    assert tables.scores(spark, str(tmp_path / "s.tsv")).count() == 1


def stream_of(spark, tmp_path, batches, schema):
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")).withColumn("ts", F.timestamp_millis("time"))


SCHEMA = "event_id long, uuid string, appid string, time long, logtype string, subtype string"


def test_stream_sessions_match_batch(spark, tmp_path, rows):
    e = [(i, f"u{i % 3}", "a", i * i * 20_000, "50", "view") for i in range(60)] + [(99, "z", "a", 500_000_000, "50", "view")]
    out = flows.run_to_end(flows.sessions(stream_of(spark, tmp_path, [e], SCHEMA)), str(tmp_path / "o"))
    twin = sessions.gap_sessions(spark.createDataFrame(e[:-1], SCHEMA), "uuid", gap_ms=600_000 - 1)
    assert sorted(rows(out.select("uuid", "start", "end", "n"))) == sorted(rows(twin.select("uuid", "start", "end", "n")))


def test_label_increments_and_words(spark, rows):
    b = spark.createDataFrame([(1, "u", 0, "50", 1, "x"), (2, "u", 20_000, "40", 1, None)], "event_id long, uuid string, time long, logtype string, company_id int, label string")
    assert [round(v, 6) for (v,) in rows(flows.label_increments(b).select("value"))] == [1.0]
    assert sorted(rows(flows.words(spark.createDataFrame([("a b a",), ("",)], "value string")))) == [("a", 2), ("b", 1)]


def test_maps_and_histories(spark, rows):
    m = spark.createDataFrame([({"a": 1, "b": 3, "c": 3}, {"a": 9, "z": 0})], "x map<string,int>, y map<string,int>")
    r = m.select(documents.top_entries(F.col("x"), 2).alias("t"), documents.preferred(F.col("x"), F.col("y"), True).alias("n"), documents.preferred(F.col("x"), F.col("y"), False).alias("o"), documents.kept_entries(F.col("x"), 3).alias("k")).first()
    assert [tuple(e) for e in r["t"]] == [("b", 3), ("c", 3)]
    assert (r["n"]["a"], r["o"]["a"], r["n"]["z"], r["k"]) == (9, 1, 0, {"b": 3, "c": 3})
    log = spark.createDataFrame([("u", 1, ["a", "b"], []), ("u", 2, ["c"], ["a"])], "uuid string, time long, added array<string>, removed array<string>")
    r = documents.app_history(log).first()
    assert [c["time"] for c in r["log"]] == [2, 1] and r["apps"] == ["b", "c"]


def test_eqids_and_costs(spark, rows):
    v = spark.createDataFrame([("https://www.baidu.com/link?eqid=e1",), ("https://www.baidu.com/link?eqid=e2",)], "ref string")
    out = documents.browse_log(v, [(1, "baidu", "baidu")], spark.createDataFrame([("e1", "sofa")], "eqid string, keyword string"))
    assert sorted(rows(out.select("source", "keyword"))) == [("baidu", "e2"), ("baidu", "sofa")]
    lines = spark.createDataFrame([('{"day": "2024-01-02", "keyword": "sofa", "cost": 1.5}',), ("junk",)], "value string")
    assert rows(documents.keyword_costs(lines).select("keyword", "cost")) == [("sofa", 1.5)]

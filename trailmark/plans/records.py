"""Queries of cleaners, ids, sources and sinks, state tables and small operators, over lines and tables that Spark derives from events.

Lines are written in the shapes of the logs, some of them broken in a known way; what is written to the shared folder is read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import scalars
from trailmark.operators import clean, documents, lookup, probe, profile, recommend, reports, sessions, state
from trailmark.plans.adapt import DAY, EV, events, table
from trailmark.plans.people import TODAY, label_days, readings
from trailmark.plans.streams import event_stream, folder
from trailmark.plans.traffic import visited
from trailmark.sources import tables
from trailmark.streaming import flows
from trailmark.streaming.tables import Keyed

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _path(spark, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def _at() -> Column:
    """The number of an event, by which lines are broken."""
    return F.col("event_id")


def _text(c: Column) -> Column:
    return c.cast("string")


# --- cleaners ----------------------------------------------------------------------------------------------------------

KEY = "a key that repeats"


def _hidden(json: Column) -> Column:
    """A payload as apps send it: XORed with the key, base64, a marker in front."""
    return F.concat(F.lit("TGR"), F.regexp_replace(F.base64(clean.xored(F.hex(F.encode(json, "UTF-8")), KEY)), r"\s", ""))


def _mobile_lines(spark, sf_dir, json: Column) -> DataFrame:
    """Mobile lines of events: address, a time with milliseconds or the server's, and a payload; each 41st has no marker."""
    second = F.floor(F.col("time") / 1000)
    exact = F.concat(_text(second), F.lit("."), F.lpad(_text(F.col("time") % 1000), 3, "0"))
    server = F.date_format(F.timestamp_seconds(second), "dd/MMM/yyyy:HH:mm:ss")
    at = F.when(_at() % 2 == 0, exact).otherwise(F.concat(server, F.lit(" +0000")))
    data = F.when(_at() % 41 == 0, F.lit("nothing")).otherwise(_hidden(json))
    return events(spark, sf_dir).select(F.concat(F.col("ip"), F.lit(" - - ["), at, F.lit('] "GET /l?data='), data, F.lit(' HTTP/1.1" 200')).alias("value"))




def _idfa() -> Column:
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("user_id").cast("string"), 12, "0"))


IDFA_SQL = "'00000000-0000-4000-8000-' || lpad(CAST(user_id AS VARCHAR), 12, '0')"
SENT_SQL = "CASE WHEN event_id % 2 = 0 THEN time ELSE time // 1000 * 1000 END"


@query("mobile_envelope", f"WITH {EV} SELECT ip, CAST({SENT_SQL} AS BIGINT) AS time, CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'é' || event_id || '}}' END AS json FROM ev")
def mobile_envelope(spark, sf_dir):
    lines = clean.envelope(_mobile_lines(spark, sf_dir, F.concat(F.lit("é"), _text(_at()), F.lit("}"))))
    return lines.select("ip", "time", clean.payload(F.col("body"), KEY).alias("json"))


@query("clean_mobile_v2", f"""WITH {EV} SELECT appid, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 0 THEN md5(lpad(CAST(user_id AS VARCHAR), 15, '1') || '#a' || user_id) WHEN event_id % 7 = 0 THEN NULL ELSE md5({IDFA_SQL}) END AS uuid, logtype, subtype, CAST(pageid AS VARCHAR) AS pageid, CAST({SENT_SQL} AS BIGINT) AS time, time AS localTime,
CAST(CASE WHEN event_id % 11 = 0 THEN 105 WHEN event_id % 7 = 0 AND event_id % 5 <> 0 THEN 120 ELSE 200 END AS INTEGER) AS status FROM ev WHERE event_id % 41 <> 0
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CAST({SENT_SQL} AS BIGINT), NULL, CAST(102 AS INTEGER) FROM ev WHERE event_id % 41 = 0""")
def clean_mobile_v2(spark, sf_dir):
    ids = F.struct(F.when((_at() % 5 != 0) & (_at() % 7 != 0), _idfa()).alias("idfa"), F.when((_at() % 5 != 0) & (_at() % 7 == 0), F.lit(None).cast("string")).otherwise(F.lpad(_text(F.col("user_id")), 15, "1")).alias("imei"), F.when(_at() % 5 == 0, F.concat(F.lit("a"), _text(F.col("user_id")))).alias("android_id"))
    ids = F.when((_at() % 5 != 0) & (_at() % 7 == 0), F.struct(F.lit("zero").alias("idfa"), F.lit(None).cast("string").alias("imei"), F.lit(None).cast("string").alias("android_id"))).otherwise(ids)
    json = F.to_json(F.struct(F.lit("2").alias("ja_version"), F.when(_at() % 11 != 0, "1.0").alias("app_version"), F.lit("pkg").alias("app_packagename"), "appid", "logtype", "subtype", _text(F.col("pageid")).alias("pageid"), F.lit("").alias("userid"), F.col("time"), ids.alias("device_info")))
    lines = clean.envelope(_mobile_lines(spark, sf_dir, json)).withColumn("json", clean.payload(F.col("body"), KEY))
    return clean.mobile_v2(lines).select("appid", F.when(F.col("status") == 200, F.col("uuid")).alias("uuid"), "logtype", "subtype", "pageid", "time", "localTime", "status")


V1_KINDS = "CASE subtype WHEN 'view' THEN 'page' WHEN 'click' THEN 'click_point' WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'commit_clue' END"


@query("clean_mobile_v1", f"""WITH {EV}, k AS (SELECT *, {V1_KINDS} AS kind, event_id % 700 + 1 AS secs FROM ev)
SELECT appid, md5({IDFA_SQL}) AS uuid, CASE WHEN kind = 'page' AND secs >= 600 THEN NULL ELSE kind END AS subtype, CASE WHEN kind = 'page' AND secs < 600 THEN '50' ELSE '40' END AS logtype,
CAST(CASE WHEN kind = 'page' AND secs < 600 THEN time - secs * 1000 ELSE time END AS BIGINT) AS time, CAST(CASE WHEN kind = 'page' AND secs < 600 THEN secs * 1000 ELSE 0 END AS BIGINT) AS staytime,
CAST(CASE WHEN kind IS NULL OR (kind = 'page' AND secs >= 600) THEN 404 ELSE 200 END AS INTEGER) AS status FROM k""")
def clean_mobile_v1(spark, sf_dir):
    sub, none = F.col("subtype"), F.lit(None).cast("string")
    kind = F.when(sub == "view", "50").when(sub == "click", "30").when(sub == "signup", "20").when(sub == "purchase", "40").otherwise("99")
    inner = F.when(sub == "signup", "3").when(sub.isin("view", "click"), "1")
    event = F.struct("time", F.when(sub == "purchase", "get_user_clue").otherwise(_text(F.col("pageid"))).alias("id"), kind.alias("type"), inner.alias("sub_type"), F.lit("t").alias("title"), none.alias("data"), (F.col("time") - (_at() % 700 + 1) * 1000).alias("open_time"), F.when(sub == "click", "1,2").alias("x_y"))
    common = F.struct(F.col("appid").alias("app_identifier"), F.lit("1").alias("app_version"), F.col("channel").alias("app_channel"), F.lit("os").alias("os_name"), _idfa().alias("device_uuid"))
    # Lines of many events: those of a user and minute come in one.
    e = events(spark, sf_dir).select("ip", (F.floor(F.col("time") / 60_000) * 60_000).alias("minute"), common.alias("common"), event.alias("event"))
    bodies = e.groupBy("common", "minute").agg(F.min("ip").alias("ip"), F.collect_list("event").alias("events")).select("ip", F.col("minute").alias("time"), F.to_json(F.struct("common", "events")).alias("json"))
    return clean.mobile_v1(bodies).select("appid", "uuid", "subtype", "logtype", "time", F.col("staytime").cast("long").alias("staytime"), "status")


APPS = ["1200", "1201", "1202", "1203"]


def _apps(spark):
    return spark.createDataFrame([(a,) for a in APPS], "appid string")


@query("clean_mini_program", f"""WITH {EV} SELECT CASE WHEN event_id % 19 = 0 THEN NULL ELSE appid END AS appid, CASE WHEN event_id % 19 = 0 OR event_id % 13 = 0 THEN NULL ELSE uuid END AS uuid, CASE WHEN event_id % 19 = 0 THEN NULL ELSE time END AS time,
CAST(CASE WHEN event_id % 19 = 0 THEN 101 WHEN appid = '1204' THEN 104 WHEN event_id % 13 = 0 THEN 105 WHEN event_id % 17 = 0 THEN 102 ELSE 200 END AS INTEGER) AS status FROM ev""")
def clean_mini_program(spark, sf_dir):
    data = F.when(_at() % 17 == 0, "{broken").otherwise('{"a":"é"}')
    body = F.struct(F.lit("1").alias("ja_version"), F.lit("1.0").alias("app_version"), F.col("appid").alias("app_identifier"), "logtype", "subtype", _text(F.col("pageid")).alias("pageid"), "time", data.alias("data"), F.struct(F.when(_at() % 13 != 0, F.col("uuid")).alias("ja_uuid")).alias("device_info"))
    text = F.replace(F.when(_at() % 19 == 0, F.lit("{}")).otherwise(F.to_json(body)), F.lit("é"), F.lit(r"\xC3\xA9"))
    return clean.mini_program(events(spark, sf_dir).select(F.concat(F.col("ip"), F.lit(' - ""'), text, F.lit(' EOF"')).alias("value")), _apps(spark)).select("appid", "uuid", "time", "status")


@query("clean_probe", f"""WITH {EV}, p AS (SELECT *, CASE WHEN event_id % 23 = 0 THEN '000' ELSE CAST(-(event_id % 100) AS VARCHAR) END AS s, user_id % 4 AS box FROM ev)
SELECT 'p' || box AS "probeId", uuid AS mac, CAST(time // 1000 * 1000 AS BIGINT) AS time, CAST(CASE WHEN event_id % 29 = 0 THEN 105 WHEN s = '000' THEN 121 WHEN box = 3 THEN 404 WHEN event_id % 100 >= 90 THEN 121 ELSE 200 END AS INTEGER) AS status FROM p""")
def clean_probe(spark, sf_dir):
    at = F.date_format(F.timestamp_seconds(F.floor(F.col("time") / 1000)), "yyyy-MM-dd HH:mm:ss")
    box, signal = F.concat(F.lit("p"), _text(F.col("user_id") % 4)), F.when(_at() % 23 == 0, "000").otherwise(_text(-(_at() % 100)))
    cells = F.array(box, F.col("uuid"), signal, F.lit("f"), at)
    lines = events(spark, sf_dir).select(F.array_join(F.when(_at() % 29 == 0, F.concat(cells, F.array(F.lit("x")))).otherwise(cells), "|").alias("value"))
    probes = spark.createDataFrame([(f"p{i}", i, f"u{i}", i) for i in range(3)], "probeId string, id int, uuid string, venueId int")
    return clean.probe(lines, probes, 90).select("probeId", "mac", "time", "status")


@query("odd_ids", f"WITH {EV} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'short' ELSE uuid END AS uuid, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'seen' END AS note FROM ev")
def odd_ids(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", F.when(_at() % 3 == 0, "short").otherwise(F.col("uuid")).alias("uuid"))
    return clean.with_odd_ids(e, lambda good: good.withColumn("note", F.lit("seen")))


@query("installed_apps", f"WITH {EV} SELECT uuid, time, 'p' || pageid AS pkg, 'app ' || pageid AS name FROM ev WHERE subtype = 'click' UNION ALL SELECT uuid, time, 'q', 'other' FROM ev WHERE subtype = 'click'")
def installed_apps(spark, sf_dir):
    app = lambda pkg, name: F.struct(pkg.alias("pkg"), name.alias("name"))
    p = _text(F.col("pageid"))
    listed = F.to_json(F.array(app(F.concat(F.lit("p"), p), F.concat(F.lit("app "), p)), app(F.lit("n"), F.lit("")), app(F.lit("q"), F.lit("other"))))
    e = events(spark, sf_dir).withColumn("data", listed).withColumn("subtype", F.when(F.col("subtype") == "click", "applist").otherwise(F.col("subtype")))
    return clean.installed_apps(e)


@query("visit_steps", f"WITH {EV} SELECT appid, count(*) AS steps, count(*) FILTER (WHERE event_id % 4 > 0) AS titled FROM ev WHERE subtype NOT IN ('click', 'error') GROUP BY appid")
def visit_steps(spark, sf_dir):
    sub = F.when(F.col("subtype") == "click", "click_point").when(F.col("subtype") == "error", "page_action").otherwise(F.col("subtype"))
    e = events(spark, sf_dir).withColumn("subtype", sub).withColumn("title", F.when(_at() % 4 > 0, "t").otherwise(""))
    titled = clean.steps(e, titled=True).groupBy("appid").agg(F.count("*").alias("titled"))
    return clean.steps(e).groupBy("appid").agg(F.count("*").alias("steps")).join(titled, "appid")


@query("event_report", f"WITH {EV} SELECT appid, subtype, CAST(count(*) AS BIGINT) AS pv, count(DISTINCT uuid) AS uv, count(DISTINCT ip) AS ip FROM ev WHERE logtype <> '50' AND subtype <> 'click' GROUP BY ALL")
def event_report(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("subtype", F.when(F.col("subtype") == "click", "location").otherwise(F.col("subtype")))
    return reports.flow(clean.reported(e), "appid", "subtype")


@query("rows_after_cleaning", f"WITH {EV} SELECT appid, system AS version, logtype, subtype, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY GROUPING SETS ((appid), (appid, system), (logtype, subtype))")
def rows_after_cleaning(spark, sf_dir):
    e = events(spark, sf_dir).withColumnRenamed("system", "version")
    return e.groupingSets([("appid",), ("appid", "version"), ("logtype", "subtype")], "appid", "version", "logtype", "subtype").agg(F.count("*").alias("n"))


# --- ids and texts -----------------------------------------------------------------------------------------------------

LUHN14 = "CAST((10 - list_sum([CASE WHEN i % 2 = 0 THEN 2 * d - CASE WHEN 2 * d > 9 THEN 9 ELSE 0 END ELSE d END FOR d, i IN [CAST(x AS INTEGER) FOR x IN string_split(m, '')]]) % 10) % 10 AS VARCHAR)"


@query("device_ids_valid", f"""WITH {EV}, u AS (SELECT DISTINCT user_id FROM ev), m AS (SELECT user_id, lpad(CAST(user_id * 7919 AS VARCHAR), 14, '35') AS m FROM u)
SELECT user_id, m || {LUHN14} AS imei, md5({IDFA_SQL}) AS by_idfa, '' AS by_none, lpad('f' || user_id, 32, '0') AS normal, reverse(m) AS salted FROM m""")
def device_ids_valid(spark, sf_dir):
    u = events(spark, sf_dir).select("user_id").distinct().withColumn("m", F.lpad(_text(F.col("user_id") * 7919), 14, "35"))
    short = F.lpad(F.concat(F.lit("f"), _text(F.col("user_id"))), 30, "0")
    imei = scalars.imei_complete(F.col("m"))
    return u.select("user_id", F.when(scalars.imei_valid(imei), imei).alias("imei"), scalars.device_uuid(F.lit("idfa"), _idfa()).alias("by_idfa"), scalars.device_uuid(F.lit("cookie"), F.concat(F.col("m"), F.lit("=_"))).alias("by_none"), scalars.normal_uuid(short).alias("normal"), scalars.salted(F.col("m")).alias("salted"))


@query("ip_text", f"WITH {EV} SELECT DISTINCT ip, true AS ok, lower(hex(10)) || 'x' AS bad, '0a' || lpad(lower(to_hex(0)), 2, '0') || lpad(lower(to_hex(CAST(split_part(ip, '.', 3) AS BIGINT))), 2, '0') || lpad(lower(to_hex(CAST(split_part(ip, '.', 4) AS BIGINT))), 2, '0') AS hex FROM ev".replace("lower(hex(10)) || 'x' AS bad", "false AS bad"))
def ip_text(spark, sf_dir):
    ips = events(spark, sf_dir).select("ip").distinct()
    return ips.select("ip", scalars.is_ip(F.col("ip")).alias("ok"), scalars.is_ip(F.concat(F.col("ip"), F.lit("0.1"))).alias("bad"), scalars.ip_hex(F.col("ip")).alias("hex"))


@query("text_repairs", "SELECT doc_id, md5(text) AS plain, coalesce(contains(text, '%') AND length(text) - length(replace(text, '%', '')) > 5 OR contains(text, chr(65533)), false) AS garbled FROM documents")
def text_repairs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    sent = F.regexp_replace(F.hex(F.encode("text", "UTF-8")), "(..)", r"\\x$1")
    return d.select("doc_id", F.md5(scalars.unhex_escapes(sent)).alias("plain"), F.coalesce(scalars.garbled(F.col("text")), F.lit(False)).alias("garbled"))


@query("narrow_text", "SELECT doc_id, md5(regexp_replace(text || chr(128512), '[\\x{10000}-\\x{10FFFF}]', '0000', 'g')) AS narrow FROM documents")
def narrow_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(scalars.without_wide(F.concat(F.col("text"), F.lit("😀")))).alias("narrow"))


@query("time_checks", f"WITH {EV}, m AS (SELECT max(time) AS now FROM ev) SELECT event_id, (time + 28800000) // 86400000 = (now + 28800000) // 86400000 AS today, time >= now - 86400000 * 3 AND time < now - 86400000 * 2 AS within FROM ev, m")
def time_checks(spark, sf_dir):
    e = events(spark, sf_dir)
    now = e.agg(F.max("time").alias("now"))  # one row
    t, n = F.col("time"), F.col("now")
    return e.join(F.broadcast(now)).select("event_id", scalars.today_and_not_later(t, n).alias("today"), scalars.within_day(t, n - 3 * scalars.DAY_MS).alias("within"))


@query("fresh_events", f"WITH {EV}, m AS (SELECT CAST(floor(avg(time)) AS BIGINT) AS now FROM ev) SELECT event_id FROM ev, m WHERE time <= now AND (time + 28800000) // 86400000 = (now + 28800000) // 86400000")
def fresh_events(spark, sf_dir):
    e = events(spark, sf_dir)
    return flows.fresh(e.join(F.broadcast(e.agg(F.floor(F.avg("time")).alias("_now")))), F.col("_now")).select("event_id")


@query("mac_brands", f"WITH {EV}, u AS (SELECT DISTINCT user_id FROM ev), m AS (SELECT user_id, upper(lpad(to_hex(user_id % 40), 6, '0')) AS prefix FROM u) SELECT user_id, n_name AS brand FROM m LEFT JOIN (SELECT upper(lpad(to_hex(n_nationkey), 6, '0')) AS prefix, n_name FROM nation) USING (prefix)")
def mac_brands(spark, sf_dir):
    six = lambda c: F.lower(F.lpad(F.hex(c), 6, "0"))
    p = six(F.col("user_id") % 40)
    u = events(spark, sf_dir).select("user_id").distinct().withColumn("mac", F.concat_ws(":", F.substring(p, 1, 2), F.substring(p, 3, 2), F.substring(p, 5, 2), F.lit("aa"), F.lit("bb"), F.lit("cc")))
    path = _path(spark, "brands")
    table(spark, sf_dir, "nation").select(F.concat_ws("|", six(F.col("n_nationkey")), "n_name").alias("value")).write.text(path)
    return lookup.brands(u, tables.mac_brands(spark, path)).select("user_id", "brand")


# --- sources and sinks -------------------------------------------------------------------------------------------------


def _app_rows(spark, sf_dir) -> DataFrame:
    e, none = events(spark, sf_dir), F.lit("")
    return e.select(F.lit("2").alias("ja_version"), F.lit("1.0").alias("app_version"), "appid", F.when(_at() % 3 == 0, "short").otherwise(F.col("uuid")).alias("uuid"), none.alias("userid"), "logtype", _text(F.col("pageid")).alias("pageid"), "subtype", "time", F.col("time").alias("localTime"), F.lit("a\tb").alias("title"), none.alias("data"), F.lit(0).cast("long").alias("staytime"), F.lit(1).alias("visitindex"), none.alias("recentPage"), "ip", F.create_map(F.lit("sw"), _text(F.col("sw"))).alias("device"))


@query("clean_app_files", f"""WITH {EV} SELECT 'all' AS part, count(*) AS n, CAST(sum(time % 1000) AS BIGINT) AS ms, CAST(sum(sw) AS BIGINT) AS sw FROM ev UNION ALL SELECT 'full', count(*), CAST(sum(time % 1000) AS BIGINT), CAST(sum(sw) AS BIGINT) FROM ev WHERE event_id % 3 <> 0
UNION ALL SELECT 'pages', count(*), CAST(sum(time % 1000) AS BIGINT), CAST(sum(sw) AS BIGINT) FROM ev WHERE logtype = '50' UNION ALL SELECT 'events', count(*), CAST(sum(time % 1000) AS BIGINT), CAST(sum(sw) AS BIGINT) FROM ev WHERE logtype = '40' UNION ALL SELECT 'click', count(*), CAST(sum(time % 1000) AS BIGINT), CAST(sum(sw) AS BIGINT) FROM ev WHERE subtype = 'click'""")
def clean_app_files(spark, sf_dir):
    path = _path(spark, "app-files")
    tables.write_clean(_app_rows(spark, sf_dir), path, tables.APP)
    lines = tables.lines(spark, path)
    parts = {"all": {}, "full": {"full_ids_only": True}, "pages": {"pages": True}, "events": {"events": True}, "click": {"event": "click"}}
    out = None
    for name, how in parts.items():
        one = tables.app_events(lines, **how).agg(F.count("*").alias("n"), F.sum(F.col("time") % 1000).alias("ms"), F.sum(F.col("device")["sw"].cast("long")).alias("sw")).select(F.lit(name).alias("part"), "n", "ms", "sw")
        out = one if out is None else out.unionByName(one)
    return out


@query("clean_web_files", f"WITH {EV} SELECT uuid, appid, subtype, time, ip, acc FROM ev WHERE acc = 1")
def clean_web_files(spark, sf_dir):
    path, none = _path(spark, "web-files"), F.lit("")
    rows = events(spark, sf_dir).select(F.lit("1").alias("ja_version"), "appid", "uuid", none.alias("userid"), "logtype", "subtype", none.alias("ref"), F.lit("u").alias("url"), "time", F.lit("two\nlines").alias("title"), none.alias("data"), F.lit(0).cast("long").alias("staytime"), F.lit(1).alias("visitindex"), "ip", "acc", F.create_map(F.lit("sw"), _text(F.col("sw"))).alias("device"))
    tables.write_clean(rows, path, tables.WEB)
    return tables.web_events(tables.lines(spark, path), people_only=True).select("uuid", "appid", "subtype", "time", "ip", "acc")


@query("tagged_sources", f"WITH {EV} SELECT 'web' AS tag, appid, count(*) AS n FROM ev WHERE acc = 1 GROUP BY ALL UNION ALL SELECT 'app', appid, count(*) FROM ev WHERE acc = 0 GROUP BY ALL")
def tagged_sources(spark, sf_dir):
    paths = {}
    for acc, tag in ((1, "web"), (0, "app")):
        paths[tag] = _path(spark, tag)
        events(spark, sf_dir).where(F.col("acc") == acc).select("event_id", "appid").write.parquet(paths[tag])
    loader = lambda tag: lambda s, p: s.read.parquet(p).withColumn("tag", F.lit(tag))
    return tables.tagged(spark, f"web,{paths['web']}|app,{paths['app']}", {"web": loader("web"), "app": loader("app")}).groupBy("tag", "appid").agg(F.count("*").alias("n"))


@query("day_partitions", f"WITH {EV}, d AS (SELECT CAST(to_timestamp(time / 1000) AS DATE) AS day, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS v FROM ev), m AS (SELECT max(day) AS last FROM d) SELECT day, count(*) AS n, CAST(sum(CASE WHEN day = last THEN 9 ELSE v END) AS BIGINT) AS v FROM d, m WHERE day BETWEEN last - 6 AND last GROUP BY day")
def day_partitions(spark, sf_dir):
    """The last day is written again with other values; the other days stay. Seven days are read."""
    path = _path(spark, "days")
    d = events(spark, sf_dir).select(F.timestamp_millis("time").cast("date").alias("day"), F.when(_at() % 2 == 0, 2).otherwise(1).alias("v"))
    last = d.agg(F.max("day")).first()[0]
    tables.write_day(d, path, "day")
    if last is None:
        return d.groupBy("day").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    tables.write_day(d.where(F.col("day") == F.lit(last)).withColumn("v", F.lit(9)), path, "day")
    return tables.days(spark, path, str(last), 7).groupBy("day").agg(F.count("*").alias("n"), F.sum("v").alias("v"))


@query("document_sink", f"WITH {EV} SELECT event_id, uuid, pageid FROM ev")
def document_sink(spark, sf_dir):
    path = _path(spark, "documents")
    tables.write_documents(events(spark, sf_dir).select("event_id", "uuid", "pageid"), path)
    return spark.read.schema("event_id long, uuid string, pageid long").json(path)


@query("score_files", f"WITH {EV} SELECT uuid, CAST(pageid AS INTEGER) AS \"itemId\", count(*) AS n FROM ev WHERE event_id % 9 > 0 GROUP BY ALL")
def score_files(spark, sf_dir):
    path = _path(spark, "scores")
    rows = events(spark, sf_dir).select(F.concat_ws("\t", "uuid", _text(F.col("pageid")), F.when(_at() % 9 > 0, "1"), F.lit("0.5")).alias("value"))
    rows.write.text(path)
    return tables.scores(spark, path).groupBy("uuid", "itemId").agg(F.count("*").alias("n"))


@query("rating_files", f"WITH {EV} SELECT uuid, CAST(pageid AS INTEGER) AS itemid, CAST(sum(event_id % 5) AS DOUBLE) AS score FROM ev GROUP BY ALL")
def rating_files(spark, sf_dir):
    path = _path(spark, "ratings")
    events(spark, sf_dir).select(F.concat_ws("\t", _text(F.col("user_id")), _text(F.col("pageid")), _text(_at() % 5), "uuid", _text(F.col("pageid"))).alias("value")).write.text(path)
    return tables.item_ratings(spark, path).groupBy("uuid", "itemid").agg(F.sum("score").alias("score"))


@query("dimension_rules", "SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CAST(s_suppkey % 7 AS INTEGER) AS weight FROM supplier WHERE s_suppkey % 3 > 0")
def dimension_rules(spark, sf_dir):
    path = _path(spark, "dimensions")
    rules = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 7).cast("int").alias("weight"), (F.col("s_suppkey") % 3 > 0).cast("int").alias("active"))
    rules.write.parquet(f"{path}/source")
    return tables.dimension(spark, "source", path).drop("active")


@query("denied_visitors", f"WITH {EV}, x AS (SELECT DISTINCT '10.0.3.' AS p UNION SELECT '10.0.' || CAST(o_custkey % 7 AS VARCHAR) || '.' || CAST(20 + o_orderkey % 3 AS VARCHAR) FROM orders) SELECT event_id FROM ev WHERE NOT EXISTS (FROM x WHERE starts_with(ip, p)) AND ip NOT IN ('10.0.1.1', '10.0.2.2') AND uuid NOT IN (SELECT md5(CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_custkey % 2 = 0)")
def denied_visitors(spark, sf_dir):
    """Each order gives a line of a denied beginning here, so their number grows with the tables."""
    path = _path(spark, "lists")
    orders = table(spark, sf_dir, "orders")
    lines = orders.select(F.concat(F.lit("10.0."), _text(F.col("o_custkey") % 7), F.lit("."), _text(20 + F.col("o_orderkey") % 3), F.lit("*")).alias("value"))
    lines.unionByName(spark.createDataFrame([("10.0.1.1",), ("10.0.2.2 ",), ("10.0.3.*",), ("",)], "value string")).write.text(f"{path}/ips")
    table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.concat(F.md5(_text(F.col("c_custkey"))), F.lit(" ")).alias("value")).write.text(f"{path}/ids")
    kept = lookup.not_denied(events(spark, sf_dir), *tables.denied_addresses(spark, f"{path}/ips"))
    return lookup.not_listed(kept, tables.registered(spark, f"{path}/ids"), "uuid").select("event_id")


@query("run_log", f"WITH {EV} SELECT 'job ' || appid AS name, min(time) AS start_ms, max(time) AS end_ms, max(time) - min(time) AS took_ms FROM ev GROUP BY appid")
def run_log(spark, sf_dir):
    path = _path(spark, "runs")
    runs = events(spark, sf_dir).groupBy("appid").agg(F.min("time").alias("start_ms"), F.max("time").alias("end_ms"))
    tables.log_runs(runs.select(F.concat(F.lit("job "), "appid").alias("name"), "start_ms", "end_ms", F.lit("note").alias("note")), path)
    return spark.read.schema("name string, start_ms long, end_ms long, took_ms long").json(path)


@query("quality_log", f"WITH {EV}, s AS (SELECT CASE WHEN event_id % 5 = 0 THEN 105 WHEN event_id % 7 = 0 THEN 120 ELSE 200 END AS status FROM ev), c AS (SELECT status, count(*) AS n FROM s GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) FILTER (WHERE status <> 200) AS BIGINT) AS errors, string_agg(status || ':' || n, ',' ORDER BY status) AS statuses FROM c")
def quality_log(spark, sf_dir):
    q = reports.quality(events(spark, sf_dir).select(F.when(_at() % 5 == 0, 105).when(_at() % 7 == 0, 120).otherwise(200).alias("status")))
    found = F.array_sort(F.map_entries(F.from_json("statuses", "map<string,bigint>")))
    return q.select("total", "errors", F.array_join(F.transform(found, lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",").alias("statuses"))


# --- state -------------------------------------------------------------------------------------------------------------


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    per = lambda odd: events(spark, sf_dir).where(_at() % 2 == odd).groupBy("uuid", "appid").agg(F.count("*").alias("n"), F.min("time").alias("first_time"))
    return per(0), per(1)


@query("state_merged", f"WITH {EV} SELECT uuid, appid, CAST(count(*) AS BIGINT) AS n, min(time) AS first_time FROM ev GROUP BY ALL")
def state_merged(spark, sf_dir):
    return state.merged(*_halves(spark, sf_dir), ["uuid", "appid"], {"n": F.sum("n"), "first_time": F.min("first_time")})


HALVES = f"{EV}, a AS (SELECT uuid, appid, count(*) AS n, min(time) AS first_time FROM ev WHERE event_id % 2 = 0 GROUP BY ALL), b AS (SELECT uuid, appid, count(*) AS n, min(time) AS first_time FROM ev WHERE event_id % 2 = 1 GROUP BY ALL)"


@query("state_replaced", f"WITH {HALVES} SELECT * FROM b UNION ALL SELECT * FROM a WHERE uuid NOT IN (SELECT uuid FROM b)")
def state_replaced(spark, sf_dir):
    return state.replaced(*_halves(spark, sf_dir), ["uuid", "appid"])


@query("state_added", f"WITH {HALVES} SELECT * FROM a UNION ALL SELECT * FROM b WHERE uuid NOT IN (SELECT uuid FROM a)")
def state_added(spark, sf_dir):
    return state.added(*_halves(spark, sf_dir), ["uuid", "appid"])


@query("state_stream_sink", f"WITH {EV} SELECT appid, uuid, CAST(count(*) AS BIGINT) AS n, max(time) AS last_time FROM ev GROUP BY ALL")
def state_stream_sink(spark, sf_dir):
    """A stream that merges each batch into a table of buckets; the last version is read."""
    kept = Keyed(_path(spark, "merged"), ["appid", "uuid"], {"n": F.sum("n"), "last_time": F.max("last_time")}, 16)
    rows = event_stream(spark, sf_dir).select("appid", "uuid", F.lit(1).cast("long").alias("n"), F.col("time").alias("last_time"))
    flows.fed(rows, kept.put, f"{kept.path}/checkpoint")
    return kept.current(spark, "appid string, uuid string, n long, last_time long")


@query("device_documents", f"WITH {EV}, i AS (SELECT DISTINCT uuid, ip FROM ev), j AS (SELECT uuid, string_agg(ip, ',' ORDER BY ip) AS ips FROM i GROUP BY uuid) SELECT uuid, min(time) AS first_time, max(time) AS last_time, any_value(ips) AS ips, any_value(appid) AS apps FROM ev JOIN j USING (uuid) GROUP BY uuid")
def device_documents(spark, sf_dir):
    e = events(spark, sf_dir)
    out = state.device_documents(state.devices(e), state.device_ids(e, {"ip": F.col("ip"), "app": F.col("appid")}))
    return out.select("uuid", "first_time", "last_time", F.array_join(F.col("ids")["ip"], ",").alias("ips"), F.array_join(F.col("ids")["app"], ",").alias("apps"))


@query("device_ids_first", f"WITH {EV} SELECT uuid, 'ip' AS kind, ip AS id, min(time) AS first_time FROM ev GROUP BY ALL")
def device_ids_first(spark, sf_dir):
    e = events(spark, sf_dir)
    old = state.device_ids(e.where(_at() % 2 == 0), {"ip": F.col("ip")})
    return state.device_ids(e.where(_at() % 2 == 1), {"ip": F.col("ip")}, old)


@query("newest_rows", f"WITH {EV}, m AS (SELECT CAST(floor(avg(time)) AS BIGINT) AS mid FROM ev), k AS (SELECT DISTINCT uuid FROM ev WHERE subtype = 'purchase') SELECT uuid, event_id, rank FROM (SELECT uuid, event_id, CAST(row_number() OVER (PARTITION BY uuid ORDER BY time DESC, event_id DESC) AS INTEGER) AS rank FROM ev, m WHERE time <= mid AND uuid IN (SELECT uuid FROM k)) WHERE rank <= 3")
def newest_rows(spark, sf_dir):
    e = events(spark, sf_dir)
    mid = e.agg(F.floor(F.avg("time"))).first()[0] or 0
    return state.newest(e, e.where("subtype = 'purchase'").select("uuid").distinct(), 0, mid, 3).select("uuid", "event_id", "rank")


@query("profiles_of", f"WITH {EV} SELECT uuid, min(time) AS first_time, max(time) AS last_time FROM ev WHERE uuid IN (SELECT md5(CAST(c_custkey AS VARCHAR)) FROM customer) GROUP BY uuid")
def profiles_of(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(F.md5(_text(F.col("c_custkey"))).alias("uuid"))
    return state.looked_up(state.devices(events(spark, sf_dir)), keys).select("uuid", "first_time", "last_time")


@query("published_days", f"WITH {EV}, d AS (SELECT {DAY} AS day, count(*) AS n FROM ev GROUP BY ALL) SELECT day, n FROM d")
def published_days(spark, sf_dir):
    days = events(spark, sf_dir).groupBy(scalars.day_number(F.col("time")).alias("day")).agg(F.count("*").alias("n"))
    return state.gated(days, 1) or days.limit(0)


# --- people and probes -------------------------------------------------------------------------------------------------


@query("first_seen_keys", f"WITH {EV} SELECT appid, uuid, channel, min(time) AS first_time, CAST(arg_max(acc, (-time, acc)) AS INTEGER) AS acc FROM ev GROUP BY GROUPING SETS ((appid, channel), (appid, channel, uuid))")
def first_seen_keys(spark, sf_dir):
    """First times of (app, user) and (app, user, device), where the channel stands for the user."""
    e = events(spark, sf_dir)
    both = [reports.first_seen(e, *keys) for keys in (["appid", "channel"], ["appid", "channel", "uuid"])]
    return both[0].unionByName(both[1], allowMissingColumns=True).select("appid", "uuid", "channel", "first_time", "acc")


@query("app_users", f"WITH {EV}, h AS (SELECT appid, uuid, count(*) FILTER (WHERE logtype = '50') AS page, max(event_id % 9) AS visit, CAST(sum(event_id % 100) AS BIGINT) AS stay FROM ev GROUP BY appid, uuid) SELECT appid, count(*) AS users, CAST(sum(visit) AS BIGINT) AS visit, CAST(sum(page) AS BIGINT) AS page, CAST(sum(stay) AS BIGINT) AS stay FROM h GROUP BY appid")
def app_users(spark, sf_dir):
    days = events(spark, sf_dir).groupBy("appid", "uuid", scalars.day_number(F.col("time")).alias("day")).agg(F.count(F.when(F.col("logtype") == "50", 1)).alias("page"), F.max(_at() % 9).alias("visit"), F.sum(_at() % 100).alias("stay"))
    return profile.app_users(days)


@query("exit_flow", f"""WITH {EV}, f AS (SELECT appid, pageid, count(*) AS pv FROM ev WHERE logtype = '50' GROUP BY ALL), x AS (SELECT appid, pageid, count(*) AS exits FROM (SELECT appid, arg_max(pageid, (time, event_id)) AS pageid FROM ev WHERE logtype = '50' GROUP BY appid, uuid) GROUP BY ALL) SELECT appid, pageid, exits, pv FROM x JOIN f USING (appid, pageid)""")
def exit_flow(spark, sf_dir):
    """Exit pages beside the flow of the page."""
    p = events(spark, sf_dir).where("logtype = '50'").withColumn("visitindex", F.lit(1))
    flow = reports.flow(p, "appid", "pageid").select("appid", "pageid", "pv")
    return reports.exits(p).join(flow, ["appid", "pageid"]).select("appid", "pageid", "exits", "pv")


@query("probe_minutes", f"WITH {EV} SELECT user_id % 3 AS venue, uuid AS mac, max(time) AS time FROM ev GROUP BY user_id % 3, uuid, time // 60000")
def probe_minutes(spark, sf_dir):
    return probe.per_minute(readings(spark, sf_dir)).select("venue", "mac", "time")


@query("probe_real_devices", f"""WITH RECURSIVE {EV}, r AS (SELECT uuid, time, row_number() OVER (PARTITION BY uuid ORDER BY time, event_id) AS i, count(*) OVER (PARTITION BY uuid) AS n FROM ev),
s AS (SELECT uuid, i, time AS start, false AS long FROM r WHERE i = 1 AND n BETWEEN 3 AND 5760
  UNION ALL SELECT r.uuid, r.i, CASE WHEN r.time - start > 7200000 THEN r.time ELSE start END, long OR (r.time - start > 60000 AND r.time - start <= 7200000) FROM s JOIN r ON r.uuid = s.uuid AND r.i = s.i + 1)
SELECT event_id, user_id % 3 AS venue FROM ev WHERE uuid IN (SELECT uuid FROM s WHERE long)""")
def probe_real_devices(spark, sf_dir):
    return probe.real_devices(readings(spark, sf_dir)).select("event_id", "venue")


@query("probe_macs", f"WITH {EV} SELECT user_id % 3 AS venue, uuid AS mac, max(time) AS last_time, max(system) AS brand FROM ev GROUP BY ALL")
def probe_macs(spark, sf_dir):
    named = events(spark, sf_dir).select((F.col("user_id") % 3).alias("venue"), F.col("uuid").alias("mac"), "time", F.col("system").alias("brand"))
    return probe.mac_list(named)


@query("probe_brands", f"""WITH {EV}, r AS (SELECT *, user_id % 3 AS venue FROM ev), c AS (SELECT *, CASE WHEN time - lag(time) OVER (PARTITION BY uuid ORDER BY time, event_id) > 7200000 THEN 1 ELSE 0 END AS cut FROM r), s AS (SELECT *, sum(cut) OVER (PARTITION BY uuid ORDER BY time, event_id) AS k FROM c),
g AS (SELECT venue, uuid, k, min(time) AS a, max(time) AS b, any_value(system) AS system FROM s GROUP BY ALL HAVING max(time) - min(time) >= 60000), f AS (SELECT uuid, min(time) AS first_time FROM r GROUP BY uuid)
SELECT venue, CAST(system <> 'windows' AS INTEGER) AS known, count(*) AS visits, CAST(sum(b - a) AS BIGINT) AS stay, count(DISTINCT CASE WHEN first_time = a THEN uuid END) AS new_devices FROM g JOIN f USING (uuid) GROUP BY ALL""")
def probe_brands(spark, sf_dir):
    r = readings(spark, sf_dir)
    brands = events(spark, sf_dir).groupBy(F.col("uuid").alias("mac")).agg(F.min(F.when(F.col("system") != "windows", F.col("system"))).alias("brand"))
    return probe.brand_report(probe.visits(r), probe.first_seen(r), brands)


@query("label_tags", f"WITH {EV}, l AS (SELECT uuid, subtype AS name, CAST(count(*) AS DOUBLE) AS value FROM ev GROUP BY ALL) SELECT uuid, count(*) AS n, arg_min(name, (-value, name)) AS tag, max(value) AS weight FROM l GROUP BY uuid")
def label_tags(spark, sf_dir):
    """Label documents, read back: how many tags, and the heaviest."""
    labels = events(spark, sf_dir).groupBy("uuid", F.col("subtype").alias("name")).agg(F.count("*").cast("double").alias("value"))
    doc = F.from_json("doc", "tags array<struct<tag:string,weight:double>>")
    return profile.label_documents(labels).select("uuid", F.size(doc["tags"]).cast("long").alias("n"), F.get(doc["tags"], 0)["tag"].alias("tag"), F.get(doc["tags"], 0)["weight"].alias("weight"))


@query("guide_labels", f"WITH {EV} SELECT DISTINCT uuid, n_name AS name, 5.0::DOUBLE AS value FROM ev JOIN nation ON n_nationkey = pageid % 25")
def guide_labels(spark, sf_dir):
    answers = events(spark, sf_dir).select("uuid", F.to_json(F.create_map(F.lit("q"), _text(F.col("pageid") % 25))).alias("answers"))
    return profile.guide_labels(answers, table(spark, sf_dir, "nation").select(_text(F.col("n_nationkey")).alias("attribute"), F.col("n_name").alias("name")))


@query("labels_merged", f"WITH {EV} SELECT uuid, appid AS company_id, subtype AS name, CAST(1 AS INTEGER) AS weight, count(*) AS times, CAST(sum(event_id % 10) AS BIGINT) AS stay FROM ev GROUP BY ALL")
def labels_merged(spark, sf_dir):
    days = events(spark, sf_dir).groupBy("uuid", F.col("appid").alias("company_id"), F.col("subtype").alias("name"), F.lit(1).alias("weight"), scalars.day_number(F.col("time")).alias("day")).agg(F.count("*").alias("times"), F.sum(_at() % 10).alias("stay"))
    return profile.merged_labels(days)


@query("label_increments", f"""WITH {EV}, s AS (SELECT *, least(coalesce(lead(time) OVER (PARTITION BY uuid ORDER BY time, event_id) - time, 10000), 600000) AS stay FROM ev)
SELECT uuid, appid AS company_id, system AS label, round(sum(0.7::DOUBLE + stay / 20000::DOUBLE * 0.3::DOUBLE), 6) AS value FROM s WHERE logtype = '50' GROUP BY ALL""")
def label_increments(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("company_id", F.col("appid")).withColumn("label", F.col("system"))
    return flows.label_increments(e).withColumn("value", F.round("value", 6))


@query("jdbc_flow", f"WITH {EV} SELECT {DAY} AS day, appid, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT uuid) AS BIGINT) AS uv, 'flow-' || CAST({DAY} % 2 AS VARCHAR) AS run_key FROM ev GROUP BY ALL")
def jdbc_flow(spark, sf_dir):
    """Flow by day and app appended to a JDBC table in two runs, of which one is made again, and read back by spans of days."""
    url, name = f"jdbc:derby:memory:x{uuid.uuid4().hex};create=true", "FLOW"
    e = events(spark, sf_dir).withColumn("day", scalars.day_number(F.col("time")))
    flow = e.groupBy("day", "appid").agg(F.count("*").alias("n"), F.countDistinct("uuid").alias("uv"))
    for part in (0, 1, 0):
        tables.append_jdbc_once(flow.where(F.col("day") % 2 == part), url, name, f"flow-{part}", driver="org.apache.derby.jdbc.EmbeddedDriver")
    return tables.jdbc_parts(spark, url, name, '"day"', 4, driver="org.apache.derby.jdbc.EmbeddedDriver")


@query("profile_shape", f"WITH {EV}, l AS (SELECT uuid, subtype AS name, count(*) AS n FROM ev GROUP BY ALL), a AS (SELECT uuid, string_agg(name, ',' ORDER BY n DESC, name) AS tag_keys, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n DESC, name) AS tag_values FROM l GROUP BY uuid) SELECT uuid, tag_keys, tag_values, CAST(CASE WHEN user_id % 3 = 2 THEN 2 WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS sex_code FROM a JOIN (SELECT DISTINCT uuid, user_id FROM ev) USING (uuid)")
def profile_shape(spark, sf_dir):
    counts = events(spark, sf_dir).groupBy("uuid", "user_id", "subtype").agg(F.count("*").alias("n"))
    p = counts.groupBy("uuid", "user_id").agg(F.map_from_entries(F.collect_list(F.struct("subtype", "n"))).alias("tags")).withColumn("sex", F.col("user_id") % 3 - 1)
    return profile.shaped(p, "tags", "sex").select("uuid", F.array_join("tag_keys", ",").alias("tag_keys"), F.array_join(F.transform("tag_values", lambda v: v.cast("string")), ",").alias("tag_values"), "sex_code")


@query("visit_pages", f"WITH {EV}, v AS (SELECT uuid, count(*) AS n FROM ev GROUP BY uuid) SELECT uuid, n FROM v ORDER BY n DESC, uuid LIMIT 10 OFFSET 10")
def visit_pages(spark, sf_dir):
    """The second page, of ten devices, by most rows."""
    return profile.paged(events(spark, sf_dir).groupBy("uuid").agg(F.count("*").alias("n")), [F.col("n").desc(), F.col("uuid")], 1, 10)[0]


@query("visits_newest_first", f"WITH {EV}, v AS (SELECT uuid, {DAY} AS day, min(time) AS start FROM ev GROUP BY ALL) SELECT uuid, string_agg(CAST(start AS VARCHAR), ',' ORDER BY start DESC) AS starts FROM v GROUP BY uuid")
def visits_newest_first(spark, sf_dir):
    v = events(spark, sf_dir).groupBy("uuid", scalars.day_number(F.col("time")).alias("day")).agg(F.min("time").alias("start"))
    return v.groupBy("uuid").agg(F.array_join(F.transform(F.sort_array(F.collect_list("start"), asc=False), lambda s: s.cast("string")), ",").alias("starts"))


@query("count_maps", f"WITH {EV}, c AS (SELECT uuid, subtype, count(*) FILTER (WHERE event_id % 2 = 0) AS a, count(*) FILTER (WHERE event_id % 2 = 1) AS b FROM ev GROUP BY ALL), m AS (SELECT uuid, subtype, CASE WHEN b > 0 THEN b ELSE a END AS n FROM c) SELECT uuid, coalesce(string_agg(subtype || '=' || n, ',' ORDER BY subtype) FILTER (WHERE n >= 2), '') AS kept FROM m GROUP BY uuid")
def count_maps(spark, sf_dir):
    """Two count maps of each device merged, new values first, and small entries dropped."""
    half = lambda odd: F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("odd") == odd, F.struct("subtype", "n")))))
    c = events(spark, sf_dir).groupBy("uuid", "subtype", (_at() % 2).alias("odd")).agg(F.count("*").alias("n"))
    m = c.groupBy("uuid").agg(half(0).alias("old"), half(1).alias("new")).withColumn("m", documents.kept_entries(documents.preferred(F.col("old"), F.col("new"), True), 2))
    return m.select("uuid", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("kept"))


@query("users_by_algorithm", f"WITH {EV} SELECT channel AS algorithm, count(DISTINCT uuid) AS users FROM ev GROUP BY channel")
def users_by_algorithm(spark, sf_dir):
    return recommend.users_by(events(spark, sf_dir), F.col("channel"))


@query("fanned_out", f"WITH {EV}, t AS (SELECT o_custkey AS \"user\", count(*) AS n FROM orders GROUP BY 1) SELECT \"user\", n FROM t WHERE \"user\" IN (SELECT user_id FROM ev WHERE {DAY} > {TODAY} - 15)")
def fanned_out(spark, sf_dir):
    top = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user")).agg(F.count("*").alias("n"))
    active = events(spark, sf_dir).select(F.col("user_id").alias("user"), scalars.day_number(F.col("time")).alias("day"))
    return recommend.fanned_out(top, active, TODAY)


@query("app_history", f"WITH {EV}, d AS (SELECT uuid, {DAY} AS day, pageid % 5 AS app FROM ev GROUP BY ALL), l AS (SELECT uuid, day, string_agg('a' || app, ',' ORDER BY app) AS apps FROM d GROUP BY ALL) SELECT uuid, arg_max(apps, day) AS apps FROM l GROUP BY uuid")
def app_history(spark, sf_dir):
    """Each day's app list becomes a change against the day before; the history ends with the last day's list."""
    from pyspark.sql import Window as W

    lists = events(spark, sf_dir).groupBy("uuid", scalars.day_number(F.col("time")).alias("time")).agg(F.array_sort(F.collect_set(F.concat(F.lit("a"), _text(F.col("pageid") % 5)))).alias("apps"))
    before = F.coalesce(F.lag("apps").over(W.partitionBy("uuid").orderBy("time")), F.array().cast("array<string>"))
    changed = lists.withColumn("before", before).select("uuid", "time", F.array_except("apps", "before").alias("added"), F.array_except("before", "apps").alias("removed"))
    return documents.app_history(changed).select("uuid", F.array_join("apps", ",").alias("apps"))


@query("word_counts", r"SELECT word, count(*) AS count FROM (SELECT unnest(string_split_regex(trim(text, ' '), '[ \t\n\x0B\f\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY word")
def word_counts(spark, sf_dir):
    """Words of documents, counted as a stream that keeps running counts."""
    docs = spark.readStream.schema(table(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/document[s].parquet")
    out = flows.run_to_end(flows.words(docs.select(F.col("text").alias("value"))), folder(spark), "complete")
    last = out.agg(F.max("batch").alias("_b"))
    return out.join(F.broadcast(last), F.col("batch") == F.col("_b")).select("word", "count")

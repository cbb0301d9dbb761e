"""Traffic queries: flows, top lists, grids, first times, exits and jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.operators import clean, lookup, reports, sessions
from trailmark.plans.adapt import DAY, EV, events, table

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


FLOW = "CAST(count(*) AS BIGINT) AS pv, count(DISTINCT uuid) AS uv, count(DISTINCT ip) AS ip"


def _flow(name: str, *keys: str) -> None:
    @query(name, f"WITH {EV} SELECT {', '.join(keys)}, {FLOW} FROM ev GROUP BY {', '.join(keys)}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.flow(events(spark, sf_dir), *keys)


_flow("flow_by_app", "appid")
_flow("flow_by_channel", "appid", "channel")
_flow("flow_by_event", "appid", "logtype", "subtype")
_flow("flow_by_page", "appid", "pageid")
_flow("flow_by_browser", "appid", "system", "browser")


@query("flow_by_screen", f"WITH {EV} SELECT appid, system, sw, sh, {FLOW} FROM ev WHERE sw > 0 AND sh > 0 GROUP BY ALL")
def flow_by_screen(spark, sf_dir):
    return reports.flow(events(spark, sf_dir).where("sw > 0 and sh > 0"), "appid", "system", "sw", "sh")


@query("flow_sets", f"""WITH {EV} SELECT appid, CASE WHEN grouping(channel) = 0 THEN 'channel' WHEN grouping(system) = 0 THEN 'system' ELSE 'all' END AS dim,
 coalesce(channel, system, 'all') AS "value", {FLOW} FROM ev GROUP BY GROUPING SETS ((appid), (appid, channel), (appid, system))""")
def flow_sets(spark, sf_dir):
    return reports.flow_sets(events(spark, sf_dir), "appid", "channel", "system")


#: Sources by rule: kind, text, name; the first that holds (made-up rules for the test tables).
SOURCES = [(1, "example.com", "com"), (5, "example[.]net/(en|de)/", "net"), (3, "https://", "secure"), (4, "html", "page")]
SOURCE_SQL = "CASE WHEN contains(url, 'example.com') THEN 'com' WHEN regexp_matches(url, 'example[.]net/(en|de)/') THEN 'net' WHEN starts_with(url, 'https://') THEN 'secure' WHEN ends_with(url, 'html') THEN 'page' END"
VIEWS = f"{EV}, vw AS (SELECT ev.*, p.url, CASE WHEN ev.event_id % 3 = 0 THEN r.url ELSE '' END AS ref FROM ev JOIN pages p ON ev.pageid = p.page_id LEFT JOIN pages r ON (ev.pageid * 7 + 3) % 97 = r.page_id)"
HOST = "lower(regexp_extract({}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"


def views(spark, sf_dir) -> DataFrame:
    """Events with the url of their page, and a referrer for a third of them."""
    e, p = events(spark, sf_dir), table(spark, sf_dir, "pages").select("page_id", "url")
    out = e.join(p, e["pageid"] == p["page_id"]).drop("page_id").withColumn("_r", (F.col("pageid") * 7 + 3) % 97)
    r = p.select(F.col("page_id").alias("_r"), F.col("url").alias("_ref"))
    return out.join(r, "_r", "left").withColumn("ref", F.when(F.col("event_id") % 3 == 0, F.col("_ref")).otherwise("")).drop("_r", "_ref")


@query("flow_by_source", f"WITH {VIEWS} SELECT appid, source, {FLOW} FROM (SELECT *, {SOURCE_SQL} AS source FROM vw) WHERE source IS NOT NULL GROUP BY ALL")
def flow_by_source(spark, sf_dir):
    v = views(spark, sf_dir).withColumn("source", lookup.first_of_literals(F.col("url"), SOURCES))
    return reports.flow(v.where("source is not null"), "appid", "source")


RANGES_SQL = """rg AS (SELECT (10 * 16777216 + CAST(n_nationkey % 7 AS BIGINT) * 256 + 20 * (n_nationkey // 7) + CASE WHEN n_nationkey >= 21 THEN 180 ELSE 19 END) AS end_ip, r_name AS country, n_name AS province, 'c' || n_nationkey AS city, 'a' || r_regionkey AS area FROM nation JOIN region ON n_regionkey = r_regionkey),
rs AS (SELECT *, coalesce(lag(end_ip) OVER (ORDER BY end_ip) + 1, 0) AS start_ip FROM rg)"""
AREA_SQL = f"{EV}, {RANGES_SQL}, ar AS (SELECT ev.*, coalesce(rs.country, '--') AS country, coalesce(rs.province, '--') AS province, coalesce(rs.city, '--') AS city FROM (SELECT *, 10 * 16777216 + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) AS num FROM ev) ev LEFT JOIN rs ON num BETWEEN start_ip AND end_ip)"


def ranges(spark, sf_dir) -> DataFrame:
    """Address ranges of nations, by their ends."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("n_nationkey").cast("long")
    end = F.lit(10 * 16777216) + k % 7 * 256 + F.floor(k / 7) * 20 + F.when(k >= 21, 180).otherwise(19)
    ends = n.select(end.cast("long").alias("end_ip"), F.col("r_name").alias("country"), F.col("n_name").alias("province"), F.concat(F.lit("c"), k.cast("string")).alias("city"), F.concat(F.lit("a"), F.col("r_regionkey").cast("string")).alias("area"))
    return lookup.ranges_from_ends(ends)


@query("flow_by_area", f"WITH {AREA_SQL} SELECT appid, country, province, city, {FLOW} FROM ar GROUP BY ALL")
def flow_by_area(spark, sf_dir):
    return reports.flow(lookup.ip_area(events(spark, sf_dir), ranges(spark, sf_dir)), "appid", "country", "province", "city")


@query("ip_area", f"WITH {AREA_SQL} SELECT DISTINCT ip, country, province, city FROM ar")
def ip_area(spark, sf_dir):
    return lookup.ip_area(events(spark, sf_dir).select("ip").distinct(), ranges(spark, sf_dir)).select("ip", "country", "province", "city")


PEOPLE = "CAST(count(*) AS BIGINT) AS all_visit_num, count(DISTINCT uuid) AS all_uv, count(DISTINCT ip) AS all_ip, count(*) FILTER (WHERE acc = 1) AS visit_num, count(DISTINCT uuid) FILTER (WHERE acc = 1) AS uv, count(DISTINCT ip) FILTER (WHERE acc = 1) AS ip"


@query("url_visits", f"WITH {VIEWS} SELECT appid, url, {PEOPLE} FROM vw GROUP BY ALL")
def url_visits(spark, sf_dir):
    return reports.people_and_bots(views(spark, sf_dir), "appid", "url")


@query("url_topn", f"WITH {VIEWS}, c AS (SELECT appid, url, {PEOPLE} FROM vw GROUP BY ALL) SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY appid ORDER BY all_visit_num DESC, url) AS INTEGER) AS rank FROM c) WHERE rank <= 20")
def url_topn(spark, sf_dir):
    return reports.top(url_visits(spark, sf_dir), "all_visit_num", 20, "appid", "url")


@query("referrer_topn", f"""WITH {VIEWS}, ho AS (SELECT appid, min({HOST.format('url')}) AS host FROM vw GROUP BY appid),
c AS (SELECT vw.appid, ref, {PEOPLE} FROM vw JOIN ho ON vw.appid = ho.appid WHERE length(ref) BETWEEN 1 AND 8191 AND length(host) > 0 AND NOT contains(ref, host) GROUP BY ALL)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY appid ORDER BY all_visit_num DESC, ref) AS INTEGER) AS rank FROM c) WHERE rank <= 20""")
def referrer_topn(spark, sf_dir):
    from trailmark.functions.scalars import host

    v = views(spark, sf_dir)
    hosts = v.groupBy("appid").agg(F.min(host(F.col("url"))).alias("host"))
    return reports.top(reports.people_and_bots(reports.external(v, hosts), "appid", "ref"), "all_visit_num", 20, "appid", "ref")


def _grid(unit: str, slots: int, ms: int) -> None:
    @query(f"{unit}_grid", f"""WITH {EV}, t AS (SELECT appid, {DAY} AS day, CAST((time + 28800000) % 86400000 // {ms} AS INTEGER) AS slot, uuid, ip FROM ev),
 s AS (SELECT appid, day, slot, {FLOW} FROM t GROUP BY ALL), g AS (SELECT appid, day, CAST(range AS INTEGER) AS slot FROM (SELECT DISTINCT appid, day FROM t), range({slots}))
 SELECT appid, day, slot, coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv, coalesce(ip, 0) AS ip FROM g LEFT JOIN s USING (appid, day, slot)""")
    def run(spark, sf_dir):
        return reports.grid(events(spark, sf_dir), unit)


_grid("hour", 24, 3_600_000)
_grid("minute", 1440, 60_000)


@query("first_seen", f"WITH {EV} SELECT appid, uuid, min(time) AS first_time, CAST(arg_max(acc, (-time, acc)) AS INTEGER) AS acc FROM ev GROUP BY ALL")
def first_seen(spark, sf_dir):
    return reports.first_seen(events(spark, sf_dir), "appid", "uuid")


@query("new_vs_old", f"""WITH {EV}, f AS (SELECT appid, uuid, min(time) AS time FROM ev GROUP BY ALL), fd AS (SELECT appid, uuid, {DAY} AS first_day FROM f), d AS (SELECT DISTINCT appid, uuid, {DAY} AS day FROM ev)
SELECT appid, day, CAST(day > first_day AS INTEGER) AS is_old, CAST(count(*) AS BIGINT) AS users FROM d JOIN fd USING (appid, uuid) GROUP BY ALL""")
def new_vs_old(spark, sf_dir):
    e = events(spark, sf_dir)
    return reports.new_and_old(e, reports.first_seen(e, "appid", "uuid"))


@query("latest_per_user", f"WITH {EV} SELECT uuid, event_id, appid, subtype, pageid, time FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY time DESC, event_id DESC) AS n FROM ev) WHERE n = 1")
def latest_per_user(spark, sf_dir):
    return reports.latest(events(spark, sf_dir).select("uuid", "event_id", "appid", "subtype", "pageid", "time"), "uuid")


RAW_SQL = f"{EV}, st AS (SELECT *, CAST(CASE WHEN event_id % 53 = 0 THEN 102 WHEN event_id % 11 = 0 THEN 105 WHEN appid = '1204' THEN 104 WHEN event_id % 13 = 0 THEN 120 WHEN event_id % 17 = 0 THEN 109 ELSE 200 END AS INTEGER) AS status FROM ev)"


def raw_web_lines(spark, sf_dir) -> DataFrame:
    """Web log lines written from events, some of them broken in a known way, with the event they come from."""
    e, i = events(spark, sf_dir), F.col("event_id")
    fields = F.struct(F.when(i % 11 != 0, F.col("appid")).alias("id"), F.when(F.col("logtype") == "50", "30").otherwise("40").alias("type"), F.col("subtype").alias("sub_type"), F.col("ip"), F.lit("").alias("ref"), F.when(i % 17 == 0, "/x").otherwise(F.concat(F.lit("http://a.example.com/"), F.col("pageid").cast("string"))).alias("url"), F.col("time"), F.when(i % 13 == 0, "a=b").otherwise(F.col("uuid")).alias("uuid"), F.col("acc").alias("is_people"))
    return e.select(F.when(i % 53 == 0, F.concat(F.lit("{broken "), i.cast("string"))).otherwise(F.to_json(fields)).alias("value"))


def cleaned(spark, sf_dir) -> DataFrame:
    apps = spark.createDataFrame([("1200",), ("1201",), ("1202",), ("1203",)], "appid string")
    return clean.web(raw_web_lines(spark, sf_dir), apps)


@query("status_histogram", f"WITH {RAW_SQL} SELECT status, CAST(count(*) AS BIGINT) AS n FROM st GROUP BY status")
def status_histogram(spark, sf_dir):
    return reports.status_histogram(cleaned(spark, sf_dir))


@query("clean_quality", f"WITH {RAW_SQL} SELECT CAST(count(*) AS BIGINT) AS total, count(*) FILTER (WHERE status <> 200) AS errors, count(*) FILTER (WHERE status = 200) AS ok FROM st")
def clean_quality(spark, sf_dir):
    return reports.quality(cleaned(spark, sf_dir)).drop("statuses")


@query("clean_web", f"WITH {RAW_SQL} SELECT appid, md5(uuid) AS uuid, logtype, subtype, time, ip FROM st WHERE status = 200")
def clean_web(spark, sf_dir):
    return cleaned(spark, sf_dir).where("status = 200").select("appid", "uuid", "logtype", "subtype", "time", "ip")


@query("dedup_events", f"WITH {EV} SELECT event_id, uuid, subtype, pageid FROM (SELECT *, row_number() OVER (PARTITION BY uuid, subtype, pageid ORDER BY time, event_id) AS n FROM ev) WHERE n = 1")
def dedup_events(spark, sf_dir):
    return clean.deduplicated(events(spark, sf_dir), ["uuid", "subtype", "pageid"], ["time", "event_id"]).select("event_id", "uuid", "subtype", "pageid")


STAY_SQL = f"""{EV}, ws AS (SELECT *, CASE WHEN logtype = '50' THEN coalesce(lead(time) OVER (PARTITION BY uuid, logtype = '50' ORDER BY time, event_id) - time, 0) ELSE 0 END AS staytime FROM ev)"""
VISIT_SQL = f"""{STAY_SQL}, wl AS (SELECT *, coalesce(lag(CASE WHEN staytime >= 600000 THEN 1 ELSE 0 END) OVER (PARTITION BY uuid ORDER BY time, event_id), 0) AS opened FROM ws),
wv AS (SELECT * REPLACE (CASE WHEN staytime >= 600000 THEN 0 ELSE staytime END AS staytime), CAST(1 + sum(opened) OVER (PARTITION BY uuid ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS visitindex FROM wl)"""


def visited(spark, sf_dir) -> DataFrame:
    return sessions.web_visit_index(sessions.web_stay(events(spark, sf_dir)))


@query("web_stay", f"WITH {STAY_SQL} SELECT event_id, uuid, CAST(staytime AS BIGINT) AS staytime FROM ws")
def web_stay(spark, sf_dir):
    return sessions.web_stay(events(spark, sf_dir)).select("event_id", "uuid", "staytime")


@query("page_stay", f"WITH {STAY_SQL} SELECT appid, pageid, CAST(count(*) AS BIGINT) AS n, CAST(sum(staytime) AS BIGINT) AS stay FROM ws WHERE staytime > 0 GROUP BY ALL")
def page_stay(spark, sf_dir):
    return reports.stay(sessions.web_stay(events(spark, sf_dir)), "appid", "pageid")


@query("web_visit_index", f"WITH {VISIT_SQL} SELECT event_id, visitindex, CAST(staytime AS BIGINT) AS staytime FROM wv")
def web_visit_index(spark, sf_dir):
    return visited(spark, sf_dir).select("event_id", "visitindex", F.col("staytime").cast("long").alias("staytime"))


@query("visits", f"""WITH {VISIT_SQL} SELECT appid, uuid, visitindex, min(time) AS start, max(time) AS "end", CAST(sum(staytime) AS BIGINT) AS stay, arg_min(ip, (time, event_id)) AS ip, arg_min(channel, (time, event_id)) AS ref,
 count(*) FILTER (WHERE logtype = '50') AS n_pages, count(*) FILTER (WHERE logtype <> '50') AS n_events, arg_min(pageid, (time, event_id)) FILTER (WHERE logtype = '50') AS entry FROM wv GROUP BY appid, uuid, visitindex""")
def visits(spark, sf_dir):
    return sessions.visit_summary(sessions.visits(visited(spark, sf_dir)))


@query("exit_pages", f"""WITH {VISIT_SQL}, la AS (SELECT appid, arg_max(pageid, (time, event_id)) AS pageid FROM wv WHERE logtype = '50' GROUP BY appid, uuid, visitindex),
c AS (SELECT appid, pageid, CAST(count(*) AS BIGINT) AS exits FROM la GROUP BY ALL) SELECT *, CAST(sum(exits) OVER (PARTITION BY appid) AS BIGINT) AS app_exits FROM c""")
def exit_pages(spark, sf_dir):
    return reports.exits(visited(spark, sf_dir).where("logtype = '50'"))


JUMP_SQL = f"""{VISIT_SQL}, pk AS (SELECT *, lag(pageid) OVER w AS before FROM wv WHERE logtype = '50' WINDOW w AS (PARTITION BY appid, uuid, visitindex ORDER BY time, event_id)),
wk AS (SELECT appid, first_value(pageid) OVER w AS source, CAST(row_number() OVER w AS INTEGER) AS step, pageid AS page, lead(pageid, 1, 0) OVER w AS next FROM pk WHERE before IS NULL OR before <> pageid WINDOW w AS (PARTITION BY appid, uuid, visitindex ORDER BY time, event_id))"""


@query("page_jump_source", f"WITH {JUMP_SQL} SELECT appid, source, step, page, next, CAST(count(*) AS BIGINT) AS n FROM wk GROUP BY ALL")
def page_jump_source(spark, sf_dir):
    return reports.jumps(visited(spark, sf_dir).where("logtype = '50'"))


@query("page_jump", f"WITH {JUMP_SQL} SELECT appid, step, page, next, CAST(count(*) AS BIGINT) AS n FROM wk GROUP BY ALL")
def page_jump(spark, sf_dir):
    return page_jump_source(spark, sf_dir).groupBy("appid", "step", "page", "next").agg(F.sum("n").alias("n"))


@query("app_stay_v1", f"""WITH {EV}, cl AS (SELECT *, CASE WHEN logtype = '50' OR subtype = 'error' THEN time END AS shut FROM ev),
c AS (SELECT *, first_value(shut IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_shut,
 last_value(CASE WHEN logtype = '50' THEN pageid WHEN subtype = 'error' THEN -1 END IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_page FROM cl)
SELECT event_id, CAST(CASE WHEN logtype = '50' THEN coalesce(next_shut - time, 0) ELSE 0 END AS BIGINT) AS staytime, CASE WHEN open_page >= 0 THEN open_page END AS recent_page FROM c""")
def app_stay_v1(spark, sf_dir):
    return sessions.app_stay_on_open(events(spark, sf_dir), background="error").select("event_id", "staytime", "recent_page")


@query("app_stay_v2", f"""WITH {EV}, c AS (SELECT *, CASE WHEN logtype = '50' OR subtype = 'signup' THEN time END AS came, CASE WHEN logtype = '50' THEN pageid END AS pg FROM ev),
d AS (SELECT *, coalesce(last_value(came IGNORE NULLS) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), first_value(time) OVER b) AS since,
 last_value(pg IGNORE NULLS) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(pg IGNORE NULLS) OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM c WINDOW b AS (PARTITION BY uuid, appid ORDER BY time, event_id))
SELECT event_id, CASE WHEN logtype = '50' THEN since ELSE time END AS time, CAST(CASE WHEN logtype = '50' THEN time - since ELSE 0 END AS BIGINT) AS staytime, CASE WHEN logtype = '50' THEN before ELSE after END AS recent_page FROM d""")
def app_stay_v2(spark, sf_dir):
    return sessions.app_stay_on_close(events(spark, sf_dir), foreground="signup").select("event_id", "time", "staytime", "recent_page")


@query("app_visit_index", f"""WITH {EV}, cl AS (SELECT *, CASE WHEN logtype = '50' OR subtype = 'error' THEN time END AS shut FROM ev),
ws AS (SELECT *, CASE WHEN logtype = '50' THEN coalesce(first_value(shut IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - time, 0) ELSE 0 END AS staytime FROM cl),
w AS (SELECT *, row_number() OVER u AS k, staytime >= 600000 OR coalesce(time - lag(time) OVER u, 0) >= 600000 AS arms, logtype = '50' OR subtype = 'signup' AS fires FROM ws WINDOW u AS (PARTITION BY uuid, appid ORDER BY time, event_id)),
x AS (SELECT *, max(CASE WHEN arms THEN k END) OVER b AS armed, max(CASE WHEN fires THEN k END) OVER b AS fired FROM w WINDOW b AS (PARTITION BY uuid, appid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, uuid, appid, CAST(CASE WHEN staytime >= 600000 THEN 0 ELSE staytime END AS BIGINT) AS staytime, CAST(1 + sum(CASE WHEN fires AND armed >= coalesce(fired, 0) THEN 1 ELSE 0 END) OVER (PARTITION BY uuid, appid ORDER BY k) AS INTEGER) AS visitindex FROM x""")
def app_visit_index(spark, sf_dir):
    e = sessions.app_stay_on_open(events(spark, sf_dir), background="error")
    return sessions.app_visit_index(e, foreground="signup").select("event_id", "uuid", "appid", "staytime", "visitindex")

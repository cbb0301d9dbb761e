"""Queries that chain operators over stored tables: profiles with all their parts, day records, reports, chats and lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions import scalars
from trailmark.operators import clean, documents, lookup, profile, recommend, reports, sessions, state
from trailmark.plans import offers, people, records
from trailmark.plans.adapt import DAY, EV, events, table
from trailmark.plans.people import APPS_SQL, LABEL_SUM_SQL, MAPS_SQL, PAGE_LABEL_SQL, TODAY, _maps_sql, label_days
from trailmark.plans.streams import folder
from trailmark.plans.traffic import AREA_SQL, VISIT_SQL, ranges, visited
from trailmark.sources import tables
from trailmark.streaming import flows

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _own(spark, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- mini-programs and version-1 apps ----------------------------------------------------------------------------------


@query("mini_visits", f"""WITH {EV}, cl AS (SELECT *, CASE WHEN logtype = '50' OR subtype = 'error' THEN time END AS shut FROM ev WHERE appid IN ('1203', '1204')),
c AS (SELECT *, CASE WHEN logtype = '50' THEN coalesce(first_value(shut IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - time, 0) ELSE 0 END AS stay,
 last_value(CASE WHEN logtype = '50' THEN pageid WHEN subtype = 'error' THEN -1 END IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_page FROM cl),
w AS (SELECT *, row_number() OVER u AS k, stay >= 600000 AS arms, logtype = '50' OR subtype = 'signup' AS fires FROM c WINDOW u AS (PARTITION BY uuid, appid ORDER BY time, event_id)),
x AS (SELECT *, max(CASE WHEN arms THEN k END) OVER b AS armed, max(CASE WHEN fires THEN k END) OVER b AS fired FROM w WINDOW b AS (PARTITION BY uuid, appid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, uuid, appid, CASE WHEN open_page >= 0 THEN open_page END AS recent_page, CAST(CASE WHEN stay >= 600000 THEN 0 ELSE stay END AS BIGINT) AS staytime, CAST(1 + sum(CASE WHEN fires AND armed >= coalesce(fired, 0) THEN 1 ELSE 0 END) OVER (PARTITION BY uuid, appid ORDER BY k) AS INTEGER) AS visitindex FROM x""")
def mini_visits(spark, sf_dir):
    """Mini-programs: pages timed when they open, the page before, and visits that only long stays part."""
    e = sessions.app_stay_on_open(events(spark, sf_dir).where("appid in ('1203', '1204')"), background="error")
    return sessions.app_visit_index(e, gap_rule=False, foreground="signup").select("event_id", "uuid", "appid", "recent_page", "staytime", "visitindex")


IMEI = "lpad(CAST(user_id AS VARCHAR), 15, '1')"


@query("clean_mobile_known", f"""WITH {EV} SELECT event_id, CASE WHEN appid IN ('1200', '1201') THEN 'a' || appid WHEN appid = '1202' THEN 'w1202' END AS appid,
 CASE appid WHEN '1200' THEN md5({records.IDFA_SQL}) WHEN '1201' THEN md5({IMEI} || '#a' || user_id) END AS uuid, CASE WHEN appid IN ('1200', '1202') AND user_id % 3 = 0 THEN 'm' || user_id WHEN appid = '1201' AND user_id % 10 = 1 AND user_id % 3 > 0 THEN 'u' || user_id ELSE '' END AS userid,
 'mac=0a' || user_id || ',model=M' || user_id % 3 || ',net=wifi,screenHeight=' || sh || ',screenWidth=' || sw || ',system=os 9' AS device,
 CAST(CASE WHEN appid IN ('1203', '1204') THEN 107 WHEN appid = '1202' THEN 404 WHEN subtype = 'error' THEN 404 ELSE 200 END AS INTEGER) AS status FROM ev""")
def clean_mobile_known(spark, sf_dir):
    """Version-1 payloads with known apps, device ids by platform, accounts' rules of user ids, and the device map."""
    none, user, sub = F.lit(None).cast("string"), F.col("user_id").cast("string"), F.col("subtype")
    kind = F.when(sub == "view", "50").when(sub == "click", "30").when(sub == "signup", "20").when(sub == "purchase", "40").otherwise("99")
    e = F.struct("time", F.col("event_id").cast("string").alias("id"), kind.alias("type"), F.when(sub == "signup", "3").when(sub.isin("view", "click"), "1").alias("sub_type"), F.lit("t").alias("title"), none.alias("data"), (F.col("time") - 1000).alias("open_time"), F.when(sub == "click", "1,2").alias("x_y"))
    device = F.struct(F.lpad(user, 15, "1").alias("imei"), F.concat(F.lit("a"), user).alias("android_id"))
    common = F.struct(
        F.concat(F.lit("com."), "appid").alias("app_identifier"), F.lit("1").alias("app_version"), F.lit("os").alias("os_name"), F.lit("9").alias("os_version"), F.concat(F.lit("M"), (F.col("user_id") % 3).cast("string")).alias("device_model"),
        F.lit("wifi").alias("net_type"), F.concat_ws("x", "sw", "sh").alias("xy_screen"), F.concat(F.lit("0A:"), user).alias("mac_id"), records._idfa().alias("device_uuid"), device.alias("device_info"),
    )
    body = F.to_json(F.struct(common.alias("common"), F.concat(F.when(F.col("user_id") % 3 == 0, "m").otherwise("u"), user).alias("wj_uid"), F.array(e).alias("events")))
    apps = spark.createDataFrame([("com.1200", "a1200", "ios", 1), ("com.1201", "a1201", "android", 2), ("com.1202", "w1202", "web", 1)], "identifier string, appid string, platform string, account int")
    accounts = spark.createDataFrame([(1, 3, "m"), (2, 5, "^u[0-9]*1$")], "account int, kind int, rule string")
    out = clean.mobile_v1(events(spark, sf_dir).select("ip", "time", body.alias("json")), apps, accounts)
    return out.select(F.col("pageid").cast("long").alias("event_id"), "appid", F.when(F.length("uuid") == 32, F.col("uuid")).alias("uuid"), "userid", profile.listed(F.col("device")).alias("device"), "status")


@query("status_names", f"""WITH {EV}, s AS (SELECT CASE WHEN appid IN ('1203', '1204') THEN 107 WHEN appid = '1202' OR subtype = 'error' THEN 404 ELSE 200 END AS status FROM ev)
SELECT status, CASE status WHEN 107 THEN 'unknown app' WHEN 404 THEN 'not known' ELSE 'good' END AS says, count(*) AS n FROM s GROUP BY ALL""")
def status_names(spark, sf_dir):
    """What the statuses of version-1 lines say."""
    return reports.status_histogram(clean_mobile_known(spark, sf_dir)).select("status", clean.status_name(F.col("status")).alias("says"), "n")


# --- profiles ----------------------------------------------------------------------------------------------------------

TAGS_SQL = f"""tg AS (SELECT platform, pkg, 't' || pkg % 6 AS tag, CASE WHEN pkg % 2 = 0 THEN 0.5 ELSE -0.25 END AS sex_weight FROM (SELECT DISTINCT platform, pkg FROM ai)),
tp AS (SELECT uuid, tag, count(*) AS n, sum(sex_weight) AS sex_weight FROM ai JOIN tg USING (platform, pkg) GROUP BY ALL),
th AS (SELECT uuid, bool_or(tag = 't0') AS t0, bool_or(tag = 't1') AS t1, bool_or(tag = 't2') AS t2 FROM tp GROUP BY uuid),
tk AS (SELECT tp.* REPLACE (md5(CAST(tp.uuid AS VARCHAR)) AS uuid) FROM tp JOIN th USING (uuid) WHERE NOT (tag = 't1' AND t0) AND NOT (tag = 't2' AND t1 AND NOT t0) AND NOT (tag = 't3' AND t2 AND NOT (t1 AND NOT t0)))"""


def _app_tags(spark, sf_dir) -> DataFrame:
    """Tags of apps; a customer's orders stand for the apps of the user of that number."""
    return people.app_tag_profile(spark, sf_dir).withColumn("uuid", F.md5(F.col("uuid").cast("string")))


def _profiles(spark, sf_dir) -> DataFrame:
    e, days = events(spark, sf_dir), profile.habit_day(visited(spark, sf_dir))
    habits = profile.habit_summary(days, TODAY)
    areas = lookup.ip_area(reports.most_frequent(e, "uuid", "ip").select("uuid", "ip"), ranges(spark, sf_dir)).select("uuid", "country", "province", "city")
    return profile.whole_profiles(state.devices(e).drop("apps"), habits, profile.label_sum(label_days(spark, sf_dir), TODAY), areas, _app_tags(spark, sf_dir))


@query("user_profile", f"""WITH {LABEL_SUM_SQL.replace(EV, AREA_SQL)}, {MAPS_SQL}, {APPS_SQL}, {TAGS_SQL},
dv AS (SELECT uuid, min(time) AS first_time, max(time) AS last_time, arg_min(system, (time, event_id)) AS system, CAST(max(acc) AS INTEGER) AS acc, count(DISTINCT {DAY}) AS active_days, count(DISTINCT {DAY}) FILTER (WHERE {DAY} > {TODAY} - 7) AS active_week, count(DISTINCT appid) AS apps FROM ev GROUP BY uuid),
sl AS (SELECT uuid, CAST((time + 28800000) % 86400000 // 1800000 AS INTEGER) AS slot, count(*) AS n FROM ev GROUP BY ALL), bs AS (SELECT uuid, arg_min(slot, (-n, slot)) AS busiest FROM sl GROUP BY uuid),
hm AS (SELECT uuid, events, ips FROM {_maps_sql('uuid', name="CASE WHEN of = 'events' THEN appid || '#' || k ELSE k END")}),
lm AS (SELECT uuid, string_agg(name || '=' || CAST(CAST(value AS DECIMAL(18, 4)) AS VARCHAR), ',' ORDER BY name) AS labels FROM (SELECT uuid, name, round(sum(value), 4) AS value FROM ls GROUP BY ALL) GROUP BY uuid),
tm AS (SELECT uuid, string_agg(tag || '=' || n, ',' ORDER BY tag) AS app_tags, CAST(sum(sex_weight) AS DOUBLE) AS sex FROM tk GROUP BY uuid),
ic AS (SELECT uuid, ip, count(*) AS n FROM ev GROUP BY ALL), mi AS (SELECT uuid, arg_min(ip, (-n, ip)) AS ip FROM ic GROUP BY uuid), ia AS (SELECT DISTINCT ip, country, province, city FROM ar)
SELECT uuid, first_time, last_time, system, acc, active_days, active_week, apps, busiest, events, ips, coalesce(labels, '') AS labels, coalesce(app_tags, '') AS app_tags, sex, country, province, city
FROM dv JOIN bs USING (uuid) JOIN hm USING (uuid) LEFT JOIN lm USING (uuid) LEFT JOIN tm USING (uuid) LEFT JOIN mi USING (uuid) LEFT JOIN ia USING (ip)""")
def user_profile(spark, sf_dir):
    """Devices with their record, habits over all apps, labels of all companies, app tags and area."""
    p = _profiles(spark, sf_dir)
    labels = F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat_ws("=", e["key"], F.format_string("%.4f", F.round(e["value"], 4)))), ","), F.lit(""))
    texts = {m: profile.listed(F.col(m)) for m in ("events", "ips", "app_tags")}
    return p.withColumns({**texts, "labels": labels}).select("uuid", "first_time", "last_time", "system", "acc", "active_days", "active_week", "apps", "busiest", "events", "ips", "labels", "app_tags", "sex", "country", "province", "city")


@query("profile_short", f"WITH {EV}, {APPS_SQL}, {TAGS_SQL}, c AS (SELECT uuid, CASE WHEN any_value(user_id) % 7 = 0 THEN NULL ELSE CAST(count(*) AS INTEGER) - 60 END AS level FROM ev GROUP BY uuid), k AS (SELECT uuid, string_agg(tag, ',' ORDER BY n DESC, tag) AS tag_keys, string_agg(CAST(n AS VARCHAR), ',' ORDER BY n DESC, tag) AS tag_values, sum(sex_weight) AS sex FROM tk GROUP BY uuid)\nSELECT uuid, tag_keys, tag_values, CAST(CASE WHEN sex > 0 THEN 2 WHEN sex < 0 THEN 1 ELSE 0 END AS INTEGER) AS sex_code, CAST(coalesce(trunc(level / 2.0), 0) AS INTEGER) AS consumption FROM k JOIN c USING (uuid)")
def profile_short(spark, sf_dir):
    """The short form of profiles: tags as lists, sex as a code, consumption halved."""
    tags = _app_tags(spark, sf_dir).groupBy("uuid").agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("tags"), F.sum("sex_weight").alias("sex"))
    level = events(spark, sf_dir).groupBy("uuid").agg(F.when(F.min("user_id") % 7 == 0, F.lit(None).cast("int")).otherwise(F.count("*").cast("int") - 60).alias("consumption"))
    out = profile.short_form(tags.join(level, "uuid"), "tags", "sex", "consumption")
    return out.select("uuid", F.array_join("tag_keys", ",").alias("tag_keys"), F.array_join(F.transform("tag_values", lambda x: x.cast("string")), ",").alias("tag_values"), "sex_code", "consumption")


@query("label_days_stored", f"WITH {LABEL_SUM_SQL} SELECT uuid, company_id, name, round(value, 6) AS value FROM ls")
def label_days_stored(spark, sf_dir):
    """Label records stored by day, one day of them written twice, and the sums rebuilt from what is stored."""
    path, days = _own(spark, "label-days"), label_days(spark, sf_dir)
    tables.write_day(days, path, "day")
    tables.write_day(days.where(F.col("day") == TODAY - 3), path, "day")
    stored = spark.read.schema(days.schema).parquet(path)
    return profile.label_sum(stored, TODAY).withColumn("value", F.round("value", 6))


@query("app_label_sum", f"WITH {PAGE_LABEL_SQL} SELECT uuid, name, round(sum((times * 0.3::DOUBLE + stay / 10000::DOUBLE * 0.7::DOUBLE) * 1.5::DOUBLE), 6) AS value FROM pl GROUP BY ALL")
def app_label_sum(spark, sf_dir):
    """Label values by the formula of apps."""
    value = scalars.app_label_value(F.col("times"), F.col("stay"), F.col("weight"), F.col("base_weight"))
    return label_days(spark, sf_dir).groupBy("uuid", "name").agg(F.round(F.sum(value), 6).alias("value"))


# --- pages, keywords and items -----------------------------------------------------------------------------------------

#: Where visitors come from: engines with words in the clear, in a parameter of lower rank, as an id, in GBK, or hidden.
REFS = ["https://www.baidu.com/s?wd=big%20", "https://www.sogou.com/web?query=red%20", "https://www.so.com/s?q=new%20", "https://cn.bing.com/search?pq=old%20", "https://m.sm.cn/s?q=hot%20", "https://www.google.com/search?q=no%20", "https://www.baidu.com/link?eqid=e", "https://shop.example.com/a?q=own%20"]


@query("browse_log", f"""WITH {EV}, r AS (SELECT event_id, event_id % 8 AS w, pageid FROM ev)
SELECT event_id, CASE w WHEN 0 THEN 'baidu' WHEN 1 THEN 'sogou' WHEN 6 THEN 'baidu' WHEN 7 THEN 'shop' ELSE 'web' END AS source,
 CASE w WHEN 0 THEN 'big ' || pageid WHEN 1 THEN 'red ' || pageid WHEN 2 THEN 'new ' || pageid WHEN 3 THEN 'old ' || pageid WHEN 4 THEN 'hot ' || pageid WHEN 6 THEN CASE WHEN pageid <= 40 THEN 'part ' || pageid ELSE 'e' || pageid END END AS keyword FROM r""")
def browse_log(spark, sf_dir):
    """Views with their source and the words they were found by; one engine's words come from a table of ids."""
    start = F.get(F.array(*[F.lit(x) for x in REFS]), (F.col("event_id") % 8).cast("int"))
    views = events(spark, sf_dir).withColumn("ref", F.concat(start, F.col("pageid").cast("string")))
    eqids = table(spark, sf_dir, "part").where("p_partkey <= 40").select(F.concat(F.lit("e"), F.col("p_partkey").cast("string")).alias("eqid"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("keyword"))
    sources = [(1, "baidu.com", "baidu"), (1, "sogou.com", "sogou"), (5, "^https?://shop[.]", "shop"), (3, "http", "web")]
    return documents.browse_log(views, sources, eqids).select("event_id", "source", "keyword")


@query("visit_documents", f"""WITH {VISIT_SQL.replace(EV, AREA_SQL)}, v AS (SELECT appid, uuid, visitindex, min(time) AS start, max(time) AS "end", CAST(sum(staytime) AS BIGINT) AS stay, arg_min(ip, (time, event_id)) AS ip, arg_min(channel, (time, event_id)) AS ref,
 string_agg(pageid || ':' || CAST(staytime AS BIGINT), ',' ORDER BY time, event_id) FILTER (WHERE logtype = '50') AS pages, string_agg(subtype, ',' ORDER BY time, event_id) FILTER (WHERE logtype <> '50') AS others FROM wv GROUP BY appid, uuid, visitindex),
a AS (SELECT DISTINCT ip, country, province, city FROM ar)
SELECT appid || '#' || uuid || '#' || visitindex || '#' || start AS key, "end", stay, ip, ref, coalesce(pages, '') AS pages, coalesce(others, '') AS others, country, province, city FROM v JOIN a USING (ip)""")
def visit_documents(spark, sf_dir):
    """Visits as JSON documents with the area of their address; the documents are read back here."""
    docs = documents.visit_documents(sessions.visits(visited(spark, sf_dir)), ranges(spark, sf_dir))
    kind = "end bigint, stay bigint, ip string, ref string, pages array<struct<pageid:bigint,stay:bigint>>, events array<struct<type:string>>, country string, province string, city string"
    d = docs.select("key", F.from_json("doc", kind).alias("d")).select("key", "d.*")
    pages = F.array_join(F.transform("pages", lambda p: F.concat_ws(":", p["pageid"].cast("string"), p["stay"].cast("string"))), ",")
    return d.select("key", "end", "stay", "ip", "ref", F.coalesce(pages, F.lit("")).alias("pages"), F.coalesce(F.array_join(F.transform("events", lambda e: e["type"]), ","), F.lit("")).alias("others"), "country", "province", "city")


@query("item_matches", f"""WITH {EV} SELECT event_id, CASE WHEN subtype = 'click' THEN 'photo' WHEN subtype = 'view' AND pageid % 2 = 0 THEN 'even' ELSE 'case' END AS item_type, CAST(CASE WHEN subtype = 'click' THEN 'p' || pageid ELSE CAST(pageid AS VARCHAR) END AS VARCHAR) AS item_id
FROM ev WHERE subtype IN ('click', 'view', 'signup') AND NOT (subtype = 'signup' AND event_id % 3 = 0)""")
def item_matches(spark, sf_dir):
    """The item of events: the heaviest rule that holds says where its id is, by a regex or by a path."""
    rules = spark.createDataFrame([(1, "a", 1, "click", 5, "photo", 1, "id=(p[0-9]+)"), (2, "a", 4, "view-even", 9, "even", 2, "$.it.id"), (3, "a", 3, "view", 3, "case", 2, "$.it.id"), (4, "a", 7, "signup-some", 1, "case", 2, "$.it.id"), (5, "a", 1, "error", 1, "none", 1, "no (id) here")], "id int, site string, rType int, rules string, weight int, item_type string, data_type int, data_rule string")
    rules = rules.withColumn("name", F.col("item_type"))
    what = F.when(F.col("subtype") == "view", F.concat_ws("-", "subtype", F.when(F.col("pageid") % 2 == 0, "even").otherwise("odd"))).when(F.col("subtype") == "signup", F.concat_ws("-", "subtype", F.when(F.col("event_id") % 3 == 0, "none").otherwise("some"))).otherwise(F.col("subtype"))
    data = F.when(F.col("subtype") == "click", F.concat(F.lit("x?id=p"), F.col("pageid").cast("string"), F.lit("&y"))).otherwise(F.to_json(F.struct(F.struct(F.col("pageid").alias("id")).alias("it"))))
    rows = events(spark, sf_dir).select("event_id", F.lit("a").alias("site"), what.alias("what"), data.alias("data"))
    return lookup.items(rows, rules, "what", "data", ["site"], ["event_id"]).select("event_id", "item_type", "item_id")


@query("similar_lists", offers.SQL["item_cosine"].replace("SELECT a, b, round(", "SELECT CASE WHEN dot / sqrt(x.sq * y.sq) >= 0.5 THEN 'near' ELSE 'far' END AS list, a, b, round("))
def similar_lists(spark, sf_dir):
    """Pairs of similar items in two lists: from 0.5 on, and from 0.2 on."""
    near = recommend.cosine(offers.stored_ratings(spark, sf_dir))
    return near.select(F.when(F.col("similarity") >= 0.5, "near").otherwise("far").alias("list"), "a", "b", F.round("similarity", 6).alias("similarity"))


# --- reports -----------------------------------------------------------------------------------------------------------


@query("query_costs", f"""WITH {EV} SELECT CAST(date_trunc('day', ts) AS DATE) AS day, appid AS account, 'q ' || pageid AS query, pageid AS keyword_id, event_id AS creative_id, CAST(event_id % 5 AS BIGINT) AS shown, CAST(event_id % 2 AS BIGINT) AS clicked, round(ev.value, 4) AS cost, CASE WHEN event_id % 5 > 0 THEN round((event_id % 2) / (event_id % 5)::DOUBLE, 6) END AS rate
FROM ev JOIN (SELECT event_id, ts FROM events) USING (event_id) WHERE event_id % 11 > 0""")
def query_costs(spark, sf_dir):
    """Query rows of ad reports that landed as JSON lines of a day and account."""
    path = _own(spark, "ads")
    e = events(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", F.to_date("ts").cast("string").alias("day")), "event_id")
    q = F.struct(F.when(F.col("event_id") % 11 == 0, " ").otherwise(F.concat(F.lit("q "), F.col("pageid").cast("string"))).alias("query"), F.col("pageid").alias("keyword_id"), F.col("event_id").alias("creative_id"), (F.col("event_id") % 5).alias("shown"), (F.col("event_id") % 2).alias("clicked"), F.col("value").alias("cost"))
    e.groupBy("day", F.col("appid").alias("account")).agg(F.collect_list(q).alias("queries")).select(F.to_json(F.struct("day", "account", "queries")).alias("value")).write.text(path)
    return documents.query_costs(spark.read.text(path)).withColumns({"cost": F.round("cost", 4), "rate": F.round("rate", 6)})


@query("lead_report", f"WITH {EV} SELECT {DAY} AS day, appid, uuid, time, 'n' || pageid AS name, '13' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS phone FROM ev WHERE subtype = 'purchase'")
def lead_report(spark, sf_dir):
    """Leads stored by day; a day that is loaded again replaces itself."""
    path = _own(spark, "leads")
    data = F.to_json(F.struct(F.concat(F.lit("n"), F.col("pageid").cast("string")).alias("name"), F.concat(F.lit("13"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("phone")))
    e = events(spark, sf_dir).withColumn("data", data).withColumn("subtype", F.when(F.col("subtype") == "purchase", clean.LEAD).otherwise(F.col("subtype")))
    found = clean.leads(e).select("appid", "uuid", "time", "name", "phone", scalars.day_number(F.col("time")).alias("day"))
    tables.write_day(found, path, "day")
    tables.write_day(found.where(F.col("day") == TODAY), path, "day")
    return spark.read.schema(found.schema).parquet(path)


@query("stamped_flow", f"WITH {EV} SELECT DATE '2024-01-10' AS log_date, 'all' AS channel, appid, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY appid")
def stamped_flow(spark, sf_dir):
    """Flow with the columns that every report carries: its date, and `all` for the channel, by the registered SQL functions."""
    scalars.register(spark)
    flow = events(spark, sf_dir).groupBy("appid").agg(F.count("*").alias("n"))
    return flow.withColumn("_time", F.expr("log_time()")).where("_time is not null").select(F.lit("2024-01-10").cast("date").alias("log_date"), F.expr("every_channel()").alias("channel"), "appid", "n")


@query("jdbc_dimension", "SELECT n_nationkey AS id, n_name AS name, CAST(n_nationkey % 4 AS INTEGER) AS weight FROM nation WHERE n_nationkey % 3 > 0")
def jdbc_dimension(spark, sf_dir):
    """A dimension in a JDBC table, without its inactive rows."""
    url, driver = f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), (F.col("n_nationkey") % 4).cast("int").alias("weight"), (F.col("n_nationkey") % 3 > 0).cast("int").alias("active"))
    tables.append_jdbc(n, url, "source", driver=driver)
    return tables.dimension(spark, "source", url=url, driver=driver).select("id", "name", "weight")


# --- chats -------------------------------------------------------------------------------------------------------------


@query("chat_stream", "SELECT conv_id, turn, CAST(role = 'user' AS INTEGER) AS from_user, sha256(coalesce(text, '')) AS said FROM conversations")
def chat_stream(spark, sf_dir):
    """Chat lines as a stream, cleaned and appended to a store as they come."""
    c = spark.readStream.schema(table(spark, sf_dir, "conversations").schema).parquet(f"{sf_dir}/conversation[s].parquet")
    body = F.to_json(F.struct(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("client_id"), F.lit("shop").alias("customer"), F.when(F.col("role") == "user", 1).otherwise(0).alias("from_type"), F.col("turn").alias("time"), F.lit("a long enough source text, so that no line is dropped for being short").alias("source"), F.base64(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("content")))
    lines = c.select(F.concat(F.lit('10.0.0.1 - - ""'), body, F.lit(' EOF"')).alias("value"))
    stored = flows.run_to_end(clean.chat_lines(lines).where("status = 200"), folder(spark))
    return stored.select(F.substring("client_id", 2, 20).cast("long").alias("conv_id"), F.col("time").cast(table(spark, sf_dir, "conversations").schema["turn"].dataType).alias("turn"), F.col("from_type").alias("from_user"), F.sha2(F.unbase64("content"), 256).alias("said"))


# --- coordinates -------------------------------------------------------------------------------------------------------

@query("wgs_to_bd", f"""WITH {people.POINT_SQL}, p AS (SELECT DISTINCT lon, lat FROM pt), v AS (SELECT *, lon - 105.0 AS x, lat - 35.0 AS y, lat / 180.0 * pi() AS rad FROM p),
d AS (SELECT *, (20.0 * sin(x * 6.0 * pi()) + 20.0 * sin(x * 2.0 * pi())) * 2.0 / 3.0 AS common, 1 - 0.00669342162296594323 * sin(rad) * sin(rad) AS magic FROM v),
g AS (SELECT lon, lat, lat + (-100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * sqrt(abs(x)) + common + (20.0 * sin(y * pi()) + 40.0 * sin(y / 3.0 * pi())) * 2.0 / 3.0 + (160.0 * sin(y / 12.0 * pi()) + 320.0 * sin(y / 30.0 * pi())) * 2.0 / 3.0) * 180.0 / (6378245.0 * (1 - 0.00669342162296594323) / (magic * sqrt(magic)) * pi()) AS gy,
 lon + (300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * sqrt(abs(x)) + common + (20.0 * sin(x * pi()) + 40.0 * sin(x / 3.0 * pi())) * 2.0 / 3.0 + (150.0 * sin(x / 12.0 * pi()) + 300.0 * sin(x / 30.0 * pi())) * 2.0 / 3.0) * 180.0 / (6378245.0 / sqrt(magic) * cos(rad) * pi()) AS gx FROM d),
b AS (SELECT *, sqrt(gx * gx + gy * gy) + 0.00002 * sin(gy * 3.14159265358979324 * 3000.0 / 180.0) AS r, atan2(gy, gx) + 0.000003 * cos(gx * 3.14159265358979324 * 3000.0 / 180.0) AS a FROM g)
SELECT round(lon, 6) AS lon, round(lat, 6) AS lat, round(gx, 6) AS gcj_lon, round(gy, 6) AS gcj_lat, round(r * cos(a) + 0.0065, 6) AS bd_lon, round(r * sin(a) + 0.006, 6) AS bd_lat, true AS comes_back FROM b""")
def wgs_to_bd(spark, sf_dir):
    """Satellite coordinates as the two map systems have them; the way back from the second comes near the first."""
    p = people.points(spark, sf_dir).select("lon", "lat").distinct()
    x, y = scalars.wgs_to_gcj(F.col("lon"), F.col("lat"))
    p = p.withColumns({"gx": x, "gy": y})
    bx, by = scalars.gcj_to_bd(F.col("gx"), F.col("gy"))
    p = p.withColumns({"bx": bx, "by": by})
    ox, oy = scalars.bd_to_gcj(F.col("bx"), F.col("by"))
    back = (F.abs(ox - F.col("gx")) < 1e-5) & (F.abs(oy - F.col("gy")) < 1e-5)
    return p.select(F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round("gx", 6).alias("gcj_lon"), F.round("gy", 6).alias("gcj_lat"), F.round("bx", 6).alias("bd_lon"), F.round("by", 6).alias("bd_lat"), back.alias("comes_back"))

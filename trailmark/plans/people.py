"""Queries about people: habits, labels, devices, profiles, probes, places, leads and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions import scalars
from trailmark.operators import clean, lookup, places, probe, profile, reports, sessions, state
from trailmark.plans.adapt import DAY, EV, events, table
from trailmark.plans.traffic import AREA_SQL, HOST, VIEWS, VISIT_SQL, ranges, views, visited

Q, SQL = {}, {}
TODAY = 19750 + 9  # within the table's days


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


# --- habits ----------------------------------------------------------------------------------------------------------

HABIT_SQL = f"""{VISIT_SQL}, hb AS (SELECT uuid, appid, {DAY} AS day, CAST(max(visitindex) AS BIGINT) AS visit, count(*) FILTER (WHERE logtype = '50') AS page, CAST(sum(staytime) AS BIGINT) AS stay, CAST(max(CASE WHEN subtype = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS lead FROM wv GROUP BY ALL)"""


#: Counts of a key as text, in order: events, half hours and addresses of a day's habit.
MAPS_SQL = f"""hd AS (SELECT uuid, appid, {DAY} AS day, unnest([('events', CASE WHEN logtype <> '50' THEN subtype END), ('times', CAST((time + 28800000) % 86400000 // 1800000 AS VARCHAR)), ('ips', ip)]) AS x FROM ev),
hc AS (SELECT uuid, appid, day, x[1] AS of, x[2] AS k, count(*) AS n FROM hd WHERE x[2] IS NOT NULL GROUP BY ALL)"""


def _maps_sql(keys: str, where: str = "true", name: str = "k") -> str:
    """The maps of MAPS_SQL added up by keys."""
    of = lambda m: f"coalesce(string_agg(k || '=' || n, ',' ORDER BY k) FILTER (WHERE of = '{m}'), '') AS {m}"
    return f"(SELECT {keys}, {of('events')}, {of('times')}, {of('ips')} FROM (SELECT {keys}, of, {name} AS k, sum(n) AS n FROM hc WHERE {where} GROUP BY ALL) GROUP BY ALL)"


def _listed(habits: DataFrame, *maps: str) -> DataFrame:
    return habits.withColumns({m: profile.listed(F.col(m)) for m in maps})


@query("habit_day", f"WITH {HABIT_SQL}, {MAPS_SQL} SELECT hb.*, events, times, ips FROM hb JOIN {_maps_sql('uuid, appid, day')} USING (uuid, appid, day)")
def habit_day(spark, sf_dir):
    return _listed(profile.habit_day(visited(spark, sf_dir)).withColumn("stay", F.col("stay").cast("long")), *profile.HABIT_MAPS)


@query("habit_60d", f"""WITH {HABIT_SQL}, {MAPS_SQL}, n AS (SELECT uuid, appid, CAST(sum(visit) AS BIGINT) AS visit, CAST(sum(page) AS BIGINT) AS page, CAST(sum(stay) AS BIGINT) AS stay, max(lead) AS lead, count(DISTINCT day) AS active_days FROM hb WHERE day BETWEEN {TODAY} - 59 AND {TODAY} - 1 GROUP BY ALL)
SELECT n.*, events, times, ips FROM n JOIN {_maps_sql('uuid, appid', f'day BETWEEN {TODAY} - 59 AND {TODAY} - 1')} USING (uuid, appid)""")
def habit_60d(spark, sf_dir):
    return _listed(profile.habit_window(profile.habit_day(visited(spark, sf_dir)), TODAY).withColumn("stay", F.col("stay").cast("long")), *profile.HABIT_MAPS)


@query("habit_summary", f"""WITH {EV}, {MAPS_SQL}, d AS (SELECT uuid, appid, {DAY} AS day, CAST((time + 28800000) % 86400000 // 1800000 AS INTEGER) AS slot FROM ev),
s AS (SELECT uuid, slot, count(*) AS n FROM d GROUP BY ALL), b AS (SELECT uuid, arg_min(slot, (-n, slot)) AS busiest FROM s GROUP BY uuid),
a AS (SELECT uuid, count(DISTINCT day) AS active_days, count(DISTINCT day) FILTER (WHERE day > {TODAY} - 7) AS active_week, count(DISTINCT appid) AS apps, any_value(busiest) AS busiest FROM d JOIN b USING (uuid) GROUP BY uuid)
SELECT a.*, events, ips FROM a JOIN {_maps_sql('uuid', name="CASE WHEN of = 'events' THEN appid || '#' || k ELSE k END")} USING (uuid)""")
def habit_summary(spark, sf_dir):
    return _listed(profile.habit_summary(profile.habit_day(visited(spark, sf_dir)), TODAY), "events", "ips")


# --- labels: rules on page titles, which here are part names ------------------------------------------------------------

RULES = [(1, 1, "red", "red things"), (2, 3, "small", "small things"), (3, 4, "bolt", "bolts"), (4, 5, "(widget|gear)$", "machines"), (5, 7, "blue ring", "blue ring")]
RULE_SQL = "(VALUES " + ", ".join(f"({i}, {k}, '{r}', '{n}')" for i, k, r, n in RULES) + ") AS ru(rule_id, kind, rule, rule_name)"
HOLDS_SQL = "CASE kind WHEN 1 THEN contains(title, rule) WHEN 2 THEN NOT contains(title, rule) WHEN 3 THEN starts_with(title, rule) WHEN 4 THEN ends_with(title, rule) WHEN 5 THEN regexp_matches(title, rule) WHEN 7 THEN title = rule ELSE false END"
LABEL_SQL = f"""{VISIT_SQL}, te AS (SELECT wv.*, p_name AS title, CAST(user_id % 5 // 3 AS INTEGER) AS company_id, {DAY} AS day FROM wv JOIN part ON pageid = p_partkey),
ma AS (SELECT te.*, rule_id, rule_name FROM te, {RULE_SQL} WHERE {HOLDS_SQL})"""


def titled(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), F.col("p_name").alias("title"))
    company = F.floor(F.col("user_id") % 5 / 3).cast("int")
    return visited(spark, sf_dir).join(p, "pageid").withColumn("company_id", company).withColumn("day", scalars.day_number(F.col("time")))


def label_rules(spark) -> DataFrame:
    rows = [(i, k, r, n, 10 - i, c) for i, k, r, n in RULES for c in (0, 1)]
    return spark.createDataFrame(rows, "id int, rType int, rules string, name string, weight int, company_id int")


def matched(spark, sf_dir) -> DataFrame:
    return lookup.rules_matching(titled(spark, sf_dir), label_rules(spark), "title", ["company_id"])


@query("rule_all_match", f"WITH {LABEL_SQL} SELECT rule_id, rule_name, CAST(count(*) AS BIGINT) AS n FROM ma GROUP BY ALL")
def rule_all_match(spark, sf_dir):
    return matched(spark, sf_dir).groupBy("rule_id", "rule_name").agg(F.count("*").alias("n"))


@query("rule_first_match", f"WITH {LABEL_SQL}, fi AS (SELECT event_id, min(rule_id) AS rule_id FROM ma GROUP BY 1) SELECT te.event_id, fi.rule_id FROM te LEFT JOIN fi USING (event_id)")
def rule_first_match(spark, sf_dir):
    return lookup.first_rule(titled(spark, sf_dir), label_rules(spark), "title", ["company_id"], ["event_id"]).select("event_id", "rule_id")


PAGE_LABEL_SQL = f"""{LABEL_SQL}, pl AS (SELECT uuid, company_id, day, rule_name AS name, count(*) AS times, sum(staytime) AS stay FROM ma WHERE logtype = '50' GROUP BY ALL
UNION ALL SELECT uuid, company_id, day, '_sf_liveness', count(*), sum(staytime) FROM te WHERE logtype = '50' GROUP BY ALL)"""


@query("label_page", f"WITH {PAGE_LABEL_SQL} SELECT uuid, company_id, name, CAST(sum(times) AS BIGINT) AS times, CAST(sum(stay) AS BIGINT) AS stay, 1.0::DOUBLE AS weight FROM pl GROUP BY ALL")
def label_page(spark, sf_dir):
    is_page = "logtype = '50'"
    return profile.page_labels(titled(spark, sf_dir).where(is_page), matched(spark, sf_dir).where(is_page)).withColumn("stay", F.col("stay").cast("long"))


@query("label_event", f"""WITH {LABEL_SQL}, el AS (SELECT uuid, company_id, rule_name AS name, 0 AS n FROM ma WHERE subtype = 'purchase' UNION ALL SELECT uuid, company_id, '_kw_' || title, 1 FROM te WHERE subtype = 'click'
UNION ALL SELECT uuid, company_id, '_sf_liveness', 1 FROM te WHERE subtype IN ('purchase', 'click')) SELECT uuid, company_id, name, CAST(sum(n) AS BIGINT) AS times, CAST(count(*) * 20000 AS BIGINT) AS stay, 5.0::DOUBLE AS weight FROM el GROUP BY ALL""")
def label_event(spark, sf_dir):
    return profile.event_labels(titled(spark, sf_dir), matched(spark, sf_dir), F.col("subtype") == "purchase", F.col("subtype") == "click", F.col("title"))


WEIGHT_SQL = f"{LABEL_SQL}, bw AS (SELECT uuid, company_id, appid, least(count(*), 200) / 200.0 + 0.5 * least(count(DISTINCT subtype), 10) / 10.0 + max(CASE WHEN subtype = 'purchase' THEN 0.4 ELSE 0 END) + max(CASE WHEN subtype = 'signup' THEN 0.3 ELSE 0 END) AS w FROM te GROUP BY ALL)"
BONUS = {"purchase": 0.4, "signup": 0.3}


@query("label_weight", f"WITH {WEIGHT_SQL} SELECT uuid, company_id, round(CAST(sum(w) AS DOUBLE), 6) AS base_weight FROM bw GROUP BY ALL")
def label_weight(spark, sf_dir):
    return profile.base_weight(titled(spark, sf_dir), BONUS).withColumn("base_weight", F.round("base_weight", 6))


def label_days(spark, sf_dir) -> DataFrame:
    t, m = titled(spark, sf_dir).where("logtype = '50'"), matched(spark, sf_dir).where("logtype = '50'")
    keys = ["uuid", "company_id", "day"]
    rules = m.groupBy(*keys, F.col("rule_name").alias("name")).agg(F.count("*").alias("times"), F.sum("staytime").alias("stay"))
    alive = t.groupBy(*keys).agg(F.count("*").alias("times"), F.sum("staytime").alias("stay")).withColumn("name", F.lit(profile.LIVENESS))
    return rules.unionByName(alive).withColumn("weight", F.lit(1.0)).withColumn("base_weight", F.lit(0.5))


LABEL_SUM_SQL = f"{PAGE_LABEL_SQL}, ls AS (SELECT uuid, company_id, name, sum((times * 0.7::DOUBLE + stay / 20000::DOUBLE * 0.3::DOUBLE) * 1.5::DOUBLE * (60 - ({TODAY} - day)) / 60::DOUBLE) AS value FROM pl WHERE day BETWEEN {TODAY} - 59 AND {TODAY} GROUP BY ALL HAVING value > 0.001)"


@query("label_sum_60d", f"WITH {LABEL_SUM_SQL} SELECT uuid, company_id, name, round(value, 6) AS value FROM ls")
def label_sum_60d(spark, sf_dir):
    return profile.label_sum(label_days(spark, sf_dir), TODAY).withColumn("value", F.round("value", 6))


@query("label_search", f"WITH {LABEL_SUM_SQL} SELECT uuid, round(max(value), 6) AS value FROM ls WHERE name = 'bolts' GROUP BY uuid")
def label_search(spark, sf_dir):
    return profile.with_label(profile.label_sum(label_days(spark, sf_dir), TODAY), "bolts").withColumn("value", F.round("value", 6))


# --- devices, identities, profiles -------------------------------------------------------------------------------------


@query("device_record", f"WITH {EV} SELECT uuid, min(time) AS first_time, max(time) AS last_time, arg_min(system, (time, event_id)) AS system, arg_min(sw, (time, event_id)) AS sw, arg_min(sh, (time, event_id)) AS sh, CAST(max(acc) AS INTEGER) AS acc, count(DISTINCT appid) AS apps FROM ev GROUP BY uuid")
def device_record(spark, sf_dir):
    return state.devices(events(spark, sf_dir))


@query("device_ids", f"WITH {EV}, i AS (SELECT uuid, 'ip' AS kind, ip AS id, time FROM ev UNION ALL SELECT uuid, 'user', CAST(user_id AS VARCHAR), time FROM ev) SELECT uuid, kind, id, min(time) AS first_time FROM i GROUP BY ALL")
def device_ids(spark, sf_dir):
    return state.device_ids(events(spark, sf_dir), {"ip": F.col("ip"), "user": F.col("user_id")})


@query("identity_resolve", """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'i' || c_custkey END AS imei, 's' || c_nationkey AS system_id FROM customer),
i AS (SELECT 'i' || c_custkey AS imei, md5('i' || c_custkey) AS uuid FROM customer WHERE c_custkey % 3 = 0), s AS (SELECT 's' || n_nationkey AS system_id, md5('s' || n_nationkey) AS uuid FROM nation WHERE n_nationkey % 2 = 0)
SELECT a.imei, a.system_id, coalesce(i.uuid, s.uuid) AS uuid FROM a LEFT JOIN i ON a.imei = i.imei LEFT JOIN s ON a.system_id = s.system_id""")
def identity_resolve(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.concat(F.lit("i"), F.col("c_custkey").cast("string"))
    asked = c.select(F.when(F.col("c_custkey") % 4 == 0, "").otherwise(key).alias("imei"), F.concat(F.lit("s"), F.col("c_nationkey").cast("string")).alias("system_id"))
    by_imei = c.where("c_custkey % 3 = 0").select(key.alias("imei"), F.md5(key).alias("uuid"))
    sid = F.concat(F.lit("s"), F.col("n_nationkey").cast("string"))
    return state.resolved(asked, by_imei, n.where("n_nationkey % 2 = 0").select(sid.alias("system_id"), F.md5(sid).alias("uuid")))[0]


@query("uuid_by_ip", f"WITH {EV} SELECT ip, array_to_string(list_sort(list_distinct(list(uuid))), ',') AS uuids FROM ev GROUP BY ip")
def uuid_by_ip(spark, sf_dir):
    return state.uuids_of(events(spark, sf_dir), "ip").withColumn("uuids", F.array_join("uuids", ","))


MOST_IP = f"{AREA_SQL}, ic AS (SELECT uuid, ip, count(*) AS n FROM ev GROUP BY ALL), mi AS (SELECT uuid, arg_min(ip, (-n, ip)) AS ip FROM ic GROUP BY uuid)"


@query("profile", f"""WITH {VISIT_SQL.replace(EV, AREA_SQL)}, ic AS (SELECT uuid, ip, count(*) AS n FROM ev GROUP BY ALL), mi AS (SELECT uuid, arg_min(ip, (-n, ip)) AS ip FROM ic GROUP BY uuid),
ia AS (SELECT DISTINCT ip, country, province FROM ar), hv AS (SELECT uuid, count(DISTINCT {DAY}) AS active_days, count(*) FILTER (WHERE logtype = '50') AS pages, min(time) AS first_time FROM wv GROUP BY uuid)
SELECT uuid, first_time, active_days, pages, country, province FROM hv LEFT JOIN mi USING (uuid) LEFT JOIN ia USING (ip)""")
def profile_(spark, sf_dir):
    e, v = events(spark, sf_dir), visited(spark, sf_dir)
    habits = v.groupBy("uuid").agg(F.countDistinct(scalars.day_number(F.col("time"))).alias("active_days"), F.count(F.when(sessions.is_page(), 1)).alias("pages"))
    areas = lookup.ip_area(reports.most_frequent(e, "uuid", "ip").select("uuid", "ip"), ranges(spark, sf_dir))
    labels = profile.label_sum(label_days(spark, sf_dir), TODAY)
    return profile.profiles(state.devices(e), habits, labels, areas).select("uuid", "first_time", "active_days", "pages", "country", "province")


AUDIENCE_SQL = f"""{EV}, au AS (SELECT uuid, count(*) AS n, count(*) FILTER (WHERE logtype = '50') AS pages, min(system) AS system, min(channel) AS channel, min(time) AS first_time, max(time) AS last_time, max(value) AS most, avg(value) AS mean,
 list_sort(list(DISTINCT subtype)) AS kinds, list_sort(list(DISTINCT browser)) AS browsers, min(sw) AS sw, max(sh) AS sh, max(acc) AS acc, count(DISTINCT {DAY}) AS days, any_value(p_name) AS title, any_value(p_brand) AS brand FROM ev LEFT JOIN part ON p_partkey = 1 + user_id % 50 GROUP BY uuid)"""


def audience(spark, sf_dir) -> DataFrame:
    """A row a device with what searches ask for."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("brand"))
    e = events(spark, sf_dir)
    e = e.join(p, F.col("p_partkey") == 1 + F.col("user_id") % 50, "left")
    kind = F.struct(F.col("subtype").alias("name"), F.count("*").over(W.partitionBy("uuid", "subtype")).alias("times"))
    return e.withColumn("kind", kind).groupBy("uuid").agg(
        F.count("*").alias("n"), F.count(F.when(sessions.is_page(), 1)).alias("pages"), F.min("system").alias("system"), F.min("channel").alias("channel"),
        F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.max("value").alias("most"), F.avg("value").alias("mean"),
        F.sort_array(F.collect_set("subtype")).alias("kinds"), F.sort_array(F.collect_set("browser")).alias("browsers"), F.min("sw").alias("sw"), F.max("sh").alias("sh"),
        F.max("acc").alias("acc"), F.countDistinct(scalars.day_number(F.col("time"))).alias("days"), F.min("title").alias("title"), F.min("brand").alias("brand"), F.collect_set("kind").alias("counts"),
    )


@query("audience_search", f"WITH {AUDIENCE_SQL} SELECT uuid, n, system FROM au WHERE n >= 50 AND n <= 90 AND system IN ('ios', 'android') AND most >= 50")
def audience_search(spark, sf_dir):
    return profile.search(audience(spark, sf_dir), n__min=50, n__max=90, system=["ios", "android"], most__min=50, uuid__has=None).select("uuid", "n", "system")


@query("audience_tree", f"""WITH {AUDIENCE_SQL}, c AS (SELECT uuid FROM ev GROUP BY uuid, subtype HAVING subtype = 'view' AND count(*) >= 12)
SELECT uuid, n, pages, channel FROM au WHERE n >= 20 AND pages BETWEEN 5 AND 40 AND system IN ('ios', 'android', 'windows') AND channel <> 'ch9' AND most > 20 AND mean < 90 AND list_contains(kinds, 'click')
 AND len(list_intersect(browsers, ['Chrome', 'UC'])) > 0 AND len(list_intersect(kinds, ['view', 'signup'])) = 2 AND sw IS NOT NULL AND acc = 1 AND len(kinds) BETWEEN 3 AND 5 AND days > 3 AND brand NOT IN ('Brand#99')
 AND ((contains(title, ' ') AND starts_with(brand, 'Brand#')) OR sh >= 1900)
 AND NOT (channel = 'ch3' AND system = 'ios') AND (uuid IN (FROM c) OR (last_time >= {(TODAY - 1) * 86_400_000} AND (first_time < {(TODAY + 5) * 86_400_000} OR sh < 500)))""")
def audience_tree(spark, sf_dir):
    """Some twenty conditions over devices: ranges, lists, phrases, flags, elements, alternatives and exclusions."""
    asked = {
        "n__min": 20, "pages__between": (5, 40), "system": ["ios", "android", "windows"], "channel__isnt": "ch9", "most__above": 20, "mean__below": 90, "kinds__holds": "click",
        "browsers__some": ["Chrome", "UC"], "kinds__every": ["view", "signup"], "sw__known": True, "acc": 1, "kinds__sized": (3, 5), "days__above": 3, "brand__none": ["Brand#99"], "title__has": None,
        "and": [{"or": [{"title__has": " ", "brand__begins": "Brand#"}, {"sh__min": 1900}]}, {"not": {"channel": "ch3", "system": "ios"}}],
        "or": [{"each": {"counts": {"name": "view", "times__min": 12}}}, {"last_time__min": (TODAY - 1) * scalars.DAY_MS, "or": [{"first_time__below": (TODAY + 5) * scalars.DAY_MS}, {"sh__below": 500}]}],
    }
    return profile.search(audience(spark, sf_dir), asked).select("uuid", "n", "pages", "channel")


FEATURE_SQL = f"""{VISIT_SQL}, ft AS (SELECT uuid, greatest(0, {TODAY} + 20 - min({DAY})) AS tenure, count(*) FILTER (WHERE logtype = '50') AS pages, count(*) FILTER (WHERE pageid % 10 = 0) AS special, sum(staytime) / 1000.0::DOUBLE AS stay, max(CASE WHEN subtype = 'purchase' THEN 1 ELSE 0 END) AS actions, count(DISTINCT {DAY}) AS days FROM wv GROUP BY uuid)"""


@query("potential_user", f"""WITH {FEATURE_SQL} SELECT uuid, CAST(tenure AS BIGINT) AS tenure, CAST(CASE WHEN tenure <= 7 THEN 1 WHEN tenure <= 31 THEN CAST((pages > 153 OR special >= 44 OR stay >= 3) AND actions <> 0 AND days >= 4 AS INTEGER)
 WHEN tenure <= 92 THEN CAST((pages > 172 OR special >= 50 OR stay >= 4.2) AND actions <> 0 AND days >= 5 AS INTEGER) ELSE 0 END AS INTEGER) AS potential FROM ft""")
def potential_user(spark, sf_dir):
    v = visited(spark, sf_dir)
    day = scalars.day_number(F.col("time"))
    ft = v.groupBy("uuid").agg(F.greatest(F.lit(0).cast("long"), TODAY + 20 - F.min(day)).alias("tenure"), F.count(F.when(sessions.is_page(), 1)).alias("pages"), F.count(F.when(F.col("pageid") % 10 == 0, 1)).alias("special"), (F.sum("staytime") / 1000.0).alias("stay"), F.countDistinct(day).alias("days"))
    return profile.potential(ft.join(profile.flags(v, {"actions": F.col("subtype") == "purchase"}), "uuid")).select("uuid", "tenure", "potential")


# --- installed apps: parts that customers ordered ----------------------------------------------------------------------

APPS_SQL = "ap AS (SELECT c_nationkey % 2 + 1 AS platform, o_custkey AS uuid, l_partkey % 200 AS pkg, o_orderdate AS time FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey), ai AS (SELECT DISTINCT platform, uuid, pkg FROM ap)"


def app_list(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("uuid"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("time"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uuid"), (F.col("c_nationkey") % 2 + 1).alias("platform"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 200).alias("pkg"))
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, "uuid").select("platform", "uuid", "pkg", "time")


@query("app_ratio", f"WITH {APPS_SQL}, d AS (SELECT platform, count(DISTINCT uuid) AS devices FROM ai GROUP BY 1), n AS (SELECT platform, pkg, count(*) AS n FROM ai GROUP BY ALL) SELECT platform, pkg, n, devices, round(n / devices, 6) AS ratio FROM n JOIN d USING (platform) WHERE n / devices >= 0.001")
def app_ratio(spark, sf_dir):
    return reports.install_ratio(app_list(spark, sf_dir).select("platform", "uuid", "pkg").distinct()).withColumn("ratio", F.round("ratio", 6))


@query("app_first_seen", f"WITH {APPS_SQL} SELECT platform, pkg, CAST(min(epoch_us(time) // 1000) AS BIGINT) AS first_time FROM ap GROUP BY ALL")
def app_first_seen(spark, sf_dir):
    return app_list(spark, sf_dir).groupBy("platform", "pkg").agg(F.min("time").alias("first_time"))


@query("app_list_diff", f"""WITH {APPS_SQL}, o AS (SELECT DISTINCT uuid, pkg FROM ap WHERE pkg % 3 <> 0), n AS (SELECT DISTINCT uuid, pkg FROM ap WHERE pkg % 5 <> 0)
SELECT uuid, coalesce(string_agg(CAST(pkg AS VARCHAR), ',' ORDER BY pkg) FILTER (WHERE o IS NULL), '') AS added, coalesce(string_agg(CAST(pkg AS VARCHAR), ',' ORDER BY pkg) FILTER (WHERE n IS NULL), '') AS removed
FROM (SELECT coalesce(o.uuid, n.uuid) AS uuid, coalesce(o.pkg, n.pkg) AS pkg, o.pkg AS o, n.pkg AS n FROM o FULL JOIN n ON o.uuid = n.uuid AND o.pkg = n.pkg) GROUP BY uuid HAVING count(*) FILTER (WHERE o IS NULL OR n IS NULL) > 0""")
def app_list_diff(spark, sf_dir):
    lists = lambda cond: app_list(spark, sf_dir).where(cond).groupBy("uuid").agg(F.collect_set("pkg").alias("pkgs"))
    out = sessions.changes(lists("pkg % 3 <> 0"), lists("pkg % 5 <> 0"), "uuid", "pkgs")
    return out.select("uuid", F.array_join(F.transform("added", lambda x: x.cast("string")), ",").alias("added"), F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed"))


@query("app_tag_profile", f"""WITH {APPS_SQL}, tg AS (SELECT platform, pkg, 't' || pkg % 6 AS tag, CASE WHEN pkg % 2 = 0 THEN 0.5 ELSE -0.25 END AS sex_weight FROM (SELECT DISTINCT platform, pkg FROM ai)),
p AS (SELECT uuid, tag, count(*) AS n, sum(sex_weight) AS sex_weight FROM ai JOIN tg USING (platform, pkg) GROUP BY ALL),
h AS (SELECT uuid, bool_or(tag = 't0') AS t0, bool_or(tag = 't1') AS t1, bool_or(tag = 't2') AS t2 FROM p GROUP BY uuid)
SELECT p.uuid, tag, n, CAST(sex_weight AS DOUBLE) AS sex_weight FROM p JOIN h USING (uuid) WHERE NOT (tag = 't1' AND t0) AND NOT (tag = 't2' AND t1 AND NOT t0) AND NOT (tag = 't3' AND t2 AND NOT (t1 AND NOT t0))""")
def app_tag_profile(spark, sf_dir):
    installed = app_list(spark, sf_dir).select("platform", "uuid", "pkg").distinct()
    tag = F.col("pkg") % 6
    tags = installed.select("platform", "pkg").distinct().select("platform", "pkg", F.concat(F.lit("t"), tag.cast("string")).alias("tag"), F.when(F.col("pkg") % 2 == 0, 0.5).otherwise(-0.25).alias("sex_weight"), (10.0 - tag).alias("tag_weight"), F.when(tag == 0, "t1").when(tag == 2, "t3").when(tag == 1, "t2").alias("mutex"))
    return profile.app_tags(installed, tags)


# --- probes: events as readings ------------------------------------------------------------------------------------------

PROBE_SQL = f"{EV}, rd AS (SELECT event_id, user_id % 3 AS venue, uuid AS mac, time FROM ev), pc AS (SELECT *, CASE WHEN time - lag(time) OVER (PARTITION BY venue, mac ORDER BY time) > 7200000 THEN 1 ELSE 0 END AS cut FROM rd), ps AS (SELECT *, sum(cut) OVER (PARTITION BY venue, mac ORDER BY time RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM pc), pv AS (SELECT venue, mac, session, min(time) AS start, max(time) AS \"end\", count(*) AS n FROM ps GROUP BY ALL HAVING max(time) - min(time) >= 60000)"


def readings(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select("event_id", (F.col("user_id") % 3).alias("venue"), F.col("uuid").alias("mac"), "time")


@query("probe_visits", f'WITH {PROBE_SQL} SELECT venue, mac, start, "end", n FROM pv')
def probe_visits(spark, sf_dir):
    return probe.visits(readings(spark, sf_dir)).drop("session")


@query("probe_hour", f"WITH {PROBE_SQL}, t AS (SELECT venue, mac, {DAY} AS day, CAST((time + 28800000) % 86400000 // 3600000 AS INTEGER) AS slot FROM rd), g AS (SELECT venue, day, CAST(range AS INTEGER) AS slot FROM (SELECT DISTINCT venue, day FROM t), range(24)), c AS (SELECT venue, day, slot, count(DISTINCT mac) AS devices FROM t GROUP BY ALL) SELECT venue, day, slot, coalesce(devices, 0) AS devices FROM g LEFT JOIN c USING (venue, day, slot)")
def probe_hour(spark, sf_dir):
    return probe.grid(readings(spark, sf_dir), "hour")


@query("probe_new", f"""WITH {PROBE_SQL}, f AS (SELECT venue, mac, min(time) AS time FROM rd GROUP BY ALL), fd AS (SELECT venue, mac, {DAY} AS first_day FROM f), v AS (SELECT venue, mac, "end" - start AS span, start AS time FROM pv), d AS (SELECT *, {DAY} AS day FROM v)
SELECT venue, day, count(*) AS visits, count(DISTINCT mac) AS devices, CAST(sum(span) AS BIGINT) AS stay, count(DISTINCT mac) FILTER (WHERE first_day = day) AS new_devices FROM d JOIN fd USING (venue, mac) GROUP BY ALL""")
def probe_new(spark, sf_dir):
    r = readings(spark, sf_dir)
    return probe.venue_report(probe.visits(r), probe.first_seen(r))


# --- places ----------------------------------------------------------------------------------------------------------

POINT_SQL = f"{EV}, pt AS (SELECT *, 116 + (user_id % 100) / 100.0::DOUBLE + (pageid % 9) / 8000.0::DOUBLE AS lon, 39 + (user_id % 70) / 70.0::DOUBLE + (pageid % 4) / 3000.0::DOUBLE AS lat FROM ev)"


def points(spark, sf_dir) -> DataFrame:
    user, page = F.col("user_id"), F.col("pageid")
    return events(spark, sf_dir).withColumn("lon", 116 + user % 100 / 100.0 + page % 9 / 8000.0).withColumn("lat", 39 + user % 70 / 70.0 + page % 4 / 3000.0).withColumn("platform", F.lit(2))


@query("heat_map", f"WITH {POINT_SQL} SELECT appid, 2 AS platform, trunc(lon * 100000) / 100000 AS lon, trunc(lat * 100000) / 100000 AS lat, CAST(count(*) AS BIGINT) AS n FROM pt GROUP BY ALL")
def heat_map(spark, sf_dir):
    return reports.heat_map(points(spark, sf_dir), scalars.truncated(F.col("lon")), scalars.truncated(F.col("lat")))


@query("gcj_to_bd", f"""WITH {POINT_SQL}, p AS (SELECT DISTINCT lon, lat FROM pt), r AS (SELECT *, sqrt(lon * lon + lat * lat) + 0.00002 * sin(lat * 3.14159265358979324 * 3000.0 / 180.0) AS r, atan2(lat, lon) + 0.000003 * cos(lon * 3.14159265358979324 * 3000.0 / 180.0) AS a FROM p)
SELECT round(lon, 6) AS lon, round(lat, 6) AS lat, round(r * cos(a) + 0.0065, 6) AS bd_lon, round(r * sin(a) + 0.006, 6) AS bd_lat FROM r""")
def gcj_to_bd(spark, sf_dir):
    p = points(spark, sf_dir).select("lon", "lat").distinct()
    x, y = scalars.gcj_to_bd(F.col("lon"), F.col("lat"))
    return p.select(F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round(x, 6).alias("bd_lon"), F.round(y, 6).alias("bd_lat"))


@query("gps_thin", f"""WITH RECURSIVE {POINT_SQL}, r AS (SELECT uuid, event_id, time, lon, lat, row_number() OVER (PARTITION BY uuid ORDER BY time, event_id) AS i FROM pt),
s AS (SELECT uuid, event_id, time, lon, lat, i, lon AS x, lat AS y, true AS kept FROM r WHERE i = 1
  UNION ALL SELECT r.uuid, r.event_id, r.time, r.lon, r.lat, r.i, CASE WHEN far THEN r.lon ELSE x END, CASE WHEN far THEN r.lat ELSE y END, far
  FROM (SELECT r.*, s.x, s.y, abs(r.lon - s.x) + abs(r.lat - s.y) > 0.0009 AS far FROM s JOIN r ON r.uuid = s.uuid AND r.i = s.i + 1) r)
SELECT uuid, event_id, time, lon, lat FROM s WHERE kept""")
def gps_thin(spark, sf_dir):
    return places.thinned(points(spark, sf_dir).select("uuid", "event_id", "time", "lon", "lat"))


def tracks(spark, sf_dir) -> DataFrame:
    """Points that are further apart, so that users have several places."""
    p = points(spark, sf_dir)
    return p.withColumns({"lon": F.col("lon") + F.col("event_id") % 5 * (F.col("pageid") % 3) * 0.017, "lat": F.col("lat") + F.col("event_id") % 2 * 0.03})


#: Each point with the cluster that takes it; c holds the clusters of its user: centre, points and the time of the last one.
CLUSTER_SQL = f"""{POINT_SQL}, po AS (SELECT uuid, lon + (event_id % 5) * (pageid % 3) * 0.017::DOUBLE AS lon, lat + (event_id % 2) * 0.03::DOUBLE AS lat, time, row_number() OVER (PARTITION BY uuid ORDER BY time, event_id) AS i FROM pt),
cl AS (SELECT uuid, lon, lat, time, i, [{{'x': lon, 'y': lat, 'n': 1, 't': time}}] AS c, 1 AS own FROM po WHERE i = 1
  UNION ALL SELECT uuid, lon, lat, time, i,
    CASE WHEN k IS NULL THEN list_append(c, {{'x': lon, 'y': lat, 'n': 1, 't': time}}) ELSE list_transform(c, lambda z, j: CASE WHEN j = k THEN {{'x': z.x + (lon - z.x) / (z.n + 1), 'y': z.y + (lat - z.y) / (z.n + 1), 'n': z.n + 1, 't': time}} ELSE z END) END,
    CAST(coalesce(k, len(c) + 1) AS INTEGER)
  FROM (SELECT q.*, q.near.j AS k FROM (SELECT p.*, s.c, list_sort(list_filter(list_transform(s.c, lambda z, j: {{'d': (z.x - p.lon) ** 2 + (z.y - p.lat) ** 2, 'j': j, 't': z.t}}), lambda w: p.time - w.t < 5184000000 AND w.d < 0.05 ** 2))[1] AS near FROM cl s JOIN po p ON p.uuid = s.uuid AND p.i = s.i + 1) q) q),
ce AS (SELECT uuid, own - 1 AS cluster, count(*) AS n, arg_max(c[own].x, i) AS x, arg_max(c[own].y, i) AS y FROM cl GROUP BY ALL)"""


@query("gps_cluster", f"WITH RECURSIVE {CLUSTER_SQL} SELECT uuid, CAST(cluster AS INTEGER) AS cluster, round(x, 6) AS lon, round(y, 6) AS lat, n FROM ce")
def gps_cluster(spark, sf_dir):
    return places.clusters(tracks(spark, sf_dir)).select("uuid", "cluster", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "n")


@query("place_labels", f"""WITH RECURSIVE {CLUSTER_SQL}, t AS (SELECT uuid, own - 1 AS cluster, sum(CASE WHEN (time + 28800000) % 86400000 // 3600000 < 7 OR (time + 28800000) % 86400000 // 3600000 > 20 THEN 1.0 ELSE -0.5 END) AS night FROM cl GROUP BY ALL),
d AS (SELECT DISTINCT uuid, own - 1 AS cluster, {DAY} AS day FROM cl), o AS (SELECT uuid, cluster, sum(CASE WHEN (day + 2) % 7 >= 5 THEN 1 ELSE -1 END) AS dayoff FROM d GROUP BY ALL),
s AS (SELECT * FROM ce JOIN t USING (uuid, cluster) JOIN o USING (uuid, cluster)),
h AS (SELECT uuid, arg_min(cluster, (-n, cluster)) AS home FROM s WHERE night > 0 GROUP BY uuid),
w AS (SELECT s.uuid, arg_min(cluster, (-n, cluster)) AS work FROM s LEFT JOIN h USING (uuid) WHERE dayoff < 0 AND cluster IS DISTINCT FROM home GROUP BY s.uuid),
l AS (SELECT s.*, CASE WHEN cluster = home THEN 'home' WHEN cluster = work THEN 'work' WHEN dayoff < 0 THEN 'business' WHEN dayoff > 0 THEN 'travel' END AS label FROM s LEFT JOIN h USING (uuid) LEFT JOIN w USING (uuid))
SELECT uuid, CAST(cluster AS INTEGER) AS cluster, label, n FROM l WHERE label IS NOT NULL""")
def place_labels(spark, sf_dir):
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"), F.when((F.col("id") < 7) | (F.col("id") > 20), 1.0).otherwise(-0.5).alias("night"))
    calendar = events(spark, sf_dir).select(scalars.day_number(F.col("time")).alias("day_num")).distinct().withColumn("day_off", (F.col("day_num") + 2) % 7 >= 5)
    return places.place_labels(places.clusters(tracks(spark, sf_dir)), hours, calendar).select("uuid", "cluster", "label", "n")


# --- texts and urls ----------------------------------------------------------------------------------------------------


#: User agents of events: a word of the browser's and one of the system's, in the case that agents have.
AGENT_SQL = "'Mozilla/5.0 (' || ['Linux; Android 9', 'iPhone; CPU', 'Windows NT; WOW64', 'Macintosh', 'X11', 'iPad'][1 + event_id % 6] || ') ' || ['UCBrowser Chrome', 'Chrome Safari', 'MSIE 10.0', 'rv:11.0', 'MQQBrowser', 'QQ/8', 'MicroMessenger Safari', 'Lynx', 'chrome'][1 + event_id % 9]"


def agents(e: DataFrame) -> DataFrame:
    pick = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (F.col("event_id") % len(xs)).cast("int"))
    system = pick(["Linux; Android 9", "iPhone; CPU", "Windows NT; WOW64", "Macintosh", "X11", "iPad"])
    return e.withColumn("agent", F.concat(F.lit("Mozilla/5.0 ("), system, F.lit(") "), pick(["UCBrowser Chrome", "Chrome Safari", "MSIE 10.0", "rv:11.0", "MQQBrowser", "QQ/8", "MicroMessenger Safari", "Lynx", "chrome"])))


@query("ua_class", f"""WITH {EV}, a AS (SELECT event_id, event_id % 6 AS s, event_id % 9 AS b, {AGENT_SQL} AS agent FROM ev)
SELECT agent, CASE b WHEN 0 THEN 'UCBrowser' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'MSIE 10' WHEN 3 THEN 'rv:1' WHEN 4 THEN 'MQQBrowser' WHEN 5 THEN 'QQ' WHEN 6 THEN 'MicroMessenger' ELSE 'Other' END AS browser,
 CASE s WHEN 0 THEN 'android' WHEN 1 THEN 'iphone' WHEN 2 THEN 'windows' WHEN 3 THEN 'mac' WHEN 5 THEN 'ipad' ELSE 'other' END AS system, count(*) AS n FROM a GROUP BY ALL""")
def ua_class(spark, sf_dir):
    a = agents(events(spark, sf_dir))
    return a.groupBy("agent", scalars.browser(F.col("agent")).alias("browser"), scalars.operating_system(F.col("agent")).alias("system")).agg(F.count("*").alias("n"))


@query("search_keyword", "WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'baidu' WHEN 1 THEN 'so.com' ELSE 'google' END AS engine FROM pages) SELECT page_id, engine, CASE WHEN engine = 'google' THEN NULL ELSE 'word ' || page_id END AS keyword FROM u")
def search_keyword(spark, sf_dir):
    i = F.col("page_id")
    words = F.concat(F.lit("word%20"), i.cast("string"))
    url = F.when(i % 3 == 0, F.concat(F.lit("https://www.baidu.com/s?ie=utf-8&wd="), words, F.lit("&x=1"))).when(i % 3 == 1, F.concat(F.lit("http://www.so.com/s?q="), words)).otherwise(F.concat(F.lit("https://www.google.com/search?q="), words))
    p = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return p.select("page_id", scalars.search_engine(F.col("url")).alias("engine"), scalars.search_keyword(F.col("url")).alias("keyword"))


@query("url_parts", f"SELECT page_id, {HOST.format('url')} AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def url_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", scalars.host(F.col("url")).alias("host"), F.try_element_at(scalars.query_map(F.col("url")), F.lit("page")).alias("page"))


@query("phones_in_text", "SELECT doc_id, CAST(len(regexp_extract_all(' ' || regexp_replace(text, '[^0-9]', '  ', 'g') || ' ', ' (1[3-9][0-9]{9}) ')) AS BIGINT) AS n FROM documents")
def phones_in_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(scalars.phones(F.col("text"))).cast("long").alias("n"))


@query("im_messages", "SELECT conv_id, count(*) AS messages, count(*) FILTER (WHERE role = 'user') AS from_users, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id")
def im_messages(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    body = F.to_json(F.struct(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("client_id"), F.lit("shop").alias("customer"), F.when(F.col("role") == "user", 1).otherwise(0).alias("from_type"), F.col("turn").alias("time"), F.lit("10.0.0.1").alias("user_ip"), F.lit("a long enough source text, so that no line is dropped for being short").alias("source"), F.base64(F.encode("text", "UTF-8")).alias("content")))
    out = clean.chat_lines(c.select(F.concat(F.lit('10.0.0.1 - - ""'), body, F.lit(' EOF"')).alias("value"))).where("status = 200")
    text = F.decode(F.unbase64("content"), "UTF-8")
    return out.groupBy(F.substring("client_id", 2, 20).cast("long").alias("conv_id")).agg(F.count("*").alias("messages"), F.count(F.when(F.col("from_type") == 1, 1)).alias("from_users"), F.sum(F.length(text)).alias("chars"))


@query("leads", f"WITH {EV} SELECT appid, uuid, time, 'n' || pageid AS name, '13' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS phone FROM ev WHERE subtype = 'purchase'")
def leads(spark, sf_dir):
    e = events(spark, sf_dir).where("subtype = 'purchase'").withColumn("subtype", F.lit(clean.LEAD))
    data = F.to_json(F.struct(F.concat(F.lit("n"), F.col("pageid").cast("string")).alias("nickname"), F.concat(F.lit("13"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("mobile")))
    return clean.leads(e.withColumn("data", F.when(F.col("event_id") % 2 == 0, F.url_encode(data)).otherwise(data))).select("appid", "uuid", "time", "name", "phone")


@query("keyword_funnel", f"""WITH {VIEWS}, l AS (SELECT *, last_value(CASE WHEN ref <> '' THEN ref END IGNORE NULLS) OVER (PARTITION BY uuid, appid ORDER BY time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entry_ref FROM vw),
g AS (SELECT uuid, appid, entry_ref, count(*) FILTER (WHERE logtype = '50') AS pages, max(CASE WHEN subtype = 'purchase' THEN 1 ELSE 0 END) AS leads, max(CASE WHEN subtype = 'signup' THEN 1 ELSE 0 END) AS logged FROM l WHERE entry_ref IS NOT NULL GROUP BY ALL)
SELECT appid, entry_ref, count(*) AS visits, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(leads) AS BIGINT) AS leads, CAST(sum(logged) AS BIGINT) AS logged FROM g GROUP BY ALL""")
def keyword_funnel(spark, sf_dir):
    v = views(spark, sf_dir).withColumn("source", F.when(F.col("ref") != "", 2).otherwise(0))
    g = sessions.attributed(v).groupBy("uuid", "appid", "entry_ref").agg(F.count(F.when(sessions.is_page(), 1)).alias("pages"), F.max((F.col("subtype") == "purchase").cast("int")).alias("leads"), F.max((F.col("subtype") == "signup").cast("int")).alias("logged"))
    return reports.funnel(g, "appid", "entry_ref")

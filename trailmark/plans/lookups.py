"""Queries that look things up: page tags, browse logs, labels and addresses of devices."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmark.operators import documents, reports, sessions
from trailmark.plans.adapt import EV, events
from trailmark.plans.people import PAGE_LABEL_SQL, TODAY, label_days
from trailmark.plans.traffic import FLOW, VIEWS, VISIT_SQL, views, visited

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


PAGE_RULES = [(1, 1, "/en/", "english", 5, 0), (2, 4, "html", "static", 9, 0), (3, 3, "https", "secure", 1, 1), (4, 1, "blog", "blog", 2, 1)]
TAG_SQL = f"{VIEWS}, tg AS (SELECT event_id, appid, uuid, ip, CAST(CASE WHEN ends_with(url, 'html') THEN 2 WHEN contains(url, '/en/') THEN 1 ELSE 0 END AS INTEGER) AS rule_id, CAST(starts_with(url, 'https') AS INTEGER) + CAST(contains(url, 'blog') AS INTEGER) AS n_loose FROM vw)"


def _rules(spark, sf_dir):
    apps = events(spark, sf_dir).select("appid").distinct()
    r = spark.createDataFrame(PAGE_RULES, "id int, rType int, rules string, name string, weight int, loose int")
    return apps.join(F.broadcast(r), F.lit(True))


@query("page_tags", f"WITH {TAG_SQL} SELECT appid, rule_id, {FLOW} FROM tg GROUP BY ALL")
def page_tags(spark, sf_dir):
    return reports.flow(documents.page_tags(views(spark, sf_dir), _rules(spark, sf_dir))[0], "appid", "rule_id")


@query("loose_excluded", f"WITH {TAG_SQL} SELECT appid, {FLOW} FROM tg WHERE n_loose = 0 GROUP BY ALL")
def loose_excluded(spark, sf_dir):
    v = views(spark, sf_dir)
    return reports.flow(documents.without_loose(v, documents.page_tags(v, _rules(spark, sf_dir))[1]), "appid")


@query("campaign", f"WITH {VIEWS} SELECT event_id, ref FROM vw WHERE appid = '1200' AND contains(ref, 'example') AND contains(url, '/en/')")
def campaign(spark, sf_dir):
    return documents.campaign(views(spark, sf_dir), "1200", "example", "/en/").select("event_id", "ref")


@query("visit_features", f"""WITH {VISIT_SQL}, s AS (SELECT uuid, min(time) AS first_visit FROM wv GROUP BY uuid), p AS (SELECT * FROM wv WHERE logtype = '50')
SELECT s.uuid, count(p.event_id) AS pages, count(*) FILTER (WHERE (p.time + 28800000) % 86400000 // 3600000 BETWEEN 9 AND 18) AS hour_pages, count(DISTINCT (p.time + 28800000) // 86400000) AS days,
 CAST(coalesce(sum(p.staytime) FILTER (WHERE pageid IN (1, 2, 3)), 0) AS BIGINT) AS named_stay, any_value(first_visit) AS first_visit FROM s LEFT JOIN p USING (uuid) GROUP BY s.uuid""")
def visit_features(spark, sf_dir):
    return documents.visit_features(sessions.visits(visited(spark, sf_dir)), [1, 2, 3]).withColumn("named_stay", F.col("named_stay").cast("long"))


@query("ip_counts", f"WITH {VISIT_SQL}, v AS (SELECT appid, uuid, visitindex, arg_min(ip, (time, event_id)) AS ip FROM wv GROUP BY ALL) SELECT ip, count(*) AS visits, count(DISTINCT uuid) AS devices FROM v GROUP BY ip ORDER BY visits DESC, ip LIMIT 10")
def ip_counts(spark, sf_dir):
    return documents.ip_counts(sessions.visits(visited(spark, sf_dir)))


@query("label_lookup", f"""WITH {PAGE_LABEL_SQL} SELECT uuid, name, round(sum(CASE WHEN {TODAY} - day BETWEEN 0 AND 59 THEN (times * 0.7::DOUBLE + stay / 20000::DOUBLE * 0.3::DOUBLE) * 1.5::DOUBLE * (60 - ({TODAY} - day)) / 60::DOUBLE ELSE 0 END), 6) AS value
FROM pl WHERE day BETWEEN {TODAY} - 59 AND {TODAY} AND uuid IN (SELECT uuid FROM ev WHERE subtype = 'purchase') GROUP BY ALL""")
def label_lookup(spark, sf_dir):
    keys = events(spark, sf_dir).where("subtype = 'purchase'").select("uuid").distinct()
    return documents.labels_of(label_days(spark, sf_dir), keys, TODAY - 59, TODAY, TODAY).withColumn("value", F.round("value", 6))


@query("interests", f"""WITH {PAGE_LABEL_SQL}, v AS (SELECT uuid, name, sum((times * 0.7::DOUBLE + stay / 20000::DOUBLE * 0.3::DOUBLE) * 1.5::DOUBLE * (60 - ({TODAY} - day)) / 60::DOUBLE) AS value FROM pl WHERE day BETWEEN {TODAY} - 59 AND {TODAY} GROUP BY uuid, name, company_id HAVING value > 0.001),
s AS (SELECT uuid, name, sum(value) AS value FROM v GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY round(value, 9) DESC, name) AS k FROM s) SELECT uuid, string_agg(name || ':' || CAST(CAST(CAST(round(value, 9) AS DECIMAL(18, 9)) AS DECIMAL(18, 3)) AS VARCHAR), ',' ORDER BY k) AS interests FROM r WHERE k <= 10 GROUP BY uuid""")
def interests(spark, sf_dir):
    from trailmark.operators import profile

    sums = profile.label_sum(label_days(spark, sf_dir), TODAY).groupBy("uuid", "name").agg(F.round(F.sum("value"), 9).alias("value"))
    return documents.interests(sums)


@query("top_ips", f"WITH {EV}, c AS (SELECT appid, ip, count(*) AS n FROM ev GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY appid ORDER BY n DESC, ip) AS k FROM c) SELECT appid, string_agg(ip || '=' || n, ',' ORDER BY k) AS ips FROM r WHERE k <= 10 GROUP BY appid")
def top_ips(spark, sf_dir):
    best = reports.top(events(spark, sf_dir).groupBy("appid", "ip").agg(F.count("*").alias("n")), "n", 10, "appid", "ip")
    return best.groupBy("appid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "ip", "n"))), lambda e: F.concat_ws("=", e["ip"], e["n"].cast("string"))), ",").alias("ips"))

"""Browse logs, page tags, lookups over visits and labels, and documents for a search store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.scalars import added_in_order, decayed, web_label_value
from trailmark.operators import lookup


# --- pages and sources -----------------------------------------------------------------------------------------------


def page_tags(views: DataFrame, rules: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """Views with their strict page rule (id 0 without one), and one row per view and loose rule that holds.

    rules: id, appid, rType, rules, name, weight, loose. A view keeps its heaviest strict rule and all loose ones.
    """
    strict = lookup.first_rule(views, rules.where("loose = 0").drop("loose"), "url", ["appid"], [key])
    loose = lookup.rules_matching(views, rules.where("loose = 1").drop("loose"), "url", ["appid"])
    return strict.withColumn("rule_id", F.coalesce("rule_id", F.lit(0))), loose


def without_loose(views: DataFrame, loose: DataFrame, key: str = "event_id") -> DataFrame:
    """Views that no loose rule holds for: what paths are made of."""
    return views.join(loose.select(key).distinct(), key, "left_anti")


def campaign(views: DataFrame, appid: str, engine: str, landing: str) -> DataFrame:
    """Views of an app that came from an engine to a landing page, with the decoded referrer."""
    hit = views.where((F.col("appid") == appid) & F.contains("ref", F.lit(engine)) & F.contains("url", F.lit(landing)))
    return hit.withColumn("ref", F.coalesce(F.try_url_decode("ref"), F.col("ref")))


def browse_log(views: DataFrame, sources: list[tuple[int, str, str]], eqids: DataFrame | None = None) -> DataFrame:
    """Views with the source of their referrer and the words it was found by.

    sources: kind, rule and name, heaviest first; eqids: eqid, keyword, for an engine that hides words behind an id.
    """
    named = views.withColumn("source", lookup.first_of_literals(F.col("ref"), sources))
    out = lookup.keywords(named, "ref")
    if eqids is None:
        return out
    known = eqids.select(F.col("eqid").alias("keyword"), F.col("keyword").alias("_words"))
    return out.join(known, "keyword", "left").withColumn("keyword", F.coalesce("_words", "keyword")).drop("_words").select(*out.columns)


def keyword_costs(landed: DataFrame) -> DataFrame:
    """Keyword rows of landed ad reports, one JSON object a line: day, account, keyword, shown, clicked, cost."""
    j = F.from_json("value", "struct<day:string,account:string,keyword:string,shown:bigint,clicked:bigint,cost:double>").alias("j")
    return landed.select(j).select("j.*").where("day is not null and keyword is not null").withColumn("day", F.col("day").try_cast("date"))


def query_costs(landed: DataFrame) -> DataFrame:
    """Query rows of landed ad reports: what was really asked for, with the keyword and creative that it showed.

    A report is one JSON object a line: day, account and a list of queries (query, keyword_id, creative_id, shown, clicked, cost).
    Queries without words are left out; rate is clicks a showing, null if nothing was shown.
    """
    kind = "struct<day:string,account:string,queries:array<struct<query:string,keyword_id:bigint,creative_id:bigint,shown:bigint,clicked:bigint,cost:double>>>"
    rows = landed.select(F.from_json("value", kind).alias("j")).select(F.col("j.day").try_cast("date").alias("day"), "j.account", F.explode("j.queries").alias("q"))
    rows = rows.select("day", "account", "q.*").where("day is not null and length(trim(query)) > 0")
    return rows.withColumn("rate", F.when(F.col("shown") > 0, F.col("clicked") / F.col("shown")))


# --- visits ----------------------------------------------------------------------------------------------------------


def visit_features(visits: DataFrame, named: list[int], hours: tuple[int, int] = (9, 18)) -> DataFrame:
    """Per device: pages, pages within hours, distinct days, stay on named pages and first visit; visits have pages as structs."""
    from trailmark.functions.scalars import day_number, hour_of_day

    p = visits.select("uuid", "start", F.explode_outer("pages").alias("p"))
    t = F.col("p.time")
    return p.groupBy("uuid").agg(
        F.count("p").alias("pages"),
        F.count(F.when(hour_of_day(t).between(*hours), 1)).alias("hour_pages"),
        F.countDistinct(day_number(t)).alias("days"),
        F.sum(F.when(F.col("p.pageid").isin(named), F.col("p.stay")).otherwise(0)).alias("named_stay"),
        F.min("start").alias("first_visit"),
    )


def visit_ips(visits: DataFrame, newest: int = 10_000) -> DataFrame:
    """Distinct addresses of the newest visits that were asked for."""
    return visits.orderBy(F.col("start").desc(), "appid", "uuid", "visitindex").limit(newest).select("ip").distinct()


def ip_counts(visits: DataFrame, n: int = 10) -> DataFrame:
    """Visits and devices of each address, the commonest first."""
    return visits.groupBy("ip").agg(F.count("*").alias("visits"), F.countDistinct("uuid").alias("devices")).orderBy(F.col("visits").desc(), "ip").limit(n)


def visit_documents(visits: DataFrame, ranges: DataFrame) -> DataFrame:
    """Visits as JSON documents by key, with the area of their address looked up anew."""
    located = lookup.ip_area(visits, ranges)
    key = F.concat_ws("#", "appid", "uuid", F.col("visitindex").cast("string"), F.col("start").cast("string"))
    return located.select(key.alias("key"), F.to_json(F.struct(*located.columns)).alias("doc"))


# --- labels and apps -------------------------------------------------------------------------------------------------


def labels_of(label_days: DataFrame, keys: DataFrame, first: int, last: int, today: int) -> DataFrame:
    """Decayed label values of the asked devices from a range of days."""
    value = decayed(web_label_value(F.col("times"), F.col("stay"), F.col("weight"), F.col("base_weight")), F.lit(today) - F.col("day"))
    asked = label_days.where(F.col("day").between(first, last)).join(keys.select("uuid"), "uuid", "left_semi")
    return asked.groupBy("uuid", "name").agg(added_in_order(F.col("day"), value).alias("value"))


def interests(labels: DataFrame, n: int = 10) -> DataFrame:
    """name:value pairs of a device's n heaviest labels in one string."""
    w = W.partitionBy("uuid").orderBy(F.col("value").desc(), "name")
    best = labels.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n)
    return best.groupBy("uuid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "name", F.format_string("%.3f", "value").alias("v")))), lambda s: F.concat(s["name"], F.lit(":"), s["v"])), ",").alias("interests"))


def top_entries(counts: Column, n: int) -> Column:
    """The n largest entries of a map, the largest first, ties to the smaller key."""
    pairs = F.array_sort(F.transform(F.map_entries(counts), lambda e: F.struct((-e["value"]).alias("m"), e["key"].alias("key"))))
    return F.transform(F.slice(pairs, 1, n), lambda s: F.struct(s["key"].alias("key"), (-s["m"]).alias("value")))


def preferred(old: Column, new: Column, replace: bool) -> Column:
    """Two maps as one; of a key in both, the new value if replace, else the old."""
    return F.map_zip_with(old, new, lambda _, a, b: F.coalesce(b, a) if replace else F.coalesce(a, b))


def kept_entries(counts: Column, least: int) -> Column:
    return F.map_filter(counts, lambda _, v: v >= least)


def app_history(changes: DataFrame) -> DataFrame:
    """Each device's app changes (uuid, time, added, removed), newest first, and the apps it has now."""
    sorted_ = F.sort_array(F.collect_list(F.struct("time", "added", "removed")), asc=False)
    now = F.aggregate(F.reverse("log"), F.array().cast("array<string>"), lambda a, c: F.array_union(F.array_except(a, c["removed"]), c["added"]))
    return changes.groupBy("uuid").agg(sorted_.alias("log")).withColumn("apps", F.array_sort(now))

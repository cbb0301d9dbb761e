"""Traffic reports: page views, users and addresses by any key, grids with zero fill, paths, exits and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.scalars import day_number, hour_of_day, minute_of_day


def flow(events: DataFrame, *keys: str) -> DataFrame:
    """Page views, distinct users and distinct addresses of each key; one pass for all three."""
    return events.groupBy(*keys).agg(F.count("*").alias("pv"), F.countDistinct("uuid").alias("uv"), F.countDistinct("ip").alias("ip"))


def flow_sets(events: DataFrame, key: str, *dims: str) -> DataFrame:
    """flow for the key alone and for the key with each dimension, in one pass over grouping sets; `dim` names the set."""
    sets = [[F.col(key)]] + [[F.col(key), F.col(d)] for d in dims]
    out = events.groupingSets(sets, F.col(key), *[F.col(d) for d in dims]).agg(F.count("*").alias("pv"), F.countDistinct("uuid").alias("uv"), F.countDistinct("ip").alias("ip"), *[F.grouping(d).alias(f"_{d}") for d in dims])
    name = F.coalesce(*[F.when(F.col(f"_{d}") == 0, F.lit(d)) for d in dims], F.lit("all"))
    return out.select(key, name.alias("dim"), F.coalesce(*[F.when(F.col(f"_{d}") == 0, F.col(d).cast("string")) for d in dims], F.lit("all")).alias("value"), "pv", "uv", "ip")


def stay(pages: DataFrame, *keys: str) -> DataFrame:
    """Views and total stay of pages that have a stay."""
    return pages.where("staytime > 0").groupBy(*keys).agg(F.count("*").alias("n"), F.sum("staytime").alias("stay"))


def people_and_bots(views: DataFrame, *keys: str) -> DataFrame:
    """All visits, those of people and of bots, with their distinct users and addresses."""
    human = F.col("acc") == 1
    return views.groupBy(*keys).agg(
        F.count("*").alias("all_visit_num"),
        F.countDistinct("uuid").alias("all_uv"),
        F.countDistinct("ip").alias("all_ip"),
        F.count(F.when(human, 1)).alias("visit_num"),
        F.countDistinct(F.when(human, F.col("uuid"))).alias("uv"),
        F.countDistinct(F.when(human, F.col("ip"))).alias("ip"),
    )


def external(views: DataFrame, hosts: DataFrame) -> DataFrame:
    """Views whose referrer is outside their app: 1 to 8191 characters, and without the app's host (appid, host)."""
    known = views.join(F.broadcast(hosts), "appid") if _few(hosts) else views.join(hosts, "appid")
    return known.where(F.length("ref").between(1, 8191) & (F.length("host") > 0) & ~F.contains("ref", "host"))


def _few(dim: DataFrame, limit: int = 50_000) -> bool:
    """True if a dimension has so few rows that it may be broadcast; counts no further than the limit."""
    return dim.limit(limit + 1).count() <= limit


def top(report: DataFrame, by: str, n: int, within: str, tie: str) -> DataFrame:
    """The n largest rows of each group, ties to the smaller name."""
    w = W.partitionBy(within).orderBy(F.col(by).desc(), F.col(tie))
    return report.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def grid(events: DataFrame, unit: str) -> DataFrame:
    """flow of each app, day and hour (or minute), with a row of zeros for each slot without events."""
    slots, slot = {"hour": (24, hour_of_day), "minute": (1440, minute_of_day)}[unit]
    timed = events.select("appid", day_number(F.col("time")).alias("day"), slot(F.col("time")).alias("slot"), "uuid", "ip")
    seen = flow(timed, "appid", "day", "slot")
    empty = seen.select("appid", "day").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("pv", "uv", "ip")]
    return empty.join(seen, ["appid", "day", "slot"], "left").select("appid", "day", "slot", *zero)


def first_seen(events: DataFrame, *keys: str) -> DataFrame:
    """First time of each key with that row's acc; of rows at the same time the largest acc."""
    return events.groupBy(*keys).agg(F.min("time").alias("first_time"), F.max_by("acc", F.struct(-F.col("time"), F.col("acc"))).alias("acc"))


def new_and_old(events: DataFrame, first: DataFrame) -> DataFrame:
    """Users of each app and day who are new (0: first seen that day) or returning (1); first has appid, uuid, first_time."""
    days = events.select("appid", "uuid", day_number(F.col("time")).alias("day")).distinct()
    known = days.join(first.select("appid", "uuid", day_number(F.col("first_time")).alias("first_day")), ["appid", "uuid"])
    return known.groupBy("appid", "day", (F.col("day") > F.col("first_day")).cast("int").alias("is_old")).agg(F.count("*").alias("users"))


def latest(events: DataFrame, *keys: str, tie: str = "event_id") -> DataFrame:
    """The latest row of each key."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("time", tie)).alias("r")).select(*keys, "r.*")


def status_histogram(checked: DataFrame) -> DataFrame:
    return checked.groupBy("status").agg(F.count("*").alias("n"))


def quality(checked: DataFrame) -> DataFrame:
    """One row: all, bad and good lines, and the count of each status as JSON."""
    per = status_histogram(checked)
    counts = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("status").cast("string"), "n"))))
    return per.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("status") != 200, F.col("n")).otherwise(0)).alias("errors"), F.sum(F.when(F.col("status") == 200, F.col("n")).otherwise(0)).alias("ok"), F.to_json(counts).alias("statuses"))


def exits(pages: DataFrame) -> DataFrame:
    """How often a page is the last of a visit (appid, uuid, visitindex), with the app's total."""
    last = pages.groupBy("appid", "uuid", "visitindex").agg(F.max_by("pageid", F.struct("time", "event_id")).alias("pageid"))
    out = last.groupBy("appid", "pageid").agg(F.count("*").alias("exits"))
    return out.withColumn("app_exits", F.sum("exits").over(W.partitionBy("appid")))


def jumps(pages: DataFrame) -> DataFrame:
    """Steps of visits: (appid, source, step, page, next) and their counts. Repeats of a page count once; next is 0 at the end."""
    visit = W.partitionBy("appid", "uuid", "visitindex").orderBy("time", "event_id")
    kept = pages.withColumn("before", F.lag("pageid").over(visit)).where(~F.col("before").eqNullSafe(F.col("pageid")) | F.col("before").isNull())
    walked = kept.select("appid", F.first("pageid").over(visit).alias("source"), F.row_number().over(visit).alias("step"), F.col("pageid").alias("page"), F.lead("pageid", 1, 0).over(visit).alias("next"))
    return walked.groupBy("appid", "source", "step", "page", "next").agg(F.count("*").alias("n"))


def heat_map(points: DataFrame, lon: Column, lat: Column) -> DataFrame:
    """Points of each app, platform and place cut to 1e-5 degrees."""
    return points.groupBy("appid", "platform", lon.alias("lon"), lat.alias("lat")).agg(F.count("*").alias("n"))


def install_ratio(installed: DataFrame, least: float = 0.001) -> DataFrame:
    """Share of a platform's devices that have an app: (platform, uuid, pkg) rows; shares below the least are left out."""
    devices = installed.groupBy("platform").agg(F.countDistinct("uuid").alias("devices"))
    counts = installed.groupBy("platform", "pkg").agg(F.count("*").alias("n"))
    return counts.join(devices, "platform").select("platform", "pkg", "n", "devices", (F.col("n") / F.col("devices")).alias("ratio")).where(F.col("ratio") >= least)


def click_through(events: DataFrame) -> DataFrame:
    """Hits by origin type, origin and item of one algorithm: (origin_type, origin_id, hit_id) counts."""
    return events.groupBy("origin_type", "origin_id", "hit_id").agg(F.count("*").alias("hits"), F.countDistinct("uuid").alias("users"))


def funnel(visits: DataFrame, *keys: str) -> DataFrame:
    """Visits, pages, leads and logged-in visits of each key."""
    return visits.groupBy(*keys).agg(F.count("*").alias("visits"), F.sum("pages").alias("pages"), F.sum("leads").alias("leads"), F.sum("logged").alias("logged"))


def most_frequent(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The commonest value of each key, ties to the smaller one."""
    counted = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    return counted.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col(value))).alias("r")).select(key, "r.*")

"""Stay times, visits and other rules over the ordered events of a user.

All rules are windows, also those that seem to need state from row to row: what armed or opened last before a row tells it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAGE, EVENT = "50", "40"
GAP_MS = 600_000
ORDER = ["time", "event_id"]


def is_page() -> Column:
    return F.col("logtype") == PAGE


def web_stay(events: DataFrame) -> DataFrame:
    """staytime of web pages: the time to the user's next page, 0 for the last page and for events."""
    user = W.partitionBy("uuid", is_page()).orderBy(*ORDER)
    return events.withColumn("staytime", F.when(is_page(), F.coalesce(F.lead("time").over(user) - F.col("time"), F.lit(0))).otherwise(0).cast("long"))


def web_visit_index(events: DataFrame) -> DataFrame:
    """visitindex of web rows with staytime: a page that stays GAP_MS or more gets stay 0, and the next row starts a visit."""
    user = W.partitionBy("uuid").orderBy(*ORDER)
    long_ = (F.col("staytime") >= GAP_MS).cast("int")
    opened = F.coalesce(F.lag(long_).over(user), F.lit(0))
    return events.withColumn("_o", opened).withColumn("visitindex", (1 + F.sum("_o").over(user.rowsBetween(W.unboundedPreceding, 0))).cast("int")).withColumn("staytime", F.when(F.col("staytime") >= GAP_MS, 0).otherwise(F.col("staytime"))).drop("_o")


def app_stay_on_open(events: DataFrame, background: str = "enter_background") -> DataFrame:
    """Apps that log a page when it opens: it stays until the next page or until the app goes to the background.

    recent_page is the page that is open when a row comes, null if none is. A stay that is already above 0 is kept.
    """
    user = W.partitionBy("uuid", "appid").orderBy(*ORDER)
    away = F.col("subtype") == background
    closes = F.when(is_page() | away, F.col("time"))
    next_close = F.first(closes, ignorenulls=True).over(user.rowsBetween(1, W.unboundedFollowing))
    mark = F.when(is_page(), F.struct("pageid", F.lit(True).alias("open"))).when(away, F.struct(F.lit(None).cast("long").alias("pageid"), F.lit(False).alias("open")))
    last = F.last(mark, ignorenulls=True).over(user.rowsBetween(W.unboundedPreceding, -1))
    given = F.coalesce(F.col("staytime"), F.lit(0)) if "staytime" in events.columns else F.lit(0)
    stay = F.when(is_page() & (given == 0), F.coalesce(next_close - F.col("time"), F.lit(0))).otherwise(given)
    return events.withColumn("recent_page", F.when(last["open"], last["pageid"])).withColumn("staytime", stay.cast("long"))


def app_stay_on_close(events: DataFrame, foreground: str = "enter_foreground") -> DataFrame:
    """Apps that log a page when it closes: it opened when the page before closed or the app came to the foreground.

    The page's time becomes its opening; an event's recent_page is the next page to close, a page's the one before.
    """
    user = W.partitionBy("uuid", "appid").orderBy(*ORDER)
    came = F.when(is_page() | (F.col("subtype") == foreground), F.col("time"))
    since = F.coalesce(F.last(came, ignorenulls=True).over(user.rowsBetween(W.unboundedPreceding, -1)), F.first("time").over(user))
    page = F.when(is_page(), F.col("pageid"))
    before = F.last(page, ignorenulls=True).over(user.rowsBetween(W.unboundedPreceding, -1))
    after = F.first(page, ignorenulls=True).over(user.rowsBetween(1, W.unboundedFollowing))
    out = events.withColumn("_since", since).withColumn("recent_page", F.when(is_page(), before).otherwise(after))
    return out.withColumn("staytime", F.when(is_page(), F.col("time") - F.col("_since")).otherwise(0).cast("long")).withColumn("time", F.when(is_page(), F.col("_since")).otherwise(F.col("time"))).drop("_since")


def app_visit_index(events: DataFrame, gap_rule: bool = True, foreground: str = "enter_foreground") -> DataFrame:
    """visitindex of app rows with staytime, by a switch that a long stay or gap arms and a page or foreground event fires.

    A row that arms the switch keeps its index. gap_rule=False leaves gaps out, as mini-programs do. The switch is armed before a
    row if the last row that arms it is not before the last row that could have fired it, so windows tell it without state.
    """
    user = W.partitionBy("uuid", "appid").orderBy(*ORDER)
    before = user.rowsBetween(W.unboundedPreceding, -1)
    stay = F.coalesce(F.col("staytime"), F.lit(0))
    gap = F.coalesce(F.col("time") - F.lag("time").over(user), F.lit(0)) >= GAP_MS
    arms = (stay >= GAP_MS) | gap if gap_rule else stay >= GAP_MS
    fires = F.coalesce(is_page() | (F.col("subtype") == foreground), F.lit(False))
    rows = events.withColumn("_at", F.row_number().over(user)).withColumn("_arms", arms).withColumn("_fires", fires)
    armed, fired = F.max(F.when(F.col("_arms"), F.col("_at"))).over(before), F.max(F.when(F.col("_fires"), F.col("_at"))).over(before)
    opens = F.col("_fires") & armed.isNotNull() & (armed >= F.coalesce(fired, F.lit(0)))
    rows = rows.withColumn("_opens", opens.cast("int")).withColumn("visitindex", (1 + F.sum("_opens").over(user.rowsBetween(W.unboundedPreceding, 0))).cast("int"))
    return rows.withColumn("staytime", F.when(stay >= GAP_MS, F.lit(0)).otherwise(stay).cast(events.schema["staytime"].dataType)).drop("_at", "_arms", "_fires", "_opens")


def visits(events: DataFrame) -> DataFrame:
    """One row per (appid, uuid, visitindex): pages and events in order, total stay, and the first row's attributes."""
    page = F.struct("time", "event_id", "pageid", F.col("staytime").alias("stay"))
    other = F.struct("time", "event_id", F.col("subtype").alias("type"), F.col("pageid").alias("on"))
    head = F.struct(*ORDER)
    out = events.groupBy("appid", "uuid", "visitindex").agg(
        F.min("time").alias("start"),
        F.max("time").alias("end"),
        F.sum("staytime").alias("stay"),
        F.min_by("ip", head).alias("ip"),
        F.min_by("channel", head).alias("ref"),
        F.sort_array(F.collect_list(F.when(is_page(), page))).alias("pages"),
        F.sort_array(F.collect_list(F.when(~is_page(), other))).alias("events"),
    )
    return out.where((F.size("pages") > 0) | (F.size("events") > 0))


def visit_summary(visited: DataFrame) -> DataFrame:
    return visited.select("appid", "uuid", "visitindex", "start", "end", "stay", "ip", "ref", F.size("pages").cast("long").alias("n_pages"), F.size("events").cast("long").alias("n_events"), F.get(F.transform("pages", lambda p: p["pageid"]), 0).alias("entry"))


def attributed(rows: DataFrame) -> DataFrame:
    """Rows with the search referrer they follow: the user's latest row of a search source; a referrer seen again re-opens its group."""
    user = W.partitionBy("uuid", "appid").orderBy(*ORDER)
    return rows.withColumn("entry_ref", F.last(F.when(F.col("source") > 1, F.col("ref")), ignorenulls=True).over(user.rowsBetween(W.unboundedPreceding, 0))).where(F.col("entry_ref").isNotNull())


def followed(pages: DataFrame, first: Column, second: Column) -> DataFrame:
    """Users who went from one page straight to another."""
    user = W.partitionBy("uuid").orderBy(*ORDER)
    return pages.withColumn("_a", first).withColumn("_b", F.lead(second).over(user)).where(F.col("_a") & F.col("_b")).select("uuid").distinct()


def gap_sessions(readings: DataFrame, *keys: str, gap_ms: int, least_ms: int = 0) -> DataFrame:
    """Readings of each key cut where a gap is longer than gap_ms: (keys, session, start, end, n); shorter sessions are dropped."""
    w = W.partitionBy(*keys).orderBy("time")
    cut = F.coalesce((F.col("time") - F.lag("time").over(w) > gap_ms).cast("int"), F.lit(0))
    cut_rows = readings.withColumn("_cut", cut).withColumn("session", F.sum("_cut").over(w.rangeBetween(W.unboundedPreceding, 0)))
    out = cut_rows.groupBy(*keys, "session").agg(F.min("time").alias("start"), F.max("time").alias("end"), F.count("*").alias("n"))
    return out.where(F.col("end") - F.col("start") >= least_ms)


def changes(old: DataFrame, new: DataFrame, key: str, items: str) -> DataFrame:
    """What each key gained and lost between two tables of item arrays: (key, added, removed); rows without change are left out."""
    none = F.array().cast(old.schema[items].dataType)
    both = old.select(key, F.col(items).alias("_old")).join(new.select(key, F.col(items).alias("_new")), key, "full")
    a, b = F.coalesce("_old", none), F.coalesce("_new", none)
    out = both.select(key, F.array_sort(F.array_except(b, a)).alias("added"), F.array_sort(F.array_except(a, b)).alias("removed"))
    return out.where((F.size("added") > 0) | (F.size("removed") > 0))

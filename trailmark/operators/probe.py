"""Wifi probe readings: visits to venues, new devices, and devices per slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.scalars import day_number, hour_of_day, minute_of_day
from trailmark.operators.sessions import gap_sessions

GAP_MS, LEAST_MS = 7_200_000, 60_000
FEWEST, MOST = 3, 5760


def per_minute(readings: DataFrame) -> DataFrame:
    """The latest reading of each venue, device and minute."""
    keys = ["venue", "mac", F.floor(F.col("time") / 60_000).alias("minute")]
    rest = [c for c in readings.columns if c not in ("venue", "mac")]
    return readings.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("time", "event_id")).alias("r")).select("venue", "mac", "r.*")


def real_devices(readings: DataFrame) -> DataFrame:
    """Readings of devices with 3 to 5760 of them, of which one comes more than a minute, and at most two hours, after its run began.

    A run begins with the first reading, and anew with each that comes more than two hours after its beginning. Only devices of
    so few readings are folded in order of time.
    """
    keys = ["venue", "mac"]
    some = readings.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n").between(FEWEST, MOST)).drop("_n")
    times = readings.join(some, keys).groupBy(*keys).agg(F.sort_array(F.collect_list("time")).alias("_t"))
    begin = F.struct(F.get("_t", 0).alias("start"), F.lit(False).alias("long"))

    def step(run: Column, t: Column) -> Column:
        since = t - run["start"]
        return F.struct(F.when(since > GAP_MS, t).otherwise(run["start"]).alias("start"), (run["long"] | since.between(LEAST_MS + 1, GAP_MS)).alias("long"))

    real = times.where(F.aggregate("_t", begin, step, lambda run: run["long"])).select(*keys)
    return readings.join(real, keys, "left_semi")


def visits(readings: DataFrame) -> DataFrame:
    """Stays at a venue, cut at gaps of more than two hours, of a minute or longer."""
    return gap_sessions(readings, "venue", "mac", gap_ms=GAP_MS, least_ms=LEAST_MS)


def first_seen(readings: DataFrame, old: DataFrame | None = None) -> DataFrame:
    new = readings.select("venue", "mac", F.col("time").alias("first_time"))
    return (old.unionByName(new) if old is not None else new).groupBy("venue", "mac").agg(F.min("first_time").alias("first_time"))


def venue_report(visited: DataFrame, first: DataFrame) -> DataFrame:
    """Per venue and day: visits, devices, stay and devices that are new that day."""
    v = visited.withColumn("day", day_number(F.col("start"))).join(first, ["venue", "mac"])
    new = F.countDistinct(F.when(day_number(F.col("first_time")) == F.col("day"), F.col("mac")))
    return v.groupBy("venue", "day").agg(F.count("*").alias("visits"), F.countDistinct("mac").alias("devices"), F.sum(F.col("end") - F.col("start")).alias("stay"), new.alias("new_devices"))


def brand_report(visited: DataFrame, first: DataFrame, brands: DataFrame) -> DataFrame:
    """Per venue and whether the device's brand is known: visits, stay and new devices. brands: mac, brand (null where unknown)."""
    v = visited.join(first, ["venue", "mac"]).join(brands, "mac", "left").withColumn("known", F.col("brand").isNotNull().cast("int"))
    return v.groupBy("venue", "known").agg(F.count("*").alias("visits"), F.sum(F.col("end") - F.col("start")).alias("stay"), F.countDistinct(F.when(F.col("first_time") == F.col("start"), F.col("mac"))).alias("new_devices"))


def grid(readings: DataFrame, unit: str) -> DataFrame:
    """Distinct devices of each venue, day and hour or minute, with zeros."""
    slots, slot = {"hour": (24, hour_of_day), "minute": (1440, minute_of_day)}[unit]
    timed = readings.select("venue", day_number(F.col("time")).alias("day"), slot(F.col("time")).alias("slot"), "mac")
    seen = timed.groupBy("venue", "day", "slot").agg(F.countDistinct("mac").alias("devices"))
    empty = seen.select("venue", "day").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return empty.join(seen, ["venue", "day", "slot"], "left").select("venue", "day", "slot", F.coalesce("devices", F.lit(0)).alias("devices"))


def mac_list(readings: DataFrame) -> DataFrame:
    """Devices of each venue with their brand and the last time they were seen."""
    return readings.groupBy("venue", "mac").agg(F.max("time").alias("last_time"), F.max("brand").alias("brand"))

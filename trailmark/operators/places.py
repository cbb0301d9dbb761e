"""Places of users: thinned tracks, clusters of points, and what a cluster is to its user."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.scalars import day_number, hour_of_day

THIN_DEG, RADIUS_DEG, SAMPLES, DAYS = 0.0009, 0.05, 50, 60


def thinned(points: DataFrame, least: float = THIN_DEG) -> DataFrame:
    """Points of each uuid by time: the first, then each whose distance |lon| + |lat| to the last kept is above the least.

    What is kept depends on what was kept before, so users are sorted within partitions and read as a stream. From a kept point
    on, the next one is looked for in growing stretches of rows at once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user, lon, lat = None, 0.0, 0.0
        for pdf in batches:
            x, y = pdf["lon"].to_numpy(float), pdf["lat"].to_numpy(float)
            starts = np.flatnonzero((pdf["uuid"] != pdf["uuid"].shift()).to_numpy())
            keep = np.zeros(len(pdf), bool)
            for begin, end in zip(starts.tolist(), [*starts.tolist()[1:], len(pdf)], strict=True):
                i = begin
                if pdf["uuid"].iat[begin] != user:
                    user, lon, lat, i = pdf["uuid"].iat[begin], x[begin], y[begin], begin + 1
                    keep[begin] = True
                stretch = 16
                while i < end:
                    far = np.abs(x[i : min(end, i + stretch)] - lon) + np.abs(y[i : min(end, i + stretch)] - lat) > least
                    if far.any():
                        i += int(far.argmax())
                        keep[i], lon, lat, stretch = True, x[i], y[i], 16
                        i += 1
                    else:
                        i, stretch = i + len(far), 2 * stretch
            yield pdf[keep]

    return points.repartition("uuid").sortWithinPartitions("uuid", "time", "event_id").mapInPandas(run, points.schema)


CLUSTER = "uuid string, cluster int, lon double, lat double, n long, min_time long, max_time long, hours map<int,int>, days map<long,int>, label_lon double, label_lat double"


class _Place:
    """A cluster of a user's points: the running mean of them all, and the SAMPLES of them that stay near it."""

    def __init__(self, time: int):
        self.lon = self.lat = 0.0
        self.n, self.first, self.last = 0, time, time
        self.hours: dict[int, int] = {}
        self.days: dict[int, int] = {}
        self.points: list[tuple[float, float]] = []

    def away(self, x: float, y: float) -> float:
        return (self.lon - x) ** 2 + (self.lat - y) ** 2

    def take(self, time: int, x: float, y: float, hour: int, day: int) -> None:
        self.n, self.last = self.n + 1, time
        self.lon, self.lat = self.lon + (x - self.lon) / self.n, self.lat + (y - self.lat) / self.n
        self.hours[hour] = self.hours.get(hour, 0) + 1
        self.days[day] = self.days.get(day, 0) + 1
        self.points.append((x, y))
        if len(self.points) > SAMPLES:
            self.points.remove(max(self.points, key=lambda p: self.away(*p)))

    def row(self, user: str, i: int) -> tuple:
        near = min(self.points, key=lambda p: self.away(*p))
        return user, i, self.lon, self.lat, self.n, self.first, self.last, self.hours, self.days, *near


def clusters(points: DataFrame, radius: float = RADIUS_DEG, days: int = DAYS) -> DataFrame:
    """Clusters of each uuid's points in order of time: a point joins the nearest centre within the radius, else opens a cluster.

    A centre is the running mean of all points of its cluster. A cluster that took no point for `days` days takes none any more.
    Clusters are numbered as they open; the label point is the stored sample nearest to the centre, the earliest of equals.
    Points come sorted, and only a user's clusters are held, SAMPLES points each.
    """
    timed = points.select("uuid", "time", "event_id", "lon", "lat", hour_of_day(F.col("time")).alias("hour"), day_number(F.col("time")).alias("day"))
    names = [c.split()[0] for c in CLUSTER.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user, held, out = None, [], []
        for pdf in batches:
            for u, t, x, y, hour, day in zip(*(pdf[c].tolist() for c in ("uuid", "time", "lon", "lat", "hour", "day")), strict=True):
                if u != user:
                    out += [c.row(user, i) for i, c in enumerate(held)]
                    user, held = u, []
                near = min((c for c in held if t - c.last < days * 86_400_000), key=lambda c: c.away(x, y), default=None)
                if near is None or near.away(x, y) >= radius**2:
                    near = _Place(t)
                    held.append(near)
                near.take(t, x, y, hour, day)
            if len(out) > 5000:
                yield pd.DataFrame(out, columns=names)
                out = []
        out += [c.row(user, i) for i, c in enumerate(held)]
        if out:
            yield pd.DataFrame(out, columns=names)

    return timed.repartition("uuid").sortWithinPartitions("uuid", "time", "event_id").mapInPandas(run, CLUSTER)


def place_labels(found: DataFrame, hour_weight: DataFrame, calendar: DataFrame) -> DataFrame:
    """home, work, business or travel for each cluster. hour_weight: hour, night; calendar: day_num, day_off.

    Clusters by size: the first with a night score is home, the first other one used more on workdays is work; of the rest
    those used more on workdays are business, those on days off travel.
    """
    keys = ["uuid", "cluster"]
    night = found.select(*keys, F.explode("hours").alias("hour", "n")).join(hour_weight, "hour", "left").groupBy(*keys).agg(F.sum(F.col("n") * F.coalesce("night", F.lit(0.0))).alias("night"))
    off = found.select(*keys, F.explode("days").alias("day_num", "n")).join(calendar, "day_num", "left").groupBy(*keys).agg(F.sum(F.when(F.col("day_off"), 1).otherwise(-1)).alias("dayoff"))
    scored = found.join(night, keys).join(off, keys)
    order = W.partitionBy("uuid").orderBy(F.col("n").desc(), "cluster")
    home = scored.withColumn("_home", F.first(F.when(F.col("night") > 0, F.col("cluster")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    work = home.withColumn("_work", F.first(F.when((F.col("dayoff") < 0) & ~F.col("cluster").eqNullSafe(F.col("_home")), F.col("cluster")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    label = F.when(F.col("cluster") == F.col("_home"), "home").when(F.col("cluster") == F.col("_work"), "work").when(F.col("dayoff") < 0, "business").when(F.col("dayoff") > 0, "travel")
    return work.withColumn("label", label).where("label is not null").select(*keys, "label", F.col("label_lon").alias("lon"), F.col("label_lat").alias("lat"), "n")

"""Day tables that carry over: keyed merges, device records, identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged(old: DataFrame, new: DataFrame, keys: list[str], how: dict[str, Column]) -> DataFrame:
    """Old and new rows of a keyed table as one row per key; how gives each other column's aggregate. One shuffle, no lookups."""
    return old.unionByName(new).groupBy(*keys).agg(*[c.alias(n) for n, c in how.items()])


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new's keys taken out and new put in."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def added(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with rows of new whose keys it lacks."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def device_ids(events: DataFrame, kinds: dict[str, Column], old: DataFrame | None = None) -> DataFrame:
    """(uuid, kind, id, first_time): each id of a device with its earliest time, merged with the old table."""
    tall = events.select("uuid", "time", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("id")) for k, c in kinds.items()])).alias("i"))
    new = tall.select("uuid", "i.kind", "i.id", F.col("time").alias("first_time")).where(F.length("id") > 0)
    return (old.unionByName(new) if old is not None else new).groupBy("uuid", "kind", "id").agg(F.min("first_time").alias("first_time"))


def devices(events: DataFrame) -> DataFrame:
    """One record per device: first and last time, attributes of its first row, acc 1 if any row has it."""
    first = F.struct("time", "event_id")
    return events.groupBy("uuid").agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.min_by("system", first).alias("system"), F.min_by("sw", first).alias("sw"), F.min_by("sh", first).alias("sh"), F.max("acc").alias("acc"), F.countDistinct("appid").alias("apps"))


def device_merge() -> dict[str, Column]:
    """Aggregates of device rows; they may be taken again over what they gave, so a table of them takes batches."""
    apps = F.sort_array(F.array_distinct(F.flatten(F.collect_list("apps"))))
    return {"first": F.min("first"), "last_time": F.max("last_time"), "acc": F.max("acc"), "apps": apps}


def device_rows(events: DataFrame) -> DataFrame:
    """Each event as a device record of its own; first holds the time, event and attributes that the earliest row keeps."""
    first = F.struct("time", "event_id", "system", "sw", "sh").alias("first")
    return events.select("uuid", first, F.col("time").alias("last_time"), "acc", F.array("appid").alias("apps"))


def device_records(merged: DataFrame) -> DataFrame:
    """Device records as columns; apps as a list parted by commas."""
    return merged.select("uuid", F.col("first.time").alias("first_time"), "last_time", "first.system", "first.sw", "first.sh", "acc", F.array_join("apps", ",").alias("apps"))


def device_documents(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Device records with their ids by kind, each kind a sorted array."""
    per = ids.groupBy("uuid", "kind").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    maps = per.groupBy("uuid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "ids")))).alias("ids"))
    return records.join(maps, "uuid", "left")


def resolved(asked: DataFrame, by_imei: DataFrame, by_system: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The uuid of (imei, system_id) pairs: the imei's if known, else the system id's. Second: imei edges that this teaches.

    by_imei: imei, uuid; by_system: system_id, uuid; keys are unique.
    """
    hit = asked.join(by_imei.select("imei", F.col("uuid").alias("_i")), "imei", "left").join(by_system.select("system_id", F.col("uuid").alias("_s")), "system_id", "left")
    out = hit.select("imei", "system_id", F.coalesce("_i", "_s").alias("uuid"), F.col("_i").isNull().alias("_new"))
    learned = out.where(F.col("_new") & F.col("uuid").isNotNull() & (F.length("imei") > 0)).groupBy("imei").agg(F.min("uuid").alias("uuid"))
    return out.drop("_new"), learned


def uuids_of(edges: DataFrame, key: str) -> DataFrame:
    """The devices of each user id, address or account, sorted."""
    return edges.where(F.length(key) > 0).groupBy(key).agg(F.sort_array(F.collect_set("uuid")).alias("uuids"))


def looked_up(table: DataFrame, keys: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows of a table whose key is asked for."""
    return table.join(keys.select(key), key, "left_semi")


def newest(table: DataFrame, keys: DataFrame, start: int, end: int, n: int, key: str = "uuid", time: str = "time", tie: str = "event_id") -> DataFrame:
    """For each asked key the n newest rows within a time range, newest first."""
    from pyspark.sql import Window as W

    w = W.partitionBy(key).orderBy(F.col(time).desc(), F.col(tie).desc())
    return looked_up(table.where(F.col(time).between(start, end)), keys, key).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def gated(table: DataFrame, least: int) -> DataFrame | None:
    """The table if it has at least so many rows, else None: a broken day is not published."""
    return table if table.limit(least).count() >= least else None

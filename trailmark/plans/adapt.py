"""The driver's tables as canonical behaviour tables, in Spark and as DuckDB text of the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour events: a user is a device, one of five apps; views are pages, all else events."""
    return table(spark, sf_dir, "events").select(*columns_of_events())


def columns_of_events() -> list[Column]:
    user, at = F.col("user_id"), F.col("event_id")
    return [
        at.alias("event_id"),
        user.alias("user_id"),
        F.md5(user.cast("string")).alias("uuid"),
        (1200 + user % 5).cast("string").alias("appid"),
        F.concat(F.lit("ch"), (user % 4).cast("string")).alias("channel"),
        F.when(F.col("event_type") == "view", "50").otherwise("40").alias("logtype"),
        F.col("event_type").alias("subtype"),
        F.get_json_object("props", "$.k").cast("long").alias("pageid"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.concat(F.lit("10.0."), (user % 7).cast("string"), F.lit("."), (user % 50).cast("string")).alias("ip"),
        F.when(at % 7 == 0, 0).otherwise(1).alias("acc"),
        F.get(F.array(*[F.lit(x) for x in ("android", "ios", "windows")]), (user % 3).cast("int")).alias("system"),
        F.get(F.array(*[F.lit(x) for x in ("Chrome", "Safari", "Firefox", "UC")]), (at % 4).cast("int")).alias("browser"),
        F.get(F.array(*[F.lit(x) for x in (1080, 750, 1920)]), (user % 3).cast("int")).cast("long").alias("sw"),
        F.get(F.array(*[F.lit(x) for x in (1920, 1334, 0, 1200)]), (at % 4).cast("int")).cast("long").alias("sh"),
        F.col("value"),
    ]


#: The same in DuckDB, to stand behind WITH.
EV = """ev AS (SELECT event_id, user_id, md5(CAST(user_id AS VARCHAR)) AS uuid, CAST(1200 + user_id % 5 AS VARCHAR) AS appid,
 'ch' || CAST(user_id % 4 AS VARCHAR) AS channel, CASE WHEN event_type = 'view' THEN '50' ELSE '40' END AS logtype, event_type AS subtype,
 CAST(json_extract_string(props, '$.k') AS BIGINT) AS pageid, CAST(epoch_us(ts) // 1000 AS BIGINT) AS time,
 '10.0.' || CAST(user_id % 7 AS VARCHAR) || '.' || CAST(user_id % 50 AS VARCHAR) AS ip, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS acc,
 ['android', 'ios', 'windows'][1 + user_id % 3] AS system, ['Chrome', 'Safari', 'Firefox', 'UC'][1 + event_id % 4] AS browser,
 CAST([1080, 750, 1920][1 + user_id % 3] AS BIGINT) AS sw, CAST([1920, 1334, 0, 1200][1 + event_id % 4] AS BIGINT) AS sh, value FROM events)"""
DAY = "CAST((time + 28800000) // 86400000 + 1 AS BIGINT)"


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What customers gave parts: the sum of quantities."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy("user", "item").agg(F.sum("l_quantity").alias("score"))


RATINGS = "rt AS (SELECT o_custkey AS \"user\", l_partkey AS item, sum(l_quantity) AS score FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"

"""Streams: flows per window, sessions, filters, and runs of streams to their end.

Input streams have a timestamp column ts besides the canonical columns. Late data is bounded by a watermark, so state is too.
Rolling counts, presence, visits and idle users are in `processors`, tables that streams keep in `tables`.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.scalars import day_number, hour_of_day, web_label_value
from trailmark.operators import clean

LATE = "10 minutes"
GAP_MS = 600_000


def windowed_flow(events: DataFrame, size: str = "1 minute", late: str = LATE) -> DataFrame:
    """Exact page views, users, addresses and the latest time per app and window, when the window closes.

    Each pair of user and address of a window is one small state row, and windows past the watermark leave the state.
    """
    return flow_of(events.withWatermark("ts", late), size)


def flow_of(events: DataFrame, size: str) -> DataFrame:
    """windowed_flow of events that have a watermark."""
    keyed = events.withColumn("w", F.window("ts", size))
    pairs = keyed.groupBy("w", "appid", "uuid", "ip").agg(F.count("*").alias("n"), F.max("time").alias("last"))
    out = pairs.groupBy("w", "appid").agg(F.sum("n").alias("pv"), F.size(F.collect_set("uuid")).cast("long").alias("uv"), F.size(F.collect_set("ip")).cast("long").alias("ip"), F.max("last").alias("last_time"))
    return out.select(F.col("w.start").alias("start"), "appid", "pv", "uv", "ip", "last_time")


def exact_users(events: DataFrame, size: str = "1 minute", late: str = LATE) -> DataFrame:
    """Exact users per app and window: each is kept once per window, then counted; windows come out when they close."""
    once = events.withWatermark("ts", late).withColumn("w", F.window("ts", size)).dropDuplicates(["w", "appid", "uuid"])
    return once.groupBy("w", "appid").agg(F.count("*").alias("uv")).select(F.col("w.start").alias("start"), "appid", "uv")


def sessions(events: DataFrame, gap: str = "10 minutes", late: str = LATE) -> DataFrame:
    """Visits of each app and user, parted by gaps, when they close."""
    out = events.withWatermark("ts", late).groupBy("appid", "uuid", F.session_window("ts", gap)).agg(F.count("*").alias("n"), F.count(F.when(F.col("logtype") == "50", 1)).alias("pages"), F.min("time").alias("start"), F.max("time").alias("end"))
    return out.select("appid", "uuid", "start", "end", "n", "pages")


def last_times(events: DataFrame) -> DataFrame:
    return events.groupBy("appid").agg(F.max("time").alias("last_time"))


def fresh(events: DataFrame, now: Column) -> DataFrame:
    """Events of the day of now that are not in the future."""
    return events.where((F.col("time") <= now) & (day_number(F.col("time")) == day_number(now)))


def marked(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Events of marked devices (a static table)."""
    return events.join(devices.select("uuid"), "uuid", "left_semi")


def words(lines: DataFrame) -> DataFrame:
    """Running counts of words."""
    return lines.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word")).where("length(word) > 0").groupBy("word").count()


def leads(events: DataFrame) -> DataFrame:
    return clean.leads(events)


#: What the flow of several sources needs of each.
FLOW = ["ts", "appid", "uuid", "ip", "time"]


def of_web(lines: DataFrame) -> DataFrame:
    """Flow columns of web lines: a JSON text in value, with the time in milliseconds."""
    j = F.from_json("value", "t long, appid string, cookie string, ip string")
    return lines.select(F.timestamp_millis(j["t"]).alias("ts"), j["appid"].alias("appid"), j["cookie"].alias("uuid"), j["ip"].alias("ip"), j["t"].alias("time"))


def of_app(records: DataFrame) -> DataFrame:
    """Flow columns of app records: nested device and place, server time in ts."""
    return records.select("ts", "appid", F.col("device.uuid").alias("uuid"), F.col("device.ip").alias("ip"), F.unix_millis("ts").alias("time"))


def of_mini(lines: DataFrame) -> DataFrame:
    """Flow columns of mini-program lines: fields in value parted by `|`."""
    f = F.split("value", r"\|")
    return lines.select(F.timestamp_millis(f[3].cast("long")).alias("ts"), f[0].alias("appid"), f[1].alias("uuid"), f[2].alias("ip"), f[3].cast("long").alias("time"))


def merged_flow(sources: list[tuple[DataFrame, str]], size: str = "1 minute") -> DataFrame:
    """windowed_flow of several sources in FLOW columns, each with the lateness of its own that it is given with.

    Spark's policy for several watermarks is to follow the slowest, so a source that lags loses no rows, and windows wait for it.
    """
    each = [df.select(*FLOW).withWatermark("ts", late) for df, late in sources]
    return flow_of(reduce(DataFrame.unionByName, each), size)


# --- sinks -----------------------------------------------------------------------------------------------------------


def label_increments(batch: DataFrame, default_ms: int = 10_000) -> DataFrame:
    """Label values of a batch's pages: a page stays until the user's next row, the last one for a default time."""
    from pyspark.sql import Window as W

    w = W.partitionBy("uuid").orderBy("time", "event_id")
    stay = F.coalesce(F.lead("time").over(w) - F.col("time"), F.lit(default_ms))
    value = web_label_value(F.lit(1.0), F.least(stay, F.lit(GAP_MS)), F.lit(1.0), F.lit(0.0))
    return batch.withColumn("value", value).where("logtype = '50' and label is not null").groupBy("uuid", "company_id", "label").agg(F.sum("value").alias("value"))


#: State stores of typed processors.
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fed(stream: DataFrame, put, checkpoint: str, typed: bool = False, mode: str = "append") -> None:
    """Run a stream over what there is, each batch through put(batch, batch_id). typed: its state needs typed stores."""
    spark: SparkSession = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    if typed:
        spark.conf.set(PROVIDER, ROCKSDB)
    try:
        run = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
        run.awaitTermination()
    finally:
        if typed:
            spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_to_end(stream: DataFrame, folder: str, mode: str = "append", typed: bool = False) -> DataFrame:
    """Run a stream over what there is and give all its batches: its columns and batch. Output and checkpoint lie in folder."""
    spark: SparkSession = stream.sparkSession
    base = f"{folder}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    fed(stream, put, f"{base}/checkpoint", typed, mode)
    schema = stream.schema.add("batch", "long")
    return spark.read.schema(schema).parquet(f"{base}/out/*")


def hour_filter(events: DataFrame, first: int, last: int) -> DataFrame:
    return events.where(hour_of_day(F.col("time")).between(first, last))

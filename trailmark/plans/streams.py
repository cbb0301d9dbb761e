"""Stream queries: the events table read as a stream to its end.

A last row a day later, of no app and user, moves the watermark past all events, so streams give all that they hold; what comes of
that row itself is left out.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.operators import clean, state
from trailmark.plans.adapt import EV, columns_of_events, table
from trailmark.streaming import flows, processors, tables

Q, SQL = {}, {}
DAY_MS = 86_400_000
#: Batches of streams whose tables change from batch to batch: equal spans of the time of the events.
PIECES = 4


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def folder(spark: SparkSession) -> str:
    """Where streams keep their checkpoints: the shared folder; a temporary one where none is set and all runs on one machine."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-streams-")
    return where.rstrip("/")


def _own(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def event_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*columns_of_events(), F.col("ts").cast("timestamp").alias("ts"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a pattern, the path may be a file or a folder.
    raw = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")
    return raw.select(*columns_of_events(), F.col("ts").cast("timestamp").alias("ts"))


def _marker(events: DataFrame) -> DataFrame:
    """The row that ends a stream: every text is empty, every number 0, and the time a day after the last event."""
    last = F.max("ts") + F.expr("INTERVAL 1 DAY")
    value = lambda f: F.col("_end") if f.name == "ts" else F.unix_millis("_end") if f.name == "time" else F.lit("" if f.dataType.simpleString() == "string" else 0).cast(f.dataType)
    return events.agg(last.alias("_end")).select(*[value(f).alias(f.name) for f in events.schema])


def ended_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream with its last row."""
    path = _own(spark, "marker")
    marker = _marker(event_batch(spark, sf_dir))
    marker.write.parquet(path)
    return event_stream(spark, sf_dir).unionByName(spark.readStream.schema(marker.schema).parquet(path))


def with_piece(events: DataFrame) -> DataFrame:
    """events with the number of the equal span of time that they fall into."""
    span = events.agg(F.min("time").alias("_from"), F.max("time").alias("_to"))  # one row
    piece = F.least(F.lit(PIECES - 1), F.floor((F.col("time") - F.col("_from")) * PIECES / (F.col("_to") - F.col("_from") + 1)).cast("int"))
    return events.join(F.broadcast(span)).withColumn("piece", piece).drop("_from", "_to")


#: The same in DuckDB, behind EV.
PIECE = f"pc AS (SELECT ev.*, CAST(least({PIECES - 1}, floor((time - f) * {PIECES} / (t - f + 1))) AS INTEGER) AS piece FROM ev, (SELECT min(time) AS f, max(time) AS t FROM ev))"


def fed_by_pieces(spark: SparkSession, sf_dir: str, rows: Callable[[DataFrame], DataFrame], put: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """The events, with a column piece, through rows and put(batch, batch_id) in PIECES batches.

    A piece is what has come when the stream runs again from its checkpoint, in as many files as tasks write, so that a batch is
    one piece of any number of files.
    """
    path, e = _own(spark, "pieces"), with_piece(event_batch(spark, sf_dir))
    for i in range(PIECES):
        e.where(F.col("piece") == i).write.parquet(f"{path}/part{i}")
        flows.fed(rows(spark.readStream.schema(e.schema).parquet(f"{path}/*")), put, checkpoint)


def _last(df: DataFrame, *keys: str) -> DataFrame:
    """The latest state of each key among the batches of a stream."""
    w = W.partitionBy(*keys).orderBy(F.col("batch").desc())
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "batch")


def _real(df: DataFrame, column: str = "appid") -> DataFrame:
    return df.where(F.col(column) != "")


FLOW_SQL = "SELECT CAST(time // 60000 * 60000 AS BIGINT) AS start_ms, appid, CAST(count(*) AS BIGINT) AS pv, count(DISTINCT uuid) AS uv, count(DISTINCT ip) AS ip, max(time) AS last_time FROM ev GROUP BY ALL"


@query("stream_flow", f"WITH {EV} {FLOW_SQL}")
def stream_flow(spark, sf_dir):
    out = _real(flows.run_to_end(flows.windowed_flow(ended_stream(spark, sf_dir)), folder(spark)))
    return out.select(F.unix_millis("start").alias("start_ms"), "appid", "pv", "uv", "ip", "last_time")


@query("stream_sources", f"WITH {EV} {FLOW_SQL}")
def stream_sources(spark, sf_dir):
    """Web lines, nested app records and mini-program fields, each a stream of its own with its own lateness."""
    e = lambda *apps: ended_stream(spark, sf_dir).where(F.col("appid").isin(*apps, ""))
    web = e("1200", "1201").select(F.to_json(F.struct(F.col("time").alias("t"), "appid", F.col("uuid").alias("cookie"), "ip")).alias("value"))
    app = e("1202", "1203").select("ts", "appid", F.struct("uuid", "ip").alias("device"))
    mini = e("1204").select(F.concat_ws("|", "appid", "uuid", "ip", F.col("time").cast("string")).alias("value"))
    out = flows.merged_flow([(flows.of_web(web), "10 minutes"), (flows.of_app(app), "30 minutes"), (flows.of_mini(mini), "1 hour")])
    out = _real(flows.run_to_end(out, folder(spark)))
    return out.select(F.unix_millis("start").alias("start_ms"), "appid", "pv", "uv", "ip", "last_time")


HOUR_MS, STEP_MS = 3_600_000, 60_000


@query("rolling_flow", f"""WITH {EV}, s AS (SELECT appid, uuid, ip, CAST(logtype = '50' AS INTEGER) AS page, CAST((time + {STEP_MS - 1}) // {STEP_MS} * {STEP_MS} AS BIGINT) AS step FROM ev),
e AS (SELECT DISTINCT appid, unnest([step, step + {HOUR_MS}]) AS "end" FROM s)
SELECT e.appid, e."end", CAST(coalesce(sum(page), 0) AS BIGINT) AS pv, count(DISTINCT uuid) AS uv, count(DISTINCT ip) AS ip FROM e LEFT JOIN s ON s.appid = e.appid AND s.step <= e."end" AND s.step > e."end" - {HOUR_MS} GROUP BY ALL""")
def rolling_flow(spark, sf_dir):
    """Pages, users and addresses of each app in the last hour, at each end of a minute at which they change."""
    changes = processors.rolling(ended_stream(spark, sf_dir), "appid", {"uv": "uuid", "ip": "ip"}, HOUR_MS, STEP_MS, F.col("logtype") == "50")
    return processors.totals(_real(flows.run_to_end(changes, folder(spark), typed=True), "key"), ["uv", "ip"]).select(F.col("key").alias("appid"), "end", F.col("n").alias("pv"), "uv", "ip")


@query("stream_users", f"WITH {EV} SELECT CAST(time // 3600000 * 3600000 AS BIGINT) AS start_ms, appid, count(DISTINCT uuid) AS uv FROM ev GROUP BY ALL")
def stream_users(spark, sf_dir):
    out = flows.run_to_end(flows.exact_users(ended_stream(spark, sf_dir), "1 hour"), folder(spark))
    return _real(out).select(F.unix_millis("start").alias("start_ms"), "appid", "uv")


@query("stream_sessions", f"""WITH {EV}, t AS (SELECT ev.*, epoch_us(ts) AS us FROM ev JOIN events USING (event_id)), g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY appid, uuid ORDER BY us, event_id) < 600000000 THEN 0 ELSE 1 END AS cut FROM t),
s AS (SELECT *, sum(cut) OVER (PARTITION BY appid, uuid ORDER BY us, event_id) AS k FROM g) SELECT appid, uuid, min(time) AS start, max(time) AS "end", count(*) AS n, count(*) FILTER (WHERE logtype = '50') AS pages FROM s GROUP BY appid, uuid, k""")
def stream_sessions(spark, sf_dir):
    return _real(flows.run_to_end(flows.sessions(ended_stream(spark, sf_dir)), folder(spark)).drop("batch"))


@query("stream_last_time", f"WITH {EV} SELECT appid, max(time) AS last_time FROM ev GROUP BY appid")
def stream_last_time(spark, sf_dir):
    return _last(flows.run_to_end(flows.last_times(event_stream(spark, sf_dir)), folder(spark), "update"), "appid")


#: In the visit stream, apps of odd number time their pages when they close, and sign-ups stand for coming to the foreground.
CLOSES_SQL = "CAST(appid AS INTEGER) % 2 = 1"


@query("stream_visits", f"""WITH RECURSIVE {EV}, r AS (SELECT appid, uuid, time, CASE WHEN subtype = 'signup' THEN '10' ELSE logtype END AS kind, {CLOSES_SQL} AS closes, row_number() OVER (PARTITION BY appid, uuid ORDER BY time, event_id) AS i FROM ev),
s AS (
  SELECT appid, uuid, i, CAST(1 AS BIGINT) AS visit, time AS start, time AS "end", CAST(kind = '50' AS BIGINT) AS pages, CAST(0 AS BIGINT) AS stay, CASE WHEN kind = '50' THEN time END AS page, CASE WHEN kind = '10' THEN time END AS front FROM r WHERE i = 1
  UNION ALL
  SELECT r.appid, r.uuid, r.i, CASE WHEN cut THEN visit + 1 ELSE visit END, CASE WHEN cut THEN time ELSE start END, CASE WHEN cut OR kind = '50' THEN time ELSE "end" END,
    CASE WHEN cut THEN 0 ELSE pages END + CAST(kind = '50' AS BIGINT),
    CASE WHEN cut THEN 0 WHEN kind <> '50' THEN stay WHEN closes THEN stay + time - coalesce(page, front, time) ELSE stay + coalesce(time - page, 0) END,
    CASE WHEN kind = '50' THEN time WHEN cut THEN NULL ELSE page END, CASE WHEN kind = '10' THEN time WHEN cut THEN NULL ELSE front END
  FROM (SELECT s.visit, s.start, s."end", s.pages, s.stay, s.page, s.front, r.*, r.time - s."end" > 600000 AS cut FROM s JOIN r ON r.appid = s.appid AND r.uuid = s.uuid AND r.i = s.i + 1) r)
SELECT appid, uuid, visit, any_value(start) AS start, max("end") AS "end", max(pages) AS pages, max(stay) AS stay FROM s GROUP BY appid, uuid, visit""")
def stream_visits(spark, sf_dir):
    e = ended_stream(spark, sf_dir).withColumn("logtype", F.when(F.col("subtype") == "signup", "10").otherwise(F.col("logtype")))
    out = flows.run_to_end(processors.visits(e, F.coalesce(F.col("appid").try_cast("int") % 2 == 1, F.lit(False))), folder(spark), typed=True)
    # A visit comes again in each batch that changes it, and with changed = false when it is over; the latest is whole.
    latest = W.partitionBy("appid", "uuid", "visit").orderBy(F.col("batch").desc(), "changed")
    return _real(out).withColumn("_n", F.row_number().over(latest)).where("_n = 1").select("appid", "uuid", "visit", "start", "end", "pages", "stay")


#: A probe reading is looked at in steps of eight hours here, as the events of a user are hours apart.
PRESENCE_MS = 28_800_000
READINGS = f"r AS (SELECT CAST(user_id % 3 AS VARCHAR) AS venue, uuid AS mac, time, CAST((time + {PRESENCE_MS - 1}) // {PRESENCE_MS} * {PRESENCE_MS} AS BIGINT) AS step FROM ev)"


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    venue = F.when(F.col("uuid") == "", "").otherwise((F.col("user_id") % 3).cast("string"))
    return ended_stream(spark, sf_dir).select("ts", "time", venue.alias("venue"), F.col("uuid").alias("mac"))


@query("stream_online", f"""WITH {EV}, {READINGS}, d AS (SELECT DISTINCT venue, mac, step FROM r),
c AS (SELECT venue, step AS "end", 1 AS entered FROM d WHERE NOT EXISTS (FROM d p WHERE p.venue = d.venue AND p.mac = d.mac AND p.step = d.step - {PRESENCE_MS})
  UNION ALL SELECT venue, step + {PRESENCE_MS}, -1 FROM d WHERE NOT EXISTS (FROM d n WHERE n.venue = d.venue AND n.mac = d.mac AND n.step = d.step + {PRESENCE_MS})),
g AS (SELECT venue, "end", count(*) FILTER (WHERE entered > 0) AS entered, count(*) FILTER (WHERE entered < 0) AS "left" FROM c GROUP BY ALL)
SELECT *, CAST(sum(entered - "left") OVER (PARTITION BY venue ORDER BY "end") AS BIGINT) AS online FROM g""")
def stream_online(spark, sf_dir):
    """Devices that enter and leave each venue, and how many are there."""
    changes = flows.run_to_end(processors.presence(_readings(spark, sf_dir), PRESENCE_MS), folder(spark), typed=True)
    return processors.online(_real(changes, "venue"))


@query("stream_presence", f"""WITH {EV}, {READINGS}, d AS (SELECT venue, mac, step, min(time) AS first FROM r GROUP BY ALL),
e AS (SELECT *, CASE WHEN step - lag(step) OVER w = {PRESENCE_MS} THEN 0 ELSE 1 END AS fresh FROM d WINDOW w AS (PARTITION BY venue, mac ORDER BY step)),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY venue, mac ORDER BY step) AS stay FROM e)
SELECT venue, mac, min(first) AS entered_at, min(step) AS "from", max(step) + {PRESENCE_MS} AS "to" FROM k GROUP BY venue, mac, stay""")
def stream_presence(spark, sf_dir):
    """Each stay of a device at a venue: its earliest reading, and the steps at which it entered and left."""
    changes = _real(flows.run_to_end(processors.presence(_readings(spark, sf_dir), PRESENCE_MS), folder(spark), typed=True), "venue")
    ends = lambda sign, name: changes.where(F.col("entered") == sign).select("venue", "mac", F.col("time").alias("entered_at"), F.col("end").alias(name))
    return ends(1, "from").join(ends(-1, "to"), ["venue", "mac", "entered_at"])


@query("probe_counts", f"""WITH {EV}, s AS (SELECT CAST(user_id % 3 AS VARCHAR) AS venue, uuid, CAST((time + {STEP_MS - 1}) // {STEP_MS} * {STEP_MS} AS BIGINT) AS step FROM ev),
e AS (SELECT DISTINCT venue, unnest([step, step + {STEP_MS}]) AS "end" FROM s)
SELECT e.venue, e."end", count(s.uuid) AS pv, count(DISTINCT s.uuid) AS uv FROM e LEFT JOIN s ON s.venue = e.venue AND s.step = e."end" GROUP BY ALL""")
def probe_counts(spark, sf_dir):
    """Readings and devices of each venue in the last minute, at each end of a minute at which they change."""
    changes = processors.rolling(_readings(spark, sf_dir), "venue", {"uv": "mac"}, STEP_MS, STEP_MS)
    return processors.totals(_real(flows.run_to_end(changes, folder(spark), typed=True), "key"), ["uv"]).select(F.col("key").alias("venue"), "end", F.col("n").alias("pv"), "uv")


@query("stream_idle", f"""WITH {EV}, f AS (SELECT *, (time + 28800000) // 86400000 AS day, min((time + 28800000) // 86400000) OVER (PARTITION BY appid, uuid) AS first_day FROM ev),
t AS (SELECT *, lag(time) OVER w AS before, lead(time) OVER w AS after FROM f WHERE day = first_day WINDOW w AS (PARTITION BY appid, uuid ORDER BY time, event_id)),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR time - before >= 600000 THEN 1 ELSE 0 END) OVER (PARTITION BY appid, uuid ORDER BY time, event_id) AS run FROM t),
r AS (SELECT uuid, appid, CAST(any_value(day) + 1 AS BIGINT) AS day, run, count(*) FILTER (WHERE logtype = '50') AS pages, max(time) - min(time) AS stay, max(time) AS last_time, bool_or(subtype = 'purchase') AS lead FROM g GROUP BY appid, uuid, run)
SELECT uuid, appid, day, pages, stay, last_time FROM r WHERE NOT lead AND (last_time + 600000 + 28800000) % 86400000 // 3600000 BETWEEN 8 AND 20 QUALIFY row_number() OVER (PARTITION BY appid, uuid ORDER BY run) = 1""")
def stream_idle(spark, sf_dir):
    """Pushes to users on the first day they were ever seen; who was seen when comes from the batch side."""
    seen = event_batch(spark, sf_dir).groupBy("appid", "uuid").agg(F.min("time").alias("first_time"))
    end = spark.createDataFrame([("", "", 0)], "appid string, uuid string, first_time long")
    pushes = processors.idle(ended_stream(spark, sf_dir), seen.unionByName(end), F.col("subtype") == "purchase")
    return _real(flows.run_to_end(pushes, folder(spark), typed=True)).drop("batch")


@query("stream_tap", f"WITH {EV} SELECT event_id, uuid FROM ev WHERE uuid IN (SELECT uuid FROM ev WHERE subtype = 'purchase')")
def stream_tap(spark, sf_dir):
    devices = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.md5(F.col("user_id").cast("string")).alias("uuid")).distinct()
    return flows.run_to_end(flows.marked(event_stream(spark, sf_dir), devices), folder(spark)).select("event_id", "uuid")


# --- tables that streams keep ------------------------------------------------------------------------------------------


def _kept(spark: SparkSession, sf_dir: str, rows: Callable[[DataFrame], DataFrame], kept: tables.Keyed, schema: str) -> DataFrame:
    fed_by_pieces(spark, sf_dir, rows, kept.put, f"{kept.path}/checkpoint")
    return kept.current(spark, schema)


@query("stream_counters", f"WITH {EV} SELECT appid, CAST(time // 60000 * 60000 AS BIGINT) AS minute, CAST(count(*) AS BIGINT) AS n, max(time) AS last_time FROM ev GROUP BY ALL")
def stream_counters(spark, sf_dir):
    """Counters per app and minute, merged batch by batch into a table of buckets."""
    rows = lambda e: e.select("appid", (F.floor(F.col("time") / 60_000) * 60_000).cast("long").alias("minute"), F.lit(1).cast("long").alias("n"), F.col("time").alias("last_time"))
    kept = tables.Keyed(_own(spark, "counters"), ["appid", "minute"], {"n": F.sum("n"), "last_time": F.max("last_time")}, 16)
    return _kept(spark, sf_dir, rows, kept, "appid string, minute long, n long, last_time long")


@query("stream_labels", f"""WITH {EV}, {PIECE}, s AS (SELECT *, least(coalesce(lead(time) OVER (PARTITION BY piece, uuid ORDER BY time, event_id) - time, 10000), 600000) AS stay FROM pc)
SELECT uuid, appid AS company_id, system AS label, round(sum(0.7::DOUBLE + stay / 20000::DOUBLE * 0.3::DOUBLE), 6) AS value FROM s WHERE logtype = '50' GROUP BY ALL""")
def stream_labels(spark, sf_dir):
    """Label increments of each batch, added to a table per user, company and label."""
    kept = tables.Keyed(_own(spark, "labels"), ["uuid", "company_id", "label"], {"value": F.sum("value")}, 16)
    rows = lambda e: e.withColumn("company_id", F.col("appid")).withColumn("label", F.col("system"))
    fed_by_pieces(spark, sf_dir, rows, lambda batch, i: kept.put(flows.label_increments(batch), i), f"{kept.path}/checkpoint")
    return kept.current(spark, "uuid string, company_id string, label string, value double").withColumn("value", F.round("value", 6))


@query("stream_devices", f"""WITH {EV}, a AS (SELECT DISTINCT uuid, appid FROM ev), j AS (SELECT uuid, string_agg(appid, ',' ORDER BY appid) AS apps FROM a GROUP BY uuid)
SELECT uuid, min(time) AS first_time, max(time) AS last_time, arg_min(system, (time, event_id)) AS system, arg_min(sw, (time, event_id)) AS sw, arg_min(sh, (time, event_id)) AS sh, CAST(max(acc) AS INTEGER) AS acc, any_value(apps) AS apps FROM ev JOIN j USING (uuid) GROUP BY uuid""")
def stream_devices(spark, sf_dir):
    """Device records that each batch brings up to date."""
    kept = tables.Keyed(_own(spark, "devices"), ["uuid"], state.device_merge(), 16)
    schema = state.device_rows(with_piece(event_batch(spark, sf_dir))).schema
    return state.device_records(_kept(spark, sf_dir, state.device_rows, kept, schema))


@query("stream_dimension", f"""WITH RECURSIVE {EV}, {PIECE}, b AS (SELECT piece, max(time) AS now FROM pc GROUP BY piece),
v AS (SELECT piece, now, now AS loaded, piece AS version FROM b WHERE piece = 0
  UNION ALL SELECT b.piece, b.now, CASE WHEN b.now - loaded < {15 * DAY_MS // 2 + 5 * DAY_MS} THEN loaded ELSE b.now END, CASE WHEN b.now - loaded < {15 * DAY_MS // 2 + 5 * DAY_MS} THEN version ELSE b.piece END FROM v JOIN b ON b.piece = v.piece + 1),
m AS (SELECT v.version, uuid, arg_max(value, (time, event_id)) AS spent FROM (SELECT DISTINCT version, loaded FROM v) v JOIN ev ON time <= loaded AND subtype = 'purchase' GROUP BY ALL)
SELECT pc.event_id, CAST(v.version AS BIGINT) AS version, m.spent FROM pc JOIN v USING (piece) JOIN m ON m.version = v.version AND m.uuid = pc.uuid WHERE pc.logtype = '50'""")
def stream_dimension(spark, sf_dir):
    """Pages with what their user last spent, from a dimension that batches load anew when it is over twelve days old; a batch's clock is its last event."""
    every = event_batch(spark, sf_dir).where("subtype = 'purchase'")
    load = lambda spark, now: every.where(F.col("time") <= now).groupBy("uuid").agg(F.max_by("value", F.struct("time", "event_id")).alias("spent"))
    spent = tables.Refreshing(_own(spark, "spent"), load, 15 * DAY_MS // 2 + 5 * DAY_MS)
    out = _own(spark, "joined")

    def put(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max("time")).first()[0]
        if now is not None:
            found = batch.where("logtype = '50'").join(spent.at(batch.sparkSession, batch_id, now), "uuid").select("event_id", "version", "spent")
            found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    fed_by_pieces(spark, sf_dir, lambda e: e, put, f"{out}/checkpoint")
    return spark.read.schema("event_id long, version long, spent double").parquet(f"{out}/batch=*")


@query("stream_leads", f"WITH {EV} SELECT uuid, appid, time, '1' || CAST(user_id AS VARCHAR) AS phone FROM ev WHERE subtype = 'purchase'")
def stream_leads(spark, sf_dir):
    """Leads of a stream, appended as they come; a purchase stands for a lead with a phone."""
    data = F.to_json(F.struct(F.concat(F.lit("1"), F.col("user_id").cast("string")).alias("phone")))
    e = event_stream(spark, sf_dir).withColumn("subtype", F.when(F.col("subtype") == "purchase", clean.LEAD).otherwise(F.col("subtype"))).withColumn("data", data)
    return flows.run_to_end(flows.leads(e), folder(spark)).select("uuid", "appid", "time", "phone")


@query("stream_last_times", f"WITH {EV} SELECT s AS stream, max(time) AS last_time FROM (SELECT CASE WHEN appid IN ('1200', '1201') THEN 'web' WHEN appid = '1204' THEN 'mini' ELSE 'app' END AS s, time FROM ev) GROUP BY s")
def stream_last_times(spark, sf_dir):
    """The latest event time of each stream."""
    which = F.when(F.col("appid").isin("1200", "1201"), "web").when(F.col("appid") == "1204", "mini").otherwise("app")
    e = event_stream(spark, sf_dir).withColumn("appid", which)
    return _last(flows.run_to_end(flows.last_times(e), folder(spark), "update"), "appid").withColumnRenamed("appid", "stream")

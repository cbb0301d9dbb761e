"""Raw log lines to typed events. Each cleaner gives one row per event with a status: 200 is good, all else is kept for the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.scalars import android_valid, bound, cookie_valid, device_uuid, idfa_valid, imei_complete, imei_valid, rule_holds, unhex_escapes

#: Status of a line (fixed values): what each number says.
STATUS = {
    200: "good", 101: "bad format", 102: "bad JSON", 103: "no identifier", 104: "no app id", 105: "missing field", 106: "bad value of a field", 107: "unknown app",
    108: "no version", 109: "bad url", 120: "bad device id", 121: "probe without signal", 122: "bad id of a device", 404: "not known",
}
OK, SHORT, BAD_JSON, NO_APP, MISSING, UNKNOWN_APP, BAD_URL, BAD_ID, FAR, UNKNOWN = 200, 101, 102, 104, 105, 107, 109, 120, 121, 404


def status_name(status: Column) -> Column:
    return F.coalesce(*[F.when(status == k, F.lit(v)) for k, v in STATUS.items()], F.lit("undefined"))


#: Names of events in the canonical table.
LOGIN, REGISTER, LOGOUT, LEAD = "login", "register", "logout", "commit_clue"
LEAD_NAMES = ["get_user_clue", "get_user_club", "commit_free_design"]
MAX_STAY_MS = 600_000


def _field(json: str, *names: str) -> Column:
    return F.coalesce(*[F.get_json_object(json, f"$.{n}") for n in names]) if len(names) > 1 else F.get_json_object(json, f"$.{names[0]}")


def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _has(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.coalesce(F.length(c) > 0, F.lit(False))
    return out


def web(lines: DataFrame, apps: DataFrame) -> DataFrame:
    """Web lines (value) to events. apps: appid. A line is checked for JSON, six fields, app, cookie id and url, in this order."""
    raw = lines.select("value", F.replace(F.col("value"), F.lit("\\x"), F.lit("%")).alias("_j"))
    parsed = raw.select(
        "value",
        F.get_json_object("_j", "$").isNotNull().alias("_json"),
        _field("_j", "id").alias("appid"),
        F.when(F.length(_field("_j", "feuuid")) > 0, _field("_j", "feuuid")).otherwise(_field("_j", "uuid")).alias("cookie"),
        _field("_j", "type").alias("_type"),
        _field("_j", "sub_type").alias("_sub"),
        _field("_j", "ip").alias("ip"),
        _decoded(_field("_j", "ref")).alias("ref"),
        _decoded(_field("_j", "url")).alias("url"),
        _field("_j", "time").try_cast("long").alias("time"),
        F.coalesce(_field("_j", "userid"), F.lit("")).alias("userid"),
        _decoded(_field("_j", "title")).alias("title"),
        _decoded(_field("_j", "data")).alias("data"),
        F.coalesce(_field("_j", "is_people").try_cast("int"), F.lit(0)).alias("acc"),
        F.map_from_arrays(F.array(*[F.lit(k) for k in ("sw", "sh", "agent", "language")]), F.array(*[_field("_j", k) for k in ("sw", "sh", "agnet", "language")])).alias("device"),
    )
    known = parsed.join(apps.select("appid", F.lit(True).alias("_known")).distinct(), "appid", "left")
    status = (
        F.when(~F.col("_json"), BAD_JSON)
        .when(~(_has("appid", "_type", "ip", "url") & F.col("ref").isNotNull() & F.col("time").isNotNull()), MISSING)
        .when(F.col("_known").isNull(), NO_APP)
        .when(~cookie_valid(F.col("cookie")), BAD_ID)
        .when(F.length("url") < 10, BAD_URL)
        .when(~F.col("_type").isin("20", "30", "40"), BAD_JSON)
        .otherwise(OK)
    )
    account = F.when(F.col("_sub") == "1", LOGIN).when(F.col("_sub") == "3", REGISTER).otherwise(LOGOUT)
    subtype = F.when(F.col("_type") == "20", account).when((F.col("_type") == "40") & F.col("_sub").isin(LEAD_NAMES), LEAD).otherwise(F.col("_sub"))
    return known.withColumn("status", status).withColumn("logtype", F.when(F.col("_type") == "30", "50").otherwise("40")).withColumn("subtype", subtype).withColumn("uuid", device_uuid(F.lit("cookie"), F.col("cookie"))).drop("_json", "_type", "_sub", "_known")


def envelope(lines: DataFrame) -> DataFrame:
    """Mobile lines to ip, time and body: the address in front, a second.millisecond or server time, and data= to ` HTTP` or ` EOF`."""
    v = F.col("value")
    exact = F.regexp_extract(v, r"\[([0-9]{10})[.:]([0-9]{1,3})\]", 1).try_cast("long") * 1000 + F.regexp_extract(v, r"\[([0-9]{10})[.:]([0-9]{1,3})\]", 2).try_cast("long")
    server = F.unix_millis(F.try_to_timestamp(F.regexp_extract(v, r"\[([0-9]{2}/[A-Za-z]{3}/[0-9]{4}:[0-9:]{8} [+-][0-9]{4})\]", 1), F.lit("dd/MMM/yyyy:HH:mm:ss Z")))
    return lines.select("value", F.regexp_extract(v, r"^(\S+) - - \[", 1).alias("ip"), F.coalesce(exact, server).alias("time"), F.regexp_extract(v, r"data=(.*?)(?: HTTP| EOF)", 1).alias("body"))


def payload(body: Column, key: str, marker: str = "TGR") -> Column:
    """A payload: marker, then base64 of text XORed with a repeating key. The key is configuration.

    Bytes are XORed by a fold over the decoded bytes' hex digits in the JVM; null where the marker or the base64 is missing.
    """
    digits = F.hex(F.try_to_binary(F.when(F.startswith(body, F.lit(marker)), F.substring(body, len(marker) + 1, 1 << 30)), F.lit("base64")))
    return F.when(F.length(digits) > 0, F.decode(xored(digits, key), "UTF-8"))


#: Bytes that are XORed at once; as a number they are a positive long.
XORED = 7


def xored(digits: Column, key: str) -> Column:
    """Bytes given as hex digits, XORed with a repeating key, XORED bytes at a time."""
    k = key.encode()
    spans = [bytes(k[(i * XORED + j) % len(k)] for j in range(XORED)) for i in range(len(k))]
    keys = F.array(*[F.lit(int.from_bytes(s, "big")).cast("long") for s in spans])

    def some(part: Column, i: Column) -> Column:
        own = F.call_function("shiftrightunsigned", F.get(keys, i % len(k)), (2 * XORED - F.length(part)) * 4)  # the last part is shorter
        return F.lpad(F.hex(F.conv(part, 16, 10).cast("long").bitwiseXOR(own)), F.length(part), "0")

    return F.unhex(F.array_join(bound(F.regexp_extract_all(digits, F.lit(f".{{1,{2 * XORED}}}"), F.lit(0)), lambda parts: F.transform(parts, some)), ""))


def _android(imei: Column, android_id: Column) -> Column:
    whole = F.concat(imei_complete(F.coalesce(imei, F.lit(""))), F.lit("#"), F.coalesce(android_id, F.lit("")))
    return F.when(android_valid(whole), device_uuid(F.lit("android"), whole)).otherwise(F.lit(""))


_V1 = "struct<common:struct<app_identifier:string,app_id:string,app_version:string,app_channel:string,os_name:string,os_version:string,device_model:string,net_type:string,xy_screen:string,mac_id:string,device_uuid:string,device_info:struct<imei:string,android_id:string>>,wj_uid:string,events:array<struct<time:bigint,id:string,type:string,sub_type:string,title:string,data:string,open_time:bigint,x_y:string>>>"


def accounts_checked(rows: DataFrame, accounts: DataFrame, userid: str = "userid", account: str = "account") -> DataFrame:
    """rows with a user id that meets the rule of its app's account, else the empty one; accounts (few): account, kind, rule. See scalars.rule_holds."""
    rules = F.broadcast(accounts.select(F.col("account").alias(account), F.col("kind").alias("_kind"), F.col("rule").alias("_rule")))
    return rows.join(rules, account, "left").withColumn(userid, F.when(rule_holds(F.col("_kind"), F.col(userid), F.col("_rule")), F.col(userid)).otherwise("")).drop("_kind", "_rule")


def _device(common: str) -> Column:
    """The device map of version-1 payloads: screen, model, system, net and MAC address; what is not given is left out."""
    f = lambda k: F.col(f"{common}.{k}")
    side = lambda i: F.get(F.split(f("xy_screen"), "x"), i).try_cast("int").cast("string")
    given = {"screenWidth": side(0), "screenHeight": side(1), "model": f("device_model"), "system": F.concat_ws(" ", f("os_name"), f("os_version")), "net": f("net_type"), "mac": F.lower(F.replace(f("mac_id"), F.lit(":"), F.lit("")))}
    return F.map_filter(F.create_map(*[x for k, v in given.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())


def mobile_v1(bodies: DataFrame, apps: DataFrame | None = None, accounts: DataFrame | None = None) -> DataFrame:
    """Version-1 payloads (ip, time, json) to many events each; a page stays where it was open for 0 to 10 minutes.

    apps (identifier, appid, platform, account): only known apps of ios and android count, and the platform says which device id does.
    accounts (account, kind, rule): user ids must meet their account's rule.
    """
    j = bodies.withColumn("_p", F.from_json("json", _V1)).withColumn("e", F.explode_outer("_p.events"))
    kind, sub = F.col("e.type"), F.col("e.sub_type")
    idfa = F.col("_p.common.device_uuid")
    by_idfa, by_android = device_uuid(F.lit("idfa"), idfa), _android(F.col("_p.common.device_info.imei"), F.col("_p.common.device_info.android_id"))
    uuid = F.when(idfa_valid(idfa), device_uuid(F.lit("idfa"), idfa)).otherwise(_android(F.col("_p.common.device_info.imei"), F.col("_p.common.device_info.android_id")))
    stay = F.col("e.time") - F.col("e.open_time")
    subtype = (
        F.when((kind == "10") & (sub == "1"), "enter_foreground")
        .when((kind == "10") & (sub == "2"), "enter_background")
        .when((kind == "20") & (sub == "1"), LOGIN)
        .when((kind == "20") & (sub == "2"), LOGOUT)
        .when((kind == "20") & (sub == "3"), REGISTER)
        .when((kind == "30") & (sub == "1") & F.col("e.x_y").isNotNull(), "click_point")
        .when((kind == "40") & (F.col("e.id") == "all_app_info"), "applist")
        .when((kind == "40") & (F.col("e.id") == "all_contact_info"), "contacts")
        .when((kind == "40") & F.col("e.id").isin(LEAD_NAMES), LEAD)
        .when(kind == "40", F.col("e.id"))
        .when((kind == "50") & (sub == "1") & (F.col("e.open_time") > 0) & (stay > 0) & (stay < MAX_STAY_MS), F.lit("page"))
    )
    appid = F.coalesce("_p.common.app_identifier", "_p.common.app_id")
    known = F.lit(None)
    if apps is not None:
        by = F.broadcast(apps.select(F.col("identifier").alias("_id"), F.col("appid").alias("_appid"), "platform", "account"))
        j = j.join(by, appid == F.col("_id"), "left")
        uuid = F.when(F.col("platform") == "ios", F.when(idfa_valid(idfa), by_idfa)).when(F.col("platform") == "android", by_android)
        known = F.when(F.col("_appid").isNull(), UNKNOWN_APP).when(~F.col("platform").isin("ios", "android"), UNKNOWN)
        appid = F.col("_appid")
    status = F.when(F.col("_p.common").isNull(), BAD_JSON).when(known.isNotNull(), known).when(appid.isNull() | F.col("e").isNull(), MISSING).when(F.coalesce(F.length(uuid) != 32, F.lit(True)), BAD_ID).when(subtype.isNull(), UNKNOWN).otherwise(OK)
    page = F.col("subtype") == "page"
    out = j.select("ip", appid.alias("appid"), uuid.alias("uuid"), F.coalesce("_p.wj_uid", F.lit("")).alias("userid"), F.col("_p.common.app_version").alias("app_version"), F.col("_p.common.app_channel").alias("channel"), subtype.alias("subtype"), F.col("e.id").alias("pageid"), F.col("e.time").alias("_t"), F.col("e.open_time").alias("_open"), stay.alias("_stay"), F.col("e.title").alias("title"), F.col("e.data").alias("data"), F.col("time").alias("localTime"), status.alias("status"), _device("_p.common").alias("device"), *([F.col("account")] if apps is not None else []))
    if accounts is not None:
        out = accounts_checked(out, accounts)
    return out.withColumn("logtype", F.when(page, "50").otherwise("40")).withColumn("time", F.when(page, F.col("_open")).otherwise(F.col("_t"))).withColumn("staytime", F.when(page, F.col("_stay")).otherwise(0)).drop("_t", "_open", "_stay")


def mobile_v2(bodies: DataFrame) -> DataFrame:
    """Version-2 payloads (ip, time, json), one event each; the server's time counts."""
    j = bodies.select("ip", "time", *[_field("json", k).alias(k) for k in ("ja_version", "app_version", "app_packagename", "appid", "logtype", "subtype", "pageid", "userid", "title", "data")], _field("json", "device_info.idfa").alias("_idfa"), _field("json", "device_info.imei").alias("_imei"), _field("json", "device_info.android_id").alias("_android"), F.get_json_object("json", "$").isNotNull().alias("_json"), _field("json", "time").try_cast("long").alias("localTime"))
    imei = F.when(imei_valid(imei_complete(F.coalesce("_imei", F.lit("")))), F.col("_imei")).otherwise("000000000000000")
    uuid = F.when(F.col("_idfa").isNotNull(), device_uuid(F.lit("idfa"), F.col("_idfa"))).otherwise(_android(imei, F.col("_android")))
    vital = _has("ja_version", "app_version", "app_packagename", "appid", "logtype", "subtype", "pageid") & F.col("userid").isNotNull() & F.col("localTime").isNotNull()
    status = F.when(~F.col("_json"), BAD_JSON).when(~vital, MISSING).when(F.length("uuid") != 32, BAD_ID).otherwise(OK)
    return j.withColumn("uuid", uuid).withColumn("status", status).drop("_idfa", "_imei", "_android", "_json")


def mini_program(lines: DataFrame, apps: DataFrame) -> DataFrame:
    """Mini-program lines: hex escapes, a body of 100 characters or more between quotes and ` EOF"`, app by identifier or id."""
    body = F.regexp_extract(unhex_escapes(F.col("value")), r'""(\{.*?\}) EOF"', 1)
    j = lines.select("value", body.alias("_b")).select("value", "_b", *[_field("_b", k).alias(k) for k in ("ja_version", "app_version", "logtype", "subtype", "pageid", "data")], F.coalesce(_field("_b", "app_identifier"), _field("_b", "appid")).alias("appid"), _field("_b", "device_info.ja_uuid").alias("uuid"), _field("_b", "time").try_cast("long").alias("time"))
    j = j.join(apps.select("appid", F.lit(True).alias("_known")).distinct(), "appid", "left")
    status = F.when(F.length("_b") < 100, SHORT).when(F.col("time").isNull(), BAD_JSON).when(F.col("_known").isNull(), NO_APP).when(~_has("logtype", "subtype", "uuid"), MISSING).when(F.col("data").isNotNull() & F.get_json_object("data", "$").isNull(), BAD_JSON).otherwise(OK)
    return j.withColumn("status", status).drop("_b", "_known")


def probe(lines: DataFrame, probes: DataFrame, limit: int) -> DataFrame:
    """Probe lines `probe|mac|signal|frame|time` of known probes (probeId, id, uuid, venueId) nearer than a signal limit."""
    p = F.split("value", r"\|")
    j = lines.select("value", F.size(p).alias("_n"), F.get(p, 0).alias("probeId"), F.get(p, 1).alias("mac"), F.get(p, 2).alias("_s"), F.get(p, 3).alias("frameType"), F.unix_millis(F.try_to_timestamp(F.get(p, 4), F.lit("yyyy-MM-dd HH:mm:ss"))).alias("time"))
    j = j.withColumn("signal", F.col("_s").try_cast("int")).join(probes.select("probeId", "id", "uuid", "venueId"), "probeId", "left")
    status = F.when((F.col("_n") != 5) | F.col("time").isNull() | F.col("signal").isNull(), MISSING).when(F.col("_s") == "000", FAR).when(F.col("venueId").isNull(), UNKNOWN).when(F.abs("signal") >= limit, FAR).otherwise(OK)
    return j.withColumn("status", status).drop("_n", "_s")


def chat_lines(lines: DataFrame) -> DataFrame:
    """Chat lines to messages; both client ids must be given, other fields have defaults."""
    body = F.regexp_extract(unhex_escapes(F.col("value")), r'""(\{.*?\}) EOF"', 1)
    j = lines.select("value", body.alias("_b")).select("value", "_b", *[_field("_b", k).alias(k) for k in ("client_id", "client", "customer")], F.coalesce(_field("_b", "type"), F.lit("text")).alias("msgtype"), F.coalesce(_field("_b", "from_type").try_cast("int"), F.lit(0)).alias("from_type"), _field("_b", "time").try_cast("long").alias("time"), F.coalesce(_field("_b", "c_time").try_cast("long"), F.lit(0)).alias("localTime"), *[F.coalesce(_field("_b", k), F.lit("")).alias(a) for k, a in (("content", "content"), ("user_ip", "client_ip"), ("source", "source"), ("avatar", "avatar"))])
    status = F.when(F.length("_b") < 100, SHORT).when(F.get_json_object("_b", "$").isNull(), BAD_JSON).when(~_has("client_id", "customer"), MISSING).otherwise(OK)
    return j.withColumn("status", status).drop("_b")


def deduplicated(events: DataFrame, by: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """One event per (uuid, logtype, subtype, appid, time): the first by a total order, so that reruns agree."""
    w = W.partitionBy(*(by or ["uuid", "logtype", "subtype", "appid", "time"])).orderBy(*(order or ["event_id"]))
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_odd_ids(events: DataFrame, cleaner) -> DataFrame:
    """Events whose uuid has 32 characters go through the cleaner; the others come back as they are."""
    good = F.coalesce(F.length("uuid") == 32, F.lit(False))
    return cleaner(events.where(good)).unionByName(events.where(~good), allowMissingColumns=True)


def leads(events: DataFrame) -> DataFrame:
    """Leads of commit-clue events: name, phone, city, area, style and flat, from JSON data that may be percent-encoded."""
    data = F.when(F.get_json_object("data", "$").isNotNull(), F.col("data")).otherwise(_decoded(F.col("data")))
    pick = lambda *n: F.coalesce(*[F.get_json_object("_d", f"$.{k}") for k in n], F.lit(""))
    return events.where(F.col("subtype") == LEAD).withColumn("_d", data).select("appid", "uuid", "time", pick("name", "nickname").alias("name"), pick("phone", "mobile").alias("phone"), pick("city").alias("city"), pick("area").alias("area"), pick("style").alias("style"), pick("flats").alias("flats")).where(F.length("phone") > 0)


#: Events that tell where a device was or what a finger did (fixed values): none of them is a step of a visit.
NO_STEP = ["click_point", "location", "applist", "page_action"]
NO_REPORT = ["location", "click_point", "enter_foreground", "enter_background"]


def steps(events: DataFrame, titled: bool = False) -> DataFrame:
    """Pages and events that are steps of a visit; for labels only those with a title."""
    out = events.where((F.col("logtype") == "50") | ~F.coalesce(F.col("subtype").isin(NO_STEP), F.lit(False)))
    return out.where(F.coalesce(F.length("title") > 0, F.lit(False))) if titled else out


def reported(events: DataFrame) -> DataFrame:
    """Events that event reports count."""
    return events.where((F.col("logtype") != "50") & ~F.coalesce(F.col("subtype").isin(NO_REPORT), F.lit(False)))


def installed_apps(events: DataFrame) -> DataFrame:
    """(uuid, time, pkg, name) of app lists; nameless apps are left out."""
    rows = events.where(F.col("subtype") == "applist").select("uuid", "time", F.explode(F.from_json("data", "array<struct<pkg:string,name:string>>")).alias("a"))
    return rows.select("uuid", "time", "a.pkg", "a.name").where(F.length("name") > 0)

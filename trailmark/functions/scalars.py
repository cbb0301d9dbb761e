"""Scalar functions as Column expressions. All stay in the JVM and accept nulls; bad input gives null or an empty string, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS, HOUR_MS, MINUTE_MS = 86_400_000, 3_600_000, 60_000
#: Days and hours are counted in UTC+8, whatever the session's zone.
ZONE_MS = 8 * HOUR_MS


def bound(value: Column, use) -> Column:
    """use(value), with value made once: a lambda makes what it refers to anew at each call, unless that is its variable."""
    return F.get(F.transform(F.array(value), use), 0)


# --- time ------------------------------------------------------------------------------------------------------------


def day_number(ms: Column) -> Column:
    """Days since 1970-01-01 in UTC+8, starting at 1."""
    return F.floor((ms + ZONE_MS) / DAY_MS).cast("long") + 1


def hour_of_day(ms: Column) -> Column:
    return F.floor(F.pmod(ms + ZONE_MS, F.lit(DAY_MS)) / HOUR_MS).cast("int")


def minute_of_day(ms: Column) -> Column:
    return F.floor(F.pmod(ms + ZONE_MS, F.lit(DAY_MS)) / MINUTE_MS).cast("int")


def half_hour_slot(ms: Column) -> Column:
    """0 to 47."""
    return F.floor(F.pmod(ms + ZONE_MS, F.lit(DAY_MS)) / (30 * MINUTE_MS)).cast("int")


def same_day(a: Column, b: Column) -> Column:
    return day_number(a) == day_number(b)


def today_and_not_later(ms: Column, now: Column) -> Column:
    """True for times of the day of now that are not after now."""
    return (ms <= now) & same_day(ms, now)


def within_day(ms: Column, day_start: Column) -> Column:
    return (ms >= day_start) & (ms < day_start + DAY_MS)


# --- ids -------------------------------------------------------------------------------------------------------------


def imei_valid(imei: Column) -> Column:
    return F.coalesce(imei.rlike("^[0-9]{15}$") & ~imei.rlike("^0+$"), F.lit(False))


def idfa_valid(idfa: Column) -> Column:
    """36 characters with some digit or letter other than zero."""
    return F.coalesce((F.length(idfa) == 36) & idfa.rlike("[^0-]"), F.lit(False))


def cookie_valid(cookie: Column) -> Column:
    return F.coalesce((F.octet_length(cookie) == 32) & ~cookie.rlike("[=_]"), F.lit(False))


def android_valid(android: Column) -> Column:
    """imei#android_id with one of the two sides given."""
    return F.coalesce(F.contains(android, F.lit("#")) & (F.length(android) > 1), F.lit(False))


def imei_complete(imei: Column) -> Column:
    """15 digits from 14 by Luhn's check digit; anything but digits becomes upper case with 0 at the end."""
    digits = F.transform(F.split(F.substring(imei, 1, 14), ""), lambda d, i: d.try_cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    total = F.aggregate(digits, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(F.coalesce(d, F.lit(0))))
    check = F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")
    return F.when(imei.rlike("^[0-9]{14}$"), F.concat(imei, check)).when(imei.rlike("^[0-9]{15}$"), imei).otherwise(F.concat(F.upper(imei), F.lit("0")))


def normal_uuid(uuid: Column) -> Column:
    """Ids that lost leading zeros, 29 to 31 characters long, padded to 32."""
    return F.when(F.length(uuid).between(29, 31), F.lpad(uuid, 32, "0")).otherwise(uuid)


def device_uuid(kind: Column, device_id: Column) -> Column:
    """32 hex digits of a valid device id of a kind (cookie, android, idfa), else an empty string."""
    valid = F.when(kind == "cookie", cookie_valid(device_id)).when(kind == "android", android_valid(device_id)).when(kind == "idfa", idfa_valid(device_id)).otherwise(F.lit(False))
    return F.when(valid, F.md5(device_id)).otherwise(F.lit(""))


def salted(text: Column) -> Column:
    """A key whose characters are reversed, so that serial keys spread."""
    return F.reverse(text)


# --- addresses -------------------------------------------------------------------------------------------------------


def is_ip(ip: Column) -> Column:
    part = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return F.coalesce(ip.rlike(rf"^{part}(?:\.{part}){{3}}$"), F.lit(False))


def ip_number(ip: Column) -> Column:
    """The 32-bit number of an address, null if it is none."""
    parts = F.split(ip, r"\.")
    value = sum((F.get(parts, i).try_cast("long") * (1 << (24 - 8 * i)) for i in range(1, 4)), F.get(parts, 0).try_cast("long") * (1 << 24))
    return F.when(is_ip(ip), value)


def ip_hex(ip: Column) -> Column:
    return F.lower(F.lpad(F.hex(ip_number(ip)), 8, "0"))


def mac_prefix(mac: Column) -> Column:
    """The maker's part of a MAC address: six upper-case digits."""
    return F.upper(F.substring(F.regexp_replace(mac, "[:-]", ""), 1, 6))


# --- text and urls ---------------------------------------------------------------------------------------------------

#: Names of browsers, of which the first counts that a user agent has, in this order and case; the last stands for none.
BROWSERS = ["Baiduspider", "UCBrowser", "Firefox", "LBBROWSER", "MQQBrowser", "QQBrowser", "QQ", "360Spider", "Googlebot", "baiduboxapp", "BingPreview", "OppoBrowser", "MicroMessenger", "VivoBrowser", "MiuiBrowser", "huaxiabank", "MetaSr", "Edge", "BIDUBrowser", "TaoBrowser", "MSIE 5", "MSIE 6", "MSIE 7", "MSIE 8", "MSIE 9", "MSIE 10", "MSIE 11", "rv:1", "MSIE 12", "MSIE 13", "MSIE 14", "MSIE", "Chrome", "Safari", "Other"]
#: Systems and the words, in lower case, that tell them, in this order.
SYSTEMS = [("ipad", ["ipad"]), ("iphone", ["iphone"]), ("android", ["android"]), ("windows", ["windows", "wow", "win"]), ("mac", ["macintosh", "mac", "ox"])]


def browser(agent: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(agent, F.lit(k)), F.lit(k)) for k in BROWSERS[:-1]], F.lit(BROWSERS[-1]))


def operating_system(agent: Column) -> Column:
    low = F.lower(agent)
    return F.coalesce(*[F.when(F.contains(low, F.lit(k)), F.lit(name)) for name, keys in SYSTEMS for k in keys], F.lit("other"))


def query_map(url: Column) -> Column:
    """The query string of a url as a map; of a repeated key the last value counts."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: F.contains(p, F.lit("=")) & ~F.startswith(p, F.lit("=")))
    split = lambda p: F.struct(F.substring_index(p, "=", 1), F.regexp_replace(p, "^[^=]*=", ""))
    keys = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    last = F.filter(F.transform(pairs, lambda p, i: F.when(i == F.size(keys) - F.array_position(F.reverse(keys), F.substring_index(p, "=", 1)), split(p))), lambda s: s.isNotNull())
    return F.map_from_entries(last)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def garbled(text: Column) -> Column:
    """True for a text that was decoded wrongly: a replacement character, or more than five percent signs."""
    return F.coalesce(F.contains(text, F.lit("�")) | (F.length(text) - F.length(F.replace(text, F.lit("%"), F.lit(""))) > 5), F.lit(False))


#: Engine by a part of the host: the keys that may hold the words, in order (fixed values). Engines without keys hide them.
ENGINES = {"baidu": ["wd", "word", "eqid"], "sogou": ["keyword", "query", "htprequery"], "so.com": ["q"], "bing": ["q", "pq"], "sm.cn": ["q"], "google": [], "yahoo": []}


def search_engine(url: Column) -> Column:
    h = host(url)
    return F.coalesce(*[F.when(F.contains(h, F.lit(k)), F.lit(k)) for k in ENGINES])


def raw_keyword(url: Column) -> Column:
    """The words that a search engine's url asks for, still percent-encoded; null where it hides them or is none."""
    asked = query_map(url)
    return F.coalesce(*[F.when(search_engine(url) == e, F.coalesce(*[F.try_element_at(asked, F.lit(k)) for k in keys])) for e, keys in ENGINES.items() if keys])


def search_keyword(url: Column) -> Column:
    """raw_keyword decoded as UTF-8. See operators.lookup.keywords for engines that used GBK."""
    return F.try_url_decode(raw_keyword(url))


def own_keyword(url: Column, key: str) -> Column:
    """The value of a source's own parameter, which must end with `&`."""
    return F.regexp_extract(url, f"[?&]{key}=([^&]*)&", 1)


PHONE = r"(?<![0-9])1[3-9][0-9]{9}(?![0-9])"


def phones(text: Column) -> Column:
    """All mobile numbers in a text."""
    return F.regexp_extract_all(text, F.lit(PHONE), F.lit(0))


def without_wide(text: Column) -> Column:
    """Characters beyond the basic plane replaced by 0000."""
    return F.regexp_replace(text, "[\\x{10000}-\\x{10FFFF}]", "0000")


def unhex_escapes(text: Column) -> Column:
    """`\\xNN` escapes decoded as UTF-8, by way of percent encoding."""
    safe = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(F.regexp_replace(safe, r"\\x([0-9A-Fa-f]{2})", "%$1")), text)


# --- numbers and places ----------------------------------------------------------------------------------------------


def floor_to(x: Column, digits: int) -> Column:
    return F.floor(x * 10**digits) / 10**digits


def truncated(x: Column, digits: int = 5) -> Column:
    """A coordinate cut towards zero."""
    return (x * 10**digits).cast("long") / F.lit(10**digits)


#: Fixed values of the coordinate systems: the factor of BD-09, the axis and squared eccentricity of GCJ-02.
_X_PI, _AXIS, _ECC = 3.14159265358979324 * 3000.0 / 180.0, 6378245.0, 0.00669342162296594323


def gcj_to_bd(lon: Column, lat: Column) -> tuple[Column, Column]:
    r = F.sqrt(lon * lon + lat * lat) + 0.00002 * F.sin(lat * _X_PI)
    angle = F.atan2(lat, lon) + 0.000003 * F.cos(lon * _X_PI)
    return r * F.cos(angle) + 0.0065, r * F.sin(angle) + 0.006


def bd_to_gcj(lon: Column, lat: Column) -> tuple[Column, Column]:
    x, y = lon - 0.0065, lat - 0.006
    r = F.sqrt(x * x + y * y) - 0.00002 * F.sin(y * _X_PI)
    angle = F.atan2(y, x) - 0.000003 * F.cos(x * _X_PI)
    return r * F.cos(angle), r * F.sin(angle)


def wgs_to_gcj(lon: Column, lat: Column) -> tuple[Column, Column]:
    x, y, pi = lon - 105.0, lat - 35.0, F.pi()

    def waves(v: Column, steps: list[tuple[float, float]]) -> Column:
        return sum((a * F.sin(v * b * pi) for a, b in steps), F.lit(0.0)) * 2.0 / 3.0

    common = waves(x, [(20.0, 6.0), (20.0, 2.0)])
    d_lat = -100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * F.sqrt(F.abs(x)) + common + waves(y, [(20.0, 1.0), (40.0, 1.0 / 3.0)]) + waves(y, [(160.0, 1.0 / 12.0), (320.0, 1.0 / 30.0)])
    d_lon = 300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * F.sqrt(F.abs(x)) + common + waves(x, [(20.0, 1.0), (40.0, 1.0 / 3.0)]) + waves(x, [(150.0, 1.0 / 12.0), (300.0, 1.0 / 30.0)])
    rad = lat / 180.0 * pi
    magic = 1 - _ECC * F.sin(rad) * F.sin(rad)
    lat_m = d_lat * 180.0 / (_AXIS * (1 - _ECC) / (magic * F.sqrt(magic)) * pi)
    lon_m = d_lon * 180.0 / (_AXIS / F.sqrt(magic) * F.cos(rad) * pi)
    return lon + lon_m, lat + lat_m


# --- labels ----------------------------------------------------------------------------------------------------------

LABEL_DAYS = 60


def web_label_value(times: Column, stay_ms: Column, weight: Column, base: Column) -> Column:
    return (times * 0.7 + stay_ms / 20000.0 * 0.3) * (weight + base)


def app_label_value(times: Column, stay_ms: Column, weight: Column, base: Column) -> Column:
    return (times * 0.3 + stay_ms / 10000.0 * 0.7) * (weight + base)


def decayed(value: Column, age_days: Column) -> Column:
    """Value falling in a line to nothing at LABEL_DAYS days."""
    return F.when((age_days >= 0) & (age_days < LABEL_DAYS), value * (LABEL_DAYS - age_days) / float(LABEL_DAYS)).otherwise(0.0)


def added_in_order(order: Column, value: Column) -> Column:
    """The sum of a group's values in their order, so that reruns agree to the last bit; null without values, as of sum. For groups of few rows."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("at"), value.alias("value")))))
    return F.when(F.size(rows) > 0, F.aggregate(rows, F.lit(0.0), lambda a, r: a + r["value"]))


def rule_holds(kind: Column, text: Column, rule: Column) -> Column:
    """1 contains, 2 does not contain, 3 begins, 4 ends, 5 regex is found, 7 equals; any other kind does not hold."""
    return F.coalesce(
        F.when(kind == 1, F.contains(text, rule))
        .when(kind == 2, ~F.contains(text, rule))
        .when(kind == 3, F.startswith(text, rule))
        .when(kind == 4, F.endswith(text, rule))
        .when(kind == 5, F.regexp_like(text, F.when(kind == 5, rule)))
        .when(kind == 7, text == rule),
        F.lit(False),
    )


def register(spark) -> None:
    """SQL functions of the analytics: fixed dates, current time, `all`, decay and label value."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION label_decay(v DOUBLE, age INT) RETURNS DOUBLE RETURN CASE WHEN age >= 0 AND age < {LABEL_DAYS} THEN v * ({LABEL_DAYS} - age) / {float(LABEL_DAYS)}D ELSE 0D END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION web_label_value(n DOUBLE, ms DOUBLE, w DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN (n * 0.7D + ms / 20000D * 0.3D) * (w + b)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION log_time() RETURNS TIMESTAMP RETURN current_timestamp()")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION every_channel() RETURNS STRING RETURN 'all'")

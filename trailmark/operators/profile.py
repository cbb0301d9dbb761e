"""Habits, interest labels, app tags, profiles and searches over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.scalars import LABEL_DAYS, added_in_order, day_number, decayed, half_hour_slot, web_label_value
from trailmark.operators.sessions import PAGE, is_page

LIVENESS = "_sf_liveness"
LEAST_LABEL = 0.001


# --- habits ----------------------------------------------------------------------------------------------------------


def habit_day(events: DataFrame) -> DataFrame:
    """One row per device, app and day: visits, pages, stay, whether it gave a lead, and counts by event, slot and address."""
    e = events.select("uuid", "appid", day_number(F.col("time")).alias("day"), "visitindex", "logtype", "staytime", "subtype", "ip", half_hour_slot(F.col("time")).cast("string").alias("slot"))
    keys = ["uuid", "appid", "day"]
    numbers = e.groupBy(*keys).agg(F.max("visitindex").cast("long").alias("visit"), F.count(F.when(is_page(), 1)).alias("page"), F.sum("staytime").alias("stay"), F.max(F.when(F.col("subtype") == "purchase", 1).otherwise(0)).alias("lead"))
    tall = e.select(*keys, F.explode(F.array(F.struct(F.lit("events").alias("of"), F.when(F.col("logtype") != PAGE, F.col("subtype")).alias("k")), F.struct(F.lit("times").alias("of"), F.col("slot").alias("k")), F.struct(F.lit("ips").alias("of"), F.col("ip").alias("k")))).alias("x"))
    counts = tall.where("x.k is not null").groupBy(*keys, "x.of", "x.k").agg(F.count("*").alias("n"))
    maps = counts.groupBy(*keys).agg(*[F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("of") == m, F.struct("k", "n"))))).alias(m) for m in ("events", "times", "ips")])
    return numbers.join(maps, keys)


HABIT_MAPS = ("events", "times", "ips")


def summed_maps(rows: DataFrame, keys: list[str], maps: dict[str, Column]) -> DataFrame:
    """For each key the maps (name: column of text to number) of its rows added up entry by entry, in order of their entries.

    Entries are summed before any of them meet in one row, so a key's row holds its different entries only.
    """
    def entries(name: str, of: Column) -> Column:
        some = F.transform(F.map_entries(of), lambda e: F.struct(F.lit(name).alias("of"), e["key"].alias("k"), e["value"].cast("long").alias("n")))
        return F.coalesce(some, F.array())

    every = F.concat(*[entries(m, c) for m, c in maps.items()])
    counts = rows.select(*keys, F.explode(every).alias("x")).groupBy(*keys, "x.of", "x.k").agg(F.sum("x.n").alias("n"))
    return counts.groupBy(*keys).agg(*[F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("of") == m, F.struct("k", "n"))))).alias(m) for m in maps])


def listed(map_: Column) -> Column:
    """A map as text, k=n parted by commas, in order; empty for null."""
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(map_)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","), F.lit(""))


def habit_window(days: DataFrame, today: int, span: int = LABEL_DAYS) -> DataFrame:
    """Sums over the days before today, today left out: visits, pages, stay, any lead, active days, and the maps added up."""
    back = days.where(F.col("day").between(today - span + 1, today - 1))
    numbers = back.groupBy("uuid", "appid").agg(F.sum("visit").alias("visit"), F.sum("page").alias("page"), F.sum("stay").alias("stay"), F.max("lead").alias("lead"), F.countDistinct("day").alias("active_days"))
    return numbers.join(summed_maps(back, ["uuid", "appid"], {m: F.col(m) for m in HABIT_MAPS}), ["uuid", "appid"], "left")


def habit_summary(days: DataFrame, today: int) -> DataFrame:
    """A device over all its apps: active days, those of the last seven, its busiest half hour (ties to the earlier), events as `app#event`, addresses."""
    own = F.transform_keys("events", lambda k, _: F.concat_ws("#", "appid", k))
    maps = summed_maps(days, ["uuid"], {"events": own, "times": F.col("times"), "ips": F.col("ips")})
    slots = F.transform(F.map_entries("times"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].cast("int").alias("slot")))
    active = days.groupBy("uuid").agg(F.countDistinct("day").alias("active_days"), F.countDistinct(F.when(F.col("day") > today - 7, F.col("day"))).alias("active_week"), F.countDistinct("appid").alias("apps"))
    return active.join(maps.select("uuid", F.array_min(slots)["slot"].alias("busiest"), "events", "ips"), "uuid")


# --- labels ----------------------------------------------------------------------------------------------------------


def page_labels(pages: DataFrame, matched: DataFrame) -> DataFrame:
    """(uuid, company_id, name, times, stay, weight) of pages: each matching rule counts the page, liveness counts them all.

    matched: pages with the label of every rule that holds. Companies without rules have no labels.
    """
    rules = matched.groupBy("uuid", "company_id", F.col("rule_name").alias("name")).agg(F.count("*").alias("times"), F.sum("staytime").alias("stay"))
    alive = pages.groupBy("uuid", "company_id").agg(F.count("*").alias("times"), F.sum("staytime").alias("stay")).withColumn("name", F.lit(LIVENESS))
    return rules.unionByName(alive.select(*rules.columns)).withColumn("weight", F.lit(1.0))


def event_labels(events: DataFrame, matched: DataFrame, kept: Column, searched: Column, keyword: Column, ms: int = 20_000, weight: float = 5.0) -> DataFrame:
    """Labels of events: a kept item gives its rules stay but no count, a search its words, both liveness."""
    rules = matched.where(kept).select("uuid", "company_id", F.col("rule_name").alias("name"), F.lit(0).alias("n"))
    words = events.where(searched).select("uuid", "company_id", F.concat(F.lit("_kw_"), keyword).alias("name"), F.lit(1).alias("n"))
    alive = events.where(kept | searched).select("uuid", "company_id", F.lit(LIVENESS).alias("name"), F.lit(1).alias("n"))
    tall = rules.unionByName(words).unionByName(alive)
    return tall.groupBy("uuid", "company_id", "name").agg(F.sum("n").cast("long").alias("times"), (F.count("*") * ms).alias("stay")).withColumn("weight", F.lit(weight))


def base_weight(events: DataFrame, bonuses: dict[str, float]) -> DataFrame:
    """Weight of a device for a company: how many rows, how many kinds, and a bonus for each telling kind; apps are summed."""
    bonus = sum((F.max(F.when(F.col("subtype") == k, b).otherwise(0.0)) for k, b in bonuses.items()), F.lit(0.0))
    per = events.groupBy("uuid", "company_id", "appid").agg((F.least(F.count("*"), F.lit(200)) / 200.0 + 0.5 * F.least(F.countDistinct("subtype"), F.lit(10)) / 10.0 + bonus).alias("w"))
    return per.groupBy("uuid", "company_id").agg(F.sum("w").alias("base_weight"))


def app_users(habits: DataFrame) -> DataFrame:
    """Two levels: each user's visits, pages and stay in an app, then users and sums of each app. habits: appid, uuid, visit, page, stay."""
    users = habits.groupBy("appid", "uuid").agg(F.max("visit").alias("visit"), F.sum("page").alias("page"), F.sum("stay").alias("stay"))
    return users.groupBy("appid").agg(F.count("*").alias("users"), *[F.sum(c).alias(c) for c in ("visit", "page", "stay")])


def merged_labels(labels: DataFrame) -> DataFrame:
    return labels.groupBy("uuid", "company_id", "name", "weight").agg(F.sum("times").alias("times"), F.sum("stay").alias("stay"))


def label_sum(label_days: DataFrame, today: int) -> DataFrame:
    """Decayed sums over 60 days of (uuid, company_id, day, name, times, stay, weight, base_weight); very small ones are dropped.

    Values are added day by day. Sums that lie half-way between two rounded ones (16.80515 to four places) otherwise round by the
    order in which rows arrive. A label has few rows a day, so a list of them stays short.
    """
    value = decayed(web_label_value(F.col("times"), F.col("stay"), F.col("weight"), F.col("base_weight")), F.lit(today) - F.col("day"))
    near = label_days.where(F.col("day").between(today - LABEL_DAYS + 1, today))
    return near.groupBy("uuid", "company_id", "name").agg(added_in_order(F.col("day"), value).alias("value")).where(F.col("value") > LEAST_LABEL)


def guide_labels(answers: DataFrame, names: DataFrame) -> DataFrame:
    """Answers (uuid, JSON map of question to attribute id) as labels of value 5."""
    tall = answers.select("uuid", F.explode(F.from_json("answers", "map<string,string>")).alias("question", "attribute"))
    return tall.join(names, "attribute").select("uuid", "name", F.lit(5.0).alias("value")).distinct()


def label_documents(labels: DataFrame) -> DataFrame:
    """One JSON document a device: its tags with weights, the heaviest first."""
    sorted_ = F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("_v"), F.col("name").alias("tag"), F.col("value").alias("weight"))))
    return labels.groupBy("uuid").agg(F.to_json(F.struct(F.transform(sorted_, lambda s: F.struct(s["tag"].alias("tag"), s["weight"].alias("weight"))).alias("tags"))).alias("doc"))


def app_tags(installed: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags of a device from its apps: (uuid, tag, n, sex_weight), without tags that a heavier one of it shuts out.

    installed: platform, pkg, uuid; tags: platform, pkg, tag, sex_weight, tag_weight, mutex (comma-joined). Exclusions go from
    the heaviest tag down; a tag that is itself shut out shuts out nothing, so the fold runs over a device's few tags in order.
    """
    hit = installed.join(tags, ["platform", "pkg"])
    per = hit.groupBy("uuid", "tag").agg(F.count("*").alias("n"), F.sum("sex_weight").alias("sex_weight"), F.max("tag_weight").alias("w"), F.max("mutex").alias("mutex"))
    ordered = per.groupBy("uuid").agg(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("_w"), "tag", "n", "sex_weight", "mutex"))).alias("t"))
    gone = F.aggregate("t", F.array().cast("array<string>"), lambda a, x: F.when(F.array_contains(a, x["tag"]), a).otherwise(F.array_union(a, F.split(F.coalesce(x["mutex"], F.lit("")), ","))))
    return ordered.withColumn("_gone", gone).select("uuid", "_gone", F.explode("t").alias("x")).where(~F.array_contains("_gone", F.col("x.tag"))).select("uuid", "x.tag", "x.n", "x.sex_weight")


# --- profiles --------------------------------------------------------------------------------------------------------


def profiles(devices: DataFrame, habits: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """One row a device that has both a record and a habit, with its labels (all companies summed) and the area of its address."""
    summed = labels.groupBy("uuid", "name").agg(added_in_order(F.col("value"), F.col("value")).alias("value"))
    mapped = summed.groupBy("uuid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("labels"))
    return devices.join(habits, "uuid").join(mapped, "uuid", "left").join(areas, "uuid", "left")


def shaped(profile: DataFrame, tags: str, sex: str) -> DataFrame:
    """A profile's tag map as key and value lists, the heaviest first, and the sex score as 2, 1 or 0."""
    entries = F.array_sort(F.transform(F.map_entries(tags), lambda e: F.struct((-e["value"]).alias("_v"), e["key"].alias("k"), e["value"].alias("v"))))
    return profile.withColumn("tag_keys", F.transform(entries, lambda e: e["k"])).withColumn("tag_values", F.transform(entries, lambda e: e["v"])).withColumn("sex_code", F.when(F.col(sex) > 0, 2).when(F.col(sex) < 0, 1).otherwise(0))


def short_form(profile: DataFrame, tags: str, sex: str, consumption: str) -> DataFrame:
    """shaped with the level of consumption halved towards zero, 0 where it is not known."""
    half = F.when(F.col(consumption) < 0, F.ceil(F.col(consumption) / 2)).otherwise(F.floor(F.col(consumption) / 2))
    return shaped(profile, tags, sex).withColumn(consumption, F.coalesce(half, F.lit(0)).cast("int"))


def whole_profiles(devices: DataFrame, habits: DataFrame, labels: DataFrame, areas: DataFrame, tags: DataFrame) -> DataFrame:
    """profiles with the tags of a device's apps: a map of tag to how many apps have it, and the sum of their sex weights."""
    mapped = tags.groupBy("uuid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("tag", "n")))).alias("app_tags"), F.sum("sex_weight").alias("sex"))
    return profiles(devices, habits, labels, areas).join(mapped, "uuid", "left")


#: How a search's parameter applies to its column. `some` and `every` take lists of array elements, `phrase` and `begins` texts.
_TESTS = {
    "min": lambda c, v: c >= v,
    "max": lambda c, v: c <= v,
    "above": lambda c, v: c > v,
    "below": lambda c, v: c < v,
    "between": lambda c, v: c.between(*v),
    "is": lambda c, v: c == v,
    "isnt": lambda c, v: c != v,
    "any": lambda c, v: c.isin(list(v)),
    "none": lambda c, v: ~c.isin(list(v)),
    "known": lambda c, v: c.isNotNull() == F.lit(v),
    "has": lambda c, v: F.contains(c, F.lit(v)),
    "begins": lambda c, v: F.startswith(c, F.lit(v)),
    "phrase": lambda c, v: F.contains(F.concat(F.lit(" "), F.regexp_replace(F.lower(c), r"\s+", " "), F.lit(" ")), F.lit(f" {' '.join(v.lower().split())} ")),
    "holds": lambda c, v: F.array_contains(c, v),
    "some": lambda c, v: F.arrays_overlap(c, F.array(*[F.lit(x) for x in v])),
    "every": lambda c, v: F.size(F.array_except(F.array(*[F.lit(x) for x in v]), c)) == 0,
    "sized": lambda c, v: F.size(c).between(*v),
}
_TESTS["all"] = _TESTS["every"]


def condition(asked: dict | list) -> Column:
    """One predicate of a tree of conditions. It is never null: what cannot be told is false.

    A dict holds conditions that must all hold: column__test: value, the test `is` by default. A list of values for a column
    without a test means any of them. The keys `and` and `or` hold lists of trees, `not` a tree, and `each` a dict of columns and
    trees: an element of the column, an array of structs, must meet the tree, whose columns are the element's fields. A value of None is no condition, an empty `and` holds, an empty `or` does not. A list is its trees under `and`.
    """
    return _tree(asked, F.col)


def _tree(asked: dict | list, column) -> Column:
    if isinstance(asked, list):
        asked = {"and": asked}
    parts = []
    for name, value in asked.items():
        if name in ("and", "or"):
            each = [_tree(t, column) for t in value]
            parts.append(reduce(Column.__and__ if name == "and" else Column.__or__, each, F.lit(name == "and")))
        elif name == "not":
            parts.append(~_tree(value, column))
        elif name == "each":
            parts += [F.coalesce(F.exists(column(c), _element(t)), F.lit(False)) for c, t in value.items()]
        elif value is not None:
            of, _, test = name.partition("__")
            test = test or ("any" if isinstance(value, (list, tuple, set)) else "is")
            if test not in _TESTS:
                raise ValueError(f"unknown test: {name}")
            parts.append(F.coalesce(_TESTS[test](column(of), value), F.lit(False)))
    return reduce(Column.__and__, parts, F.lit(True))


def _element(asked: dict | list):
    return lambda e: _tree(asked, lambda field: e[field])


def search(table: DataFrame, asked: dict | list | None = None, **wanted) -> DataFrame:
    """Rows that meet a tree of conditions and all others given as column__test=value; see condition."""
    return table.where(condition([asked or {}, wanted]))


def paged(rows: DataFrame, order: list[Column], page: int, size: int) -> tuple[DataFrame, int, int]:
    """A page (from 0) of ordered rows, the number of hits and of pages."""
    hits = rows.count()
    return rows.orderBy(*order).offset(page * size).limit(size), hits, -(-hits // size)


def with_label(labels: DataFrame, name: str) -> DataFrame:
    """Devices that have a label, by its largest value, the heaviest first."""
    return labels.where(F.col("name") == name).groupBy("uuid").agg(F.max("value").alias("value")).orderBy(F.col("value").desc(), "uuid")


# --- potential customers -----------------------------------------------------------------------------------------------

#: Thresholds by tenure in days: (last day, least pages, least special visits, least stay in seconds, least active days).
BANDS = [(31, 153, 44, 3.0, 4), (92, 172, 50, 4.2, 5)]


def potential(features: DataFrame) -> DataFrame:
    """potential 0 or 1 of devices: new ones always, older ones by the thresholds of their band.

    features: tenure (days since the first visit), pages, special, stay (seconds), actions, days.
    """
    tenure = F.greatest(F.col("tenure"), F.lit(0))
    out = F.when(tenure <= 7, 1)
    for last, pages, special, stay, days in BANDS:
        much = (F.col("pages") > pages) | (F.col("special") >= special) | (F.col("stay") >= stay)
        out = out.when(tenure <= last, (much & (F.col("actions") != 0) & (F.col("days") >= days)).cast("int"))
    return features.withColumn("potential", out.otherwise(0))


def flags(events: DataFrame, names: dict[str, Column]) -> DataFrame:
    """One 0/1 column per behaviour of a device: 1 if any of its rows shows it."""
    return events.groupBy("uuid").agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in names.items()])

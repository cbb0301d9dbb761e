"""Lookups that are no plain equi-joins: ranges of addresses, rules by weight, ids by prefix."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions.scalars import garbled, ip_number, mac_prefix, raw_keyword, rule_holds

#: A rule table with more rows than this is never broadcast.
FEW_RULES = 20_000


def _sized(dim: DataFrame) -> DataFrame:
    """dim with a broadcast hint if it is small; counts no further than the limit."""
    return F.broadcast(dim) if dim.limit(FEW_RULES + 1).count() <= FEW_RULES else dim


def ranges_from_ends(ends: DataFrame, end: str = "end_ip") -> DataFrame:
    """Ranges that begin after the end before: adds start_ip. The window is over the range table alone, once per load."""
    w = W.partitionBy(F.lit(0)).orderBy(end)
    return ends.withColumn("start_ip", F.coalesce(F.lag(end).over(w) + 1, F.lit(0).cast("long")))


def ip_area(rows: DataFrame, ranges: DataFrame, ip: str = "ip", bits: int = 16) -> DataFrame:
    """rows with country, province, city and area of the range (start_ip, end_ip) that holds the address, `--` where none does.

    Both sides are cut into buckets of 2^bits addresses and joined on the bucket, so each row meets the few ranges of its
    bucket; distinct addresses are looked up once.
    """
    parts = ["country", "province", "city", "area"]
    cut = ranges.withColumn("_bucket", F.explode(F.sequence(F.shiftright("start_ip", bits), F.shiftright("end_ip", bits))))
    asked = rows.select(F.col(ip).alias("_ip")).distinct().withColumn("_n", ip_number(F.col("_ip"))).withColumn("_bucket", F.shiftright("_n", bits))
    hit = asked.join(cut.select("_bucket", "start_ip", "end_ip", *parts), "_bucket").where(F.col("_n").between(F.col("start_ip"), F.col("end_ip")))
    # Where ranges overlap, the one that ends first holds.
    found = hit.groupBy("_ip").agg(F.min_by(F.struct(*parts), F.struct("end_ip", "start_ip")).alias("_a")).select("_ip", "_a.*")
    return rows.join(found, rows[ip].eqNullSafe(found["_ip"]), "left").drop("_ip").fillna("--", parts)


def rules_matching(rows: DataFrame, rules: DataFrame, text: str, on: list[str]) -> DataFrame:
    """Every pair of a row and a rule of its group that holds: rules have id, rType, rules, name, weight and the columns `on`.

    Rules are few per group and are joined by their group, so this is an equi-join with a predicate.
    """
    r = _sized(rules.select(*on, F.col("id").alias("rule_id"), F.col("rType").alias("_kind"), F.col("rules").alias("_rule"), F.col("name").alias("rule_name"), F.col("weight").alias("rule_weight")))
    return rows.join(r, on).where(rule_holds(F.col("_kind"), F.col(text), F.col("_rule"))).drop("_kind", "_rule")


def first_rule(rows: DataFrame, rules: DataFrame, text: str, on: list[str], key: list[str]) -> DataFrame:
    """rows (unique by key) with the heaviest rule that holds, ties to the smaller id; null where none does."""
    hit = rules_matching(rows.select(*dict.fromkeys([*key, *on, text])), rules, text, on)
    best = hit.groupBy(*key).agg(F.min_by(F.struct("rule_id", "rule_name"), F.struct(-F.col("rule_weight"), F.col("rule_id"))).alias("_r")).select(*key, "_r.*")
    return rows.join(best, key, "left")


def first_of_literals(text: Column, rules: list[tuple[int, str, str]]) -> Column:
    """The name of the first rule (kind, rule, name) that holds, as one CASE expression; for rule sets known when the query is built."""
    return F.coalesce(*[F.when(rule_holds(F.lit(k), text, F.lit(r)), F.lit(n)) for k, r, n in rules], F.lit(None).cast("string"))


def items(rows: DataFrame, rules: DataFrame, text: str, data: str, on: list[str], key: list[str]) -> DataFrame:
    """The item of each row: the heaviest rule whose behaviour holds, and its id by regex group 1 or by JSON path.

    rules: id, rType, rules, weight, item_type, data_type (1 regex, 2 JSON path) and data_rule.
    """
    more = rules.select(F.col("id").alias("rule_id"), "item_type", "data_type", "data_rule")
    hit = first_rule(rows, rules, text, on, key).join(_sized(more), "rule_id")
    by_regex = F.expr(f"regexp_extract({data}, CASE WHEN data_type = 1 THEN data_rule ELSE '()' END, 1)")
    found = F.when(F.col("data_type") == 1, by_regex).otherwise(F.expr(f"get_json_object({data}, data_rule)"))
    return hit.withColumn("item_id", found).where(F.length("item_id") > 0)


def not_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed, neither whole nor up to its first `#`; two anti joins, each by equality."""
    names = listed.select(F.col(listed.columns[0]).alias("_listed"))
    rest = rows.join(names, F.col(key) == F.col("_listed"), "left_anti")
    return rest.join(names, F.substring_index(F.col(key), "#", 1) == F.col("_listed"), "left_anti")


def not_denied(rows: DataFrame, exact: DataFrame, prefixes: DataFrame, ip: str = "ip") -> DataFrame:
    """Rows whose address is neither denied nor begins with a denied prefix; rows without an address stay.

    An address is looked up by its beginnings of the lengths that prefixes have, each by equality, so their number does not
    matter. Each different address is looked up once.
    """
    kept = rows.join(exact.select(F.col(exact.columns[0]).alias("_denied")), F.col(ip) == F.col("_denied"), "left_anti")
    short = prefixes.select(F.col(prefixes.columns[0]).alias("_prefix")).where(F.length("_prefix") > 0)
    lengths = sorted(r[0] for r in short.select(F.length("_prefix")).distinct().collect())  # at most the length of an address, or no address is longer
    if not lengths:
        return kept
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("_ip"))
    asked = kept.select(F.col(ip).alias("_ip")).where("_ip is not null").distinct().withColumn("_n", F.explode(starts))
    found = asked.select("_ip", F.col("_ip").substr(F.lit(1), F.col("_n")).alias("_prefix")).join(short, "_prefix", "left_semi").select("_ip").distinct()
    return kept.join(found, F.col(ip) == F.col("_ip"), "left_anti")


def brands(rows: DataFrame, mac_brands: DataFrame, mac: str = "mac") -> DataFrame:
    """rows with the brand of the MAC prefix, null if unknown; mac_brands: prefix, brand."""
    known = mac_brands.where(F.length("prefix") == 6).select(F.upper("prefix").alias("_prefix"), "brand")
    return rows.withColumn("_prefix", mac_prefix(F.col(mac))).join(_sized(known), "_prefix", "left").drop("_prefix")


def _from_gbk(raw: pd.Series) -> pd.Series:
    from urllib.parse import unquote_to_bytes

    return raw.map(lambda x: unquote_to_bytes(x.replace("+", " ")).decode("gbk", "replace"), na_action="ignore")


def keywords(rows: DataFrame, url: str) -> DataFrame:
    """rows with keyword, the words their url asked a search engine for. Words that are no UTF-8 are read as GBK.

    Spark decodes no GBK itself, so the few rows that need it go through an Arrow function, all others stay in the JVM.
    """
    raw = rows.withColumn("_raw", raw_keyword(F.col(url))).withColumn("keyword", F.try_url_decode("_raw"))
    odd = F.col("_raw").isNotNull() & (F.col("keyword").isNull() | garbled(F.col("keyword")))
    return raw.where(~odd).unionByName(raw.where(odd).withColumn("keyword", F.pandas_udf(_from_gbk, "string")("_raw"))).drop("_raw")

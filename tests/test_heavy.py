"""Operators under heavy users and many rules, merged maps, condition trees, places that expire, and JDBC tables."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import lookup, places, profile, recommend
from trailmark.sources import tables

DAY = 86_400_000


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_pairs_of_a_heavy_user_are_whole_and_spread(spark, block):
    rng = random.Random(3)
    ratings = [("big", i, float(rng.randrange(1, 9))) for i in range(300)] + [(f"u{u}", i, float(rng.randrange(1, 9))) for u in range(20) for i in rng.sample(range(300), 5)] + [("one", 3, 1.0)]
    r = spark.createDataFrame(ratings, "user string, item int, score double")
    made = recommend._pairs(r, None, block)
    got = Counter(map(tuple, made.select("user", "a", "x", "b", "y").collect()))
    by = {}
    for u, i, s in ratings:
        by.setdefault(u, []).append((i, s))
    assert got == Counter((u, *p, *q) for u, items in by.items() for p in items for q in items if p[0] < q[0])
    if block == 7:
        # No key of the join has much more than a block's square.
        plan = made._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_similarities_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(4)
    ratings = spark.createDataFrame([(int(u), int(i), float(s)) for u, i, s in zip(rng.integers(0, 9, 400), rng.permutation(400) % 60, rng.integers(1, 9, 400), strict=True)], "user int, item int, score double").dropDuplicates(["user", "item"]).persist()
    for f in (recommend.cosine, recommend.pearson):
        a, b = ({(r["a"], r["b"]): round(r["similarity"], 6) for r in f(ratings, block=n).collect()} for n in (3, 1000))
        assert a == b and a


def test_pairs_are_made_where_they_are_added_up(spark):
    """Parts of few pairs and an item that all users have: each a and b have one part, and pairs themselves are not dealt out."""
    r = spark.createDataFrame([(u, i, float(u % 5 + i)) for u in range(60) for i in {0, u % 7 + 1, u % 11 + 10, u % 13 + 30}], "user int, item int, score double")
    made = recommend._pairs(r, None, 3, 20).groupBy("_part", "_split", "a", "b").agg(F.count("*").alias("n"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "a#" not in "".join(x for x in plan.split("\n") if "Exchange hash" in x)
    got = {(x["a"], x["b"]): x["n"] for x in made.collect()}
    want = Counter((a, b) for u in range(60) for a in {0, u % 7 + 1, u % 11 + 10, u % 13 + 30} for b in {0, u % 7 + 1, u % 11 + 10, u % 13 + 30} if a < b)
    assert got == want and made.count() == len(want)
    assert made.select("_split").distinct().count() > 1


@pytest.mark.parametrize("pairs, kind", [(20, "int"), (10**6, "long"), (20, "string")])
def test_sums_of_packed_pairs(spark, monkeypatch, pairs, kind):
    """Few pairs a part, an item that all users have, a heavy user in blocks, and slices of some rows; texts as items take the plain way."""
    rng = random.Random(5)
    monkeypatch.setattr(recommend, "SLICE", 50)
    of = {u: {i * 1000 - 7000: rng.randrange(1, 50) / 2 for i in {0, *rng.sample(range(40), 4)}} for u in range(60)} | {99: {i * 1000 - 7000: float(i % 5) for i in range(40)}}
    r = spark.createDataFrame([(u, i, s) for u, items in of.items() for i, s in items.items()], "user int, item long, score double").withColumn("item", F.col("item").cast(kind))
    want = {}
    for items in of.values():
        for a in items:
            for b in items:
                if (str(a) < str(b)) if kind == "string" else (a < b):
                    x, y = items[a], items[b]
                    want[a, b] = np.add(want.get((a, b), np.zeros(6)), [1, x, y, x * x, y * y, x * y])
    made = recommend._sums(r, None, 7, pairs)
    assert (made is None) == (kind == "string")
    if made is not None:
        assert dict(made.dtypes)["a"] == r.schema["item"].dataType.simpleString()
        got = [((x["a"], x["b"]), [x[c] for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]) for x in made.collect()]
        assert len(got) == len(want) and {k: v for k, v in got} == {k: v.tolist() for k, v in want.items()}
    got = {(int(x["a"]), int(x["b"])): x["n"] for x in recommend.pearson(r, block=7).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    nulls = r.unionByName(spark.createDataFrame([(1, 1, None), (None, 2, 1.0)], "user int, item long, score double").withColumn("item", F.col("item").cast(kind)))
    assert recommend._sums(nulls, None, 7) is None and recommend.pearson(nulls).count() >= len(want)


def test_few_pairs_leave_the_task_that_adds_them_up(spark):
    """Pairs that are surely not similar are left out before they meet their norms, so they are not shuffled for that."""
    rng = random.Random(6)
    of = {u: {i: float(rng.randrange(1, 50)) for i in rng.sample(range(200), 20)} for u in range(300)}
    of |= {1000 + u: {500: 1.0 + u, 501: 1.0 + u, 502: 60.0} for u in range(9)} | {2000: {600: 3.0, 601: 3.0}}
    r = spark.createDataFrame([(u, i, s) for u, items in of.items() for i, s in items.items()], "user int, item int, score double")
    z, sq, dots = {}, Counter(), Counter()
    for u, items in of.items():
        mean = sum(items.values()) / len(items)
        z[u] = {i: s - mean for i, s in items.items()}
        for i, x in z[u].items():
            sq[i] += x * x
        for a in items:
            for b in items:
                if a < b:
                    dots[a, b] += z[u][a] * z[u][b]
    want = {p: d / (sq[p[0]] * sq[p[1]]) ** 0.5 for p, d in dots.items() if sq[p[0]] > 0 and sq[p[1]] > 0 and d / (sq[p[0]] * sq[p[1]]) ** 0.5 >= 0.2}
    made = recommend.cosine(r)
    got = {(x["a"], x["b"]): x["similarity"] for x in made.collect()}
    assert set(got) == set(want) and (500, 501) in got and all(abs(got[p] - want[p]) < 1e-9 for p in got)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan
    weighed = r.join(r.groupBy("user").agg(F.avg("score").alias("mean")), "user").withColumn("weight", F.lit(0).cast("long"))
    weighed = weighed.drop("weight").join(spark.createDataFrame([(i, int(np.floor(8 * np.log2(s))) if s else -20_000) for i, s in sq.items()], "item int, weight long"), "item")
    assert len(want) <= recommend._sums(weighed, None, 512, least=0.2).count() < min(1.5 * len(want) + 20, len(dots) / 4)


def test_many_denied_prefixes(spark, rows):
    short = spark.range(100_000).select(F.concat(F.lit("7."), (F.col("id") % 250).cast("string"), F.lit("."), F.floor(F.col("id") / 250).cast("string"), F.lit(".")).alias("prefix"))
    short = short.unionByName(spark.createDataFrame([("9.",), ("",)], "prefix string"))
    exact = spark.createDataFrame([("1.1.1.1",)], "ip string")
    hot = spark.range(5000).select(F.lit("7.3.200.9").alias("ip"))
    df = spark.createDataFrame([("1.1.1.1",), ("1.1.1.2",), ("7.3.399.1",), ("7.3.400.1",), ("9.9.9.9",), ("99.1.1.1",), (None,), ("",)], "ip string").unionByName(hot)
    assert sorted(rows(lookup.not_denied(df, exact, short)), key=str) == sorted([("1.1.1.2",), ("7.3.400.1",), ("99.1.1.1",), (None,), ("",)], key=str)
    assert lookup.not_denied(df, exact, short.limit(0)).count() == df.count() - 1


def test_maps_are_added_up_in_order(spark):
    d = [("u", {"b": 1, "a": 2}), ("u", {"a": 3}), ("u", None), ("v", None), ("w", {})]
    got = profile.summed_maps(spark.createDataFrame(d, "uuid string, m map<string,long>"), ["uuid"], {"m": F.col("m")})
    assert [(r["uuid"], r["m"]) for r in got.withColumn("m", profile.listed(F.col("m"))).collect()] == [("u", "a=5,b=1")]


def test_condition_trees(spark):
    t = spark.createDataFrame([(i, None if i == 9 else f"Big  Red n{i}", ["a"] if i % 2 else ["a", "b"], [("x", i)], i % 3 == 0) for i in range(10)], "id int, name string, tags array<string>, counts array<struct<k:string,n:int>>, flag boolean")
    ids = lambda *a, **b: [r["id"] for r in profile.search(t, *a, **b).orderBy("id").collect()]
    assert ids({}) == ids(None) == ids([]) == ids({"and": []}) == list(range(10))
    assert ids({"or": []}) == [] and ids({"or": [{"id": 1}, {"id": [2, 3]}]}) == [1, 2, 3]
    assert ids({"or": [{"id__min": 8}, {"and": [{"id__below": 2}, {"flag": True}]}]}) == [0, 8, 9]
    assert ids({"not": {"name__has": "n1"}}) == [0, 2, 3, 4, 5, 6, 7, 8, 9]  # what is null does not hold, so its opposite does
    assert ids({"name__phrase": "big red"}) == list(range(9)) and ids({"name__phrase": "ig red"}) == []
    assert ids({"name__known": False}) == [9] and ids({"tags__every": ["a", "b"]}, id__max=4) == [0, 2, 4] and ids({"tags__some": ["b", "z"], "tags__sized": (2, 2)}, id__between=(3, 6)) == [4, 6]
    assert ids({"each": {"counts": {"k": "x", "or": [{"n__above": 8}, {"n__max": 0}]}}}) == [0, 9]
    with pytest.raises(ValueError):
        ids({"id__like": 3})


def points(spark, rows):
    return spark.createDataFrame([("u", i, t, x, 0.0) for i, (t, x) in enumerate(rows)], "uuid string, event_id long, time long, lon double, lat double")


def test_clusters_keep_running_means_and_expire(spark, rows):
    got = rows(places.clusters(points(spark, [(0, 0.0), (1, 0.04), (2, 0.06), (3, 0.084)])).orderBy("cluster").select("cluster", F.round("lon", 9).alias("lon"), "n", "label_lon"))
    assert got == [(0, round((0 + 0.04 + 0.06) / 3, 9), 3, 0.04), (1, 0.084, 1, 0.084)]  # 0.084 is more than 0.05 from the mean
    got = rows(places.clusters(points(spark, [(0, 0.0), (60 * DAY - 1, 0.0), (120 * DAY - 1, 0.0)])).orderBy("cluster").select("cluster", "n"))
    assert got == [(0, 2), (1, 1)]  # a cluster idle for 60 days takes no point
    assert places.clusters(points(spark, [(0, 0.0), (1, 0.05)])).count() == 2  # on the radius is outside
    many = rows(places.clusters(points(spark, [(i, 0.0004 * (i % 100)) for i in range(1000)])).select("n", F.round("lon", 6).alias("lon")))
    assert many == [(1000, round(0.0004 * 49.5, 6))]


def test_thinning_over_long_runs(spark, rows):
    rng = np.random.default_rng(2)
    steps = np.where(rng.random(4000) < 0.02, 0.002, 0.0).cumsum()
    p = [("u" if i < 2500 else "v", i, i, float(x), 0.0) for i, x in enumerate(steps)]
    want, last = [], {}
    for u, i, _, x, _ in p:
        if u not in last or abs(x - last[u]) > places.THIN_DEG:
            last[u] = x
            want.append(i)
    df = spark.createDataFrame(p, "uuid string, event_id long, time long, lon double, lat double").repartition(5)
    assert sorted(r[0] for r in rows(places.thinned(df).select("event_id"))) == want


def test_jdbc_appends_once_and_reads_by_parts(spark, tmp_path, rows):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    a = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id long, name string")
    tables.append_jdbc_once(a, url, "T", "monday", driver=driver)
    tables.append_jdbc_once(a.where("id < 10"), url, "T", "tues'day", driver=driver)
    tables.append_jdbc_once(a.where("id >= 40"), url, "T", "monday", driver=driver)  # made again, with other rows
    df = tables.jdbc_parts(spark, url, "T", '"id"', 4, driver=driver)
    assert df.rdd.getNumPartitions() == 4
    assert sorted(rows(df.select("id", "run_key"))) == sorted([(i, "tues'day") for i in range(10)] + [(i, "monday") for i in range(40, 50)])
    tables.append_jdbc(a.select("id").limit(3), url, "PLAIN", driver=driver)
    assert tables.jdbc(spark, url, "PLAIN", driver=driver).count() == 3
    assert tables.jdbc_parts(spark, url, "(SELECT * FROM PLAIN WHERE \"id\" < 0) p", '"id"', 4, driver=driver).count() == 0

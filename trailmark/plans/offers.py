"""Queries about items: similarity, recommendations, their effect. Customers rate parts by the quantity they ordered."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators import recommend, sessions
from trailmark.plans.adapt import EV, RATINGS, events, ratings, table
from trailmark.plans.streams import folder

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def stored_ratings(spark, sf_dir) -> DataFrame:
    """Ratings, written once, as sums of pairs read them several times."""
    r, path = ratings(spark, sf_dir), f"{folder(spark)}/ratings-{uuid.uuid4().hex}"
    r.write.parquet(path)
    return spark.read.schema(r.schema).parquet(path)


@query("item_cosine", f"""WITH {RATINGS}, c AS (SELECT "user", item, score - avg(score) OVER (PARTITION BY "user") AS score FROM rt), n AS (SELECT item, sum(score * score) AS sq FROM c GROUP BY item),
d AS (SELECT a.item AS a, b.item AS b, sum(a.score * b.score) AS dot FROM c a JOIN c b ON a."user" = b."user" AND a.item < b.item GROUP BY ALL)
SELECT a, b, round(dot / sqrt(x.sq * y.sq), 6) AS similarity FROM d JOIN n x ON a = x.item JOIN n y ON b = y.item WHERE x.sq > 0 AND y.sq > 0 AND dot / sqrt(x.sq * y.sq) >= 0.2""")
def item_cosine(spark, sf_dir):
    return recommend.cosine(stored_ratings(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


@query("item_pearson", f"""WITH {RATINGS}, s AS (SELECT a.item AS a, b.item AS b, count(*) AS n, sum(a.score) AS sx, sum(b.score) AS sy, sum(a.score * a.score) AS sxx, sum(b.score * b.score) AS syy, sum(a.score * b.score) AS sxy FROM rt a JOIN rt b ON a."user" = b."user" AND a.item < b.item GROUP BY ALL),
d AS (SELECT *, sqrt(greatest(sxx - sx * sx / n, 0)) * sqrt(greatest(syy - sy * sy / n, 0)) AS below FROM s) SELECT a, b, n, round(CASE WHEN below > 1e-4 THEN (sxy - sx * sy / n) / below ELSE 0 END, 6) AS similarity FROM d""")
def item_pearson(spark, sf_dir):
    return recommend.pearson(stored_ratings(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


SCORE_SQL = f"{RATINGS}, sc AS (SELECT \"user\", (item * 7 + 11) % 2000 AS item, 1 + item % 2 AS item_type, score FROM rt), sg AS (SELECT \"user\", item, item_type, max(score) AS score FROM sc GROUP BY ALL), re AS (SELECT \"user\", item, CASE WHEN item % 4 = 0 THEN 0 ELSE 1 END AS stay FROM rt)"


def scores(spark, sf_dir) -> DataFrame:
    """Model scores, made from ratings of other parts."""
    r = ratings(spark, sf_dir)
    s = r.select("user", ((F.col("item") * 7 + 11) % 2000).alias("item"), (1 + F.col("item") % 2).alias("item_type"), "score")
    return s.groupBy("user", "item", "item_type").agg(F.max("score").alias("score"))


def rated(spark, sf_dir) -> DataFrame:
    return ratings(spark, sf_dir).select("user", "item", F.when(F.col("item") % 4 == 0, 0).otherwise(1).alias("stay"))


TOP_SQL = f"{SCORE_SQL}, tp AS (SELECT * FROM (SELECT \"user\", item_type, item, score, CAST(row_number() OVER (PARTITION BY \"user\", item_type ORDER BY score DESC, item) AS INTEGER) AS rank FROM sg WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM re WHERE re.\"user\" = sg.\"user\" AND re.item = sg.item AND re.stay > 0)) WHERE rank <= CASE item_type WHEN 1 THEN 250 ELSE 125 END)"


def _top(spark, sf_dir) -> DataFrame:
    return recommend.top_items(scores(spark, sf_dir), rated(spark, sf_dir), {1: 250, 2: 125})


@query("recommend_topn", f'WITH {TOP_SQL} SELECT "user", item_type, item, rank, CAST(trunc(score * 100000) AS BIGINT) AS points FROM tp')
def recommend_topn(spark, sf_dir):
    return recommend.published(_top(spark, sf_dir)).select("user", "item_type", "item", "rank", "points")


@query("recommend_push", f'WITH {TOP_SQL} SELECT "user", CAST(CASE WHEN coalesce(avg(score) FILTER (WHERE item_type = 1), 0) > coalesce(avg(score) FILTER (WHERE item_type = 2), 0) THEN 1 ELSE 2 END AS INTEGER) AS push_type FROM tp GROUP BY 1')
def recommend_push(spark, sf_dir):
    return recommend.push_type(_top(spark, sf_dir))


@query("recommend_user", f'WITH {SCORE_SQL} SELECT c_nationkey AS account, item_type, item, round(max(score), 6) AS score FROM sg JOIN customer ON "user" = c_custkey GROUP BY ALL')
def recommend_user(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user"), F.col("c_nationkey").alias("account"))
    return recommend.by_account(scores(spark, sf_dir), c).withColumn("score", F.round("score", 6))


@query("recommend_area", f"""WITH {SCORE_SQL}, m AS (SELECT r_name || '@' || n_name AS area, item_type, item, avg(score) AS score FROM sg JOIN customer ON "user" = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT area, item_type, item, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY area, item_type ORDER BY score DESC, item) AS INTEGER) AS rank FROM m) WHERE rank <= CASE item_type WHEN 1 THEN 250 ELSE 125 END""")
def recommend_area(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    areas = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("user"), F.concat_ws("@", "r_name", "n_name").alias("area"))
    best = recommend.by_area(scores(spark, sf_dir), areas, 250).where(F.col("rank") <= F.when(F.col("item_type") == 1, 250).otherwise(125))
    return best.select("area", "item_type", "item", "rank")


EFFECT_SQL = f"""{EV}, l AS (SELECT DISTINCT uuid FROM ev WHERE logtype = '50' AND pageid < 40), r AS (SELECT DISTINCT uuid FROM ev WHERE system = 'ios'), pg AS (SELECT uuid, pageid, lead(pageid) OVER (PARTITION BY uuid ORDER BY time, event_id) AS nx FROM ev WHERE logtype = '50'),
h AS (SELECT DISTINCT uuid FROM pg WHERE pageid < 40 AND nx >= 90), t AS (SELECT DISTINCT uuid FROM ev WHERE logtype = '50' AND pageid >= 90 AND value > 40)"""


@query("recommend_effect", f"""WITH {EFFECT_SQL} SELECT 'seen' AS "group", count(*) AS users FROM l UNION ALL SELECT 'exposed', count(*) FROM l WHERE uuid IN (SELECT uuid FROM r) UNION ALL SELECT 'default', count(*) FROM l WHERE uuid NOT IN (SELECT uuid FROM r)
UNION ALL SELECT 'default_hit', count(*) FROM l WHERE uuid NOT IN (SELECT uuid FROM r) AND uuid IN (SELECT uuid FROM h) UNION ALL SELECT 'recommended_hit', count(*) FROM t""")
def recommend_effect(spark, sf_dir):
    e = events(spark, sf_dir)
    pages = e.where("logtype = '50'")
    told = pages.where("pageid >= 90 and value > 40").select("uuid").distinct()
    hits = sessions.followed(pages, F.col("pageid") < 40, F.col("pageid") >= 90)
    return recommend.effect(pages.where("pageid < 40").select("uuid").distinct(), e.where("system = 'ios'").select("uuid").distinct(), hits, told)


@query("item_rating", f"WITH {EV}, r AS (SELECT uuid, CAST(pageid AS VARCHAR) AS item, CAST(CASE WHEN subtype IN ('view', 'click') THEN 1 ELSE 2 END AS INTEGER) AS item_type, CASE WHEN logtype = '50' THEN (event_id % 1000) * 10 / 1000.0::DOUBLE ELSE 5 END AS score FROM ev) SELECT uuid, item, item_type, round(sum(score), 6) AS score FROM r GROUP BY ALL")
def item_rating(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("staytime", F.col("event_id") % 1000 * 10)
    kind = F.when(F.col("subtype").isin("view", "click"), "photo_x").otherwise("case_x")
    data = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.struct(F.col("pageid").alias("id")).alias("item")))).otherwise(F.to_json(F.struct(F.col("pageid").alias("id"))))
    return recommend.item_rating(e.withColumn("data", data).withColumn("subtype", kind)).withColumn("score", F.round("score", 6))


@query("click_through", f"WITH {EV} SELECT subtype AS origin_type, CAST(pageid % 10 AS VARCHAR) AS origin_id, CAST(pageid AS VARCHAR) AS hit_id, count(*) AS hits, count(DISTINCT uuid) AS users FROM ev WHERE logtype <> '50' GROUP BY ALL")
def click_through(spark, sf_dir):
    from trailmark.operators import reports

    data = F.to_json(F.struct(F.when(F.col("logtype") == "50", "1").otherwise("0").alias("alg"), (F.col("pageid") % 10).cast("string").alias("from"), F.col("pageid").cast("string").alias("to")))
    e = events(spark, sf_dir).withColumn("data", data).where(F.get_json_object("data", "$.alg") == "0")
    return reports.click_through(e.select("uuid", F.col("subtype").alias("origin_type"), F.get_json_object("data", "$.from").alias("origin_id"), F.get_json_object("data", "$.to").alias("hit_id")))

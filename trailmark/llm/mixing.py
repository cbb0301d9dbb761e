"""Mixing sources to target weights by repetition rates.

Sizes are summed per source, targets follow from the weights, and the rate of a source is its target over its size. Each
document is taken floor(rate) times, and once more with the probability of the fraction, drawn from a hash of its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.shared import materialise, private

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times the size of its source.
MOST = 3
#: Seeds tried for each source; the one whose draw comes nearest to the target is used.
SEEDS = 16


def words(text: Column) -> Column:
    """The number of runs without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(key: Column, seed: Column) -> Column:
    """A number from [0, 1) fixed by a row's key and a seed: 48 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", seed.cast("string"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources sorted by code point, null last, have WEIGHTS in turn. All sizes are shared out by weight; a target stops at MOST
    times its source's size and the excess is shared again. With sources in the order of MOST * size / weight the first
    ones stop, so prefix sums over that order give the same result as sharing again and again. One row per source is
    all that meets in one place here.
    """
    name = W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(name) - 1) % len(WEIGHTS) + 1)
    t = sizes.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * MOST).alias("most"))
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    left = F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))
    t = t.select("*", left.alias("left"), F.sum("weight").over(after).alias("open"))
    # A source stops if its share of what the earlier ones leave reaches its limit; then all before it have stopped as well.
    stops = F.col("left") * F.col("weight") >= F.col("most") * F.col("open")
    t = t.select("*", stops.alias("stops"))
    level = F.first(F.when(~F.col("stops"), F.struct("left", "open")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    share = F.col("weight") * level["left"] / level["open"]
    return t.select("source", "source_size", F.when(F.col("stops"), F.col("most").cast("double")).otherwise(share).alias("target"))


MADE = ["size", "source_size", "target", "copies"]


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with the columns MADE under names of their own, so none of the caller's is touched; those names."""
    own = {n: private(n) for n in [*MADE, "source", "times", "odds", "seed"]}
    sized = docs.select(F.col(id_col).alias("key"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    sized = materialise(sized, "sizes")
    goal = materialise(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = goal.select("source", "source_size", "target", F.floor(rate).alias("times"), (rate - F.floor(rate)).alias("odds"))
    # One row per source is joined to all rows: Spark broadcasts it while small and splits hot sources otherwise.
    joined = sized.join(rated, sized["source"].eqNullSafe(rated["source"])).select(sized["source"].alias("source"), "key", "size", "odds", "times", "target")
    extra = [F.sum(F.when(draw(F.col("key"), F.lit(s)) < F.col("odds"), F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(SEEDS)]
    totals = joined.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("times")).alias("whole"), *extra)
    miss = F.array(*[F.struct(F.abs(F.col("whole") + F.col(f"s{s}") - F.col("target")).alias("miss"), F.lit(s).alias("seed")) for s in range(SEEDS)])
    best = totals.select(F.col("source").alias("s"), F.array_min(miss)["seed"].alias("seed"))
    plan = materialise(rated.join(best, rated["source"].eqNullSafe(best["s"])).select("source", "source_size", "target", "times", "odds", "seed"), "rates")
    plan = plan.select(*[F.col(c).alias(own[c]) for c in plan.columns])
    out = docs.withColumn(own["size"], words(F.col(text_col))).join(plan, F.col(source_col).eqNullSafe(F.col(own["source"])))
    again = (draw(F.col(id_col), F.col(own["seed"])) < F.col(own["odds"])).cast("long")
    return out.withColumn(own["copies"], F.col(own["times"]) + again), own


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Each row of docs with size, source_size, target and copies (how often the mix takes it).

    A null text has size 0; a null source is a source of its own; a null id draws like the text "null"; repeated rows draw
    alike. A source without words has target 0 and is not taken. Columns named as a result column are replaced. An empty
    table gives an empty result. The result depends on ids, sources and texts alone, so reruns agree. Texts are measured whole.

    The draw of a document is a Bernoulli trial; of SEEDS seeds a source uses the one whose total is nearest to its target,
    so a few very long documents do not throw a source off.
    """
    out, own = _planned(docs, id_col, text_col, source_col)
    return out.select(*[c for c in docs.columns if c not in MADE or c in (id_col, text_col, source_col)], *[F.col(own[c]).alias(c) for c in MADE])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with all columns as they are, whatever their names. See mix."""
    out, own = _planned(docs, id_col, text_col, source_col)
    taken = out.where(F.col(own["copies"]) > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(own["copies"]))).alias(own["seed"]))
    return taken.select(*docs.columns)

"""Item similarity, ratings and recommendations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def item_rating(events: DataFrame, fixed: float = 5.0) -> DataFrame:
    """(uuid, item, item_type, score): a page rates its item by stay in seconds, another behaviour by a fixed score.

    The item is `id` of the JSON data, plain or within `item`; type 1 is a photo, 2 a case.
    """
    item = F.coalesce(F.get_json_object("data", "$.item.id"), F.get_json_object("data", "$.id"))
    kind = F.when(F.contains("subtype", F.lit("photo")), 1).when(F.contains("subtype", F.lit("case")), 2)
    score = F.when(F.col("logtype") == "50", F.col("staytime") / 1000.0).otherwise(fixed)
    rated = events.select("uuid", item.alias("item"), kind.alias("item_type"), score.alias("score")).where("item is not null and item_type is not null")
    return rated.groupBy("uuid", "item", "item_type").agg(F.sum("score").alias("score"))


#: Items of a block of a user's items, so that no row holds more of them.
BLOCK = 512
#: Pairs of a part of the items, about so many of which are added up in one task.
PAIRS = 1_000_000


def _pairs(ratings: DataFrame, most: int | None, block: int = BLOCK, pairs: int = PAIRS) -> DataFrame:
    """Items a < b that a user rated, with their scores x and y; all pairs of an a and b have the same _part and _split.

    Pairs are made where they are added up. The items are cut into ranges of about `pairs` pairs, and what is dealt out by part is
    each user's items a of a range beside the list of its items b, not a row for each pair. An item with more pairs than that has
    its lists split by a hash of b, and a user's items are dealt over lists of about `block`; no pair is lost. Only if `most` is
    given, users with more items give their best ones alone.
    """
    r = ratings
    if most is not None:
        w = W.partitionBy("user").orderBy(F.col("score").desc(), "item")
        r = r.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
    r = r.withColumn("_m", F.count("*").over(W.partitionBy("user")))
    made = r.agg(F.sum("_m")).first()[0]  # one number: twice the pairs
    parts = max(1, -(-(made or 0) // (2 * pairs)))
    ranges = r.select("item", "_m").repartitionByRange(parts, "item").withColumn("_part", F.spark_partition_id())
    ranges = ranges.groupBy("item", "_part").agg(F.ceil(F.sum("_m") / (2 * pairs)).cast("int").alias("_of"))
    lists = F.ceil(F.col("_m") / block)
    r = r.join(ranges, "item").withColumn("_own", F.pmod(F.xxhash64("item"), lists).cast("int"))
    sorted_lists = lambda *keys: r.groupBy("user", *keys).agg(F.sort_array(F.collect_list(F.struct("item", "score"))).alias("_l"))
    a = sorted_lists("_own", "_part", "_of").drop("_own").select("user", "_part", "_of", F.col("_l")[0]["item"].alias("_least"), F.col("_l.item").alias("_a"), F.col("_l.score").alias("_x"))
    b = sorted_lists("_own").select("user", "_l")
    both = a.join(b, "user").withColumn("_split", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    mine = lambda e: (e["item"] > F.col("_least")) & ((F.col("_of") == 1) | (F.pmod(F.xxhash64(e["item"]), F.col("_of")) == F.col("_split")))
    both = both.withColumn("_l", F.filter("_l", mine)).where(F.size("_l") > 0)
    dealt = both.select("user", "_part", "_split", "_a", "_x", F.col("_l.item").alias("_b"), F.col("_l.score").alias("_y")).repartition(parts, "_part", "_split")
    one = dealt.select("user", "_part", "_split", F.inline(F.arrays_zip("_a", "_x")).alias("a", "x"), "_b", "_y")
    return one.select("user", "_part", "_split", "a", "x", F.inline(F.arrays_zip("_b", "_y")).alias("b", "y")).where("a < b")


#: Pairs that a task makes at a time, of many users.
SLICE = 2_000_000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then their second ones: small numbers have long runs of zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), 8).T).tobytes()


def _values(data: memoryview, n: int, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, n).T).reshape(-1).view(kind)


def _dealt(bounds: np.ndarray, hot: dict[int, int]) -> Callable:
    """Rows (items a, their scores and weights, items b, theirs, mean), sorted by item, to messages (_part, _split, n, m, data) of the pairs a < b of many rows.

    A message lists n items a of a range of items, and after them the m items b of each as gaps. hot: parts of an item's list of b.
    """
    schema = pa.schema([("_part", pa.int32()), ("_split", pa.int32()), ("n", pa.int64()), ("m", pa.int64()), ("data", pa.binary())])
    often = np.array(sorted(hot), np.int64)
    splits = np.array([hot[i] for i in often.tolist()], np.int64)

    def column(b: pa.RecordBatch, i: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        lists = b.column(i)
        return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)

    def messages(b: pa.RecordBatch) -> Iterator[tuple]:
        (a, at), (x, _), (u, _), (c, to), (y, _), (v, _) = [column(b, i, k) for i, k in enumerate((np.int64, np.float64, np.int64) * 2)]
        row = np.repeat(np.arange(b.num_rows), np.diff(at))
        # Where an item's larger ones begin in its row's list.
        rank = np.concatenate([np.searchsorted(c[to[r] : to[r + 1]], a[at[r] : at[r + 1]], "right") for r in range(b.num_rows)]) + to[row]
        mean = b.column(6).to_numpy(zero_copy_only=False)[row]
        part = np.searchsorted(bounds, a, "left")
        order = np.argsort(part, kind="stable")
        a, x, u, row, rank, mean, part = (z[order] for z in (a, x, u, row, rank, mean, part))
        size = to[row + 1] - rank
        own = np.repeat(np.arange(len(a)), size)
        other = np.arange(len(own)) + np.repeat(rank - (np.cumsum(size) - size), size)
        split = np.zeros(len(own), np.int64)
        if len(often):
            place = np.minimum(np.searchsorted(often, a), len(often) - 1)
            of = np.where(often[place] == a, splits[place], 1)
            split = (c[other].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % of[own]
            order = np.lexsort((own, split, part[own]))
            own, other, split = own[order], other[order], split[order]
        p = part[own]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (split[1:] != split[:-1])]) if len(own) else np.zeros(0, bool)
        first = np.flatnonzero(new)  # of the pairs of an item a
        gaps = np.diff(c[other], prepend=0)
        gaps[first] = c[other[first]] - a[own[first]]
        cuts = np.flatnonzero(np.concatenate([[True], (p[first][1:] != p[first][:-1]) | (split[first][1:] != split[first][:-1])])) if len(first) else []
        ends = np.append(first, len(own))
        for i, j in zip(cuts, [*cuts[1:], len(first)], strict=True):
            h, t = first[i:j], slice(ends[i], ends[j])
            body = [a[own[h]], np.diff(ends[i : j + 1]), x[own[h]], u[own[h]], mean[own[h]], gaps[t], y[other[t]], v[other[t]]]
            yield int(p[h[0]]), int(split[h[0]]), len(h), int(ends[j] - ends[i]), pa.compress(b"".join(map(_planes, body)), codec="zstd", asbytes=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = np.cumsum(b.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) * b.column(3).value_lengths().to_numpy(zero_copy_only=False))
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + SLICE, "right")))
                rows = list(messages(b.slice(at, to - at)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                at = to

    return run


def _added(least: float | None) -> Callable:
    """The messages of a part to a row (a, b, n, sx, sy, sxx, syy, sxy) of each pair; with least, those alone that can be that similar."""
    kinds = (np.int64, np.int64, np.float64, np.int64, np.float64, np.int64, np.float64, np.int64)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = []
        for n, m, data in zip(*[table.column(c).to_pylist() for c in ("n", "m", "data")], strict=True):
            sizes = [n] * 5 + [m] * 3
            raw, at = memoryview(pa.decompress(data, decompressed_size=8 * sum(sizes), codec="zstd", asbytes=True)), 0
            got = []
            for size, kind in zip(sizes, kinds, strict=True):
                got.append(_values(raw[at : at + 8 * size], size, kind))
                at += 8 * size
            a, count, x, u, mean, gaps, y, v = got
            start = np.cumsum(count) - count
            b = np.cumsum(gaps)
            b += np.repeat(a - (b[start] - gaps[start]), count)
            parts.append((np.repeat(a, count), b, np.repeat(x - mean, count), y - np.repeat(mean, count), np.repeat(u, count) + v))
        a, b, x, y, w = (np.concatenate(c) for c in zip(*parts, strict=True))
        low, span = int(b.min()), int(b.max()) - int(b.min()) + 1
        together = (int(a.max()) - int(a.min()) + 1) * span < 2**62
        order = np.argsort((a - a.min()) * span + (b - low)) if together else np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        x, y, added = x[order], y[order], lambda z: np.add.reduceat(z, first)
        dot = added(x * y)
        if least is not None:
            keep = ~(dot < least * 2.0 ** (w[order][first] / 16) * (1 - 1e-9) - 1e-12)
            out = {"a": a[first][keep], "b": b[first][keep], "sxy": dot[keep]}
        else:
            out = {"a": a[first], "b": b[first], "n": np.diff(np.append(first, len(a))), "sx": added(x), "sy": added(y), "sxx": added(x * x), "syy": added(y * y), "sxy": dot}
        return pa.table(out)

    return run


def _sums(ratings: DataFrame, most: int | None, block: int, pairs: int = PAIRS, least: float | None = None) -> DataFrame | None:
    """(a, b, n, sx, sy, sxx, syy, sxy) of items a < b, their pairs as of `_pairs`; None if items are no whole numbers or a score is null.

    What is dealt out are each user's items of a range beside the lists of their larger items, of many users in one packed message,
    about three bytes a pair. The pairs of a range are made and added up in one task. With `least`, only a, b and sxy come, of scores
    less the column `mean`, and pairs are left out whose sum is surely below least times their norms; weight is 8 log2 of an item's squared norm, rounded down.
    """
    if not isinstance(ratings.schema["item"].dataType, _WHOLE):
        return None
    r = ratings.where("user is not null and item is not null")
    if most is not None:
        w = W.partitionBy("user").orderBy(F.col("score").desc(), "item")
        r = r.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
    seen = r.groupBy("user").agg(F.count("*").alias("m"), F.count("score").alias("scores")).agg(F.sum(F.col("m") * F.col("m")), F.sum(F.col("m") - F.col("scores"))).first()
    if seen[1]:
        return None
    parts = max(1, -(-(seen[0] or 0) // (2 * pairs)))
    # Numbers of the driver: bounds of parts, and the items with more than a part's pairs, at most one a part.
    cuts = r.agg(F.percentile_approx(F.col("item").cast("long"), [i / parts for i in range(1, parts)], max(10_000, 10 * parts))).first()[0] if parts > 1 else []
    r = r.withColumn("_m", F.count("*").over(W.partitionBy("user")))
    often = r.groupBy(F.col("item").cast("long").alias("item")).agg(F.ceil(F.sum("_m") / (2 * pairs)).cast("long").alias("of")).where("of > 1")
    hot = {x["item"]: x["of"] for x in often.collect()} if parts > 1 else {}
    own = F.pmod(F.xxhash64("item"), F.ceil(F.col("_m") / block)).cast("int")
    entry = F.struct(F.col("item").cast("long").alias("item"), F.col("score").cast("double").alias("score"), F.col("weight") if least is not None else F.lit(0).cast("long").alias("weight"))
    mean = F.first("mean") if least is not None else F.lit(0.0)
    lists = r.groupBy("user", own.alias("_own")).agg(F.sort_array(F.collect_list(entry)).alias("l"), mean.alias("mean"))
    sides = [lists.select("user", *[F.col(f"l.{c}").alias(f"{x}_{c}") for c in ("item", "score", "weight")], *(["mean"] if x == "b" else [])) for x in "ab"]
    rows = sides[0].join(sides[1], "user").drop("user")
    sent = rows.mapInArrow(_dealt(np.array(sorted(set(cuts or [])), np.int64), hot), "_part int, _split int, n long, m long, data binary")
    kind = "a long, b long, sxy double" if least is not None else "a long, b long, n long, sx double, sy double, sxx double, syy double, sxy double"
    out = sent.groupBy("_part", "_split").applyInArrow(_added(least), kind)
    whole = ratings.schema["item"].dataType
    return out.withColumns({c: F.col(c).cast(whole) for c in "ab"})


def cosine(ratings: DataFrame, least: float = 0.2, most: int | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity) of items: cosine of scores less their user's mean, norms over all raters; items without a norm drop out."""
    means = ratings.groupBy("user").agg(F.avg("score").alias("mean"))
    with_mean = ratings.join(means, "user")
    centred = F.col("score") - F.col("mean")
    norms = with_mean.groupBy("item").agg(F.sum(centred * centred).alias("sq"))
    dots = None
    if least > 0:
        weighed = with_mean.join(norms.select("item", F.coalesce(F.floor(8 * F.log2("sq")), F.lit(-20_000)).cast("long").alias("weight")), "item")
        dots = _sums(weighed, most, block, least=least)
    if dots is None:
        of = with_mean.select("user", "item", centred.alias("score"))
        dots = _pairs(of, most, block).groupBy("_part", "_split", "a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("sxy"))
    out = dots.join(norms.select(F.col("item").alias("a"), F.col("sq").alias("sa")), "a").join(norms.select(F.col("item").alias("b"), F.col("sq").alias("sb")), "b")
    sim = F.col("sxy") / F.sqrt(F.col("sa") * F.col("sb"))
    return out.where("sa > 0 and sb > 0").select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= least)


def pearson(ratings: DataFrame, most: int | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b, n, similarity): correlation over the users who rated both; 0 where it has no value."""
    s = _sums(ratings, most, block)
    if s is None:
        x, y, n = F.col("x"), F.col("y"), F.count("*")
        s = _pairs(ratings, most, block).groupBy("_part", "_split", "a", "b").agg(n.alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"))
    below = F.sqrt(F.greatest(F.col("sxx") - F.col("sx") ** 2 / F.col("n"), F.lit(0.0))) * F.sqrt(F.greatest(F.col("syy") - F.col("sy") ** 2 / F.col("n"), F.lit(0.0)))
    return s.select("a", "b", "n", F.when(below > 1e-4, (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / below).otherwise(0.0).alias("similarity"))


def top_items(scores: DataFrame, rated: DataFrame, n: dict[int, int]) -> DataFrame:
    """The best items of each user and type by positive score, without those already rated with a stay, ties to the smaller item.

    scores: user, item, item_type, score; rated: user, item, stay; n: how many of each type.
    """
    left = scores.where("score > 0").join(rated.where("stay > 0").select("user", "item"), ["user", "item"], "left_anti")
    w = W.partitionBy("user", "item_type").orderBy(F.col("score").desc(), "item")
    limit = F.create_map(*[F.lit(x) for kv in n.items() for x in kv])[F.col("item_type")]
    return left.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def push_type(kept: DataFrame) -> DataFrame:
    """1 where a user's kept items of type 1 have the better average, else 2."""
    mean = lambda t: F.coalesce(F.avg(F.when(F.col("item_type") == t, F.col("score"))), F.lit(0.0))
    return kept.groupBy("user").agg(mean(1).alias("photo"), mean(2).alias("case")).select("user", F.when(F.col("photo") > F.col("case"), 1).otherwise(2).alias("push_type"))


def by_account(scores: DataFrame, accounts: DataFrame) -> DataFrame:
    """The largest score of an item over an account's devices."""
    return scores.join(accounts, "user").groupBy("account", "item_type", "item").agg(F.max("score").alias("score"))


def by_area(scores: DataFrame, areas: DataFrame, n: int) -> DataFrame:
    """The n items of each area and type with the best mean score."""
    mean = scores.join(areas, "user").groupBy("area", "item_type", "item").agg(F.avg("score").alias("score"))
    w = W.partitionBy("area", "item_type").orderBy(F.col("score").desc(), "item")
    return mean.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def published(top: DataFrame) -> DataFrame:
    """Scores as whole numbers, 100000 for 1."""
    return top.withColumn("points", (F.col("score") * 100_000).cast("long"))


def fanned_out(top: DataFrame, active: DataFrame, today: int, days: int = 15) -> DataFrame:
    """Recommendations of users who were active lately; active: user, day."""
    seen = active.where(F.col("day") > today - days).select("user").distinct()
    return top.join(seen, "user", "left_semi")


def effect(list_pages: DataFrame, recommended: DataFrame, hits: DataFrame, told: DataFrame) -> DataFrame:
    """Users of each group: seen, exposed, default, default_hit and recommended_hit. All inputs are distinct uuids.

    list_pages saw the list; hits went from it straight to a detail; told opened a detail that names the algorithm.
    """
    exposed = list_pages.join(recommended, "uuid", "left_semi")
    default = list_pages.join(recommended, "uuid", "left_anti")
    groups = {"seen": list_pages, "exposed": exposed, "default": default, "default_hit": default.join(hits, "uuid", "left_semi"), "recommended_hit": told}
    counted = [df.agg(F.count("*").alias("users")).select(F.lit(n).alias("group"), "users") for n, df in groups.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def users_by(events: DataFrame, name: Column) -> DataFrame:
    """Distinct users of each algorithm."""
    return events.groupBy(name.alias("algorithm")).agg(F.countDistinct("uuid").alias("users"))

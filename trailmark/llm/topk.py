"""Exact top-k search by distributed histogram selection.

All pairs of a query and a candidate are scored, block by block. A first pass counts the scores of each query in wide bins over
the range that the vectors' norms allow; each further pass splits the one bin that holds a query's k-th value, until the bin is
one integer wide. The k-th value is then exact, and a last pass keeps what lies at or above it. Scores are recomputed, never
stored; only counts and winners are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.blocks import pack, paired, unpack
from trailmark.llm.shared import materialise, valid_vector

BINS = 512
CANDIDATES_A_BLOCK = 2048
QUERIES_A_BLOCK = 512
#: Queries scored at a time within a block.
SLICE = 128


#: Scores are longs; those beyond are the nearest of these ends.
MOST = 2**63 - 1


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products. Doubles are exact below 2^53; larger ones are taken in 64-bit integers, and beyond those in whole numbers of any size."""
    bound = np.abs(q).sum(axis=1).max(initial=0) * np.abs(c).max(initial=0)
    if bound < 2**53:
        return (q @ c.T).astype(np.int64)
    if bound < 2**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = lambda x: np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    return np.clip(whole(q) @ whole(c).T, -MOST, MOST).astype(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(query ids, low, ids, scores) of each slice of a pair of blocks; a query's own row is out."""
    for b in batches:
        for r in range(b.num_rows):
            x = {n: b.column(i)[r].as_py() for i, n in enumerate(b.schema.names)}
            if x["dim"] != x["q_dim"]:
                continue
            ids, data = unpack(x["ids"], x["data"], x["dim"])
            q_ids, q_data = unpack(x["q_ids"], x["q_data"], x["dim"])
            low = np.frombuffer(x["q_low"], np.int64)
            for i in range(0, len(q_ids), SLICE):
                s = slice(i, i + SLICE)
                yield q_ids[s], low[s], ids, np.where(q_ids[s][:, None] == ids, np.iinfo(np.int64).min, _scores(q_data[s], data))


def _counts(k: int, width: int):
    """Counts per bin of the block's own k best scores and their ties: no lower bin can hold the k-th value."""
    schema = pa.schema([("query_id", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, low, _, scores in _cells(batches):
            kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(q_ids), np.iinfo(np.int64).min)
            at, col = np.nonzero((scores >= np.maximum(kth, low)[:, None]) & (scores > np.iinfo(np.int64).min))
            above = scores[at, col].view(np.uint64) - low[at].view(np.uint64)  # up to twice the largest long
            bins = np.minimum(above // np.uint64(width), np.uint64(BINS)).astype(np.int64)  # above the range: bin BINS
            keys, n = np.unique(at * (BINS + 1) + bins, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[keys // (BINS + 1)]), pa.array(keys % (BINS + 1)), pa.array(n)], schema=schema)

    return run


def _winners(k: int):
    """At or above each query's k-th value (low): at most k of a block, higher scores first, then smaller ids."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, low, ids, scores in _cells(batches):
            at, col = np.nonzero((scores >= low[:, None]) & (scores > np.iinfo(np.int64).min))
            value, found = scores[at, col], ids[col]
            order = np.lexsort((found, -value, at))
            at, value, found = at[order], value[order], found[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            keep = place < k
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[at[keep]]), pa.array(found[keep]), pa.array(value[keep])], schema=schema)

    return run


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def exact_top_k(vectors: DataFrame, k: int, every: int, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query: (query_id, rank from 1, vec_id, score), ties to the smaller id.

    Components become floor(scale * x). Queries are the rows whose id is divisible by `every`; candidates are all rows with
    another id. Vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no part;
    vectors of different length do not meet. A query with fewer than k candidates returns them all, one without any returns
    nothing. Repeated rows of one id are candidates each; as a query, the smallest vector of an id counts. Scores are 64-bit; one
    that would be larger is the largest long, one that would be smaller its negative.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("id").isNotNull() & valid_vector(F.col("v")))
    v = v.withColumn("low", F.lit(0).cast("long"))
    candidates = materialise(pack(v, CANDIDATES_A_BLOCK, scale).drop("low"), "candidates")
    # |q.c| <= |q||c|, so the largest norm bounds all scores.
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.floor(x.cast("double") * scale).cast("double") ** 2)
    seen = v.agg(F.max(square).alias("most"), F.count("*").alias("n"), F.count(F.when(F.col("id") % every == 0, 1)).alias("asked")).first()
    most = int(min(seen["most"] or 0, float(2**62))) + 1 if (seen["most"] or 0) < 2**61 else MOST
    # At most as many groups as there are candidates for a query, so that queries sent to each add up to about the candidates.
    sizes = (1 + seen["asked"] // QUERIES_A_BLOCK, 1 + min(seen["n"] // CANDIDATES_A_BLOCK, seen["n"] // max(1, seen["asked"])))
    width = -(-(2 * most + 1) // BINS)
    asked = materialise(v.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("low", F.lit(-most).cast("long")), "asked")
    while True:
        blocks = pack(asked, QUERIES_A_BLOCK, scale)
        counts = paired(blocks, candidates, *sizes).mapInArrow(_counts(k, width), "query_id long, bin long, n long")
        counts = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = W.partitionBy("query_id").orderBy(F.col("bin").desc())
        # The bin where the sum from above reaches k holds the k-th value. A query with fewer candidates has none: all are kept.
        hit = counts.withColumn("above", F.sum("n").over(down)).where(F.col("above") >= k).groupBy("query_id").agg(F.max("bin").alias("bin"))
        low = F.when(F.col("bin").isNotNull(), _wide("low") + _wide("bin") * F.lit(str(width)).cast("decimal(20,0)")).otherwise(-most).cast("long")
        asked = materialise(asked.join(hit, asked["id"] == hit["query_id"], "left").select("id", "v", low.alias("low")), "asked")
        if width == 1:
            break
        width = -(-width // BINS)
    best = paired(pack(asked, QUERIES_A_BLOCK, scale), candidates, *sizes).mapInArrow(_winners(k), "query_id long, vec_id long, score long")
    ranked = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Approximate nearest neighbours by largest inner product: a navigable small-world graph per shard, results merged.

Rows are dealt over shards by a hash. Each shard's graph is built in one task and stored as one row of flat arrays: vectors,
ids, and for each layer the neighbours of its nodes, padded with -1. Every row is indexed. Blocks of queries meet every shard,
and the best of all shards are merged and scored again in double precision.

Insertion and search run for a batch of vectors in lockstep: one step expands the best open candidates of each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.blocks import pack, paired, unpack
from trailmark.llm.shared import materialise, valid_vector

ROWS_A_SHARD = 8192
QUERIES_A_BLOCK = 512
#: Neighbours of a node above the lowest layer; twice as many there.
LINKS = 16
EF_BUILD = 64
EF_SEARCH = 128
#: Candidates expanded in a step.
BEAM = 4
INDEX = "shard long, dim int, n int, ids binary, rows binary, starts binary, vectors binary, layers binary, sizes binary"


def search_layer(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ef nodes of a layer nearest to each query found from its entries: (ids, scores), best first, -1 where there are fewer."""
    n_q = len(q)
    width = max(ef, entry.shape[1])
    ids, score = np.full((n_q, width), -1), np.full((n_q, width), -np.inf, np.float32)
    done = np.zeros((n_q, width), bool)
    seen = np.zeros((n_q, len(x) + 1), bool)  # the last column stands for -1
    seen[:, -1] = True
    rows = np.arange(n_q)[:, None]
    ids[:, : entry.shape[1]] = entry
    seen[rows, entry] = True
    score[:, : entry.shape[1]] = np.where(entry >= 0, np.einsum("qed,qd->qe", x[entry], q), -np.inf)
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    live = np.arange(n_q)
    while len(live):
        open_ = ~done[live] & (score[live] > -np.inf)
        open_[:, ef:] = False
        place = np.argsort(~open_, axis=1, kind="stable")[:, :BEAM]
        some = np.take_along_axis(open_, place, 1)
        going = some[:, 0]
        live, place, some = live[going], place[going], some[going]
        if not len(live):
            break
        at = np.arange(len(live))[:, None]
        nodes = np.where(some, ids[live[:, None], place], -1)
        done[live[:, None], place] |= some
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[live[:, None], near]] = -1
        seen[live[:, None], near] = True
        s = np.einsum("qed,qd->qe", x[near], q[live])
        s[near < 0] = -np.inf
        ids2, score2 = np.concatenate([ids[live], near], 1), np.concatenate([score[live], s], 1)
        done2 = np.concatenate([done[live], np.zeros(near.shape, bool)], 1)
        best = np.argsort(-score2, axis=1, kind="stable")[:, :width]
        ids[live], score[live], done[live] = ids2[at, best], score2[at, best], done2[at, best]
    return ids[:, :ef], score[:, :ef]


def diverse(x: np.ndarray, ids: np.ndarray, score: np.ndarray, m: int) -> np.ndarray:
    """Up to m of each row's candidates (best first, -1 padded): those nearer to the node than to any taken before, then the rest."""
    rows, c = ids.shape
    v = x[ids]
    among = v @ v.transpose(0, 2, 1)
    worst = np.full((rows, c), -np.inf, np.float32)  # the nearest taken one's score
    taken, count = np.zeros((rows, c), bool), np.zeros(rows, int)
    for j in range(c):
        take = (ids[:, j] >= 0) & (score[:, j] > worst[:, j]) & (count < m)
        taken[:, j] = take
        count += take
        worst = np.where(take[:, None], np.maximum(worst, among[:, j]), worst)
    first = np.argsort(np.where(taken, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :m]
    return np.take_along_axis(ids, first, 1)


def build(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Neighbour arrays by layer (lowest first) of vectors of equal norm. A node's level is drawn from a seed."""
    n = len(x)
    level = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int), 5)
    order = np.lexsort((np.arange(n), -level))  # the highest first, so that upper layers stand when lower nodes come
    layers = [np.full((n + 1, LINKS * (2 if ell == 0 else 1)), -1) for ell in range(level.max(initial=0) + 1)]
    entry, start = order[:1], 1
    while start < n:
        new = order[start : start + min(512, max(16, start // 2))]
        start += len(new)
        near = np.repeat(entry[None], len(new), 0)
        for ell in range(len(layers) - 1, -1, -1):
            links = layers[ell]
            near, score = search_layer(x, links, x[new], near, EF_BUILD if (level[new] >= ell).any() else 1)
            on = np.flatnonzero(level[new] >= ell)
            if not len(on):
                continue
            nodes = new[on]
            # Peers of the batch are candidates too.
            peers = x[nodes] @ x[nodes].T
            np.fill_diagonal(peers, -np.inf)
            top = np.argsort(-peers, axis=1, kind="stable")[:, :LINKS]
            peer_ids = np.where(np.take_along_axis(peers, top, 1) > -np.inf, nodes[top], -1)
            ids, s = np.concatenate([near[on], peer_ids], 1), np.concatenate([score[on], np.take_along_axis(peers, top, 1)], 1)
            best = np.argsort(-s, axis=1, kind="stable")[:, :EF_BUILD]
            ids, s = np.take_along_axis(ids, best, 1), np.take_along_axis(s, best, 1)
            chosen = diverse(x, ids, s, LINKS)
            links[nodes, : chosen.shape[1]] = chosen
            _link_back(x, links, nodes, chosen)
            near = near[:, : max(1, EF_BUILD // 2)]
    while len(layers) > 1 and (layers[-1] < 0).all():  # a lone node on top leads nowhere
        layers.pop()
    return layers


def _link_back(x: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Add the reverse of each new link; a full node keeps a diverse choice of old and new."""
    to, frm = chosen.ravel(), np.repeat(nodes, chosen.shape[1])
    to, frm = to[to >= 0], frm[to >= 0]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    target, first, n = np.unique(to, return_index=True, return_counts=True)
    m = links.shape[1]
    place = np.arange(len(to)) - np.repeat(first, n)
    for i in range(0, len(target), 1024):
        t, cap = target[i : i + 1024], int(n[i : i + 1024].max())
        in_ = slice(first[i], first[i] + int(n[i : i + 1024].sum()))
        more = np.full((len(t), cap), -1)
        more[np.searchsorted(t, to[in_]), place[in_]] = frm[in_]
        more[(more[:, :, None] == links[t][:, None, :]).any(2)] = -1
        ids = np.concatenate([links[t], more], 1)
        s = np.where(ids >= 0, np.einsum("ted,td->te", x[ids], x[t]), -np.inf)
        best = np.argsort(-s, axis=1, kind="stable")[:, : 2 * m]
        ids, s = np.take_along_axis(ids, best, 1), np.take_along_axis(s, best, 1)
        full = (ids >= 0).sum(1) > m
        links[t[~full]] = ids[~full][:, :m]
        if full.any():
            links[t[full]] = diverse(x, ids[full], s[full], m)


def _index(part: pd.DataFrame) -> pd.DataFrame:
    """One row per vector length in a shard. Equal vectors are one node with several ids, so copies cannot crowd a graph."""
    out = []
    for dim, rows in part.groupby(part["v"].map(len)):
        v, where = np.unique(np.stack(rows["v"].to_numpy()).astype(np.float64), axis=0, return_inverse=True)
        order = np.lexsort((rows["row"].to_numpy(), rows["id"].to_numpy(), where.ravel()))
        starts = np.searchsorted(where.ravel()[order], np.arange(len(v) + 1))
        v = v / np.abs(v).max()  # squares of the largest doubles would not be finite
        square = (v * v).sum(axis=1)
        # One more component makes all norms equal; with 0 there for queries, inner products stay as they are.
        scale = max(float(square.max()) ** 0.5, 1e-300)
        x = np.concatenate([v / scale, np.sqrt(np.maximum(0, 1 - square / scale**2))[:, None]], axis=1).astype(np.float32)
        layers = build(x)
        sizes = np.array([a.shape[1] for a in layers], np.int64)
        flat = np.concatenate([a[:-1].astype(np.int32).ravel() for a in layers])
        out.append((int(rows["shard"].iloc[0]), int(dim), len(v), rows["id"].to_numpy().astype(np.int64)[order].tobytes(), rows["row"].to_numpy().astype(np.int64)[order].tobytes(), starts.astype(np.int64).tobytes(), x.tobytes(), flat.tobytes(), sizes.tobytes()))
    return pd.DataFrame(out, columns=[c.split()[0] for c in INDEX.split(", ")])


def build_index(vectors: DataFrame) -> DataFrame:
    """(id, row, v) of valid, non-zero vectors to one row of flat arrays per shard. All rows are indexed; row numbers are unique."""
    shards = max(1, round(vectors.count() / ROWS_A_SHARD))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_index, INDEX)


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("row", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                g = {n: b.column(i)[r].as_py() for i, n in enumerate(b.schema.names)}
                if g["dim"] != g["q_dim"]:
                    continue
                n, dim = g["n"], g["dim"]
                ids, numbers, starts = (np.frombuffer(g[c], np.int64) for c in ("ids", "rows", "starts"))
                x = np.frombuffer(g["vectors"], np.float32).reshape(n, dim + 1)
                flat, layers, at = np.frombuffer(g["layers"], np.int32), [], 0
                for m in np.frombuffer(g["sizes"], np.int64):
                    layers.append(np.concatenate([flat[at : at + n * m].reshape(n, m), np.full((1, m), -1, np.int32)]))
                    at += n * m
                q_ids, q = unpack(g["q_ids"], g["q_data"], dim)
                q = np.concatenate([q / np.abs(q).max(axis=1, keepdims=True), np.zeros((len(q), 1))], axis=1).astype(np.float32)
                top = np.flatnonzero((layers[-1][:-1] >= 0).any(axis=1))[:1] if n > 1 else np.zeros(1, int)
                near = np.repeat(top[None], len(q), 0)
                for links in layers[:0:-1]:
                    near, _ = search_layer(x, links, q, near, 8)
                near, _ = search_layer(x, layers[0], q, near, max(EF_SEARCH, k + 1))
                # Of each node the k rows with the smallest ids that are not the query's own; then k in all are left.
                a, c = np.nonzero(near >= 0)
                nodes = near[a, c]
                first, last = starts[nodes], starts[nodes + 1]
                own = np.zeros((2, len(nodes)), np.int64)
                for i in np.flatnonzero(last - first > k).tolist():  # nodes of many copies, whose ids are sorted
                    own[:, i] = np.searchsorted(ids[first[i] : last[i]], q_ids[a[i]], "left"), np.searchsorted(ids[first[i] : last[i]], q_ids[a[i]], "right")
                size = np.minimum(last - first - (own[1] - own[0]), k)
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                at = np.repeat(first, size) + place + np.where(place >= np.repeat(own[0], size), np.repeat(own[1] - own[0], size), 0)
                who = np.repeat(a, size)
                other = q_ids[who] != ids[at]
                who, at = who[other], at[other]
                keep = np.arange(len(who)) - np.searchsorted(who, who) < k
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[who[keep]]), pa.array(numbers[at[keep]])], schema=schema)

    return run


def nearest(vectors: DataFrame, k: int, every: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest found of each query: (query_id, rank from 1, vec_id, score), by inner product, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`; candidates are all rows with another id. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows with a null id, take no part; vectors of different length do
    not meet. Equal vectors and rows that repeat an id are all candidates; as a query, the smallest vector of an id counts. A query
    with fewer than k candidates returns what there is. Scores are double sums over the original components, and infinite where
    those pass the doubles.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    v = v.where(F.col("id").isNotNull() & valid_vector(F.col("v"))).where(F.exists("v", lambda x: x != 0))
    v = materialise(v.withColumn("row", F.monotonically_increasing_id()), "vectors")
    index = materialise(build_index(v), "index").withColumn("block", F.col("shard"))
    asked = v.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = materialise(pack(asked.withColumn("low", F.lit(0).cast("long")), QUERIES_A_BLOCK).drop("low"), "queries")
    found = paired(queries, index, max(1, queries.count()), max(1, min(index.count(), every))).mapInArrow(_search(k), "query_id long, row long")
    q, c = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), v.select("row", F.col("id").alias("vec_id"), "v")
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    scored = found.join(c, "row").join(q, "query_id").select("query_id", "vec_id", "row", dot.alias("score"))
    ranked = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "row")
    return scored.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Ranked lexical search by range maxima of posting lists.

Documents lie in shards of bounded size. In a shard each posting list, by document, holds integer impacts and a sparse table of
range maxima. A search begins with the interval of all documents of the shard. The maxima of an item's lists over an interval sum
to a bound of every score in it; the interval of the highest bound is taken first and split at the document of its largest
impact, which is scored, and what is left on both sides goes on if its bound can still reach the k-th best score. A task carries
the best of its shards on from one to the next, so later shards are cut short early. Results are exact.

The items are taken in blocks of bounded bytes: a block's terms are told to all tasks, and all documents are read once a block.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.shared import materialise

#: Bytes of items' texts that are searched for at a time.
ITEM_BYTES = 8 << 20
#: Postings and documents of a shard.
SHARD_POSTINGS, SHARD_DOCS = 1 << 20, 1 << 16
#: Intervals that are split at a time, the highest bounds first.
AT_ONCE = 64
_TERM = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
POSTINGS = "doc long, n long, terms array<int>, tfs array<int>"


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """What a term of weight w adds to the score of a document of n terms that has it tf times; 64-bit integers throughout."""
    m = 100 - 75 + 75 * n * n_docs // max(1, all_terms)
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Shard:
    """Posting lists of one shard, sorted by term and document, with the leftmost place of the maximum of each range of 2^j postings."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        """ids ascend; doc, term and impact are parallel, doc is a place in ids."""
        self.ids, self.width = ids, max(1, len(ids))
        key = term.astype(np.int64) * self.width + doc
        order = np.argsort(key, kind="stable")
        self.key, self.doc, self.impact = key[order], doc[order].astype(np.int64), impact[order]
        self.end = np.searchsorted(self.key, np.arange(1, n_terms + 1, dtype=np.int64) * self.width)
        self.start = np.concatenate([[0], self.end[:-1]])
        longest = int((self.end - self.start).max(initial=0))
        # The last entry stands for no posting.
        self.impact, self.doc = np.append(self.impact, 0), np.append(self.doc, 0)
        levels = [np.arange(len(key), dtype=np.int32)]
        for j in range(1, max(1, longest).bit_length()):
            below, half = levels[-1], 1 << (j - 1)
            left, right = below[: len(below) - half], below[half:]
            best = below.copy()
            best[: len(left)] = np.where(self.impact[left] >= self.impact[right], left, right)  # past a list's end: never asked for
            levels.append(best)
        self.most = np.stack(levels)

    def highest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The posting of the largest impact, the leftmost of equals, in each range from a to b (exclusive); -1 for an empty one."""
        size = b - a
        some = size > 0
        out = np.full(a.shape, -1, np.int64)
        a, b, level = a[some], b[some], np.frexp(size[some].astype(np.float64))[1] - 1
        left, right = self.most[level, a], self.most[level, b - (1 << level)]
        out[some] = np.where(self.impact[left] >= self.impact[right], left, right)
        return out

    def search(self, asked: np.ndarray, times: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
        """best, (-score, id) of the k best so far in order, with the documents of this shard; asked: the item's terms, times: how often each."""
        a, b = self.start[asked][None, :], self.end[asked][None, :]
        top = self.highest(a, b)
        heap: list[tuple[int, int, int]] = []
        held: dict[int, tuple[np.ndarray, ...]] = {}
        base, made = asked.astype(np.int64) * self.width, 0

        def hopeful(bound: int, lo: int) -> bool:
            return bound > 0 and (len(best) < k or (-bound, int(self.ids[lo])) < best[-1])

        def push(lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray, top: np.ndarray) -> None:
            nonlocal made
            bound = (self.impact[top] * times).sum(axis=1)
            for i in np.flatnonzero((hi > lo) & (bound > (-best[-1][0] - 1 if len(best) == k else 0))).tolist():
                at, value = int(lo[i]), int(bound[i])
                if hopeful(value, at):
                    made += 1
                    heapq.heappush(heap, (-value, at, made))
                    held[made] = at, hi[i], a[i], b[i], top[i]

        push(np.array([0]), np.array([len(self.ids)]), a, b, top)
        while heap:
            taken = []
            while heap and len(taken) < AT_ONCE:
                bound, at, which = heapq.heappop(heap)
                if hopeful(-bound, at):
                    taken.append(held.pop(which))
            if not taken:
                break
            lo, hi, a, b, top = (np.array(x) for x in zip(*taken, strict=True))
            # Each interval is split at the document of its largest impact.
            split = self.doc[top[np.arange(len(top)), (self.impact[top] * times).argmax(axis=1)]]
            key = base[None, :] + split[:, None]
            at = np.searchsorted(self.key, key)
            there = at < b
            there[there] = self.key[at[there]] == key[there]
            score = (self.impact[np.where(there, at, -1)] * times).sum(axis=1)
            for value, d in zip(score.tolist(), split.tolist(), strict=True):
                found = (-value, int(self.ids[d]))
                if value > 0 and (len(best) < k or found < best[-1]):
                    best.append(found)
                    best.sort()
                    del best[k:]
            push(lo, split, a, at, self.highest(a, at))
            push(split + 1, hi, at + there, b, self.highest(at + there, b))
        return best


@dataclass
class Asked:
    """A block of items: the terms and their counts of each, and what the corpus says of the terms."""

    ids: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    weights: np.ndarray
    n_docs: int
    all_terms: int


def _postings(told: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = told.value
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                sizes, found = [], []
                for t in part.column(1):
                    words = terms(t.as_py())
                    sizes.append(len(words))
                    counts = Counter(map(number.get, words))
                    counts.pop(None, None)
                    found.append(counts)
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "terms", "tfs"])

    return run


def _searched(told: Broadcast, k: int):
    schema = pa.schema([("item", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Asked = told.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked.ids]

        def take(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held)
            rows = rows.sort_by("doc").combine_chunks()
            ids, n = rows["doc"].to_numpy(), rows["n"].to_numpy()
            lists, tfs = rows["terms"].combine_chunks(), rows["tfs"].combine_chunks()
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            shard = Shard(ids, doc, term, impacts(asked.weights[term], tf, n[doc], asked.n_docs, asked.all_terms), len(asked.weights))
            for i, (t, times) in enumerate(zip(asked.terms, asked.times, strict=True)):
                best[i] = shard.search(t, times, best[i], k)

        held, size, docs = [], 0, 0
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                held.append(part)
                size, docs = size + len(part.column(2).flatten()), docs + part.num_rows
                if size >= SHARD_POSTINGS or docs >= SHARD_DOCS:
                    take(held)
                    held, size, docs = [], 0, 0
        if held:
            take(held)
        rows = [(i, d, -s) for i, found in enumerate(best) for s, d in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(schema)], schema=schema)

    return run


def _block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """(item_id, doc_id, score) of the k best of each task for the items of one block, written; None if the items have no terms."""
    sc = docs.sparkSession.sparkContext
    got = [(r[0], Counter(terms(r[1]))) for r in items.collect()]
    number = {w: i for i, w in enumerate(dict.fromkeys(w for _, c in got for w in c))}
    if not number:
        return None
    vocabulary = sc.broadcast(number)
    postings = materialise(docs.mapInArrow(_postings(vocabulary), POSTINGS).where("n > 0"), "postings")
    vocabulary.destroy()
    total = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    weights = np.zeros(len(number), np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
        weights[r["term"]] = weight(total["docs"], r["count"])
    asked = Asked([i for i, _ in got], [np.array([number[w] for w in c], np.int64) for _, c in got], [np.array(list(c.values()), np.int64) for _, c in got], weights, total["docs"], total["terms"] or 0)
    told = sc.broadcast(asked)
    found = postings.where("doc is not null and size(terms) > 0").mapInArrow(_searched(told, k), "item int, doc long, score long")
    ids = docs.sparkSession.createDataFrame(list(enumerate(asked.ids)), f"item int, item_id {items.schema[0].dataType.simpleString()}")
    found = materialise(found.join(F.broadcast(ids), "item").select("item_id", F.col("doc").alias("doc_id"), "score"), "found")
    told.destroy()
    return found


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The k documents of the highest score above 0 for each item: (item_id, rank from 1, doc_id, score), equal scores by ascending id.

    A term weighs floor(1000 ln((2N + 2) / (2df + 1))), and a document's score sums weight * (10^9 tf div (1000 tf + 8m)) over the
    item's terms, repeats included, with m = 25 + 75 * n * N div L. N, L and df are of all rows with a term; null and empty texts
    have none. Rows that repeat an id are documents each; rows without an id count in N, L and df but are not ranked. Of items
    that repeat an id the largest text counts; a null id is an item. Ids of documents are integers. Texts are taken whole; empty
    tables give an empty result.
    """
    items = items.groupBy(F.col(item_col).alias("item_id")).agg(F.max(item_text_col).alias("text")).where(F.length("text") > 0)
    items = materialise(items, "items")
    blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes)
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    found = None
    for i in range(blocks):
        part = _block(docs, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i), k)
        found = part if found is None or part is None else found.unionByName(part)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    ranked = W.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")

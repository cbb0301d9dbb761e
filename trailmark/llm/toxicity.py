"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors over all their words that any example has: (1 + ln tf) * idf, idf over all documents. A word that leans to
toxic examples weighs more, by a smooth function of its likelihood ratio (`lean`); no word is left out. Examples lie in an inverted
index whose postings are cut into blocks of examples, each with its largest weight. A search takes the blocks by the largest
cosine that these maxima allow and stops where no block can hold a nearer example, so its neighbours are exact. Distance-weighted
votes of the nearest examples, calibrated on votes that leave an example itself out, give the score; the examples are the
evidence.

The fit takes at most EXAMPLES labelled rows of each class with at most EXAMPLE_BYTES of text, picked by a hash of the id: that
bounds the vocabulary, the index and what is broadcast. Document frequencies are counted over all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.shared import let_go, materialise

#: Bounds of the fit, for each class.
EXAMPLES, EXAMPLE_BYTES = 6000, 64 << 20
#: A word that surely leans to toxic weighs 1 + LEAN times its idf; a likelihood ratio of DOUBT is half sure.
LEAN, DOUBT = 8.0, 8.0
#: Examples a block, and blocks that a search takes before it asks which others may hold a nearer example.
BLOCK, FIRST = 64, 16
#: A word that more than one in DENSE examples has is a dense column. Texts are searched for SEARCHES at a time.
DENSE, SEARCHES = 16, 256
NEIGHBOURS = 16
#: Weight of the prior in a vote.
PRIOR_WEIGHT = 0.05
THRESHOLD = 0.3
BINS = 50
#: Words whose numbers a worker remembers; most words of a text are among the first that it meets.
CACHED = 50_000
#: Examples by whose nearness the others are ordered, so that blocks hold examples that are alike.
PIVOTS = 16
_words = re.compile(r"[^\W_]+").findall


def words(text: str | None) -> Counter:
    return Counter(_words((text or "").lower()))


class Vocabulary:
    """The words of the examples as sorted 64-bit hashes: eight bytes a word in every worker. Words that share a hash are one word."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def __len__(self) -> int:
        return len(self.hashes)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of the known words of a text."""
        found = words(text)
        at = self.numbers_of(found)
        return at[at >= 0], np.fromiter(found.values(), float, len(found))[at >= 0]

    def numbers_of(self, found: Collection[str]) -> np.ndarray:
        """The number of each word, -1 for one that no example has. A worker remembers the first CACHED words it has looked up."""
        out = np.fromiter(map(self.seen.get, found, repeat(-2)), np.int64, len(found))
        new = np.flatnonzero(out == -2)
        if len(new):
            listed = list(found)
            asked = [listed[i] for i in new.tolist()]
            out[new] = self._looked_up(asked)
            if len(self.seen) < CACHED:
                self.seen.update(zip(asked, out[new].tolist(), strict=True))
        return out

    @cached_property
    def seen(self) -> dict[str, int]:
        return {}

    def _looked_up(self, asked: list[str]) -> np.ndarray:
        hashes = hashes_of(asked)
        if not len(self):
            return np.full(len(asked), -1, np.int64)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)

    def __reduce__(self):
        return Vocabulary, (self.hashes,)


def hashes_of(found: Collection[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


@dataclass
class Index:
    """Postings sorted by word, then example, in cells: what a word has in one block of examples, with the largest weight there.

    Words that many examples have are kept as dense columns by block; that is the same index, added up by matrix products.
    """

    n: int
    sizes: np.ndarray  # postings of each word
    example: np.ndarray
    weight: np.ndarray

    def __post_init__(self) -> None:
        self.blocks = -(-self.n // BLOCK)
        self.start = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])
        often = np.flatnonzero(self.sizes * DENSE > self.n)
        self.head = np.full(len(self.sizes), -1, np.int32)
        self.head[often] = np.arange(len(often))
        heads = np.zeros((self.blocks, len(often), BLOCK), self.weight.dtype)  # as wide as the postings; products are of doubles
        post = _ranges(self.start[often], self.sizes[often])
        heads[self.example[post] // BLOCK, np.repeat(np.arange(len(often)), self.sizes[often]), self.example[post] % BLOCK] = self.weight[post]
        self.heads, self.head_best = heads, np.ascontiguousarray(heads.max(axis=2).T, float) if self.n else np.zeros((0, 0))
        block = self.example // BLOCK
        fresh = np.ones(len(block), bool)
        fresh[1:] = block[1:] != block[:-1]
        fresh[self.start[:-1][self.sizes > 0]] = True
        first = np.flatnonzero(fresh)
        self.cell_block = block[first]
        self.cell_best = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.cell_start = np.searchsorted(first, self.start)

    @staticmethod
    def of(n: int, n_words: int, row: np.ndarray, word: np.ndarray, weight: np.ndarray) -> Index:
        order = np.argsort(word.astype(np.int64) << 32 | row, kind="stable")
        return Index(n, np.bincount(word, minlength=n_words).astype(np.int32), row[order].astype(np.int32), weight[order].astype(np.float32))

    def __reduce__(self):
        # Only the postings travel; what is made from them is made again.
        return Index, (self.n, self.sizes, self.example, self.weight)

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and cosines of the k examples nearest to each normed vector (words, weights): exact, nearest first, ties to the earlier row."""
        m, n = len(vectors), self.blocks * BLOCK
        heads = np.zeros((m, len(self.head_best)))
        bound, sums = np.zeros((m, self.blocks)), np.zeros((m, n))
        for i, (at, q) in enumerate(vectors):
            head = self.head[at]
            rare = head < 0
            heads[i, head[~rare]] = q[~rare]
            at, q = at[rare], q[rare]
            size = self.cell_start[at + 1] - self.cell_start[at]
            cell = _ranges(self.cell_start[at], size)
            bound[i] = np.bincount(self.cell_block[cell], np.repeat(q, size) * self.cell_best[cell], self.blocks)
            size = self.sizes[at]
            post = _ranges(self.start[at], size)
            sums[i] = np.bincount(self.example[post], np.repeat(q, size) * self.weight[post], n)
        bound += heads @ self.head_best
        sums = sums.reshape(m, self.blocks, BLOCK)
        # The most promising blocks first; what they give leaves few others that may hold a nearer example.
        order = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        first, kth, whole = np.zeros((m, self.blocks), bool), np.zeros((m, 1)), np.zeros((m, self.blocks), bool)
        np.put_along_axis(first, order, True, 1)
        for now in (first, ~first):
            now &= (bound >= kth - 1e-9) & (bound > 0)
            for b in np.flatnonzero(now.any(axis=0)).tolist():
                some = np.flatnonzero(now[:, b])
                sums[some, b] += heads[some] @ self.heads[b]
            whole |= now
            if now is first and order.shape[1] * BLOCK > k:
                lead = sums[np.arange(m)[:, None], order].reshape(m, -1)
                kth = np.partition(lead, lead.shape[1] - k, axis=1)[:, lead.shape[1] - k, None]
        sums[~whole] = 0.0
        sums = sums.reshape(m, n)
        who, row = np.nonzero((sums >= kth - 1e-9) & (sums > 0))
        value = sums[who, row].round(12)  # which texts are searched for together must not show
        by = np.lexsort((row, -value, who))
        who, row, value = who[by], row[by], value[by]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        cut = np.searchsorted(who[place < k], np.arange(1, m))
        return list(zip(np.split(row[place < k], cut), np.split(value[place < k], cut), strict=True))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    end = np.cumsum(size)
    out = np.repeat(start - end + size, size)
    out += np.arange(len(out), dtype=out.dtype)
    return out


def lean(d0: np.ndarray, d1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """How much more than others the words weigh that d0 clean and d1 toxic examples have: 1 to 1 + LEAN."""
    n, x = max(1, n0 + n1), d0 + d1
    part = lambda o, e: np.where(o > 0, o * np.log(np.maximum(o, 1) / np.maximum(e, 1e-9)), 0.0)
    ratio = np.maximum(0.0, 2 * (part(d1, x * n1 / n) + part(d0, x * n0 / n)))
    toxic = (d1 + 0.5) * (n0 + 1) > (d0 + 0.5) * (n1 + 1)
    return 1 + LEAN * np.where(toxic, ratio / (ratio + DOUBT), 0.0)


@dataclass
class Model:
    """What a fit gives; its size is bounded by the words of the examples."""

    vocabulary: Vocabulary
    idf: np.ndarray
    d0: np.ndarray  # clean and toxic examples that have each word
    d1: np.ndarray
    ids: list
    toxic: np.ndarray
    index: Index
    class_weight: tuple[float, float]
    silent: float  # the score of texts without any known word
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    levels: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def __post_init__(self) -> None:
        self.n1 = int(self.toxic.sum())
        self.n0 = len(self.toxic) - self.n1
        self.worth = self.idf * lean(self.d0, self.d1, self.n0, self.n1)

    def vector(self, at: np.ndarray, tf: np.ndarray, own: bool | None = None) -> np.ndarray:
        """The normed vector of a text; own: the class of an example whose share in its words' leaning is left out."""
        worth = self.worth[at] if own is None else self.idf[at] * lean(self.d0[at] - (not own), self.d1[at] - own, self.n0 - (not own), self.n1 - own)
        w = (1 + np.log(tf)) * worth
        return w / max(1e-300, np.sqrt(w @ w))

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave_out: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each vector the share of the nearest examples' weight that is toxic, and those examples with their cosines."""
        out = []
        for i, (rows, near) in enumerate(self.index.nearest(vectors, NEIGHBOURS + (leave_out is not None)) if vectors else []):
            if leave_out is not None:
                other = rows != leave_out[i]
                rows, near = rows[other][:NEIGHBOURS], near[other][:NEIGHBOURS]
            y = self.toxic[rows]
            w = near**2 * np.where(y, self.class_weight[1], self.class_weight[0])
            out.append((round(float((w @ y + PRIOR_WEIGHT * self.silent) / (w.sum() + PRIOR_WEIGHT)), 9), rows, near))
        return out

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[float], list[np.ndarray], list[np.ndarray]]:
        """Scores of texts given as numbers and counts of their known words, and the rows and cosines of their nearest examples."""
        none = np.empty(0, np.int64), np.empty(0)
        out = [(self.silent, *none)] * len(found)
        asked = [i for i, (at, _) in enumerate(found) if len(at)]
        for i, (vote, rows, near) in zip(asked, self.votes([(found[i][0], self.vector(*found[i])) for i in asked]), strict=True):
            out[i] = float(np.interp(vote, self.knots, self.levels)), rows, near
        return tuple(map(list, zip(*out, strict=True))) if out else ([], [], [])


def isotonic(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing levels, by pooling neighbours."""
    pools: list[list[float]] = []
    for value, weight in zip(y, w, strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.array([p[0] for p in pools for _ in range(int(p[2]))])


def held_out(id_: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(True))


def _examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """(id, y, text) of the examples, and the labelled rows of each class. Copies of a text are one example, toxic if any is."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = materialise(known.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y")), "labels")
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # At most EXAMPLES ids of each class, so the chosen ids may be broadcast at any size of the labels.
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES) for y in (0, 1)]
    picked = materialise(picked[0].unionByName(picked[1]), "picked")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), "id")
    rows = rows.groupBy("id", "y").agg(F.max("text").alias("text"))
    rows = materialise(rows.groupBy(F.sha2("text", 256).alias("copy")).agg(F.min("id").alias("id"), F.max("y").alias("y"), F.first("text").alias("text")).drop("copy"), "examples")
    rows = rows.where(F.octet_length("text") <= EXAMPLE_BYTES)  # a text beyond the bound keeps no other one out
    upto = F.sum(F.octet_length("text")).over(W.partitionBy("y").orderBy(F.xxhash64("id"), "id"))
    fits = rows.select("id", "y", upto.alias("upto")).where(F.col("upto") <= EXAMPLE_BYTES).select("id")
    return materialise(rows.join(F.broadcast(fits), "id"), "examples"), totals


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled rows of docs that are not held out.

    Conflicting labels of an id count as toxic, and so do copies of a text if one is toxic. Labels without a document, null labels
    and null ids teach nothing; of rows that repeat an id, the largest text counts.
    """
    spark = docs.sparkSession
    examples, totals = _examples(docs, labels, id_col, text_col, label_col)
    hashes = examples.select("text").mapInArrow(_distinct, "word long").distinct().toArrow().column(0).to_numpy()
    vocabulary = Vocabulary(np.sort(hashes.view(np.uint64)))
    told = spark.sparkContext.broadcast(vocabulary)

    counted = docs.select(text_col).mapInArrow(_frequencies(told), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    at, n = counted.column(0).to_numpy(), counted.column(1).to_numpy()
    n_docs, df = int(n[at < 0].sum()), np.zeros(len(vocabulary))
    df[at[at >= 0]] = n[at >= 0]
    idf = np.log((n_docs + 1) / (df + 1)) + 1e-3

    id_type = examples.schema["id"].dataType
    kept = T.StructType([T.StructField("id", id_type), T.StructField("y", T.IntegerType()), T.StructField("at", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.DoubleType()))])
    vectors = materialise(examples.select("id", "y", "text").mapInArrow(_vectors(told), kept), "vectors")
    got = vectors.select("id", "y", F.col("at").cast("array<int>").alias("at"), F.col("tf").cast("array<float>").alias("tf")).toArrow().sort_by("id")
    told.destroy()
    ids, y = got["id"].to_pylist(), np.array(got["y"].to_pylist(), bool)
    n_words = np.array([len(x) for x in got["at"]], np.int64)
    word, tf = (got[c].combine_chunks().flatten().to_numpy() if len(ids) else np.empty(0) for c in ("at", "tf"))
    del got
    n0, n1 = int((~y).sum()), int(y.sum())
    class_weight = (totals.get(0, 0) / n0 if n0 else 1.0, totals.get(1, 0) / n1 if n1 else 1.0)
    silent = [class_weight[c] * int(((y == bool(c)) & (n_words == 0)).sum()) for c in (0, 1)]
    row = np.repeat(np.arange(len(ids), dtype=np.int32), n_words)
    word = word.astype(np.int32)
    d = [np.bincount(word[y[row] == bool(c)], minlength=len(vocabulary)).astype(np.int32) for c in (0, 1)]
    weight = ((1 + np.log(tf)) * (idf * lean(*d, n0, n1))[word]).astype(np.float32)
    weight /= np.maximum(1e-30, np.sqrt(np.bincount(row, weight.astype(float) ** 2, len(ids))))[row].astype(np.float32)
    order = _alike(len(ids), len(vocabulary), row, word, weight)
    place = np.empty(len(ids), np.int32)
    place[order] = np.arange(len(ids))
    index = Index.of(len(ids), len(vocabulary), place[row], word, weight)
    model = Model(vocabulary, idf, *d, [ids[i] for i in order], y[order], index, class_weight, (silent[1] + 0.5) / (sum(silent) + 10))
    del row, word, weight, tf
    if len(ids):
        _calibrate(model, vectors)
    return model


def _alike(n: int, n_words: int, row: np.ndarray, word: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """An order of the examples by the nearest of PIVOTS of them."""
    pivots = np.unique(np.linspace(0, max(0, n - 1), PIVOTS).astype(int))
    near, best = np.zeros(n, np.int32), np.full(n, -1.0)
    for i, p in enumerate(pivots if n else []):
        own = row == p
        of = np.zeros(n_words, np.float32)
        of[word[own]] = weight[own]
        cosine = np.bincount(row, of[word] * weight, n)
        near, best = np.where(cosine > best, i, near), np.maximum(cosine, best)
    return np.lexsort((np.arange(n), np.bincount(row, minlength=n), near))


def _calibrate(model: Model, vectors: DataFrame) -> None:
    """Levels of the votes that leave an example itself out, in bins, made non-decreasing."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = shared.value
        place = {id_: i for i, id_ in enumerate(model.ids)}
        for b in batches:
            for i in range(0, b.num_rows, SEARCHES):
                rows = [r for r in zip(*(b.column(c)[i : i + SEARCHES].to_pylist() for c in range(4)), strict=True) if r[2]]
                asked = [(np.array(at), model.vector(np.array(at), np.array(tf), bool(y))) for _, y, at, tf in rows]
                votes = [v for v, _, _ in model.votes(asked, [place[r[0]] for r in rows])]
                yield pa.RecordBatch.from_arrays([pa.array([min(BINS - 1, int(v * BINS)) for v in votes], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array(votes, pa.float64())], names=["bin", "y", "vote"])

    dealt = vectors.repartition(max(1, len(model.ids) // 500))
    got = dealt.mapInArrow(run, "bin int, y int, vote double").groupBy("bin").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"), F.avg("vote").alias("at")).orderBy("bin").collect()
    shared.destroy()
    if got:
        w = np.array([[g["n0"] * model.class_weight[0], g["n1"] * model.class_weight[1]] for g in got])
        level = isotonic((w[:, 1] + 0.5 * model.silent) / (w.sum(axis=1) + 0.5), w.sum(axis=1))
        model.knots, model.levels = np.array([0.0, *[g["at"] for g in got], 1.0]), np.array([min(model.silent, level[0]), *level, max(level[-1], 0.999)])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for b in batches:
        for i in range(0, b.num_rows, 256):
            found = set().union(*(words(t.as_py()) for t in b.column(0)[i : i + 256]))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes_of(found)).view(np.int64))], names=["word"])


def _frequencies(told: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        vocabulary, total = told.value, 0
        df = np.zeros(len(vocabulary) + 1, np.int64)  # the last place stands for -1
        for b in batches:
            total += b.num_rows
            for text in b.column(0):
                df[np.unique(vocabulary.numbers_of(set(_words((text.as_py() or "").lower()))))] += 1
        word = np.flatnonzero(df[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], word]), pa.int32()), pa.array(np.concatenate([[total], df[word]]), pa.int64())], names=["word", "n"])

    return run


def _vectors(told: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                got = [told.value.of(t.as_py()) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *[pa.array([g[j] for g in got], t) for j, t in enumerate((pa.list_(pa.int64()), pa.list_(pa.float64())))]], names=["id", "y", "at", "tf"])

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", evidence_col: str = "evidence") -> DataFrame:
    """docs with score_col (0 to 1) and evidence_col (the nearest examples with their cosines); columns of these names are replaced.

    Only the text is an input. Null and empty texts, and texts without a known word, have the score of such examples and no
    evidence. Repeated rows score alike. Without any labels no word is known and all texts have the same low score. Texts are taken
    whole; an empty table gives an empty result.
    """
    docs = docs.drop(score_col, evidence_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    ids = pa.array(model.ids) if model.ids else pa.array([], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = shared.value
        for b in batches:
            for i in range(0, b.num_rows, SEARCHES):
                part = b.slice(i, SEARCHES)
                scores, rows, near = model.scores([model.vocabulary.of(t.as_py()) for t in part.column(at)])
                flat = np.concatenate(rows)
                found = pa.StructArray.from_arrays([ids.take(pa.array(flat)), pa.array(np.concatenate(near)), pa.array(model.toxic[flat])], names=["example_id", "similarity", "toxic"])
                starts = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rows])]), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.ListArray.from_arrays(starts, found)], names=[*b.schema.names, score_col, evidence_col])

    near = T.StructType().add("example_id", T.StringType() if pa.types.is_string(ids.type) else T.LongType()).add("similarity", T.DoubleType()).add("toxic", T.BooleanType())
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()), T.StructField(evidence_col, T.ArrayType(near))]))

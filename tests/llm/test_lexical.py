"""Ranked lexical search against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import lexical, queries, sql

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """The contract over all pairs: (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, c, _ in bags for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in bags:
            m = 100 - 75 + 75 * n * n_docs // total
            s = sum(lexical.weight(n_docs, df[w]) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if w in c)
            if s > 0 and i is not None:
                found.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=lambda x: (x[0] is not None, x))


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = ["The", "a", "of", "É", "straße", "x9"] + [f"w{i}" for i in range(60)]
    make = lambda most: " ".join(rng.choice(vocab[: rng.choice([6, 20, 66])]) + rng.choice(["", ".", ",\n", "-"]) for _ in range(rng.randrange(most)))
    docs = [(i, make(80)) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]  # copies, which tie
    docs += [(2000, None), (2001, ""), (2002, " .,-"), (5, "w1 w2 the"), (5, "w1 w2 the"), (None, "w1 w3 the of"), (2003, "the w5 " * 5000)]
    rng.shuffle(docs)
    items = [(i, make(40)) for i in range(12)] + [(50, docs[3][1]), (51, "the the THE of w1 w1"), (52, "nowhere"), (53, None), (54, "!!"), (None, "w4 w5 straße")]
    return docs, items


@pytest.mark.parametrize("seed,postings,at_once,item_bytes", [(1, 1 << 20, 64, 8 << 20), (2, 500, 1, 300), (3, 60, 3, 8 << 20)])
def test_matches_brute_force(spark, monkeypatch, seed, postings, at_once, item_bytes):
    """Many small shards, single splits and several blocks of items change nothing."""
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(lexical, "AT_ONCE", at_once)
    docs, items = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("score", F.lit("clash")).withColumn("n", F.lit(None))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = lexical.search(frame, asked, k=7, item_bytes=item_bytes).collect()
    assert sorted(map(tuple, got), key=lambda x: (x[0] is not None, x)) == brute(docs, items, 7)


def test_range_maxima():
    rng = np.random.default_rng(4)
    doc, term = np.nonzero(rng.random((300, 9)) < 0.4)
    shard = lexical.Shard(np.arange(300), doc, term, rng.integers(1, 6, len(doc)), 9)
    for _ in range(300):
        t = rng.integers(9)
        a, b = np.sort(rng.integers(shard.start[t], shard.end[t] + 1, 2))
        got = int(shard.highest(np.array([a]), np.array([b]))[0])
        assert got == (-1 if a == b else a + int(shard.impact[a:b].argmax()))


def test_search_leaves_intervals_out():
    """A search scores few documents where one stands out."""
    rng = np.random.default_rng(5)
    doc, term = np.nonzero(rng.random((5000, 4)) < 0.5)
    impact = rng.integers(1, 100, len(doc))
    impact[doc == 77] = 10_000
    seen = []

    class Watched(lexical.Shard):
        def highest(self, a, b):
            seen.append(len(a))
            return super().highest(a, b)

    best = Watched(np.arange(5000), doc, term, impact, 4).search(np.arange(4), np.ones(4, np.int64), [], 1)
    assert best[0][1] == 77 and sum(seen) < 20


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).schema.names == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == [(1, 1, 1, lexical.weight(1, 1) * (1_000_000_000 // (1000 + 8 * 100)))]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(sql.OP13)
    names = [c[0] for c in want.description]
    got = queries.op13_lexical(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())

"""Phrase collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import collocations, queries, sql

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, listed):
    """The contract, read word for word: (lang, rank, phrase, a, l, r, n, score)."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, w[i : i + m]) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inner = {}
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner[lang, w[i : i + m]] = max(a, inner.get((lang, w[i : i + m]), 0))
    out = {}
    for (lang, w), a in cand.items():
        if 100 * inner.get((lang, w), 0) >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:listed], 1))


def corpus(seed, docs=160):
    rng = random.Random(seed)
    words = ["New", "york", "é", "of", "the", "a\x0bb", "state", "x\x1fy", "ÀB", "the", "of"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n"]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "en", "en", None, "de"])))
    return [*rows, (None, None, "en"), (None, "", None), (5, "the state of new york", "en"), (5, "the state of new york", "en"), (6, " \t. ,", "zz")]


@pytest.mark.parametrize("seed,bits,chunk,sample", [(1, 1 << 16, 4 << 20, 8), (2, 1 << 6, 97, 3), (3, 1 << 20, 40, 40)])
def test_matches_brute_force(spark, monkeypatch, seed, bits, chunk, sample):
    """A nearly full bitmap, texts cut into many parts, and a sample that misses most phrases change nothing."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("n", F.lit("clash")).withColumn("words", F.lit(1)).withColumn("rank", F.lit(None))
    got = collocations.collocations(docs, 9, 12, sample=sample, bits=bits).collect()
    want = brute(rows, 12, 9)
    assert sorted(map(tuple, got)) == want and {w[0] for w in want} >= {"en", "und"}


def test_border_failures_are_mended(spark):
    """Nothing of a sample's documents is frequent elsewhere, so every long phrase must come through the expansion passes."""
    rows = [(i, "one two three four five six", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    part = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1000)).alias("p")).where("p = 0")
    assert part.isEmpty()
    found = collocations.frequent_phrases(docs, 30, sample=1000, bits=1 << 20)
    assert sorted((r["phrase"], r["f"]) for r in found.where("words = 4").collect()) == [("one two three four", 40), ("three four five six", 40), ("two three four five", 40)]
    assert found.count() == 6 + 5 + 4 + 3 + 1 and found.where("words = 0").first()["f"] == 240


def test_phrases_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_mixed", lambda x: x % np.uint64(7))
    rows = corpus(5, 60)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), 50, 12, sample=2, bits=1 << 16).collect()
    assert sorted(map(tuple, got)) == brute(rows, 12, 50)


def test_very_long_text_and_empty_table(spark):
    text = "alpha beta gamma. " * 60_000 + "x" * 100_000
    docs = spark.createDataFrame([(1, text, "en")], SCHEMA)
    got = collocations.collocations(docs, sample=2, bits=1 << 16).collect()
    assert sorted(map(tuple, got)) == brute([(1, text, "en")], 30, 2000)
    assert collocations.collocations(docs.limit(0), bits=1 << 16).count() == 0


def test_counts_past_64_bits(spark):
    """Products of counts are exact beyond 2^63."""
    big = 9_000_000_000_000_000_000
    found = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 7), ("en", "c", 1, big), ("en", "a b", 2, big // 3), ("en", "b c", 2, big // 3 - 1), ("en", "a b c", 3, big // 4)], "lang string, phrase string, words tinyint, f long")
    got = {r["phrase"]: r for r in collocations.scored(found).collect()}
    assert got["a b"]["score"] == 2_000_000 * (big // 3) // (2 * big - 7)
    assert set(got) == {"a b", "b c", "a b c"} and (100 * (big // 4) >= 80 * (big // 3)) is False


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(sql.OP11)
    names = [c[0] for c in want.description]
    got = queries.op11_collocations(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())

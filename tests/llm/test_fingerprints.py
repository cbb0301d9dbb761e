"""Document fingerprints, their neighbours and edited texts against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import fingerprints as fps
from trailmark.llm import queries


def brute(rows):
    """(id, n_chars, sha of the edited text, fingerprints, likenesses) of rows of (id, text) with ids."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = (fps.fingerprint(x) for x in (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:032x}", f"{b:032x}", fps.likeness(a, b), fps.likeness(a, c)))
    return sorted(out)


def near(prints, radius):
    return [sum((a ^ b).bit_count() <= radius for b in prints) - 1 for a in prints]


def texts(seed, n=150):
    rng = random.Random(seed)
    words = [f"wört{i}" for i in range(300)]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))) for i in range(n)]
    base = " ".join(rng.choice(words) for _ in range(400))
    rows += [(1000 + i, base + rng.choice(["", " x", " y", " z z"])) for i in range(40)]
    return [*rows, (2000, None), (2001, ""), (2002, "one"), (2003, " \n"), (7, "same id, first"), (7, "same id, second"), (2004, "long " * 50_000 + "end"), (2005, "😀é" * 9)]


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 1)])
def test_matches_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(fps, "HOT_KEY", hot)
    rows = texts(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("w0", F.lit("clash")).withColumn("place", F.lit(1))
    got = fps.report(docs)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute(rows)
    prints = {(i, t or ""): fps.fingerprint(t) for i, t in rows}
    want = sorted(zip([i for i, _ in prints], near(list(prints.values()), fps.RADIUS), strict=True))
    assert sorted(map(tuple, got.select("doc_id", "n_near").collect())) == want and max(n for _, n in want) >= 39


@pytest.mark.parametrize("hot", [256, 3])
def test_tables_find_every_pair_within_the_radius(spark, monkeypatch, hot):
    """Fingerprints around few centres, many of which share keys."""
    monkeypatch.setattr(fps, "HOT_KEY", hot)
    rng = random.Random(hot)
    prints = set()
    for centre in (0, (1 << 128) - 1, *(rng.getrandbits(128) for _ in range(6))):
        for flips in range(7):
            for _ in range(9):
                x = centre
                for bit in rng.sample(range(128), flips):
                    x ^= 1 << bit
                prints.add(x)
    prints = sorted(prints)
    frame = spark.createDataFrame([fps.halves(p) for p in prints], "w0 long, w1 long")
    whole = lambda a, b: (a % (1 << 64)) << 64 | b % (1 << 64)
    for radius in (0, 2, 4):
        got = [tuple(sorted((whole(r[0], r[1]), whole(r[2], r[3])))) + (r[4],) for r in fps.within(frame, radius).collect()]
        want = [(a, b, (a ^ b).bit_count()) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= radius]
        assert sorted(got) == want
    with pytest.raises(ValueError):
        fps.within(frame, 5)


def test_odd_input(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, None), (4, "x y z w")], "doc_id long, text string")
    got = {r["n_chars"]: r for r in fps.report(docs).collect() if r["doc_id"] is None}
    assert got[7]["near_edited"] == 1.0 and got[7]["near_next"] is None and got[7]["edited_sha256"] == hashlib.sha256(b"a b c d").hexdigest() and 0 in got
    alone = fps.report(docs.where("doc_id = 4")).collect()
    assert [(r["doc_id"], r["near_next"], r["edited_sha256"], r["n_near"]) for r in alone] == [(4, 1.0, hashlib.sha256(b"x y x y").hexdigest(), 0)]
    assert fps.report(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "k l m")] * 5, "doc_id long, text string")
    assert [(r["n_near"], r["near_next"]) for r in fps.report(same).collect()] == [(4, 1.0)] * 5


def test_fingerprints_tell_edited_texts_from_others(spark):
    """Half a text is nearer than another text."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 5000, 300))) for i in range(100)]
    got = fps.edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.97


def test_query_is_whole(spark):
    got = queries.op12_fingerprints(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == brute(rows)

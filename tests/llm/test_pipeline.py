"""Pipeline stages on odd input: nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trailmark.llm import mixing, simhash, similar

CLASHES = ["size", "source_size", "target", "copies", "score", "evidence", "_copy", "_id", "_n", "_c", "_row", "_spans", "_kept", "component", "fp", "id", "row", "least", "seed", "times"]


def odd_docs(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, words, "a"), (2, words + " x", "a"), (3, None, "a"), (4, "", None), (5, words.upper() + "!", "b"), (5, "quite another text of this id number five", "b"), (7, words, "b"), (None, "first text without an id, mail me@x.example now", None), (None, "second text without an id of its own here", "c"), (8, long, "c"), (8, long, "c"), (9, "   ", "c")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    return docs.withColumn("extra", F.create_map(F.lit("k"), F.lit(1)))


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory, spark):
    where = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, 0), (2, 0), (7, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_leave_the_callers_columns_alone(spark, sf_dir, name, stage):
    docs = odd_docs(spark)
    out = stage(spark, docs, sf_dir)
    if name == "tokens":
        assert out.count() == docs.count() and out.where("doc_id = 3").first()["n_tokens"] == 0
        return
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [(f.name, f.dataType.simpleString()) for f in docs.schema]
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASHES) and all(r["extra"] == {"k": 1} for r in rows)
    if name != "tokens":
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_duplicates_lose_no_text(spark, sf_dir):
    kept = sorted(((r["doc_id"] or 0, (r["text"] or "")[:12]) for r in corpus_pipeline.drop_near_duplicates(spark, odd_docs(spark), sf_dir).collect()))
    # One of the wordless 3, 4 and 9; 1 for its copies; both texts without an id; the other text of 5; one of the two rows of 8.
    assert kept == sorted([(1, "alpha beta g"), (3, ""), (0, "first text w"), (0, "second text "), (5, "quite anothe"), (8, "w0 w1 w2 w3 ")])


@pytest.mark.parametrize("deduplicated", [similar.deduplicated, simhash.deduplicated])
def test_repeated_ids_stay_in_the_classes_of_their_texts(spark, deduplicated):
    a, b = "one text about a number of things that are said here", "and another one which has nothing to do with it at all"
    for rows, want in (([(5, a), (5, b), (7, a)], [(5, a), (5, b)]), ([(3, a), (5, a), (5, b)], [(3, a), (5, b)]), ([(None, a), (None, b), (None, a)], [(None, a), (None, b)])):
        got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((r["text"], r["doc_id"]) for r in got) == sorted((t, i) for i, t in want)


def test_masking_follows_the_text(spark, sf_dir):
    out = {(r["doc_id"], (r["text"] or "")[:6]): r for r in corpus_pipeline.mask_personal_data(spark, odd_docs(spark), sf_dir).collect()}
    hidden = out[(None, "first ")]
    assert hidden["text"] == "first text without an id, mail <EMAIL> now" and hidden["n_chars"] == len(hidden["text"]) and out[(3, "")]["n_chars"] is None


def test_mix_of_clashing_columns_takes_what_it_says(spark):
    docs = odd_docs(spark)
    planned = mixing.mix(docs)
    assert planned.where("text is null").first()["size"] == 0 and planned.where("doc_id = 8").first()["size"] == 60_000
    assert mixing.mixed(docs).count() == planned.agg(F.sum("copies")).first()[0]


def test_a_worker_lets_go_of_the_tokenizer(tmp_path):
    import gc
    import weakref

    import public_tokenizers

    from trailmark.llm import bpe, shared

    path = public_tokenizers.path("word_bpe_49k.json")
    kept = weakref.ref(bpe.model(path))
    assert bpe.model(path) is kept()
    gc.disable()
    try:
        shared.let_go()  # as tasks of another operator do when they begin
        assert kept() is None
    finally:
        gc.enable()


def test_dense_columns_are_as_wide_as_postings():
    import numpy as np

    from trailmark.llm.toxicity import Index

    rng = np.random.default_rng(3)
    row, word = np.nonzero(rng.random((300, 40)) < 0.5)
    index = Index.of(300, 40, row, word, rng.random(len(row)).astype(np.float32))
    q = np.arange(40), rng.random(40)
    rows, near = index.nearest([q], 5)[0]
    every = np.zeros((300, 40))
    every[index.example, np.repeat(np.arange(40), index.sizes)] = index.weight
    want = (every @ q[1]).round(12)
    best = np.lexsort((np.arange(300), -want))[:5]
    assert index.heads.dtype == np.float32 and rows.tolist() == best.tolist() and np.abs(near - want[best]).max() < 1e-9


def test_near_duplicates_are_proposed_by_fingerprints(spark):
    prints = [0, 0b11, 0b111, 0b11, -1, 1 << 63 | 5]
    rows = [(10 * i, p - (1 << 64) if p >= 1 << 63 else p) for i, p in enumerate(prints)]
    got = {tuple(r) for r in similar.simhash_pairs(spark.createDataFrame(rows, "fp long, print long")).collect()}
    assert got == {(0, 10), (10, 20), (10, 30), (20, 50)}


def test_near_duplicates_are_fingerprinted_with_bands(spark):
    import pyarrow as pa

    texts = ["a b c d e f g", "a b c d e f g h", ""]
    (b,) = similar._sketches(iter([pa.RecordBatch.from_pydict({"fp": [1, 2, 3], "text": texts})]))
    for t, p in zip(texts, b.column("print").to_pylist(), strict=True):
        hashes = similar.shingles(t).tolist()
        assert p % (1 << 64) == sum((2 * sum(h >> i & 1 for h in hashes) > len(hashes)) << i for i in range(64))


def test_parities_leave_out_only_pairs_that_are_not_similar(spark):
    """Of a large group of near copies, of which few are similar enough, few pairs are left to be verified, and every similar one is."""
    import random

    import pyarrow as pa

    rng = random.Random(31)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(120):
        v = list(base)
        for i in rng.sample(range(150), rng.choice([1, 2, 3, 5, 6, 7])):
            v[i] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(v))
    (b,) = similar._sketches(iter([pa.RecordBatch.from_pydict({"fp": list(range(120)), "text": texts})]))
    df = spark.createDataFrame([{c: r[c] for c in r if c not in ("keys", "print")} for r in b.to_pylist()], ", ".join(["fp long", "n int", *[f"{w} long" for w in similar.BITS + similar.ODD]]))
    left = {tuple(r) for r in similar._of(df, "a").crossJoin(similar._of(df, "b")).where("a < b").where(similar._near()).select("a", "b").collect()}
    sets = [set(similar.shingles(t).tolist()) for t in texts]
    near = {(x, y): len(sets[x] & sets[y]) / len(sets[x] | sets[y]) for y in range(120) for x in range(y)}
    wanted = {p for p, s in near.items() if s >= 0.8}
    assert wanted and wanted <= left and len(left - wanted) < 0.1 * sum(0.7 <= s < 0.8 for s in near.values())


def test_few_labels_of_components_are_sent_and_many_shuffled(spark, monkeypatch):
    from trailmark.llm import components

    edges = spark.createDataFrame([(7, 3), (3, 5), (5, 3), (9, 8), (8, 10), (4, 4)], "a long, b long")
    for most in (0, 1_000_000):
        monkeypatch.setattr(components, "BROADCAST_ROWS", most)
        assert sorted(tuple(r) for r in components.components(edges).collect()) == [(3, 3), (5, 3), (7, 3), (8, 8), (9, 8), (10, 8)]

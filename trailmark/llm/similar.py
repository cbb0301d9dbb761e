"""Near-duplicates by the similarity of their shingles.

Two texts are near-duplicates if the sets of their five-word shingles have a Jaccard similarity of at least 0.8. The first candidates
are those of SimHash: texts whose fingerprints over these shingles differ in at most two bits, found by the signatures of operator 10.
Of texts of similarity 0.8 fingerprints differ in about ten bits, so further candidates are texts whose MinHash sketches agree on
one of 16 bands of four places. Each candidate is verified on the true sets, so no pair is linked that is not similar. A pair of
similarity 0.8 shares a band with a probability of 0.9998.

A band that n texts share is not joined with itself at once: its members are first compared with a few representatives, and only
members that are then still in different components are compared with each other (ROUNDS puts more such rounds in between). That is the same for bands of any size, and finds
the same components, but a large group of copies of one text with some changes is mostly linked by its representatives. The join
itself leaves out pairs that cannot be similar by the parities of their shingles, which is exact (see `_near`) and tells texts of up
to some hundred words apart almost as well as their sets, and pairs whose sketches, of which two bits of each of 512 places go along,
differ too much, for longer texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.components import components
from trailmark.llm.shared import let_go, materialise, sent_if_small, shuffled
from trailmark.llm.simhash import links, majority, one_of_each, row_hash

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 16, 4
#: Places of a sketch; the bands are its first ones. Two bits of each place go along with a text, in so many longs.
PLACES = 512
BITS = [f"bits{i}" for i in range(2 * PLACES // 64)]
#: Of texts of similarity LEAST, 0.15 of the places differ in their two bits; pairs are not verified beyond four standard deviations.
MOST_DIFFERENT = round(PLACES * 0.15 + 4 * (PLACES * 0.15 * 0.85) ** 0.5)
#: Shingles are dealt by their hashes to so many places; the parity of each place's count goes along with a text, in so many longs.
PARITIES = 1024
ODD = [f"odd{i}" for i in range(PARITIES // 64)]
#: All members of a band meet so many representatives; those still in different components do so again in so many rounds, then meet each other.
REPRESENTATIVES, ROUNDS = 8, 0
_random = np.random.default_rng(42)
_FACTORS = _random.integers(0, 1 << 63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _random.integers(0, 1 << 63, PLACES, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the different five-word shingles; one of all words if there are fewer, none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(whole[i:j]) for i, j in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The least value of the hashes under each of PLACES orders, upper halves as 32-bit integers."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 256):  # long texts in slices, so memory stays bounded
        least = np.minimum(least, ((hashes[i : i + 256, None] ^ _MASKS) * _FACTORS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _bits(places: np.ndarray) -> np.ndarray:
    """Two bits of each place as longs: the lowest bits of all places, then their second bits."""
    planes = np.concatenate([places & 1, places >> 1 & 1]).astype(np.uint8)
    return np.packbits(planes, bitorder="little").view("<i8")


def _parities(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes at each of PARITIES places, as longs."""
    counts = np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for b in batches:
        sizes, prints, keys, bits = [], [], [], []
        for t in b.column(1):
            hashes = shingles(t.as_py())
            places = sketch(hashes)
            sizes.append(len(hashes))
            prints.append(majority(hashes))
            keys.append(np.array([xxhash.xxh64_intdigest(places[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)], np.uint64).view(np.int64))
            bits.append(np.concatenate([_bits(places), _parities(hashes)]))
        columns = np.array(bits, np.int64).reshape(-1, len(BITS + ODD)).T
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *[pa.array(c) for c in columns]], names=["fp", "n", "print", "keys", *BITS, *ODD])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            sets = [shingles(t.as_py()).view(np.int64) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "shingles"])


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.xxhash64(text_col).alias("fp"), F.col(text_col).alias("text"))


def _of(df: DataFrame, x: str) -> DataFrame:
    """df as one side of a pair."""
    return df.select(*[F.col(c).alias(x if c == "fp" else f"{c}_{x}") for c in df.columns])


def _near() -> Column:
    """True for pairs that can be similar by their sizes, parities and sketches.

    Where the parities of two sets differ, one of them has a shingle that the other has not, so their sets differ in at least as many
    shingles as parities. Sets of similarity LEAST differ in at most (1 - LEAST) / (1 + LEAST) of the sum of their sizes.
    """
    sizes = F.least("n_a", "n_b") >= LEAST * F.greatest("n_a", "n_b") - 1e-9
    half = len(BITS) // 2
    differ = lambda w: F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))
    odd = reduce(Column.__add__, [F.bit_count(differ(w)) for w in ODD])
    apart = [F.bit_count(differ(low).bitwiseOR(differ(high))) for low, high in zip(BITS[:half], BITS[half:], strict=True)]
    return sizes & ((1 + LEAST) * odd <= (1 - LEAST) * (F.col("n_a") + F.col("n_b")) + 1e-6) & (reduce(Column.__add__, apart) <= MOST_DIFFERENT)


def _similar(near: DataFrame, texts: DataFrame) -> DataFrame:
    """Those rows of the pairs (a, b, n_a, n_b and others), a written table, whose sets are similar."""
    nodes = materialise(near.select(F.col("a").alias("fp")).unionByName(near.select(F.col("b").alias("fp"))).distinct(), "nodes")
    sets = texts.join(sent_if_small(nodes), "fp", "left_semi").dropDuplicates(["fp"]).select("fp", "text").mapInArrow(_sets, "fp long, shingles array<long>")
    sets = materialise(sets, "shingles")
    both = near.join(_of(sets, "a"), "a").join(_of(sets, "b"), "b")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.col("n_a") + F.col("n_b") - shared
    return materialise(both.where((union == 0) | (shared >= LEAST * union - 1e-9)).select(*near.columns), "similar")


def _across(members: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Different pairs a < b of a member and another one that share a key, are in different components and can be similar."""
    once = F.expr("a < b") if others is None else F.lit(True)  # among the members alone each pair would come twice
    a, b = _of(members, "a"), _of(members if others is None else others, "b")
    found = a.join(b, (F.col("key_a") == F.col("key_b")) & once & F.expr("component_a <> component_b") & _near())
    turned = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x)
    return found.select(*[c for x in ("", "n_", "component_") for c in (pick(f"{x}a", f"{x}b"), pick(f"{x}b", f"{x}a"))]).distinct()


def _first(round_: int = 0) -> Column:
    """Of a key's members, those that come first in one of REPRESENTATIVES orders by hashes, others in each round."""
    return F.array_distinct(F.array(*[F.min_by("fp", F.xxhash64("fp", F.lit(round_ * REPRESENTATIVES + i))) for i in range(REPRESENTATIVES)]))


def _representatives(members: DataFrame, round_: int) -> DataFrame:
    chosen = members.groupBy("key").agg(_first(round_).alias("first")).select("key", F.explode("first").alias("fp"))
    return members.join(chosen, ["key", "fp"])


def _merged(of: DataFrame, found: DataFrame) -> DataFrame:
    """(fp, component) with components merged that links (a, b) between them join."""
    if found.isEmpty():
        return of
    linked = components(found).select(F.col("node").alias("component"), F.col("component").alias("least"))
    merged = of.join(sent_if_small(linked), "component", "left").select("fp", F.coalesce("least", "component").alias("component"))
    return materialise(merged, "components")


def simhash_pairs(prints: DataFrame) -> DataFrame:
    """Pairs a < b of texts (fp, print) by their fingerprints: each text and the least one of its fingerprint, and the least ones of fingerprints that differ in at most two bits."""
    least = materialise(prints.groupBy("print").agg(F.min("fp").alias("least")), "fingerprints")
    own = prints.join(least, "print").where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    of = lambda x: least.select(F.col("print").alias(x), F.col("least").alias(f"least_{x}"))
    linked = links(least.select(F.col("print").alias("fp"))).join(of("a"), "a").join(of("b"), "b")
    return own.unionByName(linked.select(F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b")))


def classes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(fp, component) of each different text: fp is its xxhash64, component the smallest fp that links of similar texts reach."""
    texts = _texts(docs, text_col)
    made = texts.mapInArrow(_sketches, ", ".join(["fp long, n int, print long, keys array<long>", *[f"{w} long" for w in BITS + ODD]]))
    groups = materialise(made.dropDuplicates(["fp"]), "sketches")
    signed = groups.select("fp", F.explode("keys").alias("key"))
    by_prints = simhash_pairs(groups.select("fp", "print"))
    groups = groups.drop("keys", "print")
    counted = signed.groupBy("key").agg(F.count("*").alias("size"), _first().alias("first")).where("size > 1").drop("size")
    signed = materialise(signed.join(shuffled(counted), "key"), "bands")
    met = signed.select("fp", F.explode("first").alias("other")).where("fp <> other")
    pairs = met.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).unionByName(by_prints).distinct()
    pairs = pairs.join(shuffled(_of(groups, "a")), "a").join(shuffled(_of(groups, "b")), "b").where(_near())
    found = _similar(materialise(pairs.select("a", "b", "n_a", "n_b"), "candidates"), texts)
    of = _merged(groups.select("fp", F.col("fp").alias("component")), found.select("a", "b"))

    for round_ in range(1, ROUNDS + 2):
        at = signed.join(of, "fp").select("key", "fp", "component")
        mixed = at.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
        at = materialise(at.join(mixed, "key").join(groups, "fp"), "mixed")
        if at.isEmpty():
            break
        # In the last round all members meet.
        pairs = materialise(_across(at, _representatives(at, round_) if round_ <= ROUNDS else None), "pairs")
        if not pairs.isEmpty():
            of = _merged(of, _similar(pairs, texts).select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))
    return of


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: the one with the smallest id (null last); of rows that repeat that id, the smallest by all columns.

    Null, empty and other texts without words are one class. Rows with equal ids but different texts are in the classes of their
    texts. Texts are taken whole; columns may have any name; an empty table gives
    an empty result.
    """
    prints = docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), F.xxhash64(text_col).alias("fp"))
    return one_of_each(docs, prints, classes(docs, text_col), id_col)

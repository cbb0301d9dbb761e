"""Near-duplicates by SimHash with deletion-variant signatures.

Two fingerprints of 64 bits that differ in at most two bits agree, but for one bit at most, in one of two halves. Each distinct
fingerprint is indexed under 64 signatures: a half, a place in it, and the half with that place blanked out. An equality join
of the signatures gives every pair within reach; each pair is then verified. Copies share a fingerprint and are folded first,
so a group of copies is one row of the join however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.components import components
from trailmark.llm.shared import comparable, materialise, private, sent_if_small, shuffled

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Signatures shared by more fingerprints than this are cut further before they are joined.
HOT_SIGNATURE = 256


def fingerprint(text: str | None) -> int:
    """SimHash over 3-word shingles, repeats included, as a signed 64-bit integer; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(whole[i:j], SEED) for i, j in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; as a signed integer."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # long texts in slices, so memory stays bounded
        counts += np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, columns to keep, fp long) of each row, in one pass without a shuffle."""
    kept = docs.select(id_col, *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py()) for t in b.columns[-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], fps], names=[*b.schema.names[:-1], "fp"])

    return docs.select(id_col, *keep, text_col).mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("fp", T.LongType())]))


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _signatures(fps: DataFrame) -> DataFrame:
    """64 rows for a fingerprint: key = half, blanked place and the half without it; rest = the other half."""
    low, high = F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32)
    place = F.col("place")
    half = F.when(place < 32, low).otherwise(high)
    blank = F.expr("shiftleft(1L, cast(place % 32 as int))")
    return (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("place"))
        .withColumn("key", F.shiftleft(place.cast("long"), 32).bitwiseOR(half.bitwiseAND(F.bitwise_not(blank))))
        .select("fp", "key")
    )


def _pairs(signed: DataFrame, keys: list[str]) -> DataFrame:
    a = signed.select(*keys, F.col("fp").alias("a"))
    b = signed.select(*keys, F.col("fp").alias("b"))
    return a.join(shuffled(b), keys).where((F.col("a") < F.col("b")) & (_differ(F.col("a"), F.col("b")) <= MAX_BITS)).select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """Distinct pairs a < b of the distinct fingerprints that differ in at most two bits.

    A signature that many fingerprints share would make their square of pairs. Such signatures are cut again: of a pair that
    agrees on one half but for the blanked bit, the other half differs in at most two bits, so one of its three parts is equal;
    the part joins the key. That is exact, and only very common halves take this way.
    """
    signed = _signatures(fps)
    counted = signed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    signed = materialise(signed.join(shuffled(counted), "key").select("key", "fp", "n"), "signatures")
    few = _pairs(signed.where(F.col("n") <= HOT_SIGNATURE), ["key"])
    many = signed.where(F.col("n") > HOT_SIGNATURE)
    other = F.when(F.shiftrightunsigned("key", 32) < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
    parts = F.array(other.bitwiseAND(0x7FF), F.shiftrightunsigned(other, 11).bitwiseAND(0x7FF), F.shiftrightunsigned(other, 22))
    many = many.select("key", "fp", F.posexplode(parts).alias("part", "value"))
    return few.unionByName(_pairs(many, ["key", "part", "value"])).distinct()


def classes(prints: DataFrame) -> DataFrame:
    """(fp, component) of each distinct fingerprint: the smallest fingerprint that links reach."""
    groups = materialise(prints.select("fp").distinct(), "groups")
    found = materialise(links(groups), "links")
    # Only linked fingerprints go through the rounds.
    linked = components(found).withColumnRenamed("node", "fp") if not found.isEmpty() else found.select(F.col("a").alias("fp"), F.col("b").alias("component"))
    return materialise(groups.join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and class of each document: (id_col, fp long, fingerprint hex string, component_id).

    Documents whose fingerprints differ in at most two bits are linked; component_id is the smallest id that links reach.
    Null and empty texts have fingerprint 0, linked like any other. Rows with a null id keep a fingerprint and a class, whose
    id is null if no row of it has one. Repeated rows each return once; other columns are left out; an empty table gives an
    empty result. Texts are taken whole.
    """
    prints = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    joined = prints.groupBy("fp").agg(F.min(id_col).alias("least")).join(classes(prints), "fp")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of = materialise(joined.join(least, "component").select("fp", "component_id"), "classes")
    # A fingerprint of very many copies makes a hot key here; the join of two shuffled sides lets Spark split it.
    return prints.join(of, "fp").select(id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: the one with the smallest id; of rows that repeat that id, the smallest by all columns."""
    prints = docs.select(F.col(id_col).alias("id"), row_hash(docs).alias("row"), F.col(text_col).alias("text"))
    prints = materialise(fingerprints(prints, "id", "text", ("row",)), "fingerprints")
    return one_of_each(docs, prints, classes(prints), id_col)


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[comparable(docs, c) for c in docs.columns])


def one_of_each(docs: DataFrame, prints: DataFrame, of: DataFrame, id_col: str) -> DataFrame:
    """One row of docs of each class, the smallest by id (null last) and then by all columns.

    prints has id, row (row_hash) and fp of each row of docs; of has the component of each fp. Rows are told apart by id and
    hash, so equal or null ids never join different classes. Rows that are equal in all columns are one. Columns of docs may
    have any name and type.
    """
    own = {n: private(n) for n in ("id", "row", "component")}
    classed = prints.join(of, "fp").select("component", "id", "row")
    rows = classed.groupBy("component", "id").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    least = rows.groupBy("component").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "n", "row")).alias("r"), F.sum("n").alias("total"))
    kept = materialise(least.where("total > 1").select(F.col("component").alias("c"), F.col("r.id").alias("i"), F.col("r.n").alias("n"), F.col("r.row").alias("k")), "kept")
    # Only rows of classes of several rows are looked at: all but the one that is kept go, and few rows need to be joined to docs.
    again = classed.join(kept, F.col("component") == F.col("c")).withColumn("least", F.col("id").eqNullSafe(F.col("i")))
    again = materialise(again.where(~((F.col("n") == 1) & F.col("least") & (F.col("row") == F.col("k")))).groupBy("component", "id", "row").agg(F.first(F.col("least") & (F.col("n") > 1)).alias("tied")), "repeats")
    hashed = docs.withColumn(own["row"], row_hash(docs))
    named = lambda df, cols: df.select(*[F.col(c).alias(own[c] + "k") for c in cols])
    same = F.col(id_col).eqNullSafe(F.col(own["id"] + "k")) & (F.col(own["row"]) == F.col(own["row"] + "k"))
    single = hashed.join(sent_if_small(named(again, ["id", "row"])), same, "left_anti").select(*docs.columns)
    tied = again.where("tied").select("component", "id", "row")
    if tied.isEmpty():
        return single
    order = F.struct(*[comparable(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    tied = sent_if_small(named(tied, ["component", "id", "row"]))
    first = hashed.join(tied, same).groupBy(own["component"] + "k").agg(F.min_by(F.struct(*docs.columns), order).alias(own["row"]))
    return single.unionByName(first.select(*[F.col(own["row"])[c].alias(c) for c in docs.columns]))

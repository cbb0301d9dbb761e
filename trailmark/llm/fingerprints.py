"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius by permuted block tables.

A text's terms are its pairs of neighbouring words; each term's 128-bit hash votes with weight 1 + ln(count) for or against every
bit. A fingerprint is cut into six blocks. Two fingerprints that differ in at most four bits agree in at least two blocks, so
fifteen tables, each with another two blocks permuted to the front as the key, hold every such pair under an equal key; an equality
join of each table finds it and a count of the differing bits verifies it. A pair counts in the first table that holds it. Copies
share a fingerprint and are one row of the tables.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.shared import flushed, materialise

BITS = 128
#: Words of a term.
TERM_WORDS = 2
#: Blocks as word, first bit and bits; a pair within RADIUS differs in at most RADIUS of them and so agrees in two.
BLOCKS = [(w, start, size) for w in (0, 1) for start, size in ((0, 21), (21, 21), (42, 22))]
RADIUS = len(BLOCKS) - 2
TABLES = list(combinations(range(len(BLOCKS)), 2))
#: Keys that more fingerprints than this share are cut further before they are joined.
HOT_KEY = 256
#: Parts of the order of documents for each shuffle partition, and sampled ids for each part.
PARTS, SAMPLED = 4, 8


def fingerprint(text: str | None) -> int:
    """128 signed votes of the weighted term hashes; 0 for a text without words. Equal texts have equal fingerprints."""
    words = (text or "").lower().split()
    if not words:
        return 0
    k = min(TERM_WORDS, len(words))
    counts = Counter(zip(*(words[i:] for i in range(k)), strict=False))
    weights = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
    hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(" ".join(t).encode("utf-8", "surrogatepass")) for t in counts), np.uint8).reshape(-1, BITS // 8)
    votes = np.zeros(BITS)
    for i in range(0, len(weights), 1 << 14):  # long texts in slices, so memory stays bounded
        part = weights[i : i + (1 << 14)]
        votes += 2 * (part @ np.unpackbits(hashes[i : i + (1 << 14)], axis=1)) - part.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    """The share of bits in which two fingerprints agree."""
    return 1 - (a ^ b).bit_count() / BITS


def halves(print_: int) -> tuple[int, int]:
    """A fingerprint as two signed 64-bit integers."""
    return tuple(int.from_bytes(part, "big", signed=True) for part in (print_.to_bytes(16, "big")[:8], print_.to_bytes(16, "big")[8:]))


def hexed(w0: str = "w0", w1: str = "w1") -> Column:
    return F.lower(F.concat(F.lpad(F.hex(w0), 16, "0"), F.lpad(F.hex(w1), 16, "0")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, w0, w1) of each row of docs: its fingerprint in two longs, in one pass without a shuffle. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [halves(fingerprint(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([p[i] for p in prints], pa.int64()) for i in (0, 1)]], names=[b.schema.names[0], "w0", "w1"])

    fields = [docs.schema[id_col], T.StructField("w0", T.LongType()), T.StructField("w1", T.LongType())]
    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def _block(i: int, of: str = "") -> Column:
    word, start, size = BLOCKS[i]
    return F.shiftrightunsigned(F.col(f"w{word}{of}"), start).bitwiseAND(F.lit((1 << size) - 1).cast("long"))


def _same(i: int) -> Column:
    return _block(i, "_a") == _block(i, "_b")


def _tables(prints: DataFrame) -> DataFrame:
    """A row of each fingerprint for each table: the table and, as key, the two blocks at its front."""
    rows = [F.struct(F.lit(t).cast("tinyint").alias("table"), F.shiftleft(_block(i), BLOCKS[j][2]).bitwiseOR(_block(j)).alias("key")) for t, (i, j) in enumerate(TABLES)]
    return prints.select("w0", "w1", F.inline(F.array(*rows)))


def _rest(table: int) -> list[Column]:
    """What is not in a table's key, in one part more than bits may differ, so that one part of a pair is equal."""
    rest = [_block(i) for i in range(len(BLOCKS)) if i not in TABLES[table]]
    return [*rest[:-1], rest[-1].bitwiseAND(F.lit(0x3FF).cast("long")), F.shiftrightunsigned(rest[-1], 10)]


def _pairs(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Pairs a < b of rows that share keys and lie within the radius, each once in all tables."""
    a, b = [rows.select(*[F.col(k) for k in keys], F.col("w0").alias(f"w0_{x}"), F.col("w1").alias(f"w1_{x}")) for x in "ab"]
    less = (F.col("w0_a") < F.col("w0_b")) | ((F.col("w0_a") == F.col("w0_b")) & (F.col("w1_a") < F.col("w1_b")))
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in ("w0", "w1")])
    # The first two equal blocks name the one table in which the pair counts.
    first = F.coalesce(*[F.when(reduce(Column.__and__, [_same(i), _same(j)]), F.lit(t)) for t, (i, j) in enumerate(TABLES)])
    near = a.join(b, [*keys]).where(less & (apart <= radius) & (F.col("table") == first))
    return near.select("w0_a", "w1_a", "w0_b", "w1_b", apart.alias("bits"))


def within(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(w0_a, w1_a, w0_b, w1_b, bits): every pair of the different fingerprints (w0, w1) that differ in at most `radius` bits, once.

    radius is at most RADIUS. prints is a written table. A key that very many fingerprints share is cut again by a part of what
    the key leaves out; that finds the same pairs.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the tables find pairs within {RADIUS} bits")
    rows = _tables(prints.select("w0", "w1").distinct())
    shared = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialise(rows.join(shared, ["table", "key"]), "tables")
    few = _pairs(rows.where(F.col("n") <= HOT_KEY), ["table", "key"], radius)
    many = rows.where(F.col("n") > HOT_KEY)
    rest = reduce(lambda other, t: F.when(F.col("table") == t, F.array(*_rest(t))).otherwise(other), range(1, len(TABLES)), F.array(*_rest(0)))
    many = many.select("table", "key", "w0", "w1", F.posexplode(rest).alias("part", "value"))
    return few.unionByName(_pairs(many, ["table", "key", "part", "value"], radius).distinct())


def near_counts(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(w0, w1, n_near) of each different fingerprint of a written table: how many other rows lie within the radius, copies among them."""
    own = prints.groupBy("w0", "w1").agg(F.count("*").alias("n"))
    pairs = materialise(within(prints, radius), "pairs")
    both = pairs.select(*[F.col(f"{w}_{x}").alias(f"{w}{'' if x == 'a' else '_of'}") for x in "ab" for w in ("w0", "w1")])
    both = both.unionByName(pairs.select(*[F.col(f"{w}_{x}").alias(f"{w}{'' if x == 'b' else '_of'}") for x in "ab" for w in ("w0", "w1")]))
    of = own.withColumnsRenamed({"w0": "w0_of", "w1": "w1_of"})
    others = both.join(of, ["w0_of", "w1_of"]).groupBy("w0", "w1").agg(F.sum("n").alias("others"))
    return own.join(others, ["w0", "w1"], "left").select("w0", "w1", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_near"))


# --- a document and its edited text ------------------------------------------------------------------------------------


def _dealt(docs: DataFrame) -> DataFrame:
    """(place, id, text): docs in parts of the ascending order of ids, sorted; each part ends with the row that follows its last one.

    Parts begin at ids of a bounded sample. place is twice the part, plus one for the row that only follows: the first row of the
    next part, or the first of all for the last part.
    """
    spark = docs.sparkSession
    wanted = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = docs.agg(F.min("id")).first()[0]
    sampled = docs.where("id is not null").select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLED * wanted).collect()
    cuts = sorted({r[0] for r in sampled} - {least})
    cuts = cuts[:: max(1, -(-len(cuts) // wanted))]

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        out = []
        for x in ids.to_pylist():
            part = bisect_right(cuts, x)
            of = [2 * part]
            if part and x == cuts[part - 1]:
                of.append(2 * part - 1)
            if x == least:
                of.append(2 * len(cuts) + 1)
            out.append(of)
        return pa.array(out, pa.list_(pa.int32()))

    placed = docs.where("id is not null").select(F.explode(places("id")).alias("place"), "id", "text")
    part = F.shiftright("place", 1)
    return placed.repartition(part).sortWithinPartitions(part, "place", "id", "text")


_EDITED = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), *[(w, pa.int64()) for w in ("w0", "w1", "e0", "e1")], ("near_edited", pa.float64()), ("near_next", pa.float64())])
EDITED = "n_chars long, edited_sha256 string, w0 long, w1 long, e0 long, e1 long, near_edited double, near_next double"


def _edited(text: str, own: int, follower: str | None, other: int) -> tuple:
    """The row of a text with fingerprint own; follower: the next text, with fingerprint other, or None."""
    half = len(text) // 2
    edited = text if follower is None else text[: len(text) - half] + follower[:half]
    after = own if edited == text else fingerprint(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), digest, *halves(own), *halves(after), likeness(own, after), None if follower is None else likeness(own, other)


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_chars, edited_sha256, w0, w1, e0, e1, near_edited, near_next): each row's fingerprint beside those of its edited text and the next row.

    In the edited text the last floor(n_chars / 2) code points are replaced by as many first ones, or all, of the next row's text,
    in ascending order of ids; the first row follows the last. Null texts are empty; rows that repeat an id follow each other by
    text; a single row follows itself. Rows without an id have no next row: their edited text is their text and near_next is null.
    Texts are taken whole and pass through a shuffle once. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL(EDITED).fields])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held = None  # id, text and fingerprint of the row that waits for the next one
        for b in batches:
            for place, id_, text in zip(*b.columns, strict=True):
                only_follows, text = place.as_py() % 2, text.as_py()
                if held is None and only_follows:
                    continue
                own = held[2] if held is not None and held[1] == text else fingerprint(text)
                if held is not None:
                    yield held[0], *_edited(held[1], held[2], text, own)
                held = None if only_follows else (id_.as_py(), text, own)

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for text in b.column(1):
                yield None, *_edited(text.as_py(), fingerprint(text.as_py()), None, 0)

    def made(rows: Callable[[Iterable[pa.RecordBatch]], Iterator[tuple]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            batches = iter(batches)
            for first in batches:
                schema = pa.schema([pa.field("id", first.schema.field("id").type), *_EDITED])
                yield from flushed(rows(chain([first], batches)), schema, lambda r: 200)

        return run

    out = _dealt(docs).mapInArrow(made(rows), whole)
    out = out.unionByName(docs.where("id is null").mapInArrow(made(alone), whole))
    return out.withColumnRenamed("id", id_col)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """edits with both fingerprints in hex and n_near, the number of other rows whose fingerprint lies within the radius."""
    made = materialise(edits(docs, id_col, text_col), "edits")
    counts = materialise(near_counts(made, radius), "near")
    return made.join(counts, ["w0", "w1"]).select(id_col, "n_chars", "edited_sha256", hexed().alias("fingerprint"), hexed("e0", "e1").alias("edited_fingerprint"), "near_edited", "near_next", "n_near")

"""Phrase collocations by Toivonen's mining.

A sample of the documents proposes words and phrases that may be frequent, by a lowered bar. A full pass counts every word, every
proposed phrase and the negative border: phrases that were not proposed although both of their parts, all words but the last and
all but the first, were. If nothing of the border is frequent, nothing was missed. Otherwise a further pass counts the phrases whose
parts are frequent only now, with all their continuations, until a pass leaves nothing frequent whose continuations are not counted.

These passes count 64-bit hashes, which are cheap to shuffle. Phrases that share a hash add up, so what is frequent by its hash holds
all that is frequent; a last pass counts just that by its text, which gives exact counts. What is proposed, and what is frequent by
its hash, is told to the tasks as a bitmap of FILTER_BITS places, so its size does not depend on the data. A phrase that shares
a place with a proposed one counts as proposed: then more is counted, never less. The same bitmap says what a pass counts and what
of it belongs to the border, so the closing test holds for what was really counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.shared import materialise, private

MOST_WORDS = 4
LEAST_COUNT = 30
#: A phrase that lies in a longer one at least so often, in hundredths of its count, is dropped.
ABSORBED = 80
LISTED = 2000
NO_LANG = "und"
#: One in so many documents is in the sample. A phrase is proposed that it has so many hundredths of the due count, and so many times at least.
SAMPLE, LOWERED, LEAST_SAMPLED = 8, 50, 2
#: Places of the bitmap, a power of two; 2^27 are 16 MB.
FILTER_BITS = 1 << 27
#: Bytes of text whose phrases a task counts at a time.
CHUNK = 2 << 20
#: Salts of a language when its best phrases are picked.
SALTS = 64
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_BREAK = b"\n"
#: Factors of the phrases' hashes, odd.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
HASHED = "a long, open boolean, n long"
COUNTED = "lang string, phrase string, words tinyint, n long"
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int8()), ("n", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX
    return x ^ x >> np.uint64(29)


class Filter:
    """A set of hashes by their places in a bitmap; None as the bits stands for all."""

    def __init__(self, bits: np.ndarray | None, size: int):
        self.bits, self.size = bits, size

    def holds(self, a: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(a), bool)
        at = a & np.uint64(self.size - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def joined(self, other: Filter) -> Filter:
        return other if self.bits is None else Filter(self.bits | other.bits, self.size)


def filter_of(hashes: DataFrame, size: int) -> Filter:
    """The filter of a column a of hashes. At most size / 8 bytes come to the driver, however many hashes there are."""
    at = hashes.select((F.col("a").bitwiseAND(F.lit(size - 1).cast("long")) + 1).alias("at"))  # Spark cuts buckets after multiples of their size
    made = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in made.collect():
        start = (r["bucket"] - 1) * 4096
        part = np.frombuffer(r["bits"], np.uint8)[: len(bits) - start]
        bits[start : start + len(part)] |= part
    return Filter(bits, size)


def _chunks(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about `size` bytes that end at a blank or break."""
    start = 0
    while len(text) - start > size:
        cuts = [x for x in (text.rfind(b" ", start, start + size), text.rfind(_BREAK, start, start + size)) if x > start]
        if not cuts:
            cuts = [x for x in (text.find(b" ", start + size), text.find(_BREAK, start + size)) if x >= 0][:1] or [len(text)]
        yield text[start : max(cuts)]
        start = max(cuts)
    yield text[start:]


class _Ids(dict):
    """Numbers for words in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Words:
    """The words of a part of a language's text: number and hash of each, in order, a break between pieces; the first ones are carried."""

    def __init__(self, lang: bytes, data: bytes, carried: list[bytes]):
        ids = _Ids({_BREAK: 0, b"": 1})
        tokens = [*carried, *data.replace(_BREAK, b" \n ").split(b" ")]
        at = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
        real = at != 1
        self.lang, self.old, self.at, self.names = lang, int(real[: len(carried)].sum()), at[real], list(ids)
        seed, digest = xxhash.xxh3_64_intdigest(lang), xxhash.xxh3_64_intdigest
        self.hashes = np.fromiter((digest(w, seed) for w in self.names), np.uint64, len(ids))

    @property
    def carried(self) -> list[bytes]:
        return [self.names[i] for i in self.at[-(MOST_WORDS - 1) :].tolist()]

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 1 to MOST_WORDS words: the hash of what begins at each place, and whether that is a phrase."""
        word, is_word = self.hashes[self.at], self.at != 0
        a, real = _mixed(word), is_word
        for n in range(1, min(MOST_WORDS, len(self.at)) + 1):
            if n > 1:
                a, real = _mixed(a[:-1] * _STEP + word[n - 1 :]), real[:-1] & is_word[n - 1 :]
            yield n, a, real

    def fresh(self, found: np.ndarray, n: int) -> np.ndarray:
        """Places of phrases of n words but for those that end in the carried words, which were counted with them."""
        found[: max(0, self.old - n + 1)] = False
        return np.flatnonzero(found)


def _hashed(words: _Words, inside: Filter, before: Filter | None, lengths: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Counts of phrases whose two parts are inside. If before is given: of those of which it had not both, and of their continuations.

    open: a phrase whose continuations are not counted.
    """
    wide = narrow = None
    for n, a, real in words.levels():
        ok = real if n == 1 else real & wide[:-1] & wide[1:]
        was = ok if n == 1 else real & narrow[:-1] & narrow[1:]
        wide, narrow = ok & inside.holds(a), None if before is None else was & before.holds(a)
        told = ok.copy()
        if before is None:
            narrow = wide
        else:
            told &= ~was
            wide |= told  # what is counted only now is followed at once, so this pass leaves nothing open
        if n in lengths and (n > 1 or before is None):
            at = words.fresh(told, n)
            found, where, count = np.unique(a[at], return_index=True, return_counts=True)
            shut = wide[at[where]] | (n == MOST_WORDS)
            for i in range(0, len(found), 1 << 16):
                s = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(found[s].view(np.int64)), pa.array(~shut[s]), pa.array(count[s])], names=["a", "open", "n"])


def _exact(words: _Words, frequent: Filter) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, n) of the phrases whose hash is in the filter, told apart by their words, and all words under no text."""
    lang, names = words.lang.decode(), pa.array(words.names, pa.binary()).cast(pa.string())

    def rows(phrase: pa.Array, n: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(phrase)), phrase, pa.array(np.full(len(phrase), n, np.int8)), pa.array(counts.astype(np.int64))], schema=_COUNTED)

    for n, a, real in words.levels():
        if n == 1:
            yield rows(pa.array([""]), 0, np.array([len(words.fresh(real.copy(), 1))]))
        at = words.fresh(real & frequent.holds(a), n)
        _, where, which = np.unique(a[at], return_index=True, return_inverse=True)
        numbers = words.at[at[:, None] + np.arange(n)]
        same = (numbers == numbers[where[which]]).all(axis=1)
        text = lambda x: pc.binary_join_element_wise(*[names.take(pa.array(c)) for c in x.T], " ")
        for i in range(0, len(where), 1 << 16):
            s = slice(i, i + (1 << 16))
            yield rows(text(numbers[where[s]]), n, np.bincount(which[same], minlength=len(where))[s])
        if not same.all():  # phrases that share a hash with another one here
            yield rows(text(numbers[~same]), n, np.ones(int((~same).sum())))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    """The texts of a task's rows (lang, text), those of a language together, in parts of about CHUNK bytes."""
    held: dict[bytes, list[bytes]] = {}
    sizes: Counter = Counter()
    take = lambda lang: (sizes.pop(lang), _Words(lang, _BREAK.join(held.pop(lang)), []))[1]
    for b in batches:
        for lang, text in zip(b.column(0), b.column(1), strict=True):
            name, data = lang.as_py().encode(), (text.as_py() or "").encode().translate(_FOLD)
            if len(data) > CHUNK:
                carried: list[bytes] = []
                for part in _chunks(data, CHUNK):
                    words = _Words(name, part, carried)
                    carried = words.carried
                    yield words
                continue
            held.setdefault(name, []).append(data)
            sizes[name] += len(data)
            if sizes[name] > CHUNK:
                yield take(name)
            elif sizes.total() > 4 * CHUNK:  # many languages: none may hold much
                yield from map(take, list(held))
    yield from map(take, list(held))


def hash_counts(docs: DataFrame, least: int, inside: Filter, before: Filter | None = None, lengths: tuple[int, ...] = tuple(range(1, MOST_WORDS + 1))) -> DataFrame:
    """(a, open, n) of docs (lang, text): the hashes that `_hashed` counts, from `least` on, written."""
    sc = docs.sparkSession.sparkContext
    told, was = sc.broadcast(inside), sc.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _parts(batches):
            yield from _hashed(words, told.value, was.value, lengths)

    got = docs.select("lang", "text").mapInArrow(run, HASHED).groupBy("a").agg(F.max("open").alias("open"), F.sum("n").alias("n"))
    got = materialise(got.where(F.col("n") >= least), "hashes")
    told.destroy()
    was.destroy()
    return got


def exact_counts(docs: DataFrame, least: int, frequent: Filter) -> DataFrame:
    """(lang, phrase, words, n) of docs (lang, text): the phrases whose hash is in the filter, from `least` on, written.

    A row of no phrase and no words has the number of all words of a language.
    """
    told = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _parts(batches):
            yield from _exact(words, told.value)

    got = docs.select("lang", "text").mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("n"))
    got = materialise(got.where((F.col("n") >= least) | (F.col("words") == 0)), "phrases")
    told.destroy()
    return got


def proposed(docs: DataFrame, bar: int, bits: int) -> Filter:
    """What a sample proposes: words, pairs of words, and of longer phrases those whose parts are proposed, that it has `bar` times.

    The longest phrases have no continuations, so they need not be proposed.
    """
    found = filter_of(hash_counts(docs, bar, Filter(None, bits), lengths=(1, 2)), bits)
    for n in range(3, MOST_WORDS):
        found = found.joined(filter_of(hash_counts(docs, bar, found, lengths=(n,)), bits))
    return found


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, f): every phrase of 1 to MOST_WORDS words that occurs `least` times or more in its language, with its count.

    An empty phrase of no words counts all words of its language.

    Words are `[^\\x20\\x09]+` of pieces that `[.,;:!?\\x0A-\\x0D]` parts, A-Z in lower case. Phrases lie within a piece; occurrences
    that overlap all count. A null language is NO_LANG, a null or empty text has no words, repeated rows count each. Texts are
    taken whole, very long ones in parts that carry their last words on. An empty table gives an empty result.
    """
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(sample)).alias("part"))
    inside = proposed(rows.where("part = 0"), max(LEAST_SAMPLED, least * LOWERED // (100 * sample)), bits)
    new = hash_counts(rows, least, inside)
    frequent = filter_of(new, bits)
    while True:
        # What is frequent and open was in the border: its continuations have not been counted.
        failed = new.where("open")
        if failed.isEmpty():
            return exact_counts(rows, least, frequent).withColumnRenamed("n", "f")
        wider = inside.joined(filter_of(failed, bits))
        new = hash_counts(rows, least, wider, inside)
        inside, frequent = wider, frequent.joined(filter_of(new, bits))


def _join(words: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def scored(found: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates among the frequent phrases that no longer one absorbs.

    A candidate is cut after each of its words; the cut of the lowest score counts, the first of equal ones. Products are decimals of 38 digits.
    """
    parts = found.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("n"))
    of = F.split("phrase", " ")
    longer = found.where((F.col("words") > 1) & (F.col("f") >= least)).select("lang", "phrase", "words", F.col("f").alias("a"))
    words = F.col("words").cast("int")
    cuts = longer.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), words - 1)).alias("k"), of.alias("w"), words.alias("words"))
    cuts = cuts.select("lang", "phrase", "a", "k", _join(F.col("w"), F.lit(1), F.col("k")).alias("head"), _join(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    cuts = cuts.join(parts.withColumnsRenamed({"part": "head", "n": "l"}), ["lang", "head"]).join(parts.withColumnsRenamed({"part": "tail", "n": "r"}), ["lang", "tail"])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("score", F.expr("(cast(a as decimal(20,0)) * 2000000BD) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # What lies in a longer candidate: each of its runs of 2 to words - 1 words.
    starts = F.flatten(F.transform(F.sequence(F.lit(2), words - 1), lambda n: F.transform(F.sequence(F.lit(1), words - n + 1), lambda i: F.struct(i.alias("i"), n.alias("n")))))
    runs = longer.where("words > 2").select("lang", "a", of.alias("w"), F.explode(starts).alias("run"))
    around = runs.select("lang", _join(F.col("w"), F.col("run.i"), F.col("run.n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    absorbed = exact("around") * 100 >= exact("a") * ABSORBED
    kept = best.join(around, ["lang", "phrase"], "left").where(~F.coalesce(absorbed, F.lit(False)))
    return kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))


def collocations(docs: DataFrame, listed: int = LISTED, least: int = LEAST_COUNT, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank from 1, phrase, a, l, r, n, score): the first `listed` phrases of each language by score, count and phrase.

    See frequent_phrases and scored; n is the number of words of the language. Equal scores and counts go by the phrase's bytes. A
    language without candidates has no rows.
    """
    found = frequent_phrases(docs, least, text_col, lang_col, id_col, sample, bits)
    best = materialise(scored(found, least), "scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # A language may hold most of the phrases, so its first ones are picked in SALTS parts before they meet.
    salt, place = private("salt"), private("place")
    salted = best.withColumn(salt, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn(place, F.row_number().over(W.partitionBy("lang", salt).orderBy(*order))).where(F.col(place) <= listed).drop(place, salt)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= listed)
    totals = found.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""License scans by ordered signature rules, with DataFrame functions only.

A text's words, lower case, are matched by rules: a family of names under one keyword times the phrasings in which licenses are
named. Only texts that pass one gate are looked at, and of the rules only those whose keyword the text has are run. Detections
have word intervals; one that lies within another of the same or a better rank is suppressed. Base phrases are counted apart
and always stay.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import ascii_lower, let, places, running_max

#: Base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Characters that part words, after A-Z are lowered; and before that.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: label: (keyword that every name has, names as words; `?` after a word makes it optional, `|` parts alternatives).
FAMILIES: dict[str, tuple[str, list[str]]] = {
    "mit": ("mit", ["mit", "mit expat", "massachusetts institute of technology mit"]),
    "mit-0": ("mit", ["mit 0", "mit no attribution"]),
    "apache-1.1": ("apache", ["apache 1 1", "apache software license? version? 1 1"]),
    "apache-2": ("apache", ["apache 2", "apache 2 0", "apache license? version? 2 0?", "apache software license? version? 2 0?", "apache v2"]),
    "bsd-2-clause": ("bsd", ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd bsd"]),
    "bsd-3-clause": ("bsd", ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd", "revised bsd"]),
    "bsd-4-clause": ("bsd", ["bsd 4 clause", "4 clause bsd", "original bsd"]),
    "bsd": ("bsd", ["bsd", "bsd style"]),
    "0bsd": ("0bsd", ["0bsd"]),
    "gpl-2": ("gpl", ["gpl 2", "gpl 2 0 only|or?", "gpl v2", "gpl version 2", "gnu gpl version? 2"]),
    "gpl-2-long": ("gnu", ["gnu general public license version? 2", "gnu general public license v2"]),
    "gpl-3": ("gpl", ["gpl 3", "gpl 3 0 only|or?", "gpl v3", "gpl version 3", "gnu gpl version? 3"]),
    "gpl-3-long": ("gnu", ["gnu general public license version? 3", "gnu general public license v3"]),
    "gpl": ("gpl", ["gpl", "gnu gpl"]),
    "gpl-long": ("gnu", ["gnu general public license"]),
    "lgpl-2.1": ("lgpl", ["lgpl 2 1", "lgpl v2 1", "lgpl version 2 1", "gnu lgpl 2 1"]),
    "lgpl-3": ("lgpl", ["lgpl 3", "lgpl v3", "lgpl version 3", "gnu lgpl 3"]),
    "lgpl": ("lgpl", ["lgpl", "gnu lgpl"]),
    "lgpl-long": ("lesser", ["gnu lesser general public license"]),
    "agpl-3": ("agpl", ["agpl 3", "agpl v3", "agpl version 3", "gnu agpl 3"]),
    "agpl": ("agpl", ["agpl", "gnu agpl"]),
    "agpl-long": ("affero", ["gnu affero general public license", "affero general public license"]),
    "fdl": ("gnu", ["gnu free documentation license"]),
    "mpl-1.1": ("mozilla", ["mozilla public license version? 1 1"]),
    "mpl-2": ("mozilla", ["mozilla public license version? 2 0?"]),
    "mpl": ("mpl", ["mpl 2 0?", "mpl"]),
    "epl-1": ("eclipse", ["eclipse public license version? 1 0?"]),
    "epl-2": ("eclipse", ["eclipse public license version? 2 0?"]),
    "cddl": ("cddl", ["cddl 1 0?", "cddl 1 1", "cddl"]),
    "cddl-long": ("distribution", ["common development and distribution license"]),
    "cpl": ("common", ["common public license"]),
    "isc": ("isc", ["isc"]),
    "zlib": ("zlib", ["zlib", "zlib libpng"]),
    "unlicense": ("unlicense", ["unlicense", "the unlicense"]),
    "wtfpl": ("wtfpl", ["wtfpl"]),
    "artistic": ("artistic", ["artistic 2 0?", "artistic license version? 2 0?", "perl artistic"]),
    "boost": ("boost", ["boost software license version? 1 0?", "boost 1 0"]),
    "python": ("python", ["python software foundation license", "python license"]),
    "postgresql": ("postgresql", ["postgresql"]),
    "ofl": ("sil", ["sil open font license version? 1 1"]),
    "eupl": ("european", ["european union public licence|license"]),
    "openssl": ("openssl", ["openssl"]),
    "php": ("php", ["php license version? 3 01?", "php"]),
    "cc0": ("cc0", ["cc0", "cc0 1 0", "creative? commons? cc0"]),
    "cc-by": ("cc", ["cc by", "cc by 4 0", "cc by 3 0", "cc by 2 0"]),
    "cc-by-sa": ("cc", ["cc by sa", "cc by sa 4 0", "cc by sa 3 0"]),
    "cc-by-nd": ("cc", ["cc by nd", "cc by nd 4 0"]),
    "cc-by-nc": ("cc", ["cc by nc", "cc by nc 4 0", "cc by nc 3 0"]),
    "cc-by-nc-sa": ("cc", ["cc by nc sa", "cc by nc sa 4 0"]),
    "cc-by-nc-nd": ("cc", ["cc by nc nd", "cc by nc nd 4 0"]),
    "cc-by-long": ("creative", ["creative commons attribution", "creative commons attribution 4 0 international?"]),
    "cc-by-sa-long": ("creative", ["creative commons attribution share|sharealike alike?"]),
    "cc-by-nc-long": ("creative", ["creative commons attribution non|noncommercial commercial?"]),
    "cc-by-nd-long": ("creative", ["creative commons attribution no|noderivatives derivatives?|derivs?"]),
    "public-domain": ("domain", ["public domain", "dedicated to the public domain"]),
    "odbl": ("odbl", ["odbl", "odbl 1 0"]),
    "proprietary": ("reserved", ["all rights reserved"]),
}
#: Phrasings in order: (words before, words after, rank, confidence). Those before need no keyword of their own.
PHRASINGS = [
    ("spdx license|licence identifier", "", 0, 0.99),
    ("released|licensed|licenced|distributed|available|published|provided under the?|a?", "license|licence?", 1, 0.95),
    ("under the terms|conditions of the?", "license|licence?", 1, 0.95),
    ("under the?", "license|licence", 1, 0.9),
    ("license|licence", "", 2, 0.8),
    ("the?", "license|licence", 2, 0.8),
]
#: Labels whose name alone says enough; the others need a phrasing, as their names are common words.
NAMED = {"apache-1.1", "apache-2", "mpl-1.1", "mpl-2", "epl-1", "epl-2", "gpl-long", "gpl-2-long", "gpl-3-long", "lgpl-long", "agpl-long", "fdl", "cddl-long", "cpl", "boost", "ofl", "eupl", "python", "unlicense", "wtfpl", "cc-by", "cc-by-sa", "cc-by-nd", "cc-by-nc", "cc-by-nc-sa", "cc-by-nc-nd", "cc-by-long", "cc-by-sa-long", "cc-by-nc-long", "cc-by-nd-long", "cc0", "odbl", "public-domain", "proprietary"}
RANKS = 4


def pattern(words: str) -> str:
    """A regex over words that each stand between two spaces of their own."""
    out = []
    for word in words.split():
        optional, plain = word.endswith("?"), word.rstrip("?")
        body = "|".join(re.escape(w.rstrip("?")) for w in plain.split("|"))
        out.append(f"(?: (?:{body}) ){'?' * optional}" if optional or "|" in plain else f" {re.escape(plain)} ")
    return "".join(out)


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, keyword, regex, rank, confidence) in order: one of each name in each phrasing, then bare names."""
    out = []
    for label, (keyword, names) in FAMILIES.items():
        label = label.removesuffix("-long")
        any_name = "(?:" + "|".join(pattern(n) for n in sorted(names, key=len, reverse=True)) + ")"
        # A common word as a name needs the word license in every phrasing that is not a tag.
        told = lambda after: after.rstrip("?") if keyword in COMMON else after
        out += [(label, keyword, pattern(before) + any_name + pattern(told(after)), rank, sure) for before, after, rank, sure in PHRASINGS]
    for label, (keyword, names) in FAMILIES.items():
        if label in NAMED:
            out += [(label.removesuffix("-long"), keyword, pattern(n), 3, 0.6) for n in names]
    return out


#: Keywords that are common words: their rules ask for the word license, except where a name has a second word of its own.
COMMON = {"mit", "isc", "php", "python", "sil", "european", "common", "distribution", "lesser", "gnu", "creative", "cc", "domain", "reserved"}
#: Their names that stand without it: first word, second word.
PAIRS = [("cc", "by"), ("public", "domain"), ("rights", "reserved"), ("creative", "commons"), ("gnu", "gpl"), ("gnu", "general"), ("gnu", "lesser")]


def gate(text: Column, low: Column) -> Column:
    """True for every text with a base phrase or a rule's match; low is the text in lower case.

    A plain search for each keyword comes first; where it hits, a regex asks for the keyword as a word of its own.
    """
    word = r"0-9A-Za-z\x80-\x{10FFFF}"
    gap = f"[^{word}]+"
    lone = sorted({k for k, _ in FAMILIES.values()} - COMMON)
    asks = [(k, rf"(?i)(?<![{word}]){k}(?![{word}])") for k in lone] + [(b, rf"(?i)(?<![{word}]){a}{gap}{b}(?![{word}])") for a, b in PAIRS]
    out = F.contains(low, F.lit("licens")) | F.contains(low, F.lit("licenc"))
    for keyword, regex in asks:
        out = out | (F.contains(low, F.lit(keyword)) & text.rlike(regex))
    return out


def spaced(text: Column) -> Column:
    """The words of a text, lower case, each between two spaces of its own."""
    words = F.trim(F.regexp_replace(ascii_lower(text), GAP, " "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" ")))


def _count(spaced_words: Column) -> Column:
    return ((F.length(spaced_words) - F.length(F.replace(spaced_words, F.lit(" "), F.lit("")))) / 2).cast("int")


def detections(words: Column) -> Column:
    """What the rules find in spaced words: array of start, end, rank, label, confidence, in order, before suppression."""
    # As one literal, the rules are folded once instead of being hundreds of expressions to plan.
    named = json.dumps([{"label": label, "keyword": f" {k} ", "regex": regex, "rank": rank, "sure": sure} for label, k, regex, rank, sure in rules()])
    table = F.from_json(F.lit(named), "array<struct<label:string,keyword:string,regex:string,rank:int,sure:double>>")
    hit = F.transform(
        F.filter(table, lambda r: F.contains(words, r["keyword"])),
        lambda r: F.transform(places(words, r["regex"], _count), lambda p: F.struct(p["start"].alias("start"), (-p["end"]).alias("minus_end"), r["rank"].alias("rank"), r["label"].alias("label"), r["sure"].alias("sure"))),
    )
    # Equal detections follow each other once sorted.
    return let(F.sort_array(F.flatten(hit)), lambda ds: F.filter(ds, lambda d, i: (i == 0) | (d != F.get(ds, i - 1))))


def unsuppressed(found: Column) -> Column:
    """Detections that lie in no other of the same or a better rank.

    Sorted by start, the longest first, one lies in another if some before it of such a rank ends at or after its end: a running
    maximum of the ends for each rank.
    """

    def of(ds: Column) -> Column:
        left = lambda reach: F.filter(ds, lambda d, i: F.get(F.get(reach, d["rank"]), i) < -d["minus_end"])
        return let(F.array(*[running_max(_ends(ds, r)) for r in range(RANKS)]), left)

    return let(found, of)


def _ends(ds: Column, rank: int) -> Column:
    """The end of each detection of this rank or a better one, -1 for others."""
    return F.transform(ds, lambda d: F.when(d["rank"] <= rank, -d["minus_end"]).otherwise(-1))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts all places of the base phrases, first_word and last_word are the smallest and largest start of one (words from
    0, null if there is none). labels are those of base phrases and of detections left after suppression, distinct, sorted and
    comma-joined; score is the confidence of the surest. spans are the detections (start, end, label, sure). A null or empty text
    has no words. Other columns are left out, so clashing names do not matter; whole texts are scanned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("text"), F.lower(text).alias("low"))
    rows = rows.select(id_col, F.regexp_count("text", F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"), F.when(gate(F.col("text"), F.col("low")), spaced(F.col("text"))).alias("words"))
    by_phrase = F.array(*[F.struct(F.lit(label).alias("label"), places(F.col("words"), F.lit(pattern(p)), _count)["start"].alias("at")) for p, label in BASE.items()])
    rows = rows.select(id_col, "n_words", F.when(F.col("words").isNotNull(), by_phrase).alias("base"), F.when(F.col("words").isNotNull(), unsuppressed(detections(F.col("words")))).alias("found"))
    base = F.coalesce("base", F.array().cast("array<struct<label:string,at:array<int>>>"))
    found = F.coalesce("found", F.array().cast("array<struct<start:int,minus_end:int,rank:int,label:string,sure:double>>"))
    at = F.flatten(F.transform(base, lambda b: b["at"]))
    base_labels = F.transform(F.filter(base, lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    rows = rows.select(id_col, "n_words", at.alias("at"), base_labels.alias("own"), found.alias("found"))
    own_sure = F.when(F.size("own") > 0, 0.95).otherwise(0.0)
    return rows.select(
        id_col,
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("own")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("own", F.transform("found", lambda d: d["label"])))), ",").alias("labels"),
        F.greatest(own_sure, F.coalesce(F.array_max(F.transform("found", lambda d: d["sure"])), F.lit(0.0))).alias("score"),
        F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"), d["sure"].alias("sure"))).alias("spans"),
    )

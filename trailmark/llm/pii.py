"""Personal data by weak supervision, with DataFrame functions only.

Patterns give candidate spans. Three labelers vote on each (yes, no or abstain): the shape of the span, a gazetteer, and the words
before it. Votes and features of all candidates are counted by Spark; expectation-maximisation over the counts, a table of bounded
size, estimates how reliable each labeler is and how likely each pattern of votes is real, and a logistic span classifier is
trained on those likelihoods. It decides on candidates; base spans, which the base patterns and checks fix, always stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import cut_out, let, materialise, pieces, places, private, running_max

#: Kinds in order; the first four have base patterns.
KINDS = ["email", "ip", "card", "phone", "ssn", "iban", "name"]
BASE_KINDS = KINDS[:4]
#: Base patterns. Quantifiers are possessive where giving back could not help, and an email starts at the start of its run of
#: characters or where the last match ended, so a match takes time in proportion to the text.
BASE_REGEX = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE_GATE = {"email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9][\x20().0-9-]"}
#: Patterns of further candidates, with a gate each.
MORE_REGEX = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(](?i:dot)[\])]) ?[A-Za-z0-9-]{1,63}){1,8}+",
    "phone": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3} )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]{1,24}(?: [A-Z][a-z]{1,24})?(?![A-Za-z])",
}
MORE_GATE = {"email": r"[\[(](?i:at)[\])]", "phone": r"[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "name": r"(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z]"}
#: Labeler 1, shape: what a real span of the kind looks like.
SHAPE = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*(?:@| ?[\[(]).*[A-Za-z]{2,}$",
    "ip": r"^(?!0\.|10\.|127\.|255\.|192\.168\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
    "card": r"^(?:[0-9]{4}[ -]?){3,4}[0-9]{0,7}$",
    "phone": r"^\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?$",
    "name": r"^\S+ \S+ \S+$",
}
#: Labeler 2, gazetteer: endings, prefixes and names that are known (null: the kind has none).
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|it|nl|uk|eu|us|ch|at)$",
    "ip": None,
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)",
    "phone": r"^(?:\+(?:1|7|20|27|3[0-69]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9])",
    "ssn": None,
    "iban": r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE|SI|SK)",
    "name": r" (?:James|Mary|John|Anna|Robert|Maria|Michael|Laura|David|Sara|Peter|Paul|Hans|Karl|Marie|Jean|Pierre|Jose|Juan|Carmen|Luis|Thomas|Martin|Julia|Emma|Smith|Jones|Brown|Miller|Garcia|Schmidt|Dubois)(?: |$)",
}
#: Labeler 3, context: words in the characters before a span that speak for or against it.
CONTEXT_CHARS = 40
FOR = {
    "email": r"(?i)mail|contact|write|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|addr|host|server|login",
    "card": r"(?i)card|visa|master|payment|karte|tarjeta|carte",
    "phone": r"(?i)phone|tel|call|fax|mobil|anruf|llam",
    "ssn": r"(?i)ssn|social",
    "iban": r"(?i)iban|account|konto|cuenta|compte",
    "name": r"(?i)name|dear|by|signed|sehr|cher|estimad",
}
AGAINST = r"(?i)(?:version|release|v|no|nr|isbn|order|id|part|model|section|page)[ .:#]{0,3}$"
PATTERN = ["kind", "shape", "gazetteer", "context", "short", "flat"]
SPAN = "struct<start:int,end:int,kind:int,base:boolean,shape:int,gazetteer:int,context:int,short:int,flat:int>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a digit string passes Luhn's check: from the right, every second digit is doubled."""
    places_ = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places_, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    """The check of a base kind."""
    if kind == "ip":
        # Leading zeros may make a part long; its number decides.
        return ~F.exists(F.split(match, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) > 3) | (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 4).try_cast("int"), F.lit(0)) > 255))
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column) -> Column:
    return F.when(yes, 1).otherwise(-1)


def _described(cut: Column, kind: str, base: bool, p: Column) -> Column:
    """A span with its votes and features; cut is the text in pieces."""
    known = GAZETTEER[kind]
    told = lambda before: F.when(before.rlike(AGAINST), -1).when(before.rlike(FOR[kind]), 1).otherwise(0)
    context = let(cut_out(cut, F.greatest(p["start"] - CONTEXT_CHARS, F.lit(0)), p["start"]), told)
    return F.struct(
        p["start"].alias("start"),
        p["end"].alias("end"),
        F.lit(KINDS.index(kind)).alias("kind"),
        F.lit(base).alias("base"),
        _vote(p["match"].rlike(SHAPE[kind])).alias("shape"),
        (_vote(p["match"].rlike(known)) if known else F.lit(0)).alias("gazetteer"),
        context.alias("context"),
        (F.length(p["match"]) < 12).cast("int").alias("short"),
        p["match"].rlike(r"([0-9])[ .-]?(?:\1[ .-]?){6}").cast("int").alias("flat"),
    ).cast(SPAN)


def _matches(text: Column) -> list[tuple[str, bool, Column]]:
    """Of each kind, what the base pattern finds and holds, and what the further pattern finds: null where the gate is shut."""
    held = lambda kind: F.filter(places(text, F.lit(BASE_REGEX[kind])), lambda p: _holds(kind, p["match"]))
    return [(k, True, F.when(text.rlike(BASE_GATE[k]), held(k))) for k in BASE_KINDS] + [(k, False, F.when(text.rlike(MORE_GATE[k]), places(text, F.lit(MORE_REGEX[k])))) for k in MORE_REGEX]


def _lone(spans: Column) -> Column:
    """Spans without those that overlap a base span and are none themselves.

    In order of their starts, a span overlaps a base span before it if one of those ends after its start, and one after it if the
    first of those starts before its end: two running maxima, one of them from the back.
    """
    far = (1 << 31) - 2

    def of(spans: Column) -> Column:
        reach = running_max(F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(-1)))
        after = F.reverse(running_max(F.reverse(F.transform(spans, lambda s: F.when(s["base"], far - s["start"]).otherwise(-1)))))
        clear = F.zip_with(reach, after, lambda r, a: F.struct(r.alias("ends"), (F.lit(far) - a).alias("starts")))
        both = F.zip_with(spans, clear, lambda s, c: F.struct(s.alias("s"), (s["base"] | ((c["ends"] <= s["start"]) & (c["starts"] >= s["end"]))).alias("stays")))
        return F.transform(F.filter(both, lambda b: b["stays"]), lambda b: b["s"])

    # Base spans come first of those with the same start and end, so the order decides nothing else.
    return F.when(F.exists(spans, lambda s: ~s["base"]) & F.exists(spans, lambda s: s["base"]), let(F.sort_array(spans), of)).otherwise(spans)


def with_candidates(docs: DataFrame, text_col: str, spans_col: str) -> DataFrame:
    """docs with spans_col, all candidate spans of the text: base spans, and others that overlap no base span."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    matches, cut = private("matches"), private("cut")
    found = _matches(text)
    kept = docs.withColumn(matches, F.struct(*[m.alias(f"m{i}") for i, (_, _, m) in enumerate(found)]))
    some = F.lit(False)
    for i in range(len(found)):
        some = some | (F.size(F.col(matches)[f"m{i}"]) > 0)
    kept = kept.withColumn(cut, F.when(some, pieces(text)))
    none = F.array().cast(f"array<{SPAN}>")
    described = lambda i, kind, base: F.transform(F.col(matches)[f"m{i}"], lambda p: _described(F.col(cut), kind, base, p))
    told = [F.coalesce(described(i, k, base), none) for i, (k, base, _) in enumerate(found)]
    return kept.withColumn(spans_col, F.when(some, F.concat(*told)).otherwise(none)).withColumn(spans_col, _lone(F.col(spans_col))).drop(matches, cut)


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier, and how reliable each labeler was found: P(vote | real), P(vote | not) for no, abstain, yes."""

    weights: tuple[float, ...]
    reliability: tuple[tuple[tuple[float, ...], ...], ...]

    def keeps(self, s: Column) -> Column:
        terms = [F.lit(self.weights[0])] + [F.lit(w) * x.cast("double") for w, x in zip(self.weights[1:], _features(s), strict=True)]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total >= 0.0


def _features(s: Column) -> list[Column]:
    ones = [(s["kind"] == k).cast("int") for k in range(len(KINDS))]
    votes = [(s[v] == x).cast("int") for v in ("shape", "gazetteer", "context") for x in (-1, 1)]
    return [*ones, *votes, s["short"], s["flat"]]


def _row_features(row: tuple) -> list[float]:
    kind, *votes, short, flat = row
    return [1.0, *[float(kind == k) for k in range(len(KINDS))], *[float(v == x) for v in votes for x in (-1, 1)], float(short), float(flat)]


def fit(spans: DataFrame, spans_col: str, rounds: int = 50) -> Model:
    """Model from a frame with candidate spans. Every candidate of every text counts.

    What is brought to the driver is one count per kind, votes and features: at most 7 * 27 * 4 rows at any size.
    """
    counted = spans.select(F.explode(spans_col).alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in PATTERN]).count().orderBy(*PATTERN).collect()
    rows, n = [tuple(r[:-1]) for r in counted], np.array([r[-1] for r in counted], float)
    # Without candidates the priors below stand.
    votes = np.array([r[1:4] for r in rows], int).reshape(-1, 3) + 1
    kinds = np.array([r[0] for r in rows], int)
    prior = np.array([[[0.1, 0.2, 0.7], [0.6, 0.3, 0.1]]] * 3)  # labeler, real or not, vote
    table, share = prior.copy(), np.full(len(KINDS), 0.5)
    real = np.zeros(len(rows))
    for _ in range(rounds):
        like = [share[kinds] if y == 0 else 1 - share[kinds] for y in (0, 1)]
        for j in range(3):
            like = [like[y] * table[j, y, votes[:, j]] for y in (0, 1)]
        real = like[0] / np.maximum(like[0] + like[1], 1e-300)
        for k in range(len(KINDS)):
            at = kinds == k
            share[k] = (n[at] @ real[at] + 1) / (n[at].sum() + 2)
        for j in range(3):
            for y, w in ((0, real), (1, 1 - real)):
                got = np.array([n[votes[:, j] == v] @ w[votes[:, j] == v] for v in range(3)]) + 20 * prior[j, y]
                table[j, y] = got / got.sum()
    weights = _logistic(np.array([_row_features(r) for r in rows]).reshape(-1, 1 + len(KINDS) + 8), real, n)
    return Model(tuple(weights.tolist()), tuple(tuple(tuple(v) for v in j) for j in table.tolist()))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    n = n / max(1.0, n.sum()) * min(n.sum(), 10_000.0)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (n * (y - p)) - w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(id_col, spans: array of start, end, kind (index in KINDS), base): personal data of each row, whole texts.

    Spans are in code points, the end exclusive, ordered by start, then kind. Base spans always stay; further ones where the
    classifier says so. A null or empty text has none. Other columns are left out; repeated rows return once each. Without a
    model one is fitted to docs. An empty table gives an empty result. The work grows with the text and its matches.
    """
    found = private("spans")
    spans = materialise(with_candidates(docs.select(id_col, text_col), text_col, found).select(id_col, found), "spans")
    model = model or fit(spans, found)
    return spans.select(id_col, _kept(F.col(found), model).alias("spans"))


def _kept(spans: Column, model: Model) -> Column:
    kept = F.filter(spans, lambda s: s["base"] | model.keeps(s))
    return F.sort_array(F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """docs with each span in the text replaced by its kind in angle brackets; overlapping spans become the first one's kind.

    Null and empty texts, repeated rows and all other columns, whatever their names, stay as they are; an empty table gives an
    empty result. Without a model one is fitted to docs.
    """
    found, kept, cut = private("spans"), private("kept"), private("cut")
    spans = materialise(with_candidates(docs, text_col, found), "spans")
    model = model or fit(spans, found)
    text, names = F.col(text_col), F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def whole(of: Column) -> Column:
        reach = lambda upto: F.transform(upto, lambda r: F.greatest(r, F.lit(0)))
        put = lambda s, r: F.when(s["start"] >= r, F.concat(cut_out(F.col(cut), r, s["start"]), F.get(names, s["kind"]))).otherwise("")
        body = F.array_join(F.zip_with(of, reach(running_max(F.transform(of, lambda s: s["end"]))), put), "")
        return F.concat(body, cut_out(F.col(cut), F.array_max(F.transform(of, lambda s: s["end"])), F.length(text)))

    out = spans.withColumn(kept, _kept(F.col(found), model)).withColumn(cut, F.when(F.size(kept) > 0, pieces(text)))
    return out.withColumn(text_col, F.when(F.size(kept) > 0, whole(F.col(kept))).otherwise(text)).select(*docs.columns)

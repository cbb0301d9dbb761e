"""Chat formatting with typed content parts, by DataFrame functions only.

A turn holds ordered parts: text, image, audio or document. A visitor over the parts writes text as it is, escaped, and a
placeholder for any other part, and records each attachment with its reference, place and expanded number of tokens. A
conversation becomes one string of marked turns, and the spans of the assistant's texts in it are the loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.shared import cut_out, let, pieces, running_sum

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that one unit of an attachment becomes: an image's patches, an audio's seconds, a document's pages.
TOKENS_A_UNIT = {"image": 1, "audio": 25, "document": 500}
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    """Text in which no control string can begin; & is the escape character."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def _inner(text: Column) -> Column:
    """An escaped text that another part follows: a `<` at its end is escaped too, so that no control string begins across parts."""
    return F.regexp_replace(escape(text), r"<\z", "&lt;")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """A plain text as its one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def visit(parts: Column) -> tuple[Column, Column]:
    """Body and attachments of a turn's parts. A part of an unknown or null kind is text; null units count as one."""
    media = list(TOKENS_A_UNIT)
    rate = F.create_map(*[F.lit(x) for kv in TOKENS_A_UNIT.items() for x in kv])
    known = lambda p: F.coalesce(p["kind"].isin(media), F.lit(False))
    text = lambda p, i: F.when(i < F.size(parts) - 1, _inner(p["text"])).otherwise(escape(p["text"]))
    body = F.array_join(F.transform(parts, lambda p, i: F.when(known(p), F.concat(F.lit("<|"), p["kind"], F.lit("|>"))).otherwise(text(p, i))), "")
    attached = F.transform(F.filter(parts, known), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), (F.coalesce(p["units"], F.lit(1)) * rate[p["kind"]]).cast("bigint").alias("tokens")))
    return body, attached


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str | None = None, text_col: str = "text") -> DataFrame:
    """One row a conversation: conv_col, n_turns, formatted, loss_mask (array of start and length in code points), attachments.

    Turns are ordered by turn_col, nulls first, then role and body, so ties have one order; repeated rows are turns each. A null
    text is empty and a null role is the empty role; a null conv_id is a conversation of its own. Other columns are left out.
    A conversation is one string by its nature, so its turns meet in one row; conversations are spread over all tasks.
    """
    parts = F.col(parts_col) if parts_col else text_parts(F.col(text_col))
    body, attached = visit(F.coalesce(parts, F.array().cast(f"array<{PART}>")))
    rows = turns.select(F.col(conv_col), F.struct(F.col(turn_col).alias("turn"), _escape_role(F.col(role_col)).alias("role"), body.alias("body"), attached.alias("attached")).alias("t"))
    grouped = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("t"))
    return _assembled(grouped, conv_col)


def _assembled(grouped: DataFrame, conv_col: str) -> DataFrame:
    piece = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["body"], F.lit(END + "\n"))
    grouped = grouped.withColumn("formatted", F.array_join(F.transform("t", piece), ""))
    lengths = F.transform("t", lambda t: F.struct(F.length(piece(t)).alias("all"), (F.lit(len(START) + 1) + F.length(t["role"])).alias("head"), F.length(t["body"]).alias("body"), (t["role"] == "assistant").alias("own")))
    span = lambda at, n: F.struct((at + n["head"]).alias("start"), n["body"].alias("length"), n["own"].alias("own"))
    spans = let(lengths, lambda ns: F.zip_with(running_sum(F.transform(ns, lambda n: n["all"])), ns, span))
    walked = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    placed = F.flatten(F.transform("t", lambda t, i: F.transform(t["attached"], lambda a: F.struct(i.alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return grouped.select(conv_col, F.size("t").cast("long").alias("n_turns"), "formatted", walked.alias("loss_mask"), placed.alias("attachments"))


def _turns(formatted: Column, read) -> Column:
    """read(role, body) of each turn of a formatted conversation, both still escaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    cut = lambda p: F.substring_index(p, "\n", 1)
    body = lambda p: F.substr(p, F.length(cut(p)) + 2, F.length(p) - F.length(cut(p)) - 1 - F.lit(len(END) + 1))
    return F.transform(pieces, lambda p: read(cut(p), body(p)))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and text, unescaped; placeholders stay in the text."""
    return _turns(formatted, lambda role, body: F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text")))


def read_parts(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role and parts (kind, text), so that a placeholder is told from a text that says it.

    Neighbouring texts are one part, and empty ones none.
    """
    placeholder = rf"<\|({'|'.join(TOKENS_A_UNIT)})\|>"
    text = lambda t: F.struct(F.lit("text").alias("kind"), unescape(t).alias("text"))
    media = lambda k: F.struct(k.alias("kind"), F.lit(None).cast("string").alias("text"))
    both = lambda t, k: F.when(k.isNull(), F.array(text(t))).otherwise(F.array(text(t), media(k)))
    parts = lambda body: F.flatten(F.zip_with(F.split(body, placeholder, -1), F.regexp_extract_all(body, F.lit(placeholder), F.lit(1)), both))
    some = lambda body: F.filter(parts(body), lambda p: (p["kind"] != "text") | (F.length(p["text"]) > 0))
    return _turns(formatted, lambda role, body: F.struct(_unescape_role(role).alias("role"), some(body).alias("parts")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(let(pieces(formatted), lambda of: F.transform(mask, lambda s: unescape(cut_out(of, s["start"], s["start"] + s["length"])))), "")

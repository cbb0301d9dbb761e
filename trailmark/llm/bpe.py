"""BPE encoding and decoding of text columns.

Each word is merged with a priority queue of merge ranks over a doubly linked list of symbols; entries whose symbols have
changed since they were queued are stale and skipped. Decoding looks the ids up in the vocabulary and joins their strings.
A task handles its rows alone, so there is no shuffle; distinct words are encoded once per worker while a bounded cache holds.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from trailmark.llm.shared import flushed, held

#: White space of the tokenizer's pattern (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CACHE_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """A word-level BPE tokenizer of the `tokenizers` JSON format: NFC, lower case, words, bytes, word-end suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback"):
            raise ValueError("only BPE models without an unknown token are handled")
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab = vocab
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if a in vocab and b in vocab:
                self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]")
        self.words_of = regex.compile(pattern).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.spaces = re.compile(f"[{SPACE}]+")
        self.odd = re.compile("[\x1c-\x1f]")
        self.byte = byte_symbols()
        self.cache = _Chunks(self)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge symbols: the queue gives the lowest rank, then the leftmost place."""
        n = len(ids)
        if n < 2:
            return ids
        get = self.merges.get
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, at, left, right, new = heapq.heappop(queue)
            follow = after[at]
            if ids[at] != left or follow < 0 or ids[follow] != right:
                continue  # stale: one of the two has been merged away since
            ids[at], ids[follow] = new, -1
            after[at] = after[follow]
            if after[at] >= 0:
                before[after[at]] = at
                if m := get((new, ids[after[at]])):
                    heapq.heappush(queue, (m[0], at, new, ids[after[at]], m[1]))
            if (prev := before[at]) >= 0 and (m := get((ids[prev], new))):
                heapq.heappush(queue, (m[0], prev, ids[prev], new, m[1]))
        return [i for i in ids if i >= 0]

    def word_ids(self, word: str) -> list[int]:
        symbols = [self.byte[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.suffix
        return self.merge([i for s in symbols if (i := self.vocab.get(s)) is not None])

    def packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.cut is None or "<" not in text:
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join(struct.pack("<I", self.special[p]) if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        # A capital sigma is lowered alone, never to its form at a word's end.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        chunks = self.spaces.split(text) if self.odd.search(text) else text.split()
        return b"".join(map(self.cache.__getitem__, chunks))

    def decode(self, packed: bytes) -> str:
        """Vocabulary strings of the ids, joined with a space as the format without a decoder says."""
        return " ".join(map(self.strings.__getitem__, struct.unpack(f"<{len(packed) // 4}I", packed)))


class _Chunks(dict):
    """Packed ids of strings without white space; emptied when it holds CACHE_WORDS."""

    def __init__(self, model: WordBpe):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> bytes:
        ids = [i for w in self.model.words_of(chunk) for i in self.model.word_ids(w)]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(chunk) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[chunk] = packed
        return packed


def model(path: str) -> WordBpe:
    """The tokenizer with the words it has met, held by the worker until tasks of another operator need the memory."""
    return held(("bpe", path), lambda: WordBpe(path))


def encode_decode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """Encode whole texts and decode them again.

    Returns id_col, n_tokens (long), ids (binary: little-endian unsigned 32-bit integers) and, if asked for, decoded (string).
    A null text counts as empty: no tokens, an empty decoded string. A null id stays null; repeated rows give repeated
    results; other columns are left out, so clashing names do not matter; an empty table gives an empty result. Texts of any
    length are encoded whole; a word of n symbols costs O(n log n). tokenizer_path names the JSON file on every worker.
    """
    kind = df.schema[id_col].dataType
    fields = [T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, schema = model(tokenizer_path), None

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                packed = bpe.packed(text.as_py() or "")
                yield (key.as_py(), len(packed) // 4, packed, bpe.decode(packed))[: 3 + decoded]

        for batch in batches:
            if schema is None:
                schema = pa.schema([pa.field(id_col, batch.schema.field(0).type), pa.field("n_tokens", pa.int64()), pa.field("ids", pa.binary())] + [pa.field("decoded", pa.string())] * decoded)
            yield from flushed(rows(batch), schema, lambda r: len(r[2]) + len(r[-1]))

    return df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))

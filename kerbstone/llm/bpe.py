"""Byte-level BPE over Arrow batches with the tokenizers library.

A text is split by the public pattern; a piece's bytes are written as the
vocabulary's characters, one for each byte, and the library's model merges
them. Pieces repeat, so each worker remembers a bounded number of them.
Decoding reverses the byte table; a token may hold a part of a character only,
so bytes are joined before they are read as text.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbstone.llm.batches import with_text_columns

VOCABULARY = "byte_bpe_50k.json"
#: Pieces that a worker remembers.
REMEMBERED = 100_000
#: Characters of a text that are encoded at once.
PART_CHARS = 1 << 20

# White space as the pattern's engine sees it, for a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others, in order, get the
    characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


@functools.cache
def piece_pattern(pattern: str = public_tokenizers.PATTERN) -> re.Pattern:
    r"""The public pattern for ``re``, which has no ``\p`` classes and a wider ``\s``.

    ``\w`` is letters, numbers and the underscore; the numbers that are not
    decimal digits are spelt out as ranges.
    """
    other = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nl", "No")]
    ranges = []
    for c in other:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    numbers = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
    made = (
        pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^{WHITE}\w]|_)")
        .replace(r"\p{L}", rf"[^\W\d_{numbers}]")
        .replace(r"\p{N}", rf"[\d{numbers}]")
        .replace(r"\s", f"[{WHITE}]")
        .replace(r"\S", f"[^{WHITE}]")
    )
    return re.compile(made)


class Codec:
    """One worker's tokenizer, its byte table and the pieces it remembers."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        self.pieces = piece_pattern()
        self.character = {b: c for b, c in enumerate(byte_characters())}
        byte = {c: b for b, c in self.character.items()}
        vocabulary = tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(byte[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def _encode_piece(self, piece: str) -> bytes:
        shown = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.character)
        ids = array("i", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(piece) <= 64:
            if len(self.known) >= self.remembered:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def parts(self, text: str):
        """Parts of a long text; each but the first begins with the white space it is cut at.

        A match never goes on from a character that is not white space into
        one that is, so parts split as the whole does.
        """
        at = 0
        while len(text) - at > PART_CHARS:
            cut = self._cut.search(text, at + PART_CHARS)
            if not cut:
                break
            yield text[at:cut.start() + 1]
            at = cut.start() + 1
        yield text[at:] if at else text

    _cut = re.compile(rf"[^{WHITE}](?=[{WHITE}])")

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text``, without special tokens."""
        known, encode = self.known, self._encode_piece
        out = []
        for part in self.parts(text):
            found = self.pieces.findall(part)
            try:
                out.append(b"".join(map(known.__getitem__, found)))
            except KeyError:
                out.append(b"".join([known[p] if p in known else encode(p) for p in found]))
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode_all(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each list of ids, all lists of a batch at once."""
        ids = pc.fill_null(ids, [])
        values = ids.flatten().to_numpy(zero_copy_only=False)
        if len(values) and values.min() < 0:
            raise ValueError("an id is negative")
        lengths = self.lengths[values]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[values] - ends[:-1], lengths) + np.arange(ends[-1])
        sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
        rows = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)].astype(np.int32)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(rows), pa.py_buffer(self.flat[at])]
        )

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last character of each token.

        A token that holds only a part of a character counts the whole of it.
        """
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return character[ends - lengths], character[ends - 1] + 1


@functools.cache
def codec(path: str) -> Codec:
    """This process's codec for a vocabulary file."""
    return Codec(path)


def encode(
    docs: DataFrame,
    text_col: str = "text",
    path: str | None = None,
    offsets: bool = False,
    check: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs``: ``keep, n_tokens, ids``, with ``offsets`` also ``starts, ends``.

    With ``check`` the ids are decoded in the same pass, and ``restored`` says
    whether they give the text back.

    ``ids`` are as the tiktoken library would give them for the same ranks; a
    special token's text is ordinary text. ``starts`` and ``ends`` count
    characters. A null or empty text has no ids. ``path`` is the vocabulary
    file, the same on each machine. ``keep`` are the columns passed on (all by
    default, but for those with one of the new names).
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(texts: list[str]) -> dict[str, list]:
        tokens = codec(path)
        ids = [tokens.encode(t) for t in texts]
        counts = [len(i) for i in ids]
        lists = pa.ListArray.from_arrays(np.cumsum([0, *counts]).astype(np.int32), np.concatenate(ids))
        out = {"n_tokens": counts, "ids": lists}
        if check:
            back = tokens.decode_all(lists).to_pylist()
            out["restored"] = [b == t.encode("utf-8", "surrogatepass") for b, t in zip(back, texts)]
        if offsets:
            places = [tokens.offsets(t, i) for t, i in zip(texts, ids)]
            out |= {"starts": [p[0] for p in places], "ends": [p[1] for p in places]}
        return out

    types = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}
    if check:
        types["restored"] = T.BooleanType()
    if offsets:
        types |= {"starts": T.ArrayType(T.IntegerType()), "ends": T.ArrayType(T.IntegerType())}
    return with_text_columns(docs, text_col, run, types, keep)


def decode(
    encoded: DataFrame,
    ids_col: str = "ids",
    path: str | None = None,
    text: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``encoded``: ``keep, decoded`` (bytes), with ``text`` also ``decoded_text``.

    Null ids decode to nothing. Bytes that are no whole character, as when
    ``ids`` are a part of a text's, read as U+FFFD in ``decoded_text``; in
    ``decoded`` they are as they were. An id beyond the vocabulary is an error.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(ids: pa.ListArray) -> dict[str, pa.Array]:
        data = codec(path).decode_all(ids)
        out = {"decoded": data}
        if text:
            shown = [(d or b"").decode("utf-8", "replace") for d in data.to_pylist()]
            out["decoded_text"] = pa.array(shown, pa.string())
        return out

    types = {"decoded": T.BinaryType()} | ({"decoded_text": T.StringType()} if text else {})
    return with_text_columns(encoded, ids_col, run, types, keep, raw=True)

"""Token ids of whole texts by a public tokenizer, remembered by chunk and piece.

A text is cut at its spaces, and a chunk keeps the space before it. No token
reaches over such a cut: both kinds of tokenizer here begin a new piece at a
space unless white space stands on both sides of the place, and texts with such
a place are encoded whole. The ids of a text are thus those of its chunks in
order. Chunks repeat a lot, so each worker remembers the ids of up to
``CHUNKS`` chunks (or as many as it is given) and ``PIECES`` pieces; a word with a mark after it is the word
and the mark, and pieces are encoded by the library's model. Anything unusual goes to the library's whole encoder.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNKS, PIECES, CHUNK_CHARS, TEXTS = 600_000, 100_000, 64, 256
#: White space on both sides of a cut.
_UNSURE = re.compile(r"[^\S ] (?:\s|\Z)|  (?:\s|\Z)")
_AFTER = re.compile(r" (?:\s|\Z)")
#: Fixed value: how byte-level tokenizers cut text into pieces.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: marks that no pattern joins with the word before.
_MARKS = frozenset(".,;:!?")
_LATIN = re.compile("[\0-įı-ɏ]*")


def _byte_names() -> dict[int, str]:
    """The character by which byte-level tokenizers name each byte: itself if it shows, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_NAMES = str.maketrans(_byte_names())
_SPACE = _byte_names()[0x20]


class _Memory(dict):
    """Remembers what ``make`` gives for a key, in two generations of half of ``most`` keys: when the young one is full
    it becomes the old one, and what is met again in the old one is young again."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CHUNK_CHARS:
            if len(self) >= self.most // 2:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, chunks: int = CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        cutter = form["pre_tokenizer"]
        self.lower = form["normalizer"] is not None
        self.before = " " if cutter["type"] == "ByteLevel" else ""
        self.cut = regex.compile(_PIECES if cutter["type"] == "ByteLevel" else cutter["pretokenizers"][0]["pattern"]["Regex"])
        self.pieces = _Memory(self._piece, PIECES)
        self.chunks = _Memory(self._chunk, chunks)
        self.heads = _Memory(self._whole, PIECES)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            named = piece  # every byte names itself
        elif piece[:1] == " " and piece.isascii() and piece[1:].isalpha():
            named = _SPACE + piece[1:]
        else:
            named = piece.encode().decode("latin-1").translate(_NAMES)
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model.tokenize(named)])

    def _chunk(self, chunk: str) -> bytes:
        # A word, or a word and a mark, is the usual chunk; all pieces' patterns agree on its pieces.
        core = chunk[:-1] if chunk[-1:] in _MARKS else chunk
        if core.isalpha() and (core.isascii() or _LATIN.fullmatch(core)):
            if core is not chunk:
                return self.chunks[core] + self.pieces[chunk[-1]]
            small = chunk.lower() if self.lower else chunk
            return self.chunks[small] if small != chunk else self._piece(self.before + chunk)
        text = " " + chunk
        if self.lower:
            if not _LATIN.fullmatch(text):
                return self._whole(text)
            text = unicodedata.normalize("NFC", text).lower()
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.cut.findall(text)])

    def encode(self, text: str) -> bytes:
        if _UNSURE.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        chunks = self.chunks
        return self._whole(first) + b"".join([chunks[c] for c in rest])

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """What ``encode`` gives for each text; a null text is empty. A chunk is looked up once for all texts that have it."""
        heads, rests = [], []
        for text in texts.to_pylist():
            if text is None:
                head, rest = b"", None
            elif _AFTER.search(text) and _UNSURE.search(text):
                head, rest = self._whole(text), None
            else:
                first, space, rest = text.partition(" ")
                head, rest = self.heads[first], rest if space else None
            heads.append(head)
            rests.append(rest)
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        ids = [self.chunks[c] for c in coded.dictionary.to_numpy(zero_copy_only=False)]
        size, flat = np.fromiter(map(len, ids), np.int64, len(ids)) // 4, np.frombuffer(b"".join(ids), "<u4")
        chunk = coded.indices.to_numpy()
        long = size[chunk]
        end = np.cumsum(long)
        every = flat[np.repeat((np.cumsum(size) - size)[chunk] - (end - long), long) + np.arange(long.sum())]
        text_end = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        edge, raw = 4 * np.concatenate([[0], end])[np.concatenate([[0], text_end])], every.tobytes()
        return [head + raw[edge[i]: edge[i + 1]] for i, head in enumerate(heads)]


@cache
def _encoder(path: str, chunks: int = CHUNKS) -> Encoder:
    return Encoder(path, chunks)


def token_ids(text: Column, path: str, end: int) -> Column:
    """Binary of the ids of each text and the end id after them; a null text is empty.

    ``path`` names a tokenizer file that every executor has, as part of its image.
    """
    last = np.array([end], "<u4").tobytes()

    def encode(column: pa.Array) -> pa.Array:
        encoder, out = _encoder(path), []
        for low in range(0, len(column), TEXTS):
            out += [encoder.encode(t or "") + last for t in column.slice(low, TEXTS).to_pylist()]
        return pa.array(out, pa.binary())

    return F.arrow_udf(encode, "binary")(F.coalesce(text, F.lit("")))

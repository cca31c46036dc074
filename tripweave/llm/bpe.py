"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets.

``Vocabulary`` reads a tokenizer file and holds the tables: an Aho-Corasick automaton over
all tokens gives the longest token at each place; ``prefix`` names the next shorter token
that starts a token; ``first`` and ``second`` are the parts a token was merged from. ``Vocabulary.encode``
takes the longest match, goes back to a shorter one where the pair of neighbours could not
both be left by the merges (``compatible``), and never visits a dead place twice. That gives
exactly the tokens of the merge rules, in time linear in the text. Tokens go out as packed
little-endian unsigned 32-bit integers.

No row is shuffled, and no text is cut: a task holds one Arrow batch and tables of a fixed
size. Defined results: a null text is encoded as an empty one (no token, empty bytes); null
bytes decode to an empty text; all input columns are kept and the new column gets another
name if its name is taken; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.frames import free_name

WORD_END = "</w>"
#: Shift of a character that ends a word, above all characters of the byte alphabet.
ENDS = 0x1000
#: Whether array("I") is already in the order of the packed tokens.
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Encoded words a worker remembers before it starts anew.
REMEMBERED = 150_000
#: The separators that the file's patterns call white space, and its words.
SPACES = "\t\n\v\f\r \x85\xa0  -     　"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte value."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def _key(token: str) -> str:
    """One character per symbol: a word end becomes part of the last character."""
    if len(token) > len(WORD_END) and token.endswith(WORD_END):
        body = token[: -len(WORD_END)]
        return body[:-1] + chr(ord(body[-1]) + ENDS)
    return token


def _remember(known: dict[str, bytes], word: str, packed: bytes) -> None:
    if len(known) >= REMEMBERED:
        known.clear()
    if len(word) <= 64:
        known[word] = packed


class Vocabulary:
    """Tables of one tokenizer file; ids must rise with the order of the merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {_key(t): i for t, i in model["vocab"].items() if t not in self.special}
        n_ids = max(model["vocab"].values()) + 1
        self.merged: dict[int, int] = {}  # by left id, shifted, and right id
        self.first, self.second = [-1] * n_ids, [-1] * n_ids
        for left, right in model["merges"]:
            a, b = ids[_key(left)], ids[_key(right)]
            whole = ids[_key(left) + _key(right)]
            self.merged[a << 20 | b] = whole
            self.first[whole], self.second[whole] = a, b
        self.length = {i: len(t) for t, i in ids.items()}
        usable = {t: i for t, i in ids.items() if len(t) == 1 or self.first[i] >= 0}
        self.automaton = ahocorasick.Automaton()
        for token, i in usable.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.prefix = {}
        for token, i in usable.items():
            n = len(token) - 1
            while n and token[:n] not in usable:
                n -= 1
            self.prefix[i] = usable[token[:n]] if n else None
        self._pairs: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._packed: dict[str, bytes] = {}
        self._alphabet = dict(enumerate(byte_alphabet()))
        self._gaps = re.compile(f"[{SPACES}]+")
        self._pieces = regex.compile(PIECES)
        marks = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self._special = re.compile(f"({marks})") if marks else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges can leave ``left`` and ``right`` side by side.

        Undoes the merges of both from the last one back. A pair that faces each other across
        the border and merges before the merge just undone would have been joined first.
        """
        merged, first, second = self.merged, self.first, self.second
        a, b, before, good = left, right, 1 << 32, True
        while True:
            if merged.get(a << 20 | b, before) < before:
                good = False
                break
            if first[b] < 0 and first[a] < 0:
                break
            if first[b] < 0 or (a > b and first[a] >= 0):
                before, a = a, second[a]
            else:
                before, b = b + 1, first[b]  # at equal rank the left merge comes first
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        self._pairs[left << 20 | right] = good
        return good

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one word, given in the byte alphabet with its last character shifted."""
        scan, length, prefix = self.automaton.iter_long, self.length, self.prefix
        pairs, compatible = self._pairs, self.compatible
        alive = bytearray(b"\1") * (len(piece) + 1)
        tokens: list[int] = []
        at, last, whole = 0, -1, len(piece)
        matches = scan(piece)  # longest matches, each where the one before it ends
        token = next(matches)[1]
        while token is not None:
            longest = token
            while token is not None:
                end = at + length[token]
                if alive[end]:
                    if last < 0:
                        break
                    good = pairs.get(last << 20 | token)
                    if good or (good is None and compatible(last, token)):
                        break
                token = prefix[token]
            if token is not None:
                tokens.append(token)
                at, last = end, token
                if at == whole:
                    break
                if token != longest:
                    matches = scan(piece, at)
                token = next(matches)[1]
            else:
                alive[at] = 0
                token = tokens.pop()
                at -= length[token]
                last = tokens[-1] if tokens else -1
        return tokens

    def _words(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # str.split() takes these for gaps
            return [w for w in self._gaps.split(text) if w]
        return text.split()

    def encode_word(self, word: str) -> bytes:
        plain = word if word.isascii() else unicodedata.normalize("NFC", word)
        plain = plain.lower() if plain.isascii() else "".join(c.lower() for c in plain)
        if plain.isascii() and plain.isalpha():
            return self.pack(plain)
        return b"".join(map(self.pack, self._pieces.findall(plain)))

    def pack(self, piece: str) -> bytes:
        """The packed tokens of one piece of a word, remembered for the next time."""
        known = self._packed.get(piece)
        if known is None:
            key = piece
            if not (piece.isascii() and piece.isprintable()):
                key = piece.encode().decode("latin-1").translate(self._alphabet)
            ids = self.encode_piece(key[:-1] + chr(ord(key[-1]) + ENDS))
            known = array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()
            _remember(self._packed, piece, known)
        return known

    def encode(self, text: str) -> bytes:
        """All tokens of a text, packed."""
        parts = self._special.split(text) if self._special and "<|" in text else [text]
        known, out = self._known, []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for word in self._words(part):
                packed = known.get(word)
                if packed is None:
                    packed = self.encode_word(word)
                    _remember(known, word, packed)
                out.append(packed)
        return b"".join(out)


class Spelling:
    """The texts of all tokens in one buffer, each followed by a space, and where they start."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = [b" "] * (max(ids.values()) + 1)
        for token, i in ids.items():
            names[i] = f"{token} ".encode()
        self.data = np.frombuffer(b"".join(names), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(n) for n in names])])

    def decode(self, packed: bytes) -> str:
        """The token texts joined by spaces, cut from one buffer by its offset table."""
        ids = np.frombuffer(packed, dtype="<u4")
        if not len(ids):
            return ""
        parts = []
        for first in range(0, len(ids), 1 << 16):  # indices of a bounded number of tokens
            some = ids[first : first + (1 << 16)]
            starts = self.offsets[some]
            n = self.offsets[some + 1] - starts
            ends = np.cumsum(n)
            index = np.arange(ends[-1]) + np.repeat(starts - (ends - n), n)
            parts.append(self.data[index].tobytes())
        return b"".join(parts)[:-1].decode()


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """The tables of a file, once per Python worker."""
    return Vocabulary(path)


@lru_cache(maxsize=1)
def spelling(path: str) -> Spelling:
    return Spelling(path)


def shorter(batches: Iterator[pd.Series], rows: int = 500) -> Iterator[pd.Series]:
    """The batches in parts, so that only the results of a part are held at once."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.iloc[first : first + rows]


def encode(docs: DataFrame, path: str, text: str = "text", name: str = "tokens") -> DataFrame:
    """``docs`` with the packed tokens of ``text``; ``path`` must exist on every executor."""

    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = vocabulary(path)
        for texts in shorter(batches):
            yield pd.Series([tables.encode(t) for t in texts], dtype=object)

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.withColumn(free_name(docs, name), packed(body))


def decode(docs: DataFrame, path: str, tokens: str = "tokens", name: str = "decoded") -> DataFrame:
    """``docs`` with the text that the packed tokens stand for."""

    @F.pandas_udf("string")
    def plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = spelling(path)
        for packed in shorter(batches):
            yield pd.Series([tables.decode(p) for p in packed], dtype=object)

    body = F.coalesce(F.col(f"`{tokens}`"), F.lit(b""))
    return docs.withColumn(free_name(docs, name), plain(body))


def round_trip(
    docs: DataFrame,
    path: str,
    text: str = "text",
    tokens: str = "tokens",
    decoded: str = "decoded",
) -> DataFrame:
    """``encode`` and ``decode`` in one pass, with half as many Python workers to hold tables."""

    @F.pandas_udf("struct<tokens:binary,decoded:string>")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words, names = vocabulary(path), spelling(path)
        for texts in shorter(batches):
            packed = [words.encode(t) for t in texts]
            yield pd.DataFrame({"tokens": packed, "decoded": [names.decode(p) for p in packed]})

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    work = free_name(docs, "_coded")
    coded = docs.withColumn(work, both(body))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return coded.select(
        *columns,
        F.col(work)["tokens"].alias(free_name(docs, tokens)),
        F.col(work)["decoded"].alias(free_name(docs, decoded)),
    )

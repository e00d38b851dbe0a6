"""Byte-pair encoding with word ends, and decoding, with a given vocabulary."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partlens.llm.common import bounded_batches, text_of

SHORT_WORD = 96
CACHED_CHUNKS = 150_000
CACHED_PIECES = 200_000
LITTLE = sys.byteorder == "little"
# The code points with the White_Space property.
WHITE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNKNOWN = "\ue000"
CHUNK = re.compile(f"[^{WHITE}]+")


def byte_letters() -> list[str]:
    """A visible letter for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def _assigned(text: str) -> str:
    """``text`` with a stand-in for code points younger than Python's own tables, which are no letters yet."""
    if text.isascii():
        return text
    return "".join([UNKNOWN if unicodedata.category(c) == "Cn" else c for c in text])


class Vocabulary:
    """The tokens, the rank of each merge, and the text handling that a vocabulary file states."""

    def __init__(self, stated: bytes):
        held = json.loads(stated)
        model = held["model"]
        steps = [step["type"] for step in held["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]:
            raise ValueError("the vocabulary does not put word ends on lower-case words")
        self.end = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        # Each merge makes a token of its own, so its string and the length of its left part name it.
        self.ranks = {left + right: rank for rank, (left, right) in enumerate(model["merges"])}
        self.lefts = [len(left) for left, _ in model["merges"]] + [-1]
        self.none = len(model["merges"])
        if len(self.ranks) != self.none:
            raise ValueError("two merges of the vocabulary make one token")
        split = held["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", WHITE))
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, number in (self.ids | self.special).items():
            self.tokens[number] = token
        self.letters = byte_letters()
        self.young, self.old = {}, {}
        self.known, self.known_before = {}, {}

    def merge(self, word: str) -> list[int]:
        """The tokens of one word, given as letters for bytes."""
        parts = self._scan(word) if len(word) <= SHORT_WORD else self._queue(word)
        ids = self.ids
        return [ids[part] for part in parts if part in ids]

    def _scan(self, word: str) -> list[str]:
        """Boundaries and the ranks of adjacent parts in two flat arrays; the least rank goes first."""
        rank, lefts, none = self.ranks.get, self.lefts, self.none
        at = [*range(len(word)), len(word) + len(self.end)]
        word += self.end
        ranks = [rank(word[i:j], none) for i, j in enumerate(at[2:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            del at[i + 1], ranks[i]
            if i < len(ranks):
                found = rank(word[at[i] : at[i + 2]], none)
                ranks[i] = found if lefts[found] == at[i + 1] - at[i] else none
            if i:
                found = rank(word[at[i - 1] : at[i + 1]], none)
                ranks[i - 1] = found if lefts[found] == at[i] - at[i - 1] else none
        return [word[a:b] for a, b in zip(at, at[1:])]

    def _queue(self, word: str) -> list[str]:
        """The same merges for a long word, where scanning would take the square of its length."""
        rank, lefts, none = self.ranks.get, self.lefts, self.none
        parts = [*word[:-1], word[-1] + self.end]
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        waiting = []

        def offer(i: int) -> None:
            found = rank(parts[i] + parts[after[i]], none)
            if lefts[found] == len(parts[i]):
                heapq.heappush(waiting, (found, i, parts[i], parts[after[i]]))

        for i in range(len(parts) - 1):
            offer(i)
        while waiting:
            _, i, left, right = heapq.heappop(waiting)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part in parts if part]

    def chunk(self, chunk: str) -> bytes:
        """The tokens of text without white space, packed as unsigned 32-bit integers."""
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                # Capital sigma becomes the plain small one wherever it stands.
                plain = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
                spans = [piece.span() for piece in self.pieces.finditer(_assigned(plain))]
                found = b"".join([self.piece(plain[a:b]) for a, b in spans])
            if len(chunk) <= SHORT_WORD:
                self.young[chunk] = found
                if len(self.young) >= CACHED_CHUNKS:
                    self.young, self.old = {}, self.young
        return found

    def piece(self, piece: str) -> bytes:
        """The tokens of one word; chunks that differ in punctuation or capitals share it."""
        found = self.known.get(piece) or self.known_before.get(piece)
        if found is None:
            letters = self.letters
            numbers = array("I", self.merge("".join([letters[b] for b in piece.encode("utf-8")])))
            if not LITTLE:
                numbers.byteswap()
            found = numbers.tobytes()
            if len(piece) <= SHORT_WORD:
                self.known[piece] = found
                if len(self.known) >= CACHED_PIECES:
                    self.known, self.known_before = {}, self.known
        return found

    def encode(self, text: str) -> bytes:
        chunk = self.chunk
        if not self.specials.search(text):
            return b"".join([chunk(c) for c in CHUNK.findall(text)])
        found, at = [], 0
        for special in self.specials.finditer(text):
            found += [chunk(c) for c in CHUNK.findall(text[at : special.start()])]
            found.append(self.special[special[0]].to_bytes(4, "little"))
            at = special.end()
        found += [chunk(c) for c in CHUNK.findall(text[at:])]
        return b"".join(found)

    def decode(self, packed: bytes) -> str:
        """The tokens' strings, with a space between: the file names no decoder that joins them closer."""
        numbers = array("I", packed)
        if not LITTLE:
            numbers.byteswap()
        return " ".join(map(self.tokens.__getitem__, numbers))


_READY: dict[int, Vocabulary] = {}


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, read by the driver and sent to the workers: a few megabytes, whatever the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _ready(shared: Broadcast) -> Vocabulary:
    key = hash(shared.value)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Vocabulary(shared.value)
    return _READY[key]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the identifier, ``ids`` and ``decoded``.

    ``ids`` are the tokens of the whole text as packed little-endian unsigned 32-bit integers,
    ``decoded`` the text they decode to. White space never joins a token, so a text is
    encoded chunk by chunk between white space, each worker keeping what it has met lately.

    Null and empty texts, and texts of white space, have no tokens and decode to empty text.
    The strings of special tokens in a text are those tokens. Repeated rows are encoded
    once each, a null identifier stays null, an empty table gives no rows, and other
    columns take no part.
    """
    bounded_batches(docs.sparkSession)
    shared = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _ready(shared)
        for batch in batches:
            packed = [known.encode(t) for t in batch["_text"]]
            yield pd.DataFrame({"_id": batch["_id"], "ids": packed, "decoded": [known.decode(p) for p in packed]})

    pair = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    schema = f"_id {pair.schema['_id'].dataType.simpleString()}, ids binary, decoded string"
    return pair.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def unpacked(ids: str = "ids"):
    """Packed tokens as an array of integers, for use in Spark expressions."""
    places = F.when(F.length(ids) > 0, F.sequence(F.lit(0), (F.length(ids) / 4).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def number(at):
        little = [F.conv(F.hex(F.substring(F.col(ids), (at * 4 + k + 1).cast("int"), F.lit(1))), 16, 10).cast("long") for k in range(4)]
        return little[0] + little[1] * 256 + little[2] * 65536 + little[3] * 16777216

    return F.transform(places, number)

"""Vocabulary, text preparation and pre-tokens of a word-end BPE tokenizer file.

Read from a public tokenizer JSON: special strings are cut out of the raw text,
the rest is NFC-normalised and lower-cased, a pattern picks the pre-tokens, and
each pre-token's UTF-8 bytes are its first symbols, the last one with the
word-end mark.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

NO_RANK = 1 << 30
PIECE_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where Latin-1 has
    a visible one, else the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


@dataclass
class Vocabulary:
    tokens: list[str]                # by id
    special: dict[str, int]
    pattern: regex.Pattern
    inner: np.ndarray                # id of a byte inside a pre-token
    final: np.ndarray                # id of a byte that ends one
    pair_keys: np.ndarray            # left << 20 | right, sorted
    pair_ranks: np.ndarray
    merged: np.ndarray               # id made by the merge of a rank
    special_pattern: regex.Pattern | None = field(init=False)

    def __post_init__(self) -> None:
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NO_RANK`` where no merge joins them."""
        keys = left.astype(np.int64) << 20 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)


def parse(raw: str) -> Vocabulary:
    """A vocabulary from the text of a tokenizer JSON of this kind."""
    spec = json.loads(raw)
    model, splitter = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
    end = model["end_of_word_suffix"]
    ids = dict(model["vocab"])
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (1 + max([*ids.values(), *special.values()]))
    for name, i in [*ids.items(), *special.items()]:
        tokens[i] = name
    letters = byte_letters()
    pairs = np.array([ids[a] << 20 | ids[b] for a, b in model["merges"]], np.int64)
    order = np.argsort(pairs, kind="stable")
    return Vocabulary(
        tokens, special, regex.compile(splitter["pattern"]["Regex"]),
        np.array([ids[c] for c in letters], np.int64),
        np.array([ids[c + end] for c in letters], np.int64),
        pairs[order], order.astype(np.int64),
        np.array([ids[a + b] for a, b in model["merges"]], np.int64))


_PARSED: dict[int, Vocabulary] = {}


def ship(spark: SparkSession, path: str) -> Broadcast:
    """The file's text (fixed size, under 2 MB) for every executor, so that
    only the driver needs the file."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def received(shipped: Broadcast) -> Vocabulary:
    """The vocabulary inside a task, parsed once per worker process."""
    raw = shipped.value
    key = hash(raw)
    if key not in _PARSED:
        _PARSED.clear()
        _PARSED[key] = parse(raw)
    return _PARSED[key]


# Letters and digits that Unicode 16 added, and lower-case forms
# that Unicode 16 and 17 added. The tokenizer library follows these versions;
# Python's tables end at 15.1, the pattern library's go to 17.
ADDED_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B),
    (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
    (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5FA))
ADDED_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
#: Below this no code point is in doubt, which settles most texts at once.
IN_DOUBT = regex.compile("[\u0558-\U0010FFFF]")


@functools.cache
def _not_letters() -> frozenset[str]:
    """What the pattern library takes as a letter or digit, but no version up
    to Unicode 16 does."""
    added = {c for a, b in ADDED_16 for c in range(a, b + 1)}
    codes = [c for c in range(0x558, 0x110000)
             if c not in added and unicodedata.category(chr(c)) == "Cn"]
    return frozenset(regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, codes))))


def pre_tokens(vocab: Vocabulary, text: str) -> list[str]:
    """Pre-tokens of prepared text."""
    if text.isascii() or not IN_DOUBT.search(text):
        return vocab.pattern.findall(text)
    odd = _not_letters().intersection(text)
    if not odd:
        return vocab.pattern.findall(text)
    shadow = text.translate(dict.fromkeys(map(ord, odd), "\u00a7"))
    return [text[m.start():m.end()] for m in vocab.pattern.finditer(shadow)]


def prepared(text: str) -> str:
    """NFC and lower case, character by character (no final-sigma rule)."""
    if text.isascii():
        return text.lower()
    lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return lowered.translate(ADDED_LOWER) if IN_DOUBT.search(lowered) else lowered


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a long text before a blank or line feed, so that no pre-token, and
    nothing that normalisation joins, is cut."""
    at = 0
    while len(text) - at > size:
        ends = [e for e in (text.find(" ", at + size), text.find("\n", at + size)) if e >= 0]
        if not ends:
            break
        yield text[at:min(ends)]
        at = min(ends)
    yield text[at:] if at else text


def segments(vocab: Vocabulary, text: str) -> Iterator[tuple[int | None, list[str]]]:
    """(special id, []) or (None, pre-tokens) in order, over the whole text."""
    for piece in pieces(text):
        if vocab.special_pattern is None or "<" not in piece:
            yield None, pre_tokens(vocab, prepared(piece))
            continue
        for part in vocab.special_pattern.split(piece):
            if part in vocab.special:
                yield vocab.special[part], []
            elif part:
                yield None, pre_tokens(vocab, prepared(part))

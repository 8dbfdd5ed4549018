"""Whole texts to token ids, exactly as the public tokenizer files define them.

Ids come from a rank merge over bytes. Texts with characters on which libraries
may differ go to the tokenizer library itself; special strings inside texts are
cut out first, as the library does.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa

from reviewloom.llm.arrow_text import Ragged, ragged, split_spaces, worker_state

# Parts kept per worker; beyond that, parts are encoded anew.
CACHED_PARTS = 200_000
# Longer parts are encoded each time.
LONGEST_KEPT = 64
# Below this character all libraries agree on letters, digits and white space.
PLAIN_BELOW = "ɐ"

BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
ASCII_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones
    for themselves, the others in order from the 256th character on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A tokenizer file: token bytes to ids, and the special strings."""

    # Ends the last symbol of a word; never a byte of UTF-8.
    WORD_END = b"\xff"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens: dict[str, int] = model["vocab"]
        self.specials = {x["content"]: x["id"] for x in content["added_tokens"]}
        letters = byte_letters()
        self.ranks = {}
        for token, number in self.tokens.items():
            whole = bool(self.suffix) and token.endswith(self.suffix)
            core = token[: -len(self.suffix)] if whole else token
            name = bytes(letters[c] for c in core) + (self.WORD_END if whole else b"")
            self.ranks[name] = number

    def merger(self):
        """Merges by rank. The ids of these files are their ranks; the end of a word
        is a byte of its own, whose merge with any last byte comes first."""
        from tiktoken._tiktoken import CoreBPE

        return CoreBPE(self.ranks, {}, BYTE_PATTERN)


class Encoder:
    """Encodes texts of a tokenizer file; see ``encoder`` for the one of a worker."""

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = Vocabulary(path)
        self.merge = self.vocabulary.merger()
        self.words = bool(self.vocabulary.suffix)
        self.special = re.compile(
            "(" + "|".join(map(re.escape, self.vocabulary.specials)) + ")"
        )
        self.kept: dict[str, bytes] = {}
        self._library = None
        self._word_pattern = None

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def by_library(self, text: str) -> bytes:
        return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def pre_tokens(self, text: str) -> list[str]:
        """Words of a text of plain characters, for word-end vocabularies."""
        low = text.lower()
        if low.isascii():
            return re.findall(ASCII_WORD_PATTERN, low, re.ASCII)
        if self._word_pattern is None:
            import regex

            self._word_pattern = regex.compile(WORD_PATTERN)
        return self._word_pattern.findall(low)

    def word_ids(self, word: str) -> list[int]:
        return self.merge.encode_single_piece(word.encode() + Vocabulary.WORD_END)

    def plain(self, text: str) -> bytes:
        """Ids of a text without special strings and with plain characters only."""
        if not self.words:
            if text[1:].isalpha() and text[0] == " ":
                return array("H", self.merge.encode_single_piece(text.encode())).tobytes()
            return array("H", self.merge.encode_ordinary(text)).tobytes()
        found = array("H")
        for word in self.pre_tokens(text):
            found.extend(self.word_ids(word))
        return found.tobytes()

    def segment(self, text: str) -> bytes:
        if text and max(text) >= PLAIN_BELOW:
            return self.by_library(text)
        return self.plain(text) if text else b""

    def whole(self, text: str) -> bytes:
        """Ids of any text: special strings are their ids, as the library has it."""
        if not self.special.search(text):
            return self.segment(text)
        pieces = self.special.split(text)
        specials = self.vocabulary.specials
        return b"".join(
            array("H", [specials[x]]).tobytes() if i % 2 else self.segment(x)
            for i, x in enumerate(pieces)
        )

    def part(self, part: str) -> bytes:
        """Ids of a part between spaces, for word-end vocabularies."""
        found = self.kept.get(part)
        if found is None:
            found = self.whole(part)
            if len(self.kept) < CACHED_PARTS and len(part) <= LONGEST_KEPT:
                self.kept[part] = found
        return found

    def encode(self, texts: pa.Array) -> Ragged:
        """Ids of each text, 16 bits each.

        Where words drop the white space around them, each distinct part between
        spaces is encoded once; byte-level texts go through the merger whole.
        """
        if not self.words:
            return ragged([self.whole(x) for x in texts.to_pylist()], np.uint16)
        split = split_spaces(texts)
        pieces = ragged([self.part(x) for x in split.parts], np.uint16)
        parts = pieces.take(split.codes)
        return Ragged(parts.values, parts.starts[split.starts])


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file; its cache stays between tasks."""
    state = worker_state("tokens")
    key = f"encoder {path}"
    if key not in state:
        state[key] = Encoder(path)
    return state[key]

"""Token ids of whole texts by a word-level tokenizer file, one distinct word at a time."""

from __future__ import annotations

import json
import os
import re

import numpy as np

from shelfmark.llm.common import ship

ship(__name__)

#: Python's split() also cuts at these, which the tokenizer's white space does not hold.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Letters that normalization leaves alone but for their case, and marks that end a word.
COMMON = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def kinds(part: dict | None) -> list[str]:
    return [x["type"] for x in (part or {}).get("normalizers", (part or {}).get("pretokenizers", []))]


class WordTokens(dict):
    """Ids of texts, as bytes of little-endian 32-bit numbers, for tokenizers that cut at white space and drop it.

    A word's ids do not depend on its neighbours there, so they are looked up by word; a new word of common letters goes to
    the model itself, any other through the whole tokenizer. The stores are emptied at ``limit`` words and
    twice as many stems, which bounds memory and changes no result. A tokenizer of another build encodes every text as a whole.
    """

    def __init__(self, path: str, limit: int = 600_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = limit
        self.stems: dict[str, bytes] = {}
        self.letters = byte_letters()
        build = json.loads(self.tokenizer.to_str())
        self.by_word = (
            kinds(build["normalizer"]) == ["NFC", "Replace", "Lowercase"]
            and kinds(build["pre_tokenizer"]) == ["Split", "ByteLevel"]
            and build["pre_tokenizer"]["pretokenizers"][0]["behavior"] == "Removed"
            and build["post_processor"] is None
        )

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def stem(self, lower: str) -> bytes:
        found = self.stems.get(lower)
        if found is None:
            if len(self.stems) >= 2 * self.limit:
                self.stems.clear()
            shown = lower if lower.isascii() else "".join(map(self.letters.__getitem__, lower.encode()))
            found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            self.stems[lower] = found
        return found

    def __missing__(self, word: str) -> bytes:
        m = COMMON.fullmatch(word)
        if m:
            ids = self.stem(m[1].lower()) + (self.stem(m[2]) if m[2] else b"")
        else:
            ids = self.plain(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text; null is empty."""
        if not text:
            return b""
        if not self.by_word or ODD_SPACE.search(text):
            return self.plain(text)
        return b"".join(map(self.__getitem__, text.split()))

"""Exact ids of a byte-level BPE tokenizer, each distinct pre-token encoded once per worker.

The tokenizers library spends most of its time on per-piece bookkeeping. Splitting a text into
pre-tokens with one compiled pattern and looking each of them up gives the same ids several times
faster; the library's model still encodes every pre-token the first time it is seen. A text with a
character on which the pattern and the library could disagree, or with the string of an added
token, goes through the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

from tokenizers import Tokenizer

#: Pre-tokens kept per worker (about 200 bytes each).
CACHE_ENTRIES = 500_000

# Outside this set the library decides; inside it these are the letters, digits and blanks on both sides.
_UNSURE = re.compile("[^\t\n\r -~ -±´-¸º»¿-ɏ‐-‧‰-⁞€]")
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
# The byte-level split: letters, contractions, digits, other marks (each with one blank before it),
# white space. Letters stand first: no other alternative can match where they do.
_SPLIT = re.compile(rf" ?[{LETTERS}]++|'(?:s|t|re|ve|m|ll|d)| ?[0-9]++| ?[^\s0-9{LETTERS}]++|\s+(?!\S)|\s+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def uncached_model(tokenizer: Tokenizer):
    """The tokenizer's model without its own cache, which costs more than it saves behind a larger one."""
    model = tokenizer.model
    if hasattr(model, "_resize_cache"):
        model._resize_cache(0)
    return model


class _Pieces(dict):
    """pre-token -> its ids as little-endian 32-bit integers."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        shown = piece.encode().decode("latin-1").translate(self.letters)
        self[piece] = ids = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        return ids


class ByteBpe:
    """``encode(text)`` gives the ids of the whole text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        pre = spec["pre_tokenizer"] or {}
        self.known = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                      and spec["normalizer"] is None and spec["post_processor"] is None
                      and spec["model"]["type"] == "BPE" and not spec["truncation"] and not spec["padding"])
        self.pieces = _Pieces(uncached_model(self.tokenizer))

    def encode(self, text: str) -> bytes:
        if not self.known or _UNSURE.search(text) or any(a in text for a in self.added):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, _SPLIT.findall(text)))


_LOADED: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]

"""Encoding texts with the tokenizers library, remembering the ids of pieces that were seen before.

The two kinds of public BPE tokenizers cut a text into pieces before they merge; a piece's ids do not depend on what stands
around it. So whole texts are cut with the tokenizer's own pattern, and only pieces that are new go through the library's BPE
model. Texts beyond Latin-1, texts with strings that look like special tokens, and tokenizers of other kinds are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

from .common import kept

_L = rb"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = rb"0-9\xb2\xb3\xb9\xbc-\xbe"
_S = rb"\x09-\x0d\x20\x85\xa0"
#: The patterns of the two kinds, for Latin-1 bytes.
_BYTE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[%b]+| ?[%b]+| ?[^%b%b%b]+|[%b]+(?![^%b])|[%b]+" % (_L, _N, _S, _L, _N, _S, _S, _S))
_WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[%b]+|[%b]|[^%b%b%b]+" % (_L, _N, _S, _L, _N))
#: Pieces that one generation of the memory holds; two generations are kept.
REMEMBERED = 250_000


class _Memory(dict):
    """Ids of pieces as bytes. When it is full, it becomes the older generation, from which pieces that recur are taken over."""

    def __init__(self, encode, size: int):
        super().__init__()
        self.encode, self.size, self.older = encode, size, {}

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = self.encode(piece)
        self[piece] = found
        return found


def _printable() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """ids(text) gives a text's ids as little-endian unsigned 32-bit integers, as the library's encode without special tokens does."""

    def __init__(self, path: str, size: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"].encode("latin-1", "ignore") for t in spec["added_tokens"]]
        self.pattern, self.lower = self._kind(spec)
        chars = _printable()
        self.as_chars = {b: "".join(chars[x] for x in chr(b).encode()) for b in range(256)}
        self.memory = _Memory(self._piece, size)

    @staticmethod
    def _kind(spec: dict) -> tuple[re.Pattern | None, bool]:
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        plain = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if plain and norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return _BYTE, False
        steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
        cuts = pre.get("pretokenizers", [])
        known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        if plain and steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["pattern"] == {"Regex": known} and cuts[0]["invert"] and not cuts[1]["use_regex"]:
            return _WORD, True
        return None, False

    def _piece(self, piece: bytes) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.as_chars))]).tobytes()

    def ids(self, text: str) -> bytes:
        try:
            raw = (text.lower() if self.lower else text).encode("latin-1") if self.pattern else None
        except UnicodeEncodeError:
            raw = None
        if raw is None or any(s in raw or s in text.encode("latin-1", "ignore") for s in self.special if b"<|" in raw or not s.startswith(b"<|")):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.memory.__getitem__, self.pattern.findall(raw)))


_encoders: dict[str, Encoder] = kept.setdefault("encoding", {})


def encoder(path: str) -> Encoder:
    """One for each process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

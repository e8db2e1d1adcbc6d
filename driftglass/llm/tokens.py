"""Token ids by the tokenizers library, with a bounded per-worker table of pre-tokens.

A byte-level BPE without a normalizer encodes each pre-token on its own, so the ids of a text are the ids of its
pre-tokens in turn. Each distinct pre-token goes through the library once per worker; the table of known pre-tokens is
emptied beyond ``table_size`` entries, between stretches of text, which bounds memory and changes no result. Any other kind of tokenizer
file is encoded text by text.

Added tokens (such as an end-of-text mark) in a text get their own id, as the library does by default; with
``special_as_text`` their strings are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: The pre-token pattern of byte-level BPE (fixed value of that tokenizer family).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"



def latin_pattern(pattern: str) -> str:
    """The pattern for texts below U+0100, with its classes spelled out: what the faster ``re`` understands."""
    import regex

    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if regex.match(kind, chr(c)))

    letters, numbers, spaces = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\S", f"[^{spaces}]")
    return out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\s", f"[{spaces}]")


#: Characters looked at together.
SEGMENT = 500_000
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[int, int]:
    """Byte to letter of byte-level BPE: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


class Table(dict):
    """Pre-tokens to ids: an unknown one goes through the library's model, its bytes written in the model's alphabet."""

    def __init__(self, tokenize):
        super().__init__()
        self.tokenize, self.letters = tokenize, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.letters))]).tobytes()
        self[piece] = ids
        return ids


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, table_size: int = 500_000, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder()
        plain = all(t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added.values())
        self.marks = {} if special_as_text else {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        #: the longest added token at the first place where one stands
        self.mark = regex.compile("|".join(map(regex.escape, sorted(self.marks, key=len, reverse=True)))) if self.marks else None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_pieces = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and plain
        self.find_any = regex.compile(BYTE_LEVEL_PATTERN).findall
        self.find_latin = re.compile(latin_pattern(BYTE_LEVEL_PATTERN)).findall
        self.table = Table(self.tokenizer.model.tokenize)
        self.table_size = table_size

    def find(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find_any(text)
        return self.find_latin(text)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ordinary(self, text: str) -> Iterator[tuple[str, bytes]]:
        """Stretches between added tokens, each with the id of the token that ends it."""
        at = 0
        for m in self.mark.finditer(text) if self.mark and any(x in text for x in self.marks) else ():
            yield text[at : m.start()], self.marks[m.group()]
            at = m.end()
        yield text[at:], b""

    def _segments(self, text: str) -> Iterator[str]:
        """A long text in parts: a single space between other characters always begins a pre-token."""
        at = 0
        while len(text) - at > SEGMENT and (m := SAFE_CUT.search(text, at + SEGMENT)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:]

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of whole texts, in order; null and empty texts have none."""
        if not self.by_pieces:
            for text in texts:
                yield self._ids([text])[0] if text else b""
            return
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if text and (len(text) > SEGMENT or any(x in text for x in self.marks)):
                yield from self._take(held)
                held, size = [], 0
                yield b"".join(b"".join(x for part in self._segments(own) for x in self._take([self.find(part)])) + mark for own, mark in self._ordinary(text))
                continue
            held.append(self.find(text) if text else [])
            size += len(text or "")
            if size > SEGMENT:
                yield from self._take(held)
                held, size = [], 0
        yield from self._take(held)

    def _take(self, held: list[list[str]]) -> Iterator[bytes]:
        if len(self.table) > self.table_size:
            self.table.clear()
        ids_of = self.table.__getitem__
        for pieces in held:
            yield b"".join(map(ids_of, pieces))

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_many([text]))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

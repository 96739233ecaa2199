"""Token ids of whole texts, by the ``tokenizers`` library.

A tokenizer that drops white space, lower-cases and splits by a pattern gives a text the
ids of its chunks between white space, one after the other. Each distinct chunk is then
looked up or encoded once; chunks of plain printable Latin letters, digits and marks go to
the library's model by their pre-tokens, all others, and every text of any other kind of
tokenizer, through the whole library. A word of Latin letters is remembered in lower case,
for all chunks that have it in capitals or before a mark.
"""

from __future__ import annotations

import codecs
import json
import re
import string
import unicodedata
from functools import lru_cache

import numpy as np

# Chunks that are remembered (some 135 bytes each), and their length at most.
MOST_CHUNKS = 1_300_000
LONGEST_CHUNK = 64
# Fixed value: the pre-token pattern whose letters make one pre-token and whose marks another.
LETTERS_OR_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = frozenset(".,;:!?")


class TokenIds:
    """Encodes texts to ids; ``id_bits`` binary digits hold any of them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bits = max(1, (max(self.tokenizer.get_vocab().values())).bit_length())
        with open(path, encoding="utf-8") as file:
            pattern, added = _chunked(json.load(file))
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.pattern, self.simple = None, pattern == LETTERS_OR_MARKS
        if pattern is not None:
            import regex

            self.pattern = regex.compile(pattern)
        # An added token of letters alone could stand inside a word.
        self.words = self.simple and not any(a.isalpha() for a in added)
        # One of letters and marks alone could stand in a word with its mark.
        marked = self.words and not any(all(c.isalpha() or c in MARKS for c in a) for a in added)
        self.chunks: dict[bytes, bytes] = (_Words if marked else _Chunks)(self)
        self.parts: dict[str, bytes] = {}
        self.codes = np.arange(1 << self.id_bits, dtype="<u4")[:, None].view("V4")[:, 0].tolist()

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned numbers of 32 bits."""
        return self.ids_of(text.encode())

    def ids_of(self, text: bytes) -> bytes:
        """The same for a text in UTF-8."""
        if self.pattern is None:
            return self._whole(text.decode())
        # Bytes are split at white space of ASCII alone; the pattern drops what else there is.
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def word(self, letters: bytes) -> bytes:
        """The ids of a lower-case word in UTF-8."""
        codes = self.codes
        shown = letters.decode() if letters.isascii() else _shown(letters)
        return b"".join([codes[t.id] for t in self.tokenize(shown)])

    def chunk(self, key: bytes) -> bytes:
        """The ids of any chunk."""
        chunk = key.decode()
        if self.words and chunk.isalpha() and (key.isascii() or _plain(chunk)):
            part = chunk.lower()
            found = self.parts.get(part) or self._part(part)
        elif not _plain(chunk) or self.added.search(chunk):
            found = self._whole(chunk)
        else:
            parts = self._split(chunk.lower())
            found = b"".join([self.parts.get(p) or self._part(p) for p in parts])
        return found

    def _split(self, chunk: str) -> list[str]:
        """The pre-tokens of a plain chunk in lower case."""
        if self.simple:
            if chunk.isalpha():
                return [chunk]
            if chunk[-1] in MARKS and chunk[:-1].isalpha():
                return [chunk[:-1], chunk[-1]]
        return self.pattern.findall(chunk)

    def _part(self, part: str) -> bytes:
        shown = part if part.isascii() else _shown(part.encode())
        codes = self.codes
        found = b"".join([codes[token.id] for token in self.tokenize(shown)])
        if len(part) <= LONGEST_CHUNK:
            if len(self.parts) >= MOST_CHUNKS:
                self.parts.clear()
            self.parts[part] = found
        return found


class _Chunks(dict):
    """The ids of chunks; those of a new one are found by the encoder, and kept within bounds."""

    def __init__(self, encoder: TokenIds) -> None:
        self.encoder = encoder

    def __missing__(self, key: bytes) -> bytes:
        return self._kept(key, self.encoder.chunk(key))

    def _kept(self, key: bytes, found: bytes) -> bytes:
        if len(key) <= LONGEST_CHUNK:
            if len(self) >= MOST_CHUNKS:
                self.clear()
            self[key] = found
        return found


class _Words(_Chunks):
    """The same where words of Latin letters, and these with a mark, need no search."""

    def __missing__(self, key: bytes) -> bytes:
        if key.isalpha() and key.islower():
            found = self.encoder.word(key)
        elif key[-1] in _MARKS and (word := _lower(key[:-1])):
            found = self[word] + self[key[-1:]]
        elif word := _lower(key):
            found = self.encoder.word(key) if word == key else self[word]
        else:
            found = self.encoder.chunk(key)
        return self._kept(key, found)


def _lower(word: bytes) -> bytes:
    """A word of ASCII letters and letters from U+00C0 to U+01FF in lower case; else nothing."""
    if word.isalpha():
        return word.lower()
    if word.translate(None, _LATIN) or _DOTTED in word:
        return b""
    text = word.decode()
    return text.lower().encode() if text.isalpha() else b""


def _shown(text: bytes) -> str:
    """The characters that byte-level vocabularies write for bytes."""
    return codecs.charmap_decode(text, "strict", _BYTES)[0]


@lru_cache(maxsize=2)
def shared(path: str) -> TokenIds:
    """One encoder for all tasks of a Python worker, with what it has looked up so far."""
    return TokenIds(path)


def _plain(chunk: str) -> bool:
    """Printable characters whose composition, case and kind no version of Unicode changes."""
    return chunk.isascii() and chunk.isprintable() or (
        max(chunk) < "ɐ" and chunk.isprintable() and "İ" not in chunk
    )


def _chunked(file: dict) -> tuple[str | None, list[str]]:
    """The pre-token pattern of a tokenizer that works chunk by chunk, and its added tokens."""
    added = [t["content"] for t in file.get("added_tokens") or []]
    steps = [s["type"] for s in (file.get("normalizer") or {}).get("normalizers", [])]
    splits = (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = file["model"]
    plain = (
        steps == ["NFC", "Replace", "Lowercase"]
        and file["normalizer"]["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and not splits[1]["add_prefix_space"]
        and not splits[1]["use_regex"]
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not any(c.isspace() for a in added for c in a)
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file.get("added_tokens") or [])
    )
    return (splits[0]["pattern"]["Regex"] if plain else None), added


def _byte_letters() -> str:
    """The character that byte-level vocabularies write for each byte: itself where it is
    printable and no space, else the next free one from 256 on."""
    letters, free = [], 256
    for byte in range(256):
        if unicodedata.category(chr(byte)) in ("Cc", "Zs", "Cf"):
            letters.append(chr(free))
            free += 1
        else:
            letters.append(chr(byte))
    return "".join(letters)


_BYTES = _byte_letters()
_MARKS = frozenset(map(ord, MARKS))
# The bytes of ASCII letters and, in UTF-8, of U+00C0 to U+01FF.
_LATIN = string.ascii_letters.encode() + bytes(range(0x80, 0xC0)) + bytes(range(0xC3, 0xC8))
_DOTTED = "İ".encode()

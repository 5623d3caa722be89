"""Exact byte-level BPE ids through a cache of pre-tokens.

The library's pre-tokenizer parts a text by a regular expression and encodes
each part on its own, so the ids of a text are the concatenated ids of its
parts.  A worker keeps the ids of the parts it has met; only new ones go
through the library's model.  The expression is restated over explicit letter
classes, which the standard engine runs twice as fast as one with properties.

Texts with characters of ``UNSAFE`` (where Python's and the library's Unicode
tables could differ), of whatever script, are parted by the library's own
normalizer and pre-tokenizer; their parts use the same cache.  Only texts that
hold a special token's string go through the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib

import numpy as np

from ._common import cache_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that the restated patterns don't cover: texts with one are parted by the library.
UNSAFE = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]")


def letter_class(test) -> str:
    """The inside of a character class: the covered characters for which ``test`` holds, as ranges."""
    held = [c for c in range(0x2100) if not UNSAFE.match(chr(c)) and test(chr(c))]
    ends = [k for k in range(len(held)) if k + 1 == len(held) or held[k + 1] != held[k] + 1]
    starts = [0, *(k + 1 for k in ends[:-1])]
    return "".join(f"\\u{held[a]:04x}-\\u{held[b]:04x}" for a, b in zip(starts, ends))


_L, _N, _W = (letter_class(f) for f in (lambda c: unicodedata.category(c)[0] == "L", lambda c: unicodedata.category(c)[0] == "N", str.isspace))
# The split patterns that the vocabulary files name, over the covered characters.
BYTE_PATTERN = f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+"
WORD_PATTERN = f"'(?:[stmd]|re|ve|ll)|[{_L}]+|[{_N}]|[^{_W}{_L}{_N}]+"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    shown = dict.fromkeys(plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in shown)}


#: Letters of the longest part that is kept: scripts without spaces have parts of any length.
LONGEST_KEPT = 64


class Ids(dict):
    """Part of a text -> its ids as bytes.

    The first ``most`` parts are kept: frequent ones come early.  Once full,
    others are encoded and not kept, so rare parts can't wash frequent ones
    out; after many misses in a row of texts unlike the first, it starts anew.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.missed = encode, most, 0

    def __missing__(self, part: str) -> bytes:
        out = self.encode(part)
        if len(part) > LONGEST_KEPT:
            return out
        if len(self) < self.most:
            self[part] = out
        else:
            self.missed += 1
            if self.missed > 20 * self.most:
                self.clear()
                self.missed = 0
        return out


class CachedEncoder:
    """Encodes texts as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does.

    most: how many pre-tokens the cache holds (about 250 bytes each).
    """

    def __init__(self, path: str, most: int = 400000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.special = tuple(x["content"] for x in spec["added_tokens"])
        model, letters = self.tokenizer.model, byte_letters()
        self.folds = spec["normalizer"] is not None
        self.split = re.compile(WORD_PATTERN if self.folds else BYTE_PATTERN).findall

        def encode(part: str) -> bytes:
            return np.array([t.id for t in model.tokenize(part.encode().decode("latin-1").translate(letters))], self.dtype).tobytes()

        self.cache = Ids(encode, most)
        self.bytes_of = {ord(letter): chr(b) for b, letter in letters.items()}

    def cached(self, text: str) -> bool:
        return not any(s in text for s in self.special)

    def parts(self, text: str) -> list[str]:
        """Pre-tokens of a text for which ``cached`` holds."""
        if not UNSAFE.search(text):
            return self.split(text.lower() if self.folds else text)
        whole = self.tokenizer.normalizer.normalize_str(text) if self.folds else text
        return [p.translate(self.bytes_of).encode("latin-1").decode() for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole)]

    def raw(self, text: str) -> bytes:
        """The ids as bytes of ``self.dtype``."""
        if self.cached(text):
            return b"".join(map(self.cache.__getitem__, self.parts(text)))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), self.dtype)


def encoder(path: str, most: int = 400000) -> CachedEncoder:
    """One encoder per worker process and vocabulary file."""
    held = cache_of("byte pairs")
    if (path, most) not in held:
        held.clear()
        held[path, most] = CachedEncoder(path, most)
    return held[path, most]


def crc32_of(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())

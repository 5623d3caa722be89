"""SentencePiece encoding through a merge-type prefix table, and decoding.

For byte-pair encoding every prefix of a text has a unique last token: the
encoding of the prefix ends in it.  A table of these last tokens is filled from
left to right.  At each position an automaton over all pieces names the pieces
that end there; piece t of length n is the last token if t is itself encoded as
one token and the last token at the position n before it is compatible with t:
encoding the two strings joined gives just these two tokens.  Reading the table
backwards from the end of the text recovers the ids.

A text is first cut where no piece crosses (a letter that meets a space, a
letter of no longer piece), which parts it into words; the table is filled once
per distinct word and worker, and kept in a bounded cache.

Decoding joins the pieces, turns the space marks back and gathers byte pieces
to UTF-8.

Defined results
    null or empty text: begin and end ids alone, decoded as the empty text.
    Letters without a piece become byte pieces.  Repeated rows and rows without
    a key are encoded one by one.  A very long text, or word, is encoded whole;
    the table of a word is as long as the word.  Extra columns, whatever their names, are
    ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cache_of, prepare
from .bpe_cache import Ids

SPACE = "▁"


class PrefixEncoder:
    """Encodes and decodes as the library does with a BPE model of identity normalisation and byte fallback."""

    def __init__(self, path: str, most: int = 600_000):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.lib, self.lib.get_piece_size()
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        kinds = [(lib.is_control(k), lib.is_byte(k), lib.is_unknown(k)) for k in range(n)]
        self.pieces = [lib.id_to_piece(k) for k in range(n)]
        self.normal = {p: k for k, p in enumerate(self.pieces) if not any(kinds[k])}
        self.score = {p: lib.get_score(k) for p, k in self.normal.items()}
        self.bytes = {int(p[3:5], 16): k for k, p in enumerate(self.pieces) if kinds[k][1]}
        self.longer = {p for p in self.normal if len(p) > 1}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = Ids(lambda word: np.array(self.word_ids(word), "<u4").tobytes(), most)
        self.plain = lib.normalize("a  b") == f"{SPACE}a{SPACE}{SPACE}b" and lib.normalize("é\n") == f"{SPACE}é\n"
        #: Pieces that their own encoding gives back; only these can be a last token.
        self.automaton = ahocorasick.Automaton()
        for p in self.normal:
            if self.merge(p) == [p]:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.cut = self.cutter()
        self.shown = [None] * n
        for k, p in enumerate(self.pieces):
            control, byte, unknown = kinds[k]
            self.shown[k] = "" if control else " ⁇ " if unknown else None if byte else p.replace(SPACE, " ")
        self.byte_of = {k: b for b, k in self.bytes.items()}

    def cutter(self):
        """A pattern whose matches part a text only where no piece crosses.

        Letters of no longer piece stand alone; trailing marks are parted from
        a word where no piece holds a word letter followed by such a mark.
        """
        inner = {c for p in self.longer for c in p}
        follows: dict[str, set[str]] = {}
        for p in self.longer:
            for a, b in zip(p, p[1:]):
                follows.setdefault(a, set()).add(b)
        if any(SPACE in f for c, f in follows.items() if c != SPACE):
            return re.compile(r"(?s).+").findall  # a piece crosses spaces: no cut
        word = {c for c in inner if c.isalpha()}
        rest = inner - word - {SPACE}
        after_word = {b for a in word for b in follows.get(a, ())}
        marks = {c for c in ".,;:!?" if c in rest} - after_word
        sets = lambda s: "[" + "".join(map(re.escape, sorted(s))) + "]"
        w, r, go_on = sets(word), sets(rest), sets(rest - marks)
        more = f"(?:{go_on}{r}*{w}*)*"
        return re.compile(f"(?s){SPACE}+{r}*{w}*{more}|{w}+{more}|{r}+{w}*{more}|.").findall

    def merge(self, text: str) -> list[str]:
        """Plain merging: join the neighbours whose joined piece scores best, the leftmost of equals, until none is a piece."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Does encoding ``left + right`` give just these two?"""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def last_tokens(self, word: str) -> list[str]:
        """The prefix table: the last token of each non-empty prefix of ``word``."""
        table: list[str | None] = [None] * len(word)
        ends: list[list[str]] = [[] for _ in word]
        for end, piece in self.automaton.iter(word):
            ends[end].append(piece)
        for j, letter in enumerate(word):
            for piece in ends[j]:
                i = j - len(piece)
                if i < 0 or self.compatible(table[i], piece):
                    table[j] = piece
                    break
            if table[j] is None:
                table[j] = letter
        return table

    def word_ids(self, word: str) -> list[int]:
        table, j, out = self.last_tokens(word), len(word) - 1, []
        while j >= 0:
            piece = table[j]
            k = self.normal.get(piece)
            out.append([k] if k is not None else [self.bytes.get(b, self.unk) for b in piece.encode()])
            j -= len(piece)
        return [k for ids in reversed(out) for k in ids]

    def raw(self, text: str) -> bytes:
        """Ids with begin and end ids, as little-endian unsigned 32-bit integers."""
        if not self.plain:
            return np.array(self.lib.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()
        shown = SPACE + text.replace(" ", SPACE) if text else ""
        ends = [np.array([k], "<u4").tobytes() for k in (self.bos, self.eos)]
        return b"".join([ends[0], *map(self.words.__getitem__, self.cut(shown)), ends[1]])

    def decode(self, ids: list[int]) -> str:
        shown = self.shown
        parts = list(map(shown.__getitem__, ids))
        # The mark put before the text goes again; it is the first shown piece's.
        first = next((i for i, p in enumerate(parts) if p != ""), None)
        if first is not None and ids[first] != self.unk and (parts[first] or "")[:1] == " ":
            parts[first] = parts[first][1:]
        if None in parts:
            out, run = [], bytearray()
            for k, p in zip(ids, parts):
                if p is None:
                    run.append(self.byte_of[k])
                    continue
                if run:
                    out.append(utf8(run))
                    run = bytearray()
                out.append(p)
            if run:
                out.append(utf8(run))
            parts = out
        return "".join(parts)


def utf8(raw: bytes) -> str:
    """Bytes as UTF-8; each byte that belongs to no character becomes a replacement character of its own."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(raw[i : i + n]).decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def encoder(path: str) -> PrefixEncoder:
    held = cache_of("pieces")
    if path not in held:
        held[path] = PrefixEncoder(path)
    return held[path]


def encode_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the ids and the decoded text; a map without any shuffle."""
    prepare(docs.sparkSession)
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * ids

    @F.pandas_udf(schema)
    def encoded(texts: pd.Series) -> pd.DataFrame:
        enc, rows = encoder(path), []
        for t in texts:
            raw = enc.raw(t or "")
            back = enc.decode(np.frombuffer(raw, "<u4").tolist())
            row = (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
            rows.append((*row, raw, back) if ids else row)
        return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(f"`{key}`").alias("doc_id"), encoded(F.col(f"`{text}`")).alias("e")).select("doc_id", "e.*")

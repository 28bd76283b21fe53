"""Encoding of whole texts with remembered pieces, shared by the operators that count, encode or pack tokens.

A byte-level tokenizer cuts a text with a pattern and encodes every match apart from the others, so the ids of a piece do
not depend on where it stands. Each Python worker therefore keeps the ids of pieces it has met. Texts are looked up by
*chunk* first: a single blank between two characters that are not white space always starts a new match of the
pattern, so the text between two such blanks, with the blank in front of it, can be remembered as a whole. Texts with
other runs of blanks are cut by the pattern itself.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

# Entries a worker remembers before it starts afresh. About 200 bytes each.
REMEMBERED = 600_000


class ChunkEncoder:
    """Joins the remembered values of a text's pieces.

    ``pattern`` has to take a blank and the letters behind it as one match, as those of byte-level tokenizers do.
    ``encode_pieces`` turns a list of distinct pattern matches into values (byte strings) of the same order;
    ``join`` puts values together (``b"".join`` for ids in four bytes each).
    """

    def __init__(
        self,
        pattern: str,
        encode_pieces: Callable[[list[str]], list[bytes]],
        join: Callable[[list[bytes]], bytes] = b"".join,
        *,
        remembered: int = REMEMBERED,
    ) -> None:
        self._find = regex.compile(pattern).findall
        self._encode_pieces = encode_pieces
        self._join = join
        self._limit = remembered
        self._pieces: dict[str, bytes] = {}
        self._chunks: dict[str, bytes | None] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The joined values of every text, in order. A null text is empty. Memory grows with one call's texts and the
        fixed number of remembered pieces."""
        out: list[bytes] = []
        start, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= 4_000_000 or i + 1 == len(texts):
                out += self._encode_group([t or "" for t in texts[start : i + 1]])
                start, size = i + 1, 0
        return out

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        if len(self._chunks) + len(self._pieces) > self._limit:
            self._chunks.clear()
            self._pieces.clear()
        chunks, pieces = self._chunks, self._pieces
        parts = [text.split(" ") for text in texts]
        wanted: dict[str, list[str]] = {}
        heads: list[list[str]] = []
        for p in parts:
            heads.append(self._find(p[0]) if _plain(p[0]) else [])
            for c in set(p).difference(chunks):
                if c not in wanted:
                    # A blank and letters are one match of the pattern; most chunks are that.
                    wanted[c] = [" " + c] if c.isalpha() else self._find(" " + c) if _plain(c) else []
        missing = dict.fromkeys(w for found in (*wanted.values(), *heads) for w in found if w not in pieces)
        self._remember(list(missing))
        for c, found in wanted.items():
            chunks[c] = self._join([pieces[w] for w in found]) if found else None
        out = []
        for text, p, head in zip(texts, parts, heads, strict=True):
            values = [chunks[c] for c in p[1:]] if head else [None]
            if None in values:
                out.append(self._by_pattern(text))
            else:
                out.append(self._join([self._join([pieces[w] for w in head]), *values]))
        return out

    def _by_pattern(self, text: str) -> bytes:
        found = self._find(text)
        self._remember(list(dict.fromkeys(w for w in found if w not in self._pieces)))
        return self._join([self._pieces[w] for w in found])

    def _remember(self, missing: list[str]) -> None:
        if missing:
            self._pieces.update(zip(missing, self._encode_pieces(missing), strict=True))


def _plain(chunk: str) -> bool:
    """Whether the chunk has characters and neither starts nor ends with white space."""
    return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()

"""A bounded per-worker cache from text chunks to packed token ids."""

from __future__ import annotations

from collections.abc import Callable


class Odd(Exception):
    """A chunk has white space where the plain cut at spaces and newlines isn't sure."""


class ChunkIds(dict):
    """Maps a chunk to its uint32 ids, packed, as ``encode`` gives them at first sight.

    Once ``limit`` chunks are held, later ones are encoded each time: frequent
    chunks come early, so they stay.  Memory is bounded and results never depend
    on what is held.
    """

    def __init__(self, encode: Callable[[str], bytes], limit: int = 350_000, longest: int = 64):
        self._encode, self._limit, self._longest = encode, limit, longest

    def __missing__(self, chunk: str) -> bytes:
        ids = self._encode(chunk)
        if len(self) < self._limit and len(chunk) <= self._longest:
            self[chunk] = ids
        return ids


def packed(text: str, first: ChunkIds, spaced: ChunkIds, newline: bytes) -> bytes:
    """The ids of a text cut at lone spaces and newlines.

    ``first`` has chunks that open a line, ``spaced`` those after a space,
    ``newline`` the ids of a newline.  :class:`Odd` comes through from them.
    """
    parts: list[bytes] = []
    for line in text.split("\n"):
        words = line.split(" ")
        parts.append(newline)
        parts.append(first[words[0]])
        del words[0]
        parts += map(spaced.__getitem__, words)
    del parts[0]
    return b"".join(parts)

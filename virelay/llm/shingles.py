"""Sets of word shingles as sorted hashes, computed by numpy over bytes.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case.  Two words
count as equal if their 64-bit hashes are, two shingles if the 56 high bits of theirs
are; the low byte is 0 and is left out where sets are packed.
"""

from __future__ import annotations

import numpy as np

FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BREAK = np.zeros(256, bool)
BREAK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at once; longer texts are cut at a word break.
PIECE = 1 << 20

_random = np.random.default_rng(20240521)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(255, 0xD1342543DE82EF95, np.uint64)]))]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> np.ndarray:
    while len(_powers[0]) < n:
        last = _powers[0]
        _powers[0] = np.concatenate([last, last * (last[-1:] * np.uint64(0xD1342543DE82EF95))])
    return _powers[0]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of each word of ``data``."""
    data = data.translate(FOLD)
    if len(data) > PIECE:
        parts, at = [], 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            while end < len(data) and not BREAK[data[end]]:
                end += 1
            h, a, b = _word_hashes(np.frombuffer(data, np.uint8, end - at, at))
            parts.append((h, a + at, b + at))
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    return _word_hashes(np.frombuffer(data, np.uint8))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~BREAK[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    long = int((ends - starts).max())
    power = _powers_to(long)
    # Position of each byte in its word; the breaks between words are summed in with weight 0.
    value = _BYTE[raw]
    value[~inside[1:-1].astype(bool)] = 0
    origin = np.zeros(len(raw), np.int64)
    origin[starts] = np.diff(starts, prepend=0)
    place = np.arange(len(raw)) - np.cumsum(origin)
    np.clip(place, 0, len(power) - 1, out=place)
    value *= power[place]
    sums = np.add.reduceat(value, starts)
    return mix(sums + (ends - starts).astype(np.uint64) * _STEP), starts, ends


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words; of all words, if they are fewer."""
    if not len(words):
        return words
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, np.uint64(0 if n == width else n))
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * _MULTIPLIERS[k % 64]
    return mix(total) & np.uint64(0xFFFFFFFFFFFFFF00)


def packed_set(shingles: np.ndarray) -> bytes:
    """A set in 7 bytes a shingle."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()


def unpacked_set(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.reshape(-1).view("<u8")


def shingle_set(text: str, width: int) -> np.ndarray:
    """The text's distinct shingles, ascending."""
    return np.unique(windows(word_hashes(text.encode("utf-8", "replace"))[0], width))


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a set."""
    total = np.add.reduce(mix(shingles), dtype=np.uint64) if len(shingles) else np.uint64(0)
    both = np.array([total, np.bitwise_xor.reduce(mix(shingles ^ _STEP)) if len(shingles) else np.uint64(0)], np.uint64)
    return int(mix(both[:1] + mix(both[1:] + np.uint64(len(shingles))))[0].astype(np.int64))

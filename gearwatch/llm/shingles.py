"""Hashed word shingles of whole texts, vectorised over a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE_WORDS = 5
PIECE_BYTES = 2 << 20
U = np.uint64


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(0, 2**63 - 1, n, dtype=np.int64).astype(U) * U(2) + U(1)


PLACES = 64              # places in a word with random numbers of their own; later ones are mixed from them
BYTE_AT = _odd(11, 256 * PLACES)
PLACE = _odd(12, SHINGLE_WORDS)
SHORT = _odd(13, SHINGLE_WORDS)
ROUND = _odd(15, 1)[0]
#: Of the rolling hash that finds anchors in suffix_dedup.
BYTE = _odd(11, 256)
BASE = int(_odd(14, 1)[0])
INVERSE = pow(BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + (1 << 16))
        have = np.full(size, U(base))
        have[0] = U(1)
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each maximal run of bytes other than space and 0x09-0x0D, A-Z lowered.

    The sum of a random number for every (byte, place): unlike a polynomial, it has no collisions by structure.
    """
    b = np.frombuffer(data, np.uint8)
    lowered = b | ((b - np.uint8(65) < 26).astype(np.uint8) << 5)
    inside = np.empty(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (b != 32) & (b - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    # a random number for each byte at its place in its word, summed over the word
    lengths = ends - starts
    held = lowered[inside[1:-1]].astype(np.int64)
    place = np.arange(len(held)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = BYTE_AT[((place % PLACES) << 8) + held]
    late = np.flatnonzero(place >= PLACES)
    value[late] = mix(value[late] + (place[late] // PLACES).astype(U) * ROUND)
    total = np.zeros(len(held) + 1, U)
    np.cumsum(value, out=total[1:])
    stop = np.cumsum(lengths)
    return mix(total[stop] - total[stop - lengths] + lengths.astype(U)), starts


def pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space into pieces of about ``PIECE_BYTES``."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(data) and data[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def shingle_hashes(w: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of a document's shingles from its words' hashes."""
    if not len(w):
        return np.zeros(0, U)
    if len(w) < SHINGLE_WORDS:
        return mix((w * SHORT[:len(w)]).sum(dtype=U, keepdims=True) + U(len(w)))
    n = len(w) - SHINGLE_WORDS + 1
    total = np.zeros(n, U)
    for k in range(SHINGLE_WORDS):
        total += w[k:k + n] * PLACE[k]
    return np.unique(mix(total))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order; empty for null."""
    group, size = [], 0
    for text in texts:
        data = b"" if text is None else text.encode("utf-8", "replace")
        if size + len(data) > PIECE_BYTES and group:
            yield from _together(group)
            group, size = [], 0
        if len(data) > PIECE_BYTES:
            yield shingle_hashes(np.concatenate([word_hashes(p)[0] for p in pieces(data)]))
        else:
            group.append(data)
            size += len(data) + 1
    yield from _together(group)


def _together(group: list[bytes]) -> Iterator[np.ndarray]:
    if not group:
        return
    h, starts = word_hashes(b"\n".join(group))
    ends = np.cumsum([len(d) + 1 for d in group])
    at = 0
    for end in np.searchsorted(starts, ends):
        yield shingle_hashes(h[at:end])
        at = end

"""Words and word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 17
FACTOR = 0x9E3779B97F4A7C15

_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint64) + 1
IS_WORD = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))


class _Powers:
    """Powers of FACTOR and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            inverse = pow(FACTOR, -1, 1 << 64)
            self.up, self.down = (self._series(base, size) for base in (FACTOR, inverse))
        return self.up, self.down

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word; letters A-Z count as a-z."""
    inside = IS_WORD[data]
    edge = np.diff(inside, prepend=False, append=False)
    places = np.flatnonzero(edge)
    starts, ends = places[::2], places[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LOWER[data] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words, so that memory follows the part."""
    start = 0
    while len(text) - start > 2 * CHUNK:
        end = start + CHUNK
        while end < len(text) and IS_WORD[text[end]]:
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def hashed_words(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > 2 * CHUNK:
            parts = [_hash_words(np.frombuffer(p, np.uint8))[0] for p in _pieces(texts[at])]
            yield np.concatenate(parts)
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) + 1 <= 2 * CHUNK):
            size += len(texts[end]) + 1
            end += 1
        chunk = texts[at:end]
        words, starts = _hash_words(np.frombuffer(b"\n".join(chunk), np.uint8))
        offsets = np.cumsum([0] + [len(t) + 1 for t in chunk])
        bounds = np.searchsorted(starts, offsets)
        for i in range(len(chunk)):
            yield words[bounds[i] : bounds[i + 1]]
        at = end


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value += words[i : i + count] * np.uint64(pow(FACTOR, i + 1, 1 << 64))
    return mix(value)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of ``k`` consecutive words; of all if there are fewer."""
    for words in hashed_words(texts):
        yield distinct(shingle_hashes(words, min(k, len(words)))) if len(words) else words

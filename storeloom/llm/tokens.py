"""Words of many texts at once, for any class of bytes: where they are, and their 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from storeloom.llm.words import mix

SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass
class Chunk:
    """Words of some texts, or of a piece of one. ``texts`` are their numbers, ``bounds`` the
    first word of each and the end, ``before`` the words of the text ahead of the piece."""

    texts: range
    bounds: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    before: int = 0


_SERIES: dict[tuple[int, int], np.ndarray] = {}


def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse modulo 2**64."""
    size, both = 1 << max(18, int(n).bit_length()), (factor, pow(factor, -1, 1 << 64))
    for base in both:
        if (base, size) not in _SERIES:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _SERIES[base, size] = np.multiply.accumulate(steps)
    return _SERIES[both[0], size], _SERIES[both[1], size]


def runs_of(words: np.ndarray, at: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of the ``size`` words from each place on."""
    up, down = _powers(FACTORS[which], len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[at + size] - sums[at]) * down[at] + np.uint64(size))


class Spelling:
    """Which bytes make a word (a table of 256), and as what they count. ``chunk`` bytes are worked
    on together; a longer text goes in pieces that end between words."""

    def __init__(self, inside: np.ndarray, counted_as: np.ndarray | None = None, chunk: int = 1 << 18):
        self.inside, self.chunk = inside, chunk
        codes = np.arange(256) if counted_as is None else counted_as
        # For each of the two functions a number of 64 bits for every byte.
        self.values = [mix(codes.astype(np.uint64) + np.uint64(seed)) for seed in SEEDS]

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word."""
        places = np.flatnonzero(np.diff(self.inside[data], prepend=False, append=False))
        return places[::2], places[1::2]

    def hashes(self, chunk: Chunk, which: int = 0) -> np.ndarray:
        """A hash of each word; ``which`` picks one of two independent functions."""
        data, starts, ends = chunk.data, chunk.starts, chunk.ends
        if not len(starts):
            return np.zeros(0, np.uint64)
        up, down = _powers(FACTORS[which], len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[which][data] * up[: len(data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * down[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    def chunks(self, texts: list[bytes], overlap: int = 0) -> Iterator[Chunk]:
        """All texts in order, a line feed between those of one chunk, which no word may hold.
        Each further piece of a long text starts with the last ``overlap`` words before it."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > self.chunk:
                yield from self._pieces(at, texts[at], overlap)
                at += 1
                continue
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < self.chunk):
                size += len(texts[end]) + 1
                end += 1
            data = np.frombuffer(b"\n".join(texts[at:end]), np.uint8)
            starts, ends = self.find(data)
            offsets = np.cumsum([0] + [len(t) + 1 for t in texts[at:end]])
            yield Chunk(range(at, end), np.searchsorted(starts, offsets), data, starts, ends)
            at = end

    def _pieces(self, at: int, text: bytes, overlap: int) -> Iterator[Chunk]:
        start, before, size = 0, 0, self.chunk
        while True:
            end = min(len(text), start + size)
            while end < len(text) and self.inside[text[end]]:
                end += 1
            data = np.frombuffer(text, np.uint8, end - start, start)
            starts, ends = self.find(data)
            if end < len(text) and len(starts) <= 2 * overlap:
                size *= 2
                continue
            yield Chunk(range(at, at + 1), np.array([0, len(starts)]), data, starts, ends, before)
            if end == len(text):
                return
            before += len(starts) - overlap
            start, size = (start + int(starts[-overlap]) if overlap else end), self.chunk

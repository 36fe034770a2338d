"""Hashes of word sequences, vectorised over the concatenated words of many texts."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd, so that it has an inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole value."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes:
    """Concatenated texts' word hashes, with hashes of any run of words in constant time each."""

    def __init__(self, texts: list[list[bytes]]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        total = int(self.sizes.sum())
        digest = xxhash.xxh64_intdigest
        self.words = np.fromiter((digest(w) for t in texts for w in t), dtype=np.uint64, count=total)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.end = np.repeat(self.begin[1:], self.sizes)
        powers, back = np.empty(total + 1, dtype=np.uint64), np.empty(total + 1, dtype=np.uint64)
        powers[0] = back[0] = 1
        powers[1:], back[1:] = BASE, INVERSE
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((self.words + np.uint64(1)) * np.multiply.accumulate(powers)[:-1], dtype=np.uint64)])

    def runs(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the runs of ``length`` words at ``starts``; a run must not pass the last word."""
        return mix((self.sums[starts + length] - self.sums[starts]) * self.back[starts] + np.uint64(length))

    @staticmethod
    def mix_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(mix(a.view(np.uint64)) + b.view(np.uint64))

    def fits(self, length: int) -> np.ndarray:
        """For every word, whether a run of ``length`` words from it ends inside its text."""
        return np.arange(len(self.words)) + length <= self.end


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours; one value a full window."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


def minimisers(hashes: WordHashes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of windows inside a text, their least gram hash, all positions that attain one).

    Two windows of equal words have the same least gram hash, so a window can only repeat if that
    hash stands at two such positions.
    """
    n, width = len(hashes.words), window - gram + 1
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    grams = hashes.runs(np.arange(n - gram + 1), gram) | np.uint64(1)
    least = sliding(grams, width, np.minimum)
    valid = hashes.fits(window)[: len(least)]
    padded = np.concatenate([np.zeros(width - 1, dtype=np.uint64), np.where(valid, least, 0), np.zeros(width - 1, dtype=np.uint64)])
    chosen = np.flatnonzero(sliding(padded, width, np.maximum)[: len(grams)] == grams)
    starts = np.flatnonzero(valid)
    return starts, least[starts], chosen

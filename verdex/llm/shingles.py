"""Words and word shingles of a text as arrays of 64-bit hashes, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words whose hashes a task remembers (memory bound; it starts anew when full).
REMEMBERED = 1_000_000
_M = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words(text: str | None, lower: bool) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8 bytes; `lower`: A-Z lower-cased."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes hashed at once; a word that is longer makes a longer piece.
PIECE = 1 << 18
_ODD = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Hasher:
    """Hashes of all words of a text without a Python object for each: sums of numbers for the bytes,
    times powers of an odd number modulo 2**64, as differences of running sums."""

    def __init__(self) -> None:
        self.byte = mixed(np.arange(1, 257, dtype=np.uint64))
        self.power = self.inverse = np.ones(1, dtype=np.uint64)
        self.grow(PIECE + 1)

    def grow(self, n: int) -> None:
        self.power, self.inverse = np.ones(n, dtype=np.uint64), np.ones(n, dtype=np.uint64)
        self.power[1:], self.inverse[1:] = _ODD, pow(_ODD, -1, 2**64)
        self.power, self.inverse = np.cumprod(self.power), np.cumprod(self.inverse)

    def piece(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, dtype=np.uint8)
        space = _SPACE[b]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        edge = np.concatenate(([0] if not space[0] else [], edge, [len(b)] if not space[-1] else [])).astype(np.int64)
        first, last = edge[::2], edge[1::2]
        if len(b) >= len(self.power):
            self.grow(len(b) + 1)
        total = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(self.byte[b] * self.power[: len(b)], out=total[1:])
        return mixed((total[last] - total[first]) * self.inverse[first] + (last - first).astype(np.uint64))

    def words(self, text: str | None, lower: bool) -> np.ndarray:
        """Hash of each word `[^\\x20\\x09-\\x0D]+`, in order; `lower`: A-Z lower-cased."""
        data = (text or "").encode("utf-8", "surrogatepass")
        data = data.lower() if lower else data
        if len(data) <= PIECE:
            return self.piece(data) if data else np.zeros(0, dtype=np.uint64)
        out, begin = [], 0
        while begin < len(data):
            end = begin + PIECE
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            out.append(self.piece(data[begin:end]))
            begin = end
        return np.concatenate(out)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` words, in text order; empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * _M
        out ^= out >> np.uint64(29)
    return mixed(out)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct `k`-word shingles, sorted; with fewer words the whole sequence is one; none if empty."""
    return np.unique(windows(hashes, min(k, len(hashes)))) if len(hashes) else np.zeros(0, dtype=np.uint64)

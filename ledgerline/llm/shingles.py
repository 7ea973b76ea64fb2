"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

WORDS_KEPT = 1 << 20  # word hashes a worker remembers before it starts over


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def _factors(n: int) -> np.ndarray:
    odd = [xxhash.xxh3_64_intdigest(f"word {i}".encode()) | 1 for i in range(n)]
    return np.array(odd, dtype=np.uint64)


def shingle_sets(texts: Iterable[bytes | None], size: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """Per UTF-8 text the digest of its word sequence and its distinct shingles.

    Words are runs without ASCII white space, with A-Z lower-cased.  A text of
    fewer than ``size`` words is one shingle; a text without words has none, and
    its digest is empty.
    """
    factors = _factors(size)
    for text in texts:
        words = (text or b"").lower().split()
        if not words:
            yield b"", np.empty(0, dtype=np.uint64)
            continue
        digest = xxhash.xxh3_128_digest(b" ".join(words))
        h = hash_words(words)
        if len(h) < size:
            h = np.concatenate([h, np.zeros(size - len(h), dtype=np.uint64)])
        n = len(h) - size + 1
        total = h[:n] * factors[0]
        for i in range(1, size):
            total += h[i : i + n] * factors[i]
        total = np.sort(mix(total))
        fresh = np.empty(n, dtype=bool)
        fresh[0] = True
        np.not_equal(total[1:], total[:-1], out=fresh[1:])
        yield digest, total[fresh]

"""Texts of Arrow batches as tokens, for operators that run numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Lower-cases A-Z and turns every other ASCII character but 0-9 and a-z into a space; bytes of
#: characters beyond ASCII stay.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))
M1, M2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def shares(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts of about ``most`` bytes, so that tokens of a whole batch never pile up."""
    a = size = 0
    for b, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of 0-9, a-z and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def nth(n: int) -> np.uint64:
    """The n-th step of a counter whose steps ``mixed`` spreads well."""
    return np.uint64(int(STEP) * n & (1 << 64) - 1)


class Hashes(dict):
    """token -> 64-bit hash, remembered while there is room."""

    def __missing__(self, token: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[token] = xxhash.xxh64_intdigest(token)
        return h

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))

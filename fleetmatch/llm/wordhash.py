"""Words of many texts as 64-bit hashes, by numpy over their bytes.

A word is a run of ASCII letters and digits and of other characters, after case
folding; everything else in ASCII separates words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SLICE = 1 << 17         # bytes hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
_MULTIPLIERS = np.random.default_rng(20240131).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@dataclass
class Words:
    hashes: np.ndarray  # one per word, over all texts
    first: np.ndarray   # where the words of each text begin, and the end of all


def _slices(inside: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of slices of about ``most`` bytes that end between words; a longer word is in one slice."""
    begin, size = 0, len(inside)
    while begin < size:
        end = min(size, begin + most)
        while end < size and inside[end - 1] and inside[end]:
            more = np.flatnonzero(~inside[end:end + most])
            end = end + int(more[0]) if len(more) else min(size, end + most)
        yield begin, end
        begin = end


def words_of(texts: list[str | None]) -> Words:
    """The words' hashes; beyond the texts' own bytes, working arrays are those of ``SLICE`` bytes."""
    parts = [text.casefold().encode("utf-8", "replace") if text else b"" for text in texts]
    begins = np.cumsum([0, *(len(part) + 1 for part in parts)])
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    del parts
    inside = _IS_WORD[data]
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end in _slices(inside, SLICE):
        change = np.flatnonzero(np.diff(inside[begin:end], prepend=False, append=False))
        starts, ends = change[::2], change[1::2]
        # A word longer than a slice is rare; its powers are not kept.
        up, down = _powers(SLICE) if end - begin <= SLICE else _powers.__wrapped__(end - begin)
        sums = np.zeros(end - begin + 1, np.uint64)
        np.cumsum((data[begin:end].astype(np.uint64) + np.uint64(1)) * up[:end - begin], out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        places.append(starts + begin)
    return Words(np.concatenate(hashes), np.searchsorted(np.concatenate(places), begins))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` words; runs that cross texts are the caller's to leave out."""
    count = max(0, len(hashes) - length + 1)
    total = np.zeros(count, np.uint64)
    for i in range(length):
        factor = _MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(2 * (i // len(_MULTIPLIERS)))
        total += hashes[i:i + count] * factor
    return mixed(total)

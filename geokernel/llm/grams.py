"""Hashed character n-grams of whole texts as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Characters that are hashed at a time; longer texts are cut at the next blank.
SLICE_CHARS = 1 << 19


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _slices(text: str, size: int) -> Iterator[str]:
    """The text cut at blanks; a blank is a boundary, so no n-gram is lost or made by a cut."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def hashed_grams(text: str, lengths: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashes below 2**bits of all n-grams of the lower-cased text, repeats included.

    Whatever is no letter is a boundary; runs of boundaries count as one, and an n-gram may
    begin or end with a boundary but not hold one inside."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, np.uint32(32))
    gap = points == 32
    keep = np.ones(len(points), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    points, gap = points[keep], gap[keep]
    found = []
    for n in lengths:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n * 0x9E3779B1 % 2**32, np.uint32)
        inside = np.zeros(m, bool)
        for i in range(n):
            h = (h ^ points[i : m + i]) * np.uint32(0x01000193)
            if 0 < i < n - 1:
                inside |= gap[i : m + i]
        h = h[~inside]
        h ^= h >> np.uint32(15)
        found.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def gram_counts(text: str, lengths: tuple[int, ...], bits: int, place: np.ndarray | None = None, columns: int = 0, size: int = SLICE_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams in ascending order and how often each occurs.

    With place, the column of each hash, columns are counted instead; n-grams whose column is
    negative do not count."""
    width = 1 << bits if place is None else columns
    counts = np.zeros(width, np.int64)
    for part in _slices(text, size):
        found = hashed_grams(part, lengths, bits)
        if place is not None:
            found = place[found]
            found = found[found >= 0]
        counts += np.bincount(found, minlength=width)
    distinct = np.flatnonzero(counts)
    return distinct, counts[distinct]

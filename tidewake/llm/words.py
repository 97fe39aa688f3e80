"""Hashes of words and of word sequences, for many texts at a time."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_FACTORS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and the bounds of each text in them.

    A running polynomial hash over all bytes, cut at white space (space and U+0009 to U+000D).
    """
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    if not len(joined):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    dark = (joined != 32) & ((joined < 9) | (joined > 13))
    edges = np.flatnonzero(np.diff(dark, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    powers = np.cumprod(np.full(len(joined), _BASE, np.uint64))
    sums = np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    back = np.cumprod(np.full(len(joined), pow(_BASE, -1, 1 << 64), np.uint64))
    hashes = mixed((sums[stops - 1] - before) * back[starts])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)])


def sequence_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on, wherever that many follow."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    last = len(words) - width + 1
    out = np.zeros(last, np.uint64)
    for k in range(width):
        out = out * np.uint64(_FACTORS[0]) + words[k:k + last]
    return mixed(out ^ np.uint64(width))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    words, bounds = word_hashes(texts)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out.append(np.unique(sequence_hashes(words[a:b], min(width, b - a))) if b > a else np.empty(0, np.uint64))
    return out

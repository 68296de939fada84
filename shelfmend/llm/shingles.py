"""Hashes of words and word windows, the same in every process, for many texts at a time.

A word's hash is a polynomial of its bytes modulo 2^64. Sums over all bytes of a batch give it for every word at
once: the difference of two sums, divided by the power that the word's place put in front.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2^64
_AT_ONCE = 1 << 19  # bytes of text, about

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _up_to(n: int) -> list[np.ndarray]:
    """The powers of the base, and of its inverse, for so many places."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, _AT_ONCE + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def chunks(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut at white space."""
    at = 0
    while len(text) - at > _AT_ONCE:
        cut = next((i for i in range(at + _AT_ONCE, len(text)) if _SPACE[text[i]]), len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case (A-Z) as one row of bytes; where words begin and end; their hashes; and the number of
    the first word of each text."""
    blob = _LOWER[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    space = _SPACE[blob]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    powers, inverse = _up_to(len(blob) + 1)
    sums = np.zeros(len(blob) + 1, np.uint64)
    np.cumsum((blob.astype(np.uint64) + np.uint64(1)) * powers[: len(blob)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    bounds = 1 + np.cumsum([0, *[len(t) + 1 for t in texts]])
    return blob, starts, ends, words, np.searchsorted(starts, bounds)


def _hashes(texts: list[bytes]) -> list[np.ndarray]:
    *_, words, at = words_of(texts)
    return [words[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def word_hashes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in lower case (A-Z)."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        if len(t) > _AT_ONCE:
            yield from _hashes(held) if held else ()
            held, size = [], 0
            yield np.concatenate([_hashes([c])[0] for c in chunks(t)])
            continue
        held.append(t)
        size += len(t)
        if size > _AT_ONCE:
            yield from _hashes(held)
            held, size = [], 0
    yield from _hashes(held) if held else ()


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, given the words' hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n] + np.uint64(k)
    for i in range(1, k):
        out = (out ^ (out >> np.uint64(29))) * _MIX + words[i : i + n]
    return mixed(out)


def shingle_sets(texts: Iterable[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its distinct ``k``-word shingles, sorted; of fewer words, that of all."""
    for words in word_hashes(texts):
        yield np.unique(windows(words, min(k, len(words)))) if len(words) else words


def shingle_set(text: bytes, k: int) -> np.ndarray:
    return next(shingle_sets([text], k))

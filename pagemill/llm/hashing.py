"""Words and shingles of many texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

CHARACTERS = 1 << 20  # about so many characters are worked on together


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit (the splitmix finish)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


@functools.cache
def _wordy() -> np.ndarray:
    """Which code points are letters or digits."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@functools.cache
def _powers(length: int) -> np.ndarray:
    return constants(length, 1)


def groups(texts: Iterable[str], characters: int = CHARACTERS) -> Iterator[list[str]]:
    """Texts in order, in lists of about so many characters, at least one text each."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of letters and digits, lower case) and for each text the
    number of words up to its end."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in low])
    inside = _wordy()[codes]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    size = 1 << max(6, int(lengths.max() - 1).bit_length())
    values = mix(codes[inside].astype(np.uint64) + np.uint64(1)) * _powers(size)[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), np.searchsorted(starts, ends)


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``text number, hash`` of every run of ``width`` words, with repeats.

    A text of fewer words is one run of them all; a text with characters but no word is
    one run made of the text itself; an empty text has none.
    """
    words, upto = word_hashes(texts)
    count = np.diff(upto, prepend=0)
    factors = constants(width, 2)
    owner = np.repeat(np.arange(len(texts)), count)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words), np.uint64)
        left = upto[owner] - np.arange(len(words))  # words from here to the end of the text
        for k in range(width):
            here = left > k
            sums[here] += words[np.flatnonzero(here) + k] * factors[k]
    whole = left >= width
    whole[(upto - count)[(count > 0) & (count < width)]] = True
    hashes = mix(sums + np.minimum(left, width).astype(np.uint64))
    lone = [i for i in np.flatnonzero(count == 0) if texts[i]]
    raw = [int.from_bytes(hashlib.blake2b(texts[i].encode(), digest_size=8).digest(), "little") for i in lone]
    return (np.concatenate((owner[whole], np.array(lone, np.int64))).astype(np.int64),
            np.concatenate((hashes[whole], np.array(raw, np.uint64))))


def counted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text number, hash, count`` of the distinct hashes of each text."""
    key = mix(hashes + mix(owner.astype(np.uint64) + np.uint64(7)))
    _, at, n = np.unique(key, return_index=True, return_counts=True)
    order = np.argsort(owner[at], kind="stable")
    at = at[order]
    return owner[at], hashes[at], n[order]

"""Words and word shingles of texts as arrays of 64-bit hashes.

Words are runs of anything but space and the control characters 9 to 13, with
A-Z lower-cased. A shingle's hash is mixed from the hashes of its words.
"""

from __future__ import annotations

import numpy as np
import xxhash

_SHIFT = np.uint64(31)
# Odd 64-bit multipliers of the mixing steps.
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
MEMO_WORDS = 500_000


class WordHashes:
    """Hashes of words, remembered within bounds."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > MEMO_WORDS:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        found = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > 2 * MEMO_WORDS:
            known.clear()
        return found


def words_of(text: str) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII letters and white space only."""
    return text.encode().lower().split()


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> _SHIFT)) * _MIX
    x = (x ^ (x >> _SHIFT)) * _ODD
    return x ^ (x >> _SHIFT)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` words from each place on; of all words, if there are fewer."""
    n = len(words) - k + 1
    if n < 1:
        n, k = min(1, len(words)), len(words)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = scramble(total * _ODD + words[i:i + n])
    return total


BLOCK = 1 << 18  # bytes that are hashed at a time
_STEP = 0xD6E8FEB86659FD93  # odd, so it has an inverse and words are hashed where they stand
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.arange(1, 257, dtype=np.uint64)
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_LETTER = scramble(_BYTES * _ODD)


def _powers(x: int) -> np.ndarray:
    out = np.full(BLOCK + 1, x, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_STEP), _powers(pow(_STEP, -1, 1 << 64))


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """The words of each text as 64-bit hashes, of all texts together.

    A word's hash is the sum of its letters' numbers times rising powers, a
    difference of two prefix sums. What a block's end cuts is put together again.
    """
    data = [t.encode() for t in texts]
    joined = b"\n".join(data)
    begins, hashes, sizes = [], [], []
    for at in range(0, len(joined), BLOCK):
        part = np.frombuffer(joined, np.uint8, min(BLOCK, len(joined) - at), at)
        inside = ~_SPACE[part]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, behind = edges[::2], edges[1::2]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTER[part] * _UP[:len(part)], out=total[1:])
        found = (total[behind] - total[first]) * _DOWN[first]
        size = behind - first
        if at and len(first) and first[0] == 0 and not _SPACE[joined[at - 1]]:
            step = np.uint64(pow(_STEP, int(sizes[-1][-1]), 1 << 64))
            hashes[-1][-1:] += found[:1] * step
            sizes[-1][-1] += size[0]
            first, found, size = first[1:], found[1:], size[1:]
        if len(first):
            begins.append(first + at)
            hashes.append(found)
            sizes.append(size)
    if not begins:
        return [np.zeros(0, np.uint64)] * len(texts)
    ends = np.cumsum([len(d) + 1 for d in data])[:-1]
    return np.split(scramble(np.concatenate(hashes)),
                    np.searchsorted(np.concatenate(begins), ends))


def window_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """The hash of each ``k`` neighbours, put together from halves; none of fewer."""
    n = len(x) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    made, size, power, width = None, 0, x, 1
    while True:
        if k & width:
            made = power if made is None else _joined(made, power, size)
            size += width
        if size == k:
            return made[:n]
        power, width = _joined(power, power, width), 2 * width


def _joined(x: np.ndarray, y: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of what ``x`` stands for at each place and ``y`` stands for ``gap`` behind."""
    n = min(len(x), len(y) - gap)
    out = x[:n] * _ODD
    out += y[gap:gap + n]
    out ^= out >> _SHIFT
    out *= _MIX
    out ^= out >> _SHIFT
    return out


def whole_shingles(words: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The hashes of ``k`` words in a row of each text; none of a text with fewer words."""
    counts = [len(w) for w in words]
    made = window_hashes(np.concatenate(words), k)
    starts = np.cumsum(counts) - counts
    return [made[s:s + max(0, n - k + 1)] for s, n in zip(starts.tolist(), counts)]

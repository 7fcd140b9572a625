"""Words of many texts at once: their places and 64-bit hashes, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
MULTIPLIERS = [U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                              0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
BYTES_AT_ONCE = 1 << 22


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    inverse = U(pow(int(BASE), -1, 1 << 64))
    one = np.ones(1, np.uint64)
    return (np.concatenate([one, np.cumprod(np.full(n - 1, BASE))]),
            np.concatenate([one, np.cumprod(np.full(n - 1, inverse))]))


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the runs ``values[start:end]``, the same wherever a run lies."""
    up, down = _powers(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + U(1)) * up[:-1])])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * MULTIPLIERS[4])


class Words:
    """The words of UTF-8 texts laid end to end (A-Z lower-cased).

    ``start``, ``end``: byte offsets in ``data``; ``hash``: 64 bits a word;
    ``cuts``: text k has the words ``cuts[k]:cuts[k + 1]``; ``heads``: the
    texts' first bytes.
    """

    def __init__(self, texts: list[bytes]):
        self.data = data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8).copy()
        data[(data - 65) < 26] += 32
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.hash = run_hashes(data, self.start, self.end)
        self.heads = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.cuts = np.searchsorted(self.start, self.heads)


def lots(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in order, some megabytes at a time (a longer text alone)."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= BYTES_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held

"""Keyed permutations of 0..n-1: a balanced Feistel network with cycle walking."""

from __future__ import annotations

import numpy as np

ROUNDS = 6
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _scrambled(value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        value = (value ^ (value >> np.uint64(30))) * np.uint64(_MIX[1])
        value = (value ^ (value >> np.uint64(27))) * np.uint64(_MIX[2])
    return value ^ (value >> np.uint64(31))


def _round_keys(key: np.ndarray) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [_scrambled(key.astype(np.uint64) + np.uint64(r + 1) * np.uint64(_MIX[0])) for r in range(ROUNDS)]


def _half_bits(size: np.ndarray) -> np.ndarray:
    """Bits of each half, so that both together hold every value below ``size``."""
    wide = np.array([max(2, int(n - 1).bit_length()) for n in np.unique(size)], np.uint64)
    return ((wide + np.uint64(1)) // np.uint64(2))[np.searchsorted(np.unique(size), size)]


def permuted(index, size, key, inverse: bool = False) -> np.ndarray:
    """Place of each ``index`` in the permutation of 0..``size``-1 chosen by ``key``.

    ``size`` and ``key`` are numbers or arrays along ``index``; ``inverse`` undoes the permutation.
    The network permutes the next power of four; a value that lands beyond ``size`` walks on along its
    cycle until it is inside, on average fewer than four steps.
    """
    index = np.asarray(index, np.uint64)
    size = np.broadcast_to(np.asarray(size, np.uint64), index.shape)
    key = np.broadcast_to(np.asarray(key).astype(np.uint64), index.shape)
    if np.any(index >= size):
        raise ValueError("an index lies outside its permutation")
    out, todo = index.copy(), np.arange(len(index))
    half = _half_bits(size) if len(index) else index
    while len(todo):
        bits = half[todo]
        mask = (np.uint64(1) << bits) - np.uint64(1)
        left, right = out[todo] >> bits, out[todo] & mask
        keys = _round_keys(key[todo])
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_scrambled(left ^ k) & mask), left
            else:
                left, right = right, left ^ (_scrambled(right ^ k) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)

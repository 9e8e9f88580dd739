"""SetSketch registers (Ertl, 2021) of sets of 64-bit hashes, in numpy.

Register i of a set is the truncated level ``floor(1 - log_b(min over elements of x_i))`` with exponentially
distributed x_i, clipped to one byte. Levels are monotone in the minimum, so the registers of a union are the
elementwise maxima of the registers, and equal registers are the more likely the more alike the sets are.
"""

from __future__ import annotations

import numpy as np

#: The base of the levels, and what maps them into one byte: level 1 stands for minima of TOP and more.
BASE = 1.1
TOP = 8.0
_LEVELS = 254


def _odd_numbers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class SetSketch:
    def __init__(self, registers: int):
        self.registers = registers
        self._times = _odd_numbers(registers, 11)
        self._plus = _odd_numbers(registers, 12)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest of each register's own 32-bit values over the elements (a block of elements at a time)."""
        least = np.full(self.registers, np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(hashes), 512):
            h = hashes[at : at + 512, None] * self._times[None, :]
            h += self._plus[None, :]
            h >>= np.uint64(32)
            np.minimum(least, h.min(axis=0).astype(np.uint32), out=least)
        return least

    def sketch(self, hashes: np.ndarray) -> np.ndarray:
        """Registers of a set with at least one element, one byte each."""
        u = (self.minima(hashes).astype(np.float64) + 0.5) / 2.0**32
        x = -np.log1p(-u)
        level = np.floor(1.0 - np.log(x / TOP) / np.log(BASE))
        return np.clip(level, 0, _LEVELS).astype(np.uint8)

    @staticmethod
    def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    """Probability that one register exceeds another, for the share x of the first set's own part."""
    return -np.log(1.0 - x * (BASE - 1.0) / BASE) / np.log(BASE)


def slope(greater, less, equal, n_a, n_b, similarity) -> np.ndarray:
    """Derivative of the joint log-likelihood at a Jaccard similarity, from how many registers differ which way.

    The log-likelihood is concave, so the estimate lies above ``similarity`` exactly where this is positive. Sizes
    that the similarity does not allow give minus infinity.
    """
    greater, less, equal, n_a, n_b = (np.asarray(v, dtype=np.float64) for v in (greater, less, equal, n_a, n_b))
    a, b = n_a / (n_a + n_b), n_b / (n_a + n_b)
    own_a, own_b = a - b * similarity, b - a * similarity
    possible = (own_a >= 0) & (own_b >= 0)
    own_a, own_b = np.maximum(own_a, 1e-9), np.maximum(own_b, 1e-9)
    rate = (BASE - 1.0) / BASE
    slope_a = -b * rate / ((1.0 - own_a * rate) * np.log(BASE))
    slope_b = -a * rate / ((1.0 - own_b * rate) * np.log(BASE))
    p_a, p_b = _p(own_a), _p(own_b)
    value = greater * slope_a / p_a + less * slope_b / p_b - equal * (slope_a + slope_b) / (1.0 - p_a - p_b)
    return np.where(possible, value, -np.inf)


def estimate(greater, less, equal, n_a, n_b, steps: int = 30) -> np.ndarray:
    """The maximum-likelihood Jaccard similarity, by bisection on the slope."""
    greater, less, equal, n_a, n_b = np.broadcast_arrays(greater, less, equal, n_a, n_b)
    low, high = np.zeros(n_a.shape), np.minimum(n_a / n_b, n_b / n_a)
    for _ in range(steps):
        middle = (low + high) / 2
        up = slope(greater, less, equal, n_a, n_b, middle) > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2

"""SetSketch registers: exponentially spaced, truncated minima of exponential hash values.

Register i of a set is floor(1 - log_b(min of h_i)), clipped to 16 bits, with h_i exponential of rate a for each element.
The register of a union is the larger of two registers; equal registers are about as likely as the similarity is high.
"""

from __future__ import annotations

import numpy as np

from sensorflow.llm.shingles import mixed

BASE, RATE = 1.001, 20.0
BANDS, ROWS = 60, 5
REGISTERS = BANDS * ROWS
_SEEDS = mixed(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
_FACTOR = (_SEEDS[:REGISTERS] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
_OFFSET = (_SEEDS[REGISTERS:] >> np.uint64(32)).astype(np.uint32)[:, None]
_ROW_FACTORS = mixed(np.arange(1001, 1001 + ROWS, dtype=np.uint64)) | np.uint64(1)
_BAND_OFFSETS = mixed(np.arange(2001, 2001 + BANDS, dtype=np.uint64))
_PART = 4096


def registers(elements: np.ndarray) -> np.ndarray:
    """16-bit registers of a set of 64-bit hashes; zeros for an empty set."""
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (elements >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _PART):
        low = np.minimum(low, (short[None, at:at + _PART] * _FACTOR + _OFFSET).min(axis=1))
    smallest = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(smallest) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mixed((rows * _ROW_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_OFFSETS).view(np.int64)


def fewest_equal(similarity: float, deviations: float = 6.5) -> int:
    """Equal registers that a pair of that similarity or more has but once in ten billion."""
    return int(REGISTERS * similarity - deviations * (REGISTERS * similarity * (1 - similarity)) ** 0.5)


_GRID = 200


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: float, slack: float = 16.0) -> np.ndarray:
    """Pairs whose similarity may be `similarity` or more: joint likelihood of both sketches, given the set sizes.

    The counts of larger, smaller and equal registers are multinomial with probabilities that depend on the similarity.
    A pair is refused only if the best similarity below the threshold is more than e**slack times as likely as the best
    one from the threshold on; a true pair is refused about once in 10**8.
    """
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    u = n_a / (n_a + n_b)
    v = 1.0 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0.0, 1.0, _GRID + 1)[None, :]
    shares = np.minimum(grid, most[:, None])  # no similarity above what the sizes allow

    def p(x: np.ndarray) -> np.ndarray:
        x = np.clip(x, 0.0, 1.0)
        return np.clip(-np.log1p(-x * (BASE - 1.0) / BASE) / np.log(BASE), 1e-12, 1.0)

    p_larger, p_smaller = p(u[:, None] - v[:, None] * shares), p(v[:, None] - u[:, None] * shares)
    p_equal = np.clip(1.0 - p_larger - p_smaller, 1e-12, 1.0)
    fit = larger[:, None] * np.log(p_larger) + smaller[:, None] * np.log(p_smaller) + equal[:, None] * np.log(p_equal)
    above = grid >= similarity - 1e-9
    reach = most >= similarity - 1e-9
    best_above = np.where(above, fit, -np.inf).max(axis=1)
    return reach & (best_above >= fit.max(axis=1) - slack)

"""Seeded normal numbers that any engine with md5 can compute.

The cell (row, column) of a seed has the number sqrt(-2 ln u) cos(2 pi v); u and v are
the first and second eight hex digits of md5("seed|row|column") over 2^32, u half a step up.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np


def seeded_normal(seed: int, row: int, column: int) -> float:
    digest = hashlib.md5(f"{seed}|{row}|{column}".encode()).hexdigest()
    u, v = (int(digest[:8], 16) + 0.5) / 2.0**32, int(digest[8:16], 16) / 2.0**32
    return math.sqrt(-2.0 * math.log(u)) * math.cos(2.0 * math.pi * v)


def normal_matrix(rows: int, columns: int, seed: int = 0) -> np.ndarray:
    """(rows × columns) seeded N(0, 1) numbers; a cell depends on its place alone, so a
    larger matrix holds a smaller one."""
    return np.array([[seeded_normal(seed, i, j) for j in range(columns)] for i in range(rows)]).reshape(rows, columns)

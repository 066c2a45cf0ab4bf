"""Repeatable random draws that depend only on a row's id.

A point gets two numbers below the prime 2**31 - 1 from the md5 of its id.  A draw evaluates one
random cubic per number modulo that prime (draws of up to four points are independent) and joins
the results to a uniform number of 62 bits.  Nothing depends on partitioning, so a task that is
run again after a lost executor draws the same.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
from pyspark.sql import Column, functions as F

PRIME = (1 << 31) - 1


def id_numbers(identifier: Column) -> list[Column]:
    """Two whole numbers below the prime for an id."""
    digest = F.md5(identifier.cast("string"))
    return [
        F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint") % PRIME for start in (1, 16)
    ]


def cubic(seed: int, run: int, step: int, half: int) -> list[int]:
    """Four coefficients of the draw (seed, run, step), for one half of its bits."""
    names = [f"{seed}:{run}:{step}:{half}:{degree}" for degree in range(4)]
    return [int(md5(name.encode()).hexdigest()[:15], 16) % PRIME for name in names]


def uniform(h1: np.ndarray, h2: np.ndarray, seed: int, run: int, step: int) -> np.ndarray:
    """Draw strictly between 0 and 1 for each point."""
    halves = []
    for half, x in enumerate((h1, h2)):
        a, b, c, d = cubic(seed, run, step, half)
        halves.append((((a * x + b) % PRIME * x + c) % PRIME * x + d) % PRIME)
    return (halves[0] * 2147483648.0 + halves[1] + 0.5) / 4611686018427387904.0


def race(h1: np.ndarray, h2: np.ndarray, seed: int, run: int, step: int, weight: np.ndarray):
    """Exponential arrival times with rate ``weight``: the first to arrive is a draw with
    probability proportional to its weight.  Weight 0 never arrives."""
    arrival = -np.log1p(-uniform(h1, h2, seed, run, step))
    with np.errstate(divide="ignore"):
        return np.where(weight > 0, arrival / weight, np.inf)

"""Random numbers that depend on a key and a seed only.

Sampling by them gives the same rows on every run, however the table is partitioned and
whichever tasks are run again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of the hash used: 8 hexadecimal ones make 32 bits.
HEX_DIGITS = 8
BUCKETS = float(16**HEX_DIGITS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(*key: Column | str, purpose: str, seed: int = 0) -> Column:
    """A number in [0, 1), evenly spread over distinct keys. Null parts count as empty.

    Draws for different purposes are independent of each other, whatever their seeds.
    """
    parts = [F.coalesce(_col(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(BUCKETS)


def poisson_steps(mean: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2 … copies, as far as `bucket` can tell them apart."""
    if not 0.0 <= mean < math.inf:
        raise ValueError(f"the mean number of copies must be 0 or more, not {mean}")
    if mean == 0.0:
        return []
    steps, total, n = [], 0.0, 0
    # The terms are worked out from their logarithms: the first may be too small for a double.
    while n <= mean or total < 1.0 - 1.0 / BUCKETS:
        total += math.exp(n * math.log(mean) - mean - math.lgamma(n + 1))
        steps.append(total)
        n += 1
    return [step for step in steps if step < 1.0 - 1.0 / BUCKETS]


def poisson_copies(u: Column, mean: float) -> Column:
    """How often a row is drawn when sampling with replacement at rate `mean`."""
    steps = F.array(*map(F.lit, poisson_steps(mean))).cast("array<double>")
    return F.aggregate(steps, F.lit(0), lambda n, step: n + (u >= step).cast("int"))

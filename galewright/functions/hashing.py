"""Deterministic pseudo-random choices from md5, equal on every engine, partitioning and rerun.

A digest is 32 hex digits; its first eight, read as a fraction of 2³², are uniform in [0, 1). Since
hex digits sort like the numbers they stand for, a share is tested by comparing text, with no
conversion per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column | str, salt: str | int) -> Column:
    """md5 over the parts and a salt, as 32 hex digits."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(F.concat_ws("|", *texts, F.lit(str(salt))))


def lowest_share(digest_col: Column, share: float) -> Column:
    """Does the digest fall into the lowest ``share`` of all digests?"""
    edge = round(share * (1 << 32))
    if edge <= 0 or edge >= 1 << 32:
        return F.lit(edge > 0)
    return digest_col < F.lit(f"{edge:08x}")


def weighted_choice(key: Column | str, values: Sequence, weights: Sequence[float], salt: str | int) -> Column:
    """Pick one of ``values`` per row with the given weights, decided by the key alone."""
    if len(values) != len(weights) or not values or min(weights) < 0 or sum(weights) == 0:
        raise ValueError("values and weights must pair up and the weights must have a positive sum")
    draw = digest(key, salt=salt)
    choice = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        reached = sum(weights[: i + 1]) / sum(weights)
        choice = F.when(lowest_share(draw, reached), F.lit(values[i])).otherwise(choice)
    return choice

"""Deterministic random keys: a hash of seed and row id, the same under any partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed, *ids) -> Column:
    """md5(seed | id | ...), a hex string."""
    parts = [F.lit(str(seed)), *[(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]]
    return F.md5(F.concat_ws("|", *parts))


def key_number(key: Column, start: int = 1, digits: int = 8) -> Column:
    """Integer value of some hex digits of a key."""
    return F.conv(F.substring(key, start, digits), 16, 10).cast("long")


def uniform(key: Column, start: int = 1) -> Column:
    """Uniform number in [0, 1) from 8 hex digits of a key."""
    return key_number(key, start).cast("double") / F.lit(4294967296.0)


def gaussian(key: Column) -> Column:
    """Standard normal number (Box-Muller) from 16 hex digits of a key."""
    u1 = (key_number(key, 1).cast("double") + 1.0) / F.lit(4294967296.0)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * uniform(key, 9))


def poisson_bounds(most: int = 16) -> list[float]:
    """A uniform number below the kth bound, and no earlier one, draws k from Poisson(1)."""
    total, p, out = 0.0, math.exp(-1.0), []
    for k in range(most):
        total += p
        out.append(total)
        p /= k + 1
    return out


def poisson_one(u: Column, most: int = 16) -> Column:
    """Poisson(1) draw by inversion of a uniform number."""
    out = F.lit(most)
    for k, bound in reversed(list(enumerate(poisson_bounds(most)))):
        out = F.when(u < bound, F.lit(k)).otherwise(out)
    return out.cast("int")


def row_id(*cols: str) -> Column:
    """One string id from several key columns."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])

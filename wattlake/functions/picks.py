"""Deterministic stand-ins for random choice.

A random label would change on every task retry.  The choice is instead read from the
MD5 of the event id: evenly spread, and the same on every run and executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(key: Column) -> Column:
    """First 32 bits of the MD5 of ``key`` as an unsigned integer."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def pick(key: Column, choices: list[str]) -> Column:
    """One of ``choices`` with equal odds."""
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, (hash32(key) % F.lit(len(choices)) + F.lit(1)).cast("int"))


def sample_order(key: Column, seed: int) -> Column:
    """Sort key of a repeatable shuffle: a hexadecimal hash."""
    return F.md5(F.concat(key, F.lit(f"#{seed}")))


def hash_slice(hexadecimal: Column) -> Column:
    """The first 20 bits of a hexadecimal hash; slices sort like the hash itself."""
    return F.conv(F.substring(hexadecimal, 1, 5), 16, 10).cast("int")

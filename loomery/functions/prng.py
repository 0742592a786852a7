"""A counter-based 32-bit generator as column expressions, and the shuffle it drives.

The generator's state is seed + k * step, so draw k is a function of k alone and a
column of draws needs no state. Every product is split in 16-bit halves to
stay inside a bigint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, functions as F

# Fixed values of the generator.
STEP = 0x6D2B79F5
MASK = 0xFFFFFFFF


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _times(a: Column, b: Column) -> Column:
    low = a.bitwiseAND(F.lit(65535)) * b
    high = F.shiftleft((F.shiftright(a, 16).bitwiseAND(F.lit(65535)) * b.bitwiseAND(F.lit(65535))).bitwiseAND(F.lit(65535)), 16)
    return (low + high).bitwiseAND(F.lit(MASK))


def draw(seed: int, k: Column) -> Column:
    """Draw number k (from 1), in [0, 1)."""
    v = (F.lit(seed & MASK).cast("bigint") + k.cast("bigint") * F.lit(STEP)).bitwiseAND(F.lit(MASK))
    v = _times(_xor(v, F.shiftright(v, 15)), v.bitwiseOR(F.lit(1)))
    v = _xor(v, (v + _times(_xor(v, F.shiftright(v, 7)), v.bitwiseOR(F.lit(61)))).bitwiseAND(F.lit(MASK)))
    return _xor(v, F.shiftright(v, 14)) / F.lit(4294967296.0)


def draws(seed: int, first: int, count: int) -> Iterator[float]:
    """The same draws in Python, for the sequential part of a shuffle."""
    for k in range(first, first + count):
        v = (seed + k * STEP) & MASK
        v = ((v ^ (v >> 15)) * (v | 1)) & MASK
        v ^= (v + ((v ^ (v >> 7)) * (v | 61))) & MASK
        yield ((v ^ (v >> 14)) & MASK) / 4294967296.0


def shuffled(items: list, seed: int, first: int) -> list:
    """Swap from the end down, each time with a place at or below it; uses len - 1 draws from ``first`` on."""
    out = list(items)
    for i, u in zip(range(len(out) - 1, 0, -1), draws(seed, first, max(len(out) - 1, 0))):
        j = int(u * (i + 1))
        out[i], out[j] = out[j], out[i]
    return out

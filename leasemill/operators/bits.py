"""A bit array over hashed keys: tells most rows that cannot meet a key before they are shuffled.

The array is sized by the number of keys (``bits_for``), a table of its non-zero 64-bit words, at most ``bits / 64`` rows, and
never larger than ``MOST_BITS``, so it may be broadcast. A key that was put in is always found; others are found by chance
only. More keys than ``MOST_BITS`` tells apart get no array: then the rows are shuffled once, which grows with the table only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the least and the most bits: at most 524,288 words of 16 bytes are broadcast.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 25


def bits_for(keys: int) -> int | None:
    """The size of the array for so many keys, a power of two; None if it could not tell most of other keys."""
    bits = max(LEAST_BITS, 1 << (BITS_A_KEY * max(1, keys) - 1).bit_length())
    return min(bits, MOST_BITS) if keys <= MOST_BITS // 2 else None


def bit_words(df: DataFrame, key: str, bits: int) -> DataFrame:
    """``w`` (number of a word) and ``b`` (its bits) of the keys, a column of 64-bit hashes; null keys are left out."""
    place = f"pmod({key}, {bits}L)"
    marked = df.filter(F.col(key).isNotNull()).select(F.expr(f"shiftright({place}, 6)").alias("w"), F.expr(f"shiftleft(1L, cast({place} % 64 AS INT))").alias("b"))
    return marked.groupBy("w").agg(F.bit_or("b").alias("b"))


def might_hold(df: DataFrame, words: DataFrame, key: str, bits: int) -> DataFrame:
    """The rows whose key may be among those of ``words``; at most ``bits / 64`` rows of 16 bytes are broadcast."""
    place = f"pmod({key}, {bits}L)"
    near = words.select(F.col("w").alias("_w"), F.col("b").alias("_b"))
    joined = df.join(F.broadcast(near), F.expr(f"shiftright({place}, 6)") == F.col("_w"))
    return joined.filter(F.expr(f"shiftrightunsigned(_b, cast({place} % 64 AS INT)) & 1L") == 1).drop("_w", "_b")

"""Signed logarithmic buckets of fixed relative width, shared by the sketches and the exact rank selection."""

from __future__ import annotations

import math
import sys

#: The smallest normal double; what is nearer to zero counts as zero.
SMALLEST = sys.float_info.min
#: Above the bucket of any finite value.
INFINITE = 1 << 30


def gamma(alpha: float) -> float:
    """Ratio of neighbouring bucket bounds for a relative error of ``alpha``."""
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie between 0 and 1")
    return (1 + alpha) / (1 - alpha)


def sign_text(c: str) -> str:
    """-1, 0 or 1, as SQL; text makes a plan with fewer calls between Python and the JVM than columns do."""
    return f"CASE WHEN {c} >= {SMALLEST!r}D THEN 1 WHEN {c} <= -{SMALLEST!r}D THEN -1 ELSE 0 END"


def bucket_text(c: str, alpha: float) -> str:
    """ceil(log_gamma |x|), 0 for a zero, ``INFINITE`` for infinite values, as SQL. For numbers only."""
    return f"CAST(CASE WHEN abs({c}) >= {SMALLEST!r}D THEN least(ceil(ln(abs({c})) / {math.log(gamma(alpha))!r}D), {INFINITE}L) ELSE 0L END AS INT)"

"""Two streams joined while both arrive."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, within: str,
                  watermark: str, how: str = "inner") -> DataFrame:
    """Pairs with equal ``on`` whose right time is at or after the left one by at most ``within`` (an interval).

    Both sides are watermarked by ``watermark``, so a row is kept in state no longer than a partner can
    come: the left one ``within`` past the watermark, the right one up to it.  Keys come from the left
    side, other names must differ; rows with a null key or time meet nothing.  ``how`` may be
    ``inner`` or ``left_outer`` (an unmatched left row comes out when its time is over).  Batch frames are joined
    by the same condition."""
    if how not in ("inner", "left_outer"):
        raise ValueError("how must be inner or left_outer")
    on = list(on)
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    lhs = left.withWatermark(left_ts, watermark) if left.isStreaming else left
    rhs = right.withWatermark(right_ts, watermark) if right.isStreaming else right
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {within}"))
    for c in on:
        near = near & (F.col(c) == F.col(f"_r_{c}"))
    return lhs.join(rhs, near, how).drop(*[f"_r_{c}" for c in on])

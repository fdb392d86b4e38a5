"""Left outer equi-join that stays balanced when the right side has hot keys
(J2 fan-out at scale).

AQE splits skewed partitions of a left outer join only on the left (preserved)
side. Here the right side's rows are first counted by key (pre-aggregated before
the shuffle). Keys that hold more than ``share`` of them are hot; there are at
most ``1 / share`` of those, so the list has a proven bound. All other keys
keep one salt. The right rows of a hot key are dealt over salts by their row
number, so identical copies spread as well, and only the left rows of hot keys
are repeated, once a salt. There are no more salts than a hot key has right rows,
so the repeated left rows are never more than the rows that the join returns. A hot key has a match by definition, so of its
repeated left rows those without one are dropped; all other unmatched left rows
appear exactly once. Both sides are read once, besides the count. The result
equals ``left.join(right, on, "left")`` as a bag.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT, HIT = "__salt", "__hit"
HOT_SHARE = 0.01


def _counted_hot_keys(df: DataFrame, on: str, share: float) -> dict:
    """Hot keys and their rows. The rollup counts the keys and, in its total, all
    rows that have one, in the same pass."""
    rows = df.where(F.col(on).isNotNull()).rollup(on)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.grouping(on).alias("all"))
    # The largest 1 / share keys hold every key above the share; the total is larger still.
    top = counts.orderBy(F.desc("all"), F.desc("n")).limit(int(1 / share) + 2).collect()
    total = sum(r["n"] for r in top if r["all"])
    return {r[on]: r["n"] for r in top if not r["all"] and r["n"] > share * total}


def hot_keys(df: DataFrame, on: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of the rows that have a key: at most
    ``1 / share`` values, found in one pre-aggregated pass."""
    return list(_counted_hot_keys(df, on, share))


def skew_safe_left_join(
    left: DataFrame, right: DataFrame, on: str, hot: Iterable | None = None, share: float = HOT_SHARE, salts: int = 64
) -> DataFrame:
    """``hot`` names the hot keys if the caller knows them; else they are counted."""
    if salts < 1:
        raise ValueError("salts must be >= 1")
    clash = (set(right.columns) & set(left.columns)) - {on}
    if clash:
        raise ValueError(f"columns on both sides besides the key: {sorted(clash)}")
    counted = _counted_hot_keys(right, on, share) if hot is None else None
    hot = list(hot if counted is None else counted)
    if not hot:
        return left.join(right, on, "left")
    if counted:
        salts = min(salts, *counted.values())
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    zero = F.lit(0).cast("long")
    # Any salt gives the right result, so it need not depend on the row's content.
    dealt = right.withColumns(
        {SALT: F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(zero), HIT: F.lit(True)}
    )
    every = F.sequence(zero, F.lit(salts - 1).cast("long"))
    repeated = left.withColumn(SALT, F.explode(F.when(is_hot, every).otherwise(F.array(zero))))
    joined = repeated.join(dealt, [on, SALT], "left").where(~is_hot | F.col(HIT))
    return joined.select(on, *[c for c in left.columns if c != on], *[c for c in right.columns if c != on])

"""Joins and rankings that survive one key holding a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key counts as hot from this share of the rows on; so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
#: Counters that the frequent-item sketch keeps per task.
SKETCH_ITEMS = 16384
#: Lanes that rows without a key are dealt to; they meet nothing, so any task can have them.
NULL_LANES = 1024


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold at least `share` of the non-null rows, by a frequent-items sketch over all rows.

    One pass, a few kilobytes per task, at most 1/share keys. Empty tables give []. Only the
    physical plan depends on the answer, never a result.
    """
    k = int(1 / share)
    row = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {k}, {SKETCH_ITEMS})").alias("top")
    ).first()
    if not row["n"]:
        return []
    return [x[0] for x in row["top"] or [] if x[1] >= share * row["n"]]


def join_unique(big: DataFrame, small: DataFrame, key: str, how: str = "inner", hot: list | None = None) -> DataFrame:
    """`big` joined to `small` on `key`, where `small` has at most one row per key.

    Rows of hot keys meet their few partner rows (at most 1/HOT_SHARE of them, as `small` is unique by
    key) through a broadcast; all others go through an ordinary shuffled join, so no task receives the
    rows of a hot key; a key below HOT_SHARE is left to the skew handling of adaptive execution. `how`: inner, left,
    left_semi or left_anti. Null keys match nothing; left and left_anti keep their rows, dealt to NULL_LANES lanes
    so that they don't meet in one task either.
    """
    hot = hot_keys(big, key) if hot is None else hot
    if not hot:
        return _cold_join(big, small, key, how)
    is_hot = F.col(key).isin(hot)
    cold_rows = big.where(~F.coalesce(is_hot, F.lit(False)))
    cold = _cold_join(cold_rows, small.where(~is_hot), key, how)
    return big.where(is_hot).join(F.broadcast(small.where(is_hot)), key, how).unionByName(cold)


def _cold_join(big: DataFrame, small: DataFrame, key: str, how: str) -> DataFrame:
    """The shuffled join; where rows without a key are kept, the lane is part of what is hashed. It follows from the row, so a task run again deals alike."""
    if how not in ("left", "left_anti"):
        return big.join(small, key, how)
    lane = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(NULL_LANES)).cast("int")).otherwise(F.lit(-1))
    # a literal would be folded into a plain condition and drop out of what is hashed; this is -1 for every row as well
    theirs = (F.pmod(F.xxhash64(key), F.lit(1)) - 1).cast("int")
    return big.withColumn("__lane", lane).join(small.withColumn("__lane", theirs), [key, "__lane"], how).drop("__lane")


#: Rows up to which a dimension is broadcast; counted before, never assumed.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has at most `most` rows (at most that many are counted), else as it is: then the join shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df

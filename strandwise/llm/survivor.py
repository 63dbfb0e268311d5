"""One surviving record per group of duplicates by skyline layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _front(points: Column, fields: list[str]) -> Column:
    """Points that no other point dominates.

    y dominates x when it has every field x has, is trusted no less and is no older, and beats x in one of these.
    """

    def beaten(x: Column) -> Column:
        def by(y: Column) -> Column:
            no_worse = (y["rank"] <= x["rank"]) & (y["at"] >= x["at"])
            better = (y["rank"] < x["rank"]) | (y["at"] > x["at"])
            for f in fields:
                no_worse = no_worse & (x[f"v_{f}"].isNull() | y[f"v_{f}"].isNotNull())
                better = better | (x[f"v_{f}"].isNull() & y[f"v_{f}"].isNotNull())
            return no_worse & better

        return F.exists(points, by)

    return F.filter(points, lambda x: ~beaten(x))


def best_representative(rows: DataFrame, group: list[str], fields: list[str], rank: str, at: str) -> DataFrame:
    """One row per group: the group columns, each of `fields`, and n_rows.

    A null in a field means "not usable"; the caller nulls placeholders. `rank` is the trust (1 best; null
    counts as worst), `at` the recency (null counts as oldest). Completeness is compared field by field.

    Rows with the same rank and the same filled fields differ in recency only, so the newest of them (of equal
    ones the smallest values) stands for the rest; that is decided by partial aggregation before the shuffle and leaves at most
    (ranks x 2^fields) points per group, however many rows it has. On those points the Pareto front is taken;
    its lexicographic first (rank, then recency, then values) is the survivor, whose empty fields are filled
    from the following points of the front.

    Deeper layers need not be computed: a point with field f is dominated only by points that also have f and come no
    later in the policy. So if any point has f, a point of the front has it, and the value that the policy would choose for
    f alone is in the front. Groups without any usable value keep nulls. Every row delivered counts in n_rows, repeats too;
    they change nothing else. An empty table gives an empty result; other columns are ignored, whatever they are called.
    """
    worst, never = 2**31 - 1, "0001-01-01 00:00:00"
    vals = [F.col(f).alias(f"v_{f}") for f in fields]
    filled = [F.col(f).isNotNull().alias(f"has_{f}") for f in fields]
    base = rows.select(
        *[F.col(g).alias(f"g_{i}") for i, g in enumerate(group)], *vals, *filled,
        F.coalesce(F.col(rank).cast("int"), F.lit(worst)).alias("rank"),
        F.coalesce(F.col(at).cast("timestamp"), F.lit(never).cast("timestamp")).alias("at"),
    )
    keys = [f"g_{i}" for i in range(len(group))]
    v = F.struct(*[f"v_{f}" for f in fields])
    age = -F.unix_micros("at")
    cells = base.groupBy(*keys, "rank", *[f"has_{f}" for f in fields]).agg(F.min_by(v, F.struct(age.alias("age"), v.alias("v"))).alias("best"), F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))
    point = F.struct("rank", (-F.unix_micros("at")).alias("age"), *[F.col(f"best.v_{f}").alias(f"v_{f}") for f in fields], "at")
    groups = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"), F.sum("n").alias("n_rows"))
    layered = groups.withColumn("front", _front(F.col("points"), fields))

    def pick(f: str) -> Column:
        return F.get(F.filter("front", lambda x: x[f"v_{f}"].isNotNull()), F.lit(0))[f"v_{f}"].alias(f)

    return layered.select(*[F.col(k).alias(g) for k, g in zip(keys, group)], *[pick(f) for f in fields], "n_rows")

"""Overlap sizes between many large sets from a coordinated sample of their identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.session import Scratch

#: Share of the identifiers whose hash lies below the common threshold.
SAMPLE_RATE = 1 / 16
#: Width of the confidence interval in standard errors; fewer than one in a million intervals miss.
Z = 5.0


def _below(rate: float):
    """Identifiers whose 64-bit hash lies in the lowest `rate` of its range; the same in every set."""
    low = -(2**63)
    return F.xxhash64("item") < F.lit(int(low + rate * 2.0**64))


def _complete(members: DataFrame) -> DataFrame:
    return members.select("kind", "set_id", "item").where("kind is not null and set_id is not null and item is not null")


def _pair_counts(members: DataFrame) -> DataFrame:
    """(kind, a, b, n): identifiers that sets a < b share; each identifier's sets come once, partial sums first."""
    sets = members.groupBy("kind", "item").agg(F.sort_array(F.collect_set("set_id")).alias("sets")).where(F.size("sets") > 1)
    one = sets.select("kind", "sets", F.explode("sets").alias("a"))
    two = one.select("kind", "a", F.explode(F.filter("sets", lambda x: x > F.col("a"))).alias("b"))
    return two.groupBy("kind", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def set_sizes(members: DataFrame) -> DataFrame:
    """(kind, set_id, size): exact distinct identifiers of each set."""
    return members.distinct().groupBy("kind", "set_id").agg(F.count(F.lit(1)).alias("size"))


def _unseen(rate: float, z: float) -> float:
    """The upper end of the interval of two sets of which no sampled identifier is shared."""
    return z * z * (1 - rate) / rate


def _with_interval(counts: DataFrame, sizes: DataFrame, rate: float, z: float) -> DataFrame:
    """Co-occurrence counts with the sizes of both sets, the estimate, and the Wilson-type interval around it."""
    n, spread = F.col("shared"), (1 - rate)
    centre, half = n + z * z * spread / 2, z * F.sqrt((n + z * z * spread / 4) * spread)
    least = F.least("size_a", "size_b").cast("double")
    return (
        _sized(counts.withColumnRenamed("n", "shared"), sizes)
        .withColumn("estimate", F.least(n / rate, least))
        .withColumn("low", F.greatest(n.cast("double"), (centre - half) / rate))
        .withColumn("high", F.least(least, (centre + half) / rate))
        .select("kind", "a", "b", "size_a", "size_b", "shared", "estimate", "low", "high")
    )


def overlap_estimates(members: DataFrame, rate: float = SAMPLE_RATE, z: float = Z) -> DataFrame:
    """Estimated overlap of the pairs of sets of a kind: (kind, a, b, size_a, size_b, shared, estimate, low, high).

    `members` has kind, set_id and item, repeats allowed; rows with a null in any of them are left out, other columns
    ignored. Only identifiers under the common hash threshold are grouped by identifier, at every size of input alike; the sizes
    are exact and take a shuffle of the distinct (set, identifier) pairs, counted in part before it. Of the
    identifiers that a and b share each is kept with probability `rate`; so shared / rate is unbiased, and
    the Wilson-type interval of width `z` around it holds for small counts too.

    Pairs come from co-occurrence: a pair of which no sampled identifier is shared has no row, and its overlap is below
    z^2 (1 - rate) / rate (375 with the defaults). The number of rows is bounded by the pairs that share an identifier.
    """
    m = _complete(members)
    return _with_interval(_pair_counts(m.where(_below(rate))), set_sizes(m), rate, z)


def exact_overlaps(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(kind, a, b, n): exact overlaps of the given pairs that share anything; only identifiers of their sets are counted.

    `pairs` holds at most one row per pair of sets, so it is as small as the estimates are.
    """
    sets = pairs.select("kind", F.explode(F.array("a", "b")).alias("set_id")).distinct()
    return _pair_counts(_complete(members).join(sets, ["kind", "set_id"], "left_semi")).join(pairs.select("kind", "a", "b"), ["kind", "a", "b"], "left_semi")


def small_overlaps(members: DataFrame, small: DataFrame) -> DataFrame:
    """(kind, a, b, n): exact overlaps of all pairs with at least one of the given sets (kind, set_id).

    Only identifiers that such a set holds are counted, found by a semi join; the other sets' own identifiers stay where they are.
    """
    m = _complete(members)
    marked = small.select("kind", "set_id").distinct()
    items = m.join(marked, ["kind", "set_id"], "left_semi").select("kind", "item").distinct()
    few = marked.withColumnRenamed("set_id", "s")
    counts = _pair_counts(m.join(items, ["kind", "item"], "left_semi"))
    of_a = counts.join(few.withColumnRenamed("s", "a"), ["kind", "a"], "left_semi")
    rest = counts.join(few.withColumnRenamed("s", "a"), ["kind", "a"], "left_anti")
    return of_a.unionByName(rest.join(few.withColumnRenamed("s", "b"), ["kind", "b"], "left_semi").select(of_a.columns))


def _split(members: DataFrame, share: float, rate: float, z: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, sets so small that an overlap of `share` of them can stay unseen in the sample, sampled estimates of the pairs of the others)."""
    m = _complete(members)
    sizes = Scratch(members.sparkSession).write(set_sizes(m))
    small = sizes.where(F.col("size") * share <= _unseen(rate, z))
    large = sizes.where(F.col("size") * share > _unseen(rate, z))
    sampled = _pair_counts(m.where(_below(rate)).join(large.select("kind", "set_id"), ["kind", "set_id"], "left_semi"))
    return sizes, small, _with_interval(sampled, large, rate, z)


def _sized(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    a = sizes.select("kind", F.col("set_id").alias("a"), F.col("size").alias("size_a"))
    b = sizes.select("kind", F.col("set_id").alias("b"), F.col("size").alias("size_b"))
    return counts.join(a, ["kind", "a"]).join(b, ["kind", "b"])


def overlap_report(members: DataFrame, share: float, rate: float = SAMPLE_RATE, z: float = Z) -> DataFrame:
    """The columns of overlap_estimates and `by`, for all pairs: estimated where both sets are large, counted where one is small.

    Large means more than z^2 (1 - rate) / rate / share identifiers. A counted overlap has low = estimate = high and a null `shared`.
    """
    sizes, small, est = _split(members, share, rate, z)
    n = F.col("n").cast("double")
    counted = _sized(small_overlaps(members, small), sizes).select("kind", "a", "b", "size_a", "size_b", F.lit(None).cast("bigint").alias("shared"), n.alias("estimate"), n.alias("low"), n.alias("high"))
    return est.withColumn("by", F.lit("sample")).unionByName(counted.withColumn("by", F.lit("count")))


def overlapping_pairs(members: DataFrame, share: float, rate: float = SAMPLE_RATE, z: float = Z) -> DataFrame:
    """(kind, a, b, by) with an overlap of at least `share` of the smaller set; `by` says what decided: sample or count.

    The sample decides pairs of sets so large that an overlap of that share can't stay unseen in it, where the interval lies wholly on
    one side; those it leaves open are counted exactly. Pairs with a smaller set (at most z^2 (1 - rate) / rate / share
    identifiers, 1 500 with a share of a quarter) are counted from the smaller sets' identifiers alone. No pair is listed that shares nothing.
    """
    sizes, small, sampled = _split(members, share, rate, z)
    need = F.least("size_a", "size_b") * F.lit(share)
    est = Scratch(members.sparkSession).write(sampled.withColumn("need", need))
    sure = est.where(F.col("low") >= F.col("need")).select("kind", "a", "b", F.lit("sample").alias("by"))
    open_ = est.where((F.col("low") < F.col("need")) & (F.col("high") >= F.col("need")))
    counted = exact_overlaps(members, open_).unionByName(small_overlaps(members, small))
    exact = _sized(counted, sizes).where(F.col("n") >= need)
    return sure.unionByName(exact.select("kind", "a", "b", F.lit("count").alias("by")))

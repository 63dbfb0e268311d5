"""Deterministic picks, ambiguity gates, new keys and dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.session import Scratch


def top1(df: DataFrame, keys: list[str], order: list[tuple[str, bool]]) -> DataFrame:
    """The first row per key under a total order of (column, ascending), nulls last, without a window.

    The order columns and the other columns form a struct whose minimum is taken with partial aggregation, so a hot key
    never meets one task. Descending columns must be numbers. Ties fall to the smallest remaining columns; rows equal in
    all columns are one row. Null keys form a group.
    """
    rest = [c for c in df.columns if c not in keys]
    parts: list[Column] = []
    value: dict[str, Column] = {c: F.col(f"b.{c}") for c in rest}
    for i, (c, up) in enumerate(order):
        parts += [F.col(c).isNull().alias(f"__n{i}"), (F.col(c) if up else -F.col(c)).alias(f"__o{i}")]
        if c in rest:  # each column travels once: an order column is read back from its place in the order
            value[c] = F.col(f"b.__o{i}") if up else -F.col(f"b.__o{i}")
    ordered = {o for o, _ in order}
    best = df.groupBy(*keys).agg(F.min(F.struct(*parts, *[F.col(c) for c in rest if c not in ordered])).alias("b"))
    return best.select(*keys, *[value[c].alias(c) for c in rest]).select(df.columns)


def value_counts(df: DataFrame, keys: list[str], value: list[str]) -> DataFrame:
    """(keys, n_values): distinct non-null values per key; a value of several columns is one."""
    v = F.struct(*value) if len(value) > 1 else F.col(value[0])
    any_null = F.lit(False)
    for c in value[:1] if len(value) == 1 else []:
        any_null = any_null | F.col(c).isNull()
    return df.where(~any_null).select(*keys, v.alias("__v")).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values"))


def ambiguity_split(df: DataFrame, keys: list[str], value: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key has exactly one value, rows whose key has several)."""
    n = value_counts(df, keys, value)
    return df.join(n.where("n_values = 1").select(*keys), keys, "left_semi"), df.join(n.where("n_values > 1").select(*keys), keys, "left_semi")


def new_keys(batch: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the cache does not hold; null keys compare as equal."""
    k = known.select(*[F.col(c).alias(f"__{c}") for c in keys]).distinct()
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return batch.join(k, on, "left_anti")


def merge_cache(known: DataFrame, batch: DataFrame, keys: list[str], first: str, last: str, sets: list[str]) -> DataFrame:
    """Cache and batch in one: earliest first, latest last, and the union of each packed array column."""
    both = known.unionByName(batch)
    times = both.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last))
    out = times
    for s in sets:
        u = both.select(*keys, F.explode_outer(s).alias("__x")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("__x")).alias(s))
        cond = F.lit(True)
        u = u.select(*[F.col(k).alias(f"__{k}") for k in keys], s)
        for k in keys:
            cond = cond & out[k].eqNullSafe(u[f"__{k}"])
        out = out.join(u, cond).drop(*[f"__{k}" for k in keys])
    return out


def dense_ids(df: DataFrame, key: str, out: str = "dense_id", start: int = 1) -> DataFrame:
    """Consecutive numbers in bytewise order of a unique key, without one task that sees all rows.

    Range partitions are sorted on their own; the number of rows before each (one figure per partition) is added.
    Rows with a null key come last.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, F.col(key).isNull(), F.col(key)).sortWithinPartitions(F.col(key).isNull(), F.col(key))
    placed = Scratch(spark).write(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id() % F.lit(1 << 33)))
    sizes = {r[0]: r[1] for r in placed.groupBy("__part").agg(F.count(F.lit(1))).collect()}
    before, total = [], start
    for i in range(parts):
        before.append((i, total))
        total += sizes.get(i, 0)
    base = spark.createDataFrame(before, "__part int, __base long")
    return placed.join(F.broadcast(base), "__part").withColumn(out, F.col("__base") + F.col("__at")).drop("__part", "__at", "__base")


def missing_names(names: DataFrame, known: DataFrame, name: str, number: str) -> DataFrame:
    """Dimension rows to add: names the dimension lacks, numbered on from its largest number in bytewise order."""
    top = known.agg(F.coalesce(F.max(number), F.lit(0))).first()[0]
    fresh = names.select(name).where(F.col(name).isNotNull()).distinct().join(known.select(name), name, "left_anti")
    return dense_ids(fresh, name, number, int(top) + 1)

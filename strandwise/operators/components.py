"""Connected groups of pairwise matches by alternating large-star and small-star rewrites."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.operators.skew import HOT_SHARE, hot_keys, join_unique
from strandwise.session import Scratch

#: Edges of a task that are contracted together before the first round.
BLOCK = 1 << 20


def local_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node) of the components that the given edges form on their own; roots hook below lower ones until none can."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, root = flat[: len(u)], flat[len(u) :], np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of a task's edges become the stars of their own components: as many edges at most, and the same components."""
    held, size = [], 0

    def stars() -> pd.DataFrame:
        return pd.DataFrame(dict(zip("uv", local_forest(*(np.concatenate([p[c].to_numpy() for p in held]) for c in "uv")))))

    for pdf in batches:
        held.append(pdf)
        size += len(pdf)
        if size >= BLOCK:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def _hubs(degrees: DataFrame, key: str, *counts: str) -> list[list[int]]:
    """For each column of counts, the keys with more than HOT_SHARE of its sum; so at most 1 / HOT_SHARE of them."""
    total = degrees.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).first()
    most = {c: HOT_SHARE * total[c] for c in counts}
    over = F.lit(False)
    for c in counts:
        over = over | (F.col(c) > most[c])
    rows = degrees.where(over).select(key, *counts).collect()
    return [[r[key] for r in rows if r[c] > most[c]] for c in counts]


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v, leaf): each neighbour above v hangs on the smallest neighbour of v (or v itself).

    A node whose only edge leads down follows its neighbour wherever that goes: such an edge is kept as it was, marked as a leaf.
    """
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("low")), F.struct(F.col("v").alias("x"), F.lit(None).cast("long").alias("low")))).alias("e")).select("e.*")
    nodes = scratch.write(ends.groupBy("x").agg(F.min("low").alias("m"), F.count("low").alias("down"), (F.count(F.lit(1)) - F.count("low")).alias("up")))
    hub_u, hub_v = _hubs(nodes, "x", "down", "up")
    joined = join_unique(edges, nodes.where("m is not null").select(F.col("x").alias("v"), "m"), "v", "left", hub_v)
    leaves = nodes.where("down = 1 and up = 0").select(F.col("x").alias("u"), F.lit(True).alias("leaf"))
    marked = join_unique(joined, leaves, "u", "left", hub_u)
    leaf = F.coalesce("leaf", F.lit(False))
    out = scratch.write(marked.select("u", F.when(leaf, F.col("v")).otherwise(F.coalesce("m", "v")).alias("v"), leaf.alias("leaf")))
    scratch.drop(nodes)
    return out


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """u and all its neighbours below hang on the smallest of them; repeated edges become one."""
    least = scratch.write(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    (hub,) = _hubs(least, "u", "n")
    joined = join_unique(edges, least.select("u", "m"), "u", "inner", hub)
    below = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = scratch.write(below.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    scratch.drop(least)
    return out


def connected_groups(pairs: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """One row (node_key, group_key) per key that occurs in a complete pair.

    `left` and `right` hold string keys; a pair with a null side links nothing and adds no node. A pair of
    a key with itself adds the key alone. Repeated and reversed pairs count once. group_key is the bytewise
    smallest key linked to node_key directly or over others, itself included. An empty table gives an empty
    result. Other columns of `pairs` are ignored, whatever they are called.

    Keys become 8-byte numbers in bytewise order (range-sorted, written once). Each task contracts its own edges to stars, which
    saves the first rounds their bulk. Then large-star and small-star rewrites alternate. A node whose only edge leads to a smaller
    one is set aside with that edge, as it ends where its neighbour ends; so finished groups leave the rounds, which go on with the
    rest until no edge is left. The edges set aside are then followed from the last round to the first. Every step is written to the shared
    checkpoint folder, which cuts lineage and survives the loss of executors. Rounds grow with the logarithm of
    the longest chain. Hubs are found by exact counts at every size and joined by broadcasting their few rows; only counts and
    at most 1 / HOT_SHARE hubs per step come to the driver.
    """
    spark = pairs.sparkSession
    scratch = Scratch(spark)
    both = pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    links = scratch.write(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    names = scratch.write(links.select(F.explode(F.array("a", "b")).alias("node_key")).distinct())
    nodes = scratch.write(names.repartitionByRange("node_key").sortWithinPartitions("node_key").select("node_key", F.monotonically_increasing_id().alias("nid")))
    scratch.drop(names)
    coded = join_unique(links.where("a <> b"), nodes.select(F.col("node_key").alias("a"), F.col("nid").alias("u")), "a")
    coded = join_unique(coded.select("u", "b"), nodes.select(F.col("node_key").alias("b"), F.col("nid").alias("v")), "b", hot=hot_keys(links, "b"))
    edges = scratch.write(coded.select("u", "v").mapInPandas(_contract, "u long, v long"))
    scratch.drop(links)
    aside: list[DataFrame] = []
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        large = _large_star(edges, scratch)
        scratch.drop(edges)
        aside.append(large.where("leaf").select("u", "v"))
        edges = _small_star(large.where("not leaf").select("u", "v"), scratch)
    else:
        raise RuntimeError(f"edges are left after {max_rounds} rounds")
    roots = spark.createDataFrame([], "u long, root long")
    for hung in reversed(aside):
        above = join_unique(hung, roots.select(F.col("u").alias("v"), "root"), "v", "left", hot_keys(hung, "v"))
        roots = roots.unionByName(scratch.write(above.select("u", F.coalesce("root", "v").alias("root"))))
    rooted = nodes.join(roots.withColumnRenamed("u", "nid"), "nid", "left").select("node_key", F.coalesce("root", "nid").alias("root"))
    named = nodes.select(F.col("nid").alias("root"), F.col("node_key").alias("group_key"))
    return join_unique(rooted, named, "root", hot=hot_keys(roots, "root")).select("node_key", "group_key")

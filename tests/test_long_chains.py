"""Components whose longest path has thousands of steps, in an order that no label travels fast along."""

import random

from strandwise.operators import chemicals, resolve


def chain(n, seed):
    """The nodes of a path in random order; the path goes along the list."""
    names = [f"n{i:05d}" for i in range(n)]
    random.Random(seed).shuffle(names)
    return names


def test_components_of_a_long_chain_in_random_order(spark):
    names = chain(3000, 5)
    rows = spark.createDataFrame([*zip(names, names[1:]), ("x", "y"), (None, "z")], "a string, b string").repartition(16)
    got = {r["node"]: r["root"] for r in resolve.lookup_components(rows, "a", "b").collect()}
    assert got == {n: "n00000" for n in names} | {"x": "x", "y": "x"}


def test_components_of_a_long_chain_without_contraction_in_tasks(spark, monkeypatch):
    """The rounds alone settle it, as they must where a chain lies over many tasks."""
    from strandwise.operators import components

    monkeypatch.setattr(components, "_contract", lambda batches: batches)
    names = chain(1500, 6)
    got = resolve.lookup_components(spark.createDataFrame([*zip(names, names[1:])], "a string, b string"), "a", "b")
    assert {tuple(r) for r in got.collect()} == {(n, "n00000") for n in names}


def test_clusters_along_a_long_chain(spark):
    names = chain(1200, 7)
    rows = [(f"r{i}", 24, n) for i, pair in enumerate(zip(names, names[1:])) for n in pair] + [("r0", 24, "n0"), ("one", 23, "C1"), (None, 23, "C2"), ("end", 24, names[-1]), ("end", 8, "CHEBI:5")]
    hits = [(24, names[0], "AAAAAAAAAAAAAA-BBBBBBBBBB-N")]
    got = chemicals.cluster_lookup(spark.createDataFrame(rows, "row_id string, key_type long, key_value string"), spark.createDataFrame(hits, "key_type long, key_value string, structure string"), 13, [8])
    far = {(24, n, 13, hits[0][2]) for n in [*names, "n0"]} | {(8, "CHEBI:5", 13, hits[0][2])}
    assert {tuple(r) for r in got.collect()} == far | {(23, "C1", 23, "C1")}

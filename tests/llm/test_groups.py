import random
from collections import defaultdict

import pytest

from strandwise.llm.components import connected_groups


def by_union_find(pairs):
    parent = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is None or b is None:
            continue
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent}


def groups(spark, pairs):
    df = spark.createDataFrame(pairs, "l string, r string, node_key int, a int") if pairs else spark.createDataFrame([], "l string, r string, node_key int, a int")
    rows = connected_groups(df, "l", "r").collect()
    assert len(rows) == len({r["node_key"] for r in rows})
    return {tuple(r) for r in rows}


def with_extra(pairs):
    return [(a, b, 1, 2) for a, b in pairs]


def test_chain_cycle_self_null_repeat_and_reverse(spark):
    pairs = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)] + [("x", "y"), ("y", "z"), ("z", "x"), ("y", "x"), ("x", "y"), ("s", "s"), (None, "n"), ("m", None), (None, None), ("Z", "a" * 5000)]
    assert groups(spark, with_extra(pairs)) == by_union_find(pairs)


def test_empty_and_all_null(spark):
    assert groups(spark, []) == set()
    assert groups(spark, with_extra([(None, "a")])) == set()


@pytest.mark.parametrize("hub", ["000hub", "zzzhub"])
def test_hub_with_most_pairs(spark, hub):
    rng = random.Random(1)
    pairs = [(hub, f"n{i}") for i in range(300)] + [(f"m{rng.randint(0, 200)}", f"m{rng.randint(0, 200)}") for _ in range(150)]
    assert groups(spark, with_extra(pairs)) == by_union_find(pairs)


def test_local_forest_equals_union_find():
    import numpy as np

    from strandwise.llm.components import local_forest

    rng = random.Random(7)
    for n in (1, 5, 60, 3000):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(n)]
        u, v = local_forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        want = {(a, b) for a, b in by_union_find([(x, y) for x, y in pairs]) if a != b}
        assert set(zip(u.tolist(), v.tolist())) == want


def test_hubs_of_small_graphs_take_the_split_path(spark, monkeypatch):
    """No size of graph leaves the rows of a hub to one task."""
    from strandwise.llm import components

    seen, real = [], components.join_unique

    def watched(big, small, key, how="inner", hot=None):
        seen.append((key, hot))
        return real(big, small, key, how, hot)

    monkeypatch.setattr(components, "join_unique", watched)
    monkeypatch.setattr(components, "_contract", lambda batches: batches)
    pairs = [("000hub", f"n{i}") for i in range(200)] + [(f"n{i}", f"p{i}") for i in range(200)] + [(f"z{i}", "zhub") for i in range(100)]
    assert groups(spark, with_extra(pairs)) == by_union_find(pairs)
    assert any(hot for key, hot in seen if key == "v") and any(hot for key, hot in seen if key == "u")


def test_random_graphs_round_by_round(spark, monkeypatch):
    from strandwise.llm import components

    monkeypatch.setattr(components, "_contract", lambda batches: batches)
    rng = random.Random(11)
    pairs = [(f"a{rng.randrange(400):03d}", f"a{rng.randrange(400):03d}") for _ in range(330)] + [(f"c{i:03d}", f"c{(i * 7) % 120:03d}") for i in range(120)]
    assert groups(spark, with_extra(pairs)) == by_union_find(pairs)

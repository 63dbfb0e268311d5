import random

from strandwise.llm.overlap import exact_overlaps, overlap_estimates, overlap_report, overlapping_pairs

SCHEMA = "kind string, set_id long, item string, a int, n int"


def sets(rng, n):
    base = [f"i{j}" for j in range(4000)]
    return {s: set(rng.sample(base, rng.choice([30, 300, 1500]))) for s in range(n)}


def frame(spark, own):
    rows = [("k", s, x, 0, 0) for s, xs in own.items() for x in xs]
    return spark.createDataFrame(rows + rows[:50] + [("k", None, "x", 0, 0), ("k", 1, None, 0, 0), (None, 1, "i1", 0, 0)], SCHEMA)


def test_pairs_equal_brute_force_though_sampled(spark):
    own = sets(random.Random(5), 12)
    own[3] = set(list(own[2])[: len(own[2]) // 2]) | {"only"}
    for share in (0.1, 0.25, 0.5):
        want = {(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= share * min(len(own[a]), len(own[b]))}
        assert {(r["a"], r["b"]) for r in overlapping_pairs(frame(spark, own), share).collect()} == want


def test_estimates_are_near_and_intervals_hold(spark):
    own = sets(random.Random(6), 10)
    rows = overlap_estimates(frame(spark, own), rate=0.25).where("kind = 'k'").collect()
    for r in rows:
        true = len(own[r["a"]] & own[r["b"]])
        assert r["shared"] > 0 and r["size_a"] == len(own[r["a"]]) and r["low"] <= true <= r["high"]
    listed = {(r["a"], r["b"]) for r in rows}
    assert all(len(own[a] & own[b]) <= 25 * 0.75 / 0.25 for a in own for b in own if a < b and (a, b) not in listed)


def test_report_counts_pairs_with_small_sets_and_estimates_the_rest(spark):
    rng = random.Random(8)
    own = {s: set(rng.sample(range(9000), n)) for s, n in enumerate([20, 40, 3000, 3500, 4000, 5])}
    own[6] = {-1}
    rows = overlap_report(frame(spark, {s: {f"i{x}" for x in xs} for s, xs in own.items()}), 0.25, rate=0.25).where("kind = 'k'").collect()
    got = {(r["a"], r["b"]): r for r in rows}
    assert set(got) == {(a, b) for a in own for b in own if a < b and own[a] & own[b]} and len(got) == len(rows)
    for (a, b), r in got.items():
        n, large = len(own[a] & own[b]), min(len(own[a]), len(own[b])) > 300
        assert r["by"] == ("sample" if large else "count") and r["low"] <= n <= r["high"] and (large or r["estimate"] == n)


def test_the_sample_decides_large_pairs(spark):
    own = {1: {f"x{i}" for i in range(4000)}, 2: {f"x{i}" for i in range(2000, 6000)}, 3: {f"y{i}" for i in range(4000)}}
    got = {(r["a"], r["b"]): r["by"] for r in overlapping_pairs(frame(spark, own).where("kind = 'k'"), 0.25, rate=0.5).collect()}
    assert got == {(1, 2): "sample"}


def test_many_sets_without_a_common_identifier_list_nothing(spark):
    members = spark.range(100_000).selectExpr("'k' kind", "id set_id", "cast(id as string) item", "0 a", "0 n")
    assert overlapping_pairs(members, 0.25).count() == 0 and overlap_report(members, 0.25).count() == 0


def test_exact_counts_of_given_pairs_and_ties_at_the_threshold(spark):
    own = {1: {"a", "b", "c", "d"}, 2: {"a", "x", "y", "z", "w"}, 3: {"q"}}
    df = frame(spark, own).where("n = 0 and item <> 'x' or set_id = 2")
    pairs = spark.createDataFrame([("k", 1, 2), ("k", 1, 3)], "kind string, a long, b long")
    assert [r["n"] for r in exact_overlaps(df, pairs).collect()] == [1]
    assert {(r["a"], r["b"]) for r in overlapping_pairs(df.where("kind = 'k'"), 0.25).collect()} == {(1, 2)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert overlapping_pairs(df, 0.25).count() == 0 and overlap_estimates(df).count() == 0 and overlap_report(df, 0.25).count() == 0

import random

import numpy as np

from strandwise.llm.mixing import bounded_least_squares, fitted_rates, mix, token_counts, whole_copies


def corpus(spark, rng, sizes):
    rows = [(i, " ".join(rng.choice(["cell", "assay", "binding", "liver", "note"]) for _ in range(rng.randint(5, 60))), s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows + [(10**6, None, "big", 0), (10**6 + 1, "", "big", 0), (10**6 + 2, "word " * 50_000, "huge", 0)], "doc_id long, text string, source string, copies int")


def test_shares_meet_targets_within_repeats(spark):
    docs = corpus(spark, random.Random(1), {"big": 600, "mid": 200, "small": 40, "off": 50, None: 20})
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("absent", 0.0, 3)], "source string, target_share double, max_repeat int")
    selection, shares = mix(docs, "doc_id", "text", "source", targets)
    got = {r["source"]: r for r in shares.collect()}
    for s, want, cap in (("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4)):
        assert abs(got[s]["actual_share"] - want) < 0.01 and got[s]["most_copies"] <= cap
    assert got["off"]["tokens_taken"] == 0 and got[None]["tokens_taken"] == 0 and got["huge"]["tokens_taken"] == 0 and got["absent"]["n_docs"] == 0
    assert abs(sum(r["expected_share"] for r in got.values()) - 1) < 1e-6
    rows = selection.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(r["n_tokens"] > 0 and r["copies"] >= 1 for r in rows)


def test_token_counts_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hello world"), (4, "<|endoftext|>"), (5, "é" * 10)], "i int, t string")
    n = {r["i"]: r["n_tokens"] for r in token_counts(df, "t").collect()}
    assert n[1] == n[2] == 0 and n[3] == 2 and n[4] > 1 and n[5] > 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeat int")
    selection, shares = mix(docs, "doc_id", "text", "source", targets)
    assert selection.count() == 0 and [r["actual_share"] for r in shares.collect()] == [0.0]
    one = spark.createDataFrame([(1, "a b", "a")], docs.schema)
    assert mix(one, "doc_id", "text", "source", targets.limit(0))[0].count() == 0


def by_coordinates(a, goal, cap):
    """The same problem one rate at a time, each set to its best value; converges to the least distance."""
    scale = np.where(goal > 0, goal, max(goal.sum(), 1.0))
    m, want, r = (a / scale).T, goal / scale, np.zeros(len(cap))
    for _ in range(20_000):
        for c in range(len(cap)):
            rest = want - m @ r + m[:, c] * r[c]
            r[c] = min(cap[c], max(0.0, m[:, c] @ rest / max(m[:, c] @ m[:, c], 1e-12)))
    return r, float(((m @ r - want) ** 2).sum())


def test_least_squares_equals_another_solver_where_bounds_bind():
    rng = np.random.default_rng(4)
    for case in range(4):
        a = rng.gamma(0.4, 1000, (12, 5)) + np.repeat(np.eye(5), 3, axis=0)[:12] * 5000
        cap = rng.integers(1, 5, 12).astype(float)
        goal = rng.dirichlet(np.ones(5)) * a.sum() * (0.4, 1.0, 2.0, 6.0)[case]
        r = bounded_least_squares(a, goal, cap, np.ones(12))
        _, least = by_coordinates(a, goal, cap)
        assert (r >= 0).all() and (r <= cap + 1e-9).all()
        assert abs((((a.T @ r - goal) / goal) ** 2).sum() - least) < 1e-6 + 1e-4 * least
        if case == 3:
            assert (np.abs(r - cap) < 1e-9).any()


def test_the_default_total_is_the_largest_that_fits():
    a, cap = np.diag([1000.0, 100.0, 10.0]), np.array([1.0, 2.0, 3.0])
    r, total = fitted_rates(a, np.array([0.5, 0.3, 0.2]), cap, np.ones(3, bool), None)
    assert abs(total - 150) < 0.5 and abs(r[2] - 3) < 0.02 and np.allclose(a.T @ r, np.array([75, 45, 30]), rtol=3e-3)
    r, _ = fitted_rates(a, np.array([0.5, 0.3, 0.2]), cap, np.ones(3, bool), 600.0)
    assert np.allclose(r, [0.3, 1.8, 3.0], atol=1e-3)  # the third can't give its 120


def test_wrong_and_missing_labels_change_the_rates(spark):
    """A third of the documents labelled a read like b, some have no label: totals by what they read like come nearer to the targets."""
    rng = random.Random(3)
    say = {"a": [f"alpha{i}" for i in range(40)], "b": [f"beta{i}" for i in range(40)]}
    rows = []
    for i in range(900):
        true = rng.choice("ab")
        label = None if rng.random() < 0.1 else "a" if true == "b" and rng.random() < 0.3 else true
        rows.append((i, " ".join(rng.choices(say[true], k=40)), label, true))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, true string")
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 3)], "source string, target_share double, max_repeat int")
    selection, shares = mix(docs, "doc_id", "text", "source", targets, trust=0.9, unlabelled=True)
    got = selection.join(docs.select("doc_id", "true"), "doc_id").collect()
    total = sum(r["n_tokens"] * r["copies"] for r in got)
    by_true = sum(r["n_tokens"] * r["copies"] for r in got if r["true"] == "a") / total
    by_label = sum(r["n_tokens"] * r["copies"] for r in got if r["source"] == "a") / total
    plain, _ = mix(docs, "doc_id", "text", "source", targets, trust=1.0)
    taken = plain.join(docs.select("doc_id", "true"), "doc_id").collect()
    by_labels_alone = sum(r["n_tokens"] * r["copies"] for r in taken if r["true"] == "a") / sum(r["n_tokens"] * r["copies"] for r in taken)
    assert abs(by_true - 0.5) < 0.03 < 0.06 < abs(by_labels_alone - 0.5) and abs(by_label - 0.5) > 0.03
    assert len({round(r["rate"], 6) for r in got}) > 2 and any(r["source"] is None for r in got)
    assert all(abs(r["expected_share"] - 0.5) < 0.03 for r in shares.collect() if r["source"])


def test_copies_follow_the_tokens_of_the_rates():
    rng = np.random.default_rng(2)
    for rate in (0.07, 0.5, 1.0, 2.3, 4.0):
        sizes = np.sort(rng.pareto(1.1, 400) * 20 + 1).astype(int)[::-1]
        c = whole_copies(sizes, np.full(400, rate), np.full(400, 4))
        assert set(c) <= {int(rate), min(4, int(np.ceil(rate)))} and abs((c * sizes).sum() - rate * sizes.sum()) <= sizes[:200].min() / 2 + sizes[-1]
    assert list(whole_copies(np.array([10, 10]), np.array([0.0, 5.0]), np.array([2, 2]))) == [0, 2]

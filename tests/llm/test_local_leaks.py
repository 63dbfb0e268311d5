import random

import numpy as np

from strandwise.llm.leakage import Params, common_path, leaked_items, local_leak, longest_leak

P = Params()


def brute(a, b, least, edits):
    """Whether a stretch with equal words at both ends fits, by plain edit distance."""
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] != b[j]:
                continue
            row = list(range(len(b) - j))
            for n, w in enumerate(a[i + 1 :], 2):
                new = [row[0] + 1]
                for x in range(1, len(row)):
                    new.append(min(row[x - 1] + (w != b[j + x]), row[x] + 1, new[-1] + 1))
                    if w == b[j + x] and n >= least and row[x - 1] <= edits * n:
                        return True
                row = new
    return False


def test_local_leaks_equal_plain_edit_distance():
    rng, both = random.Random(3), set()
    for _ in range(150):
        a = [rng.randrange(1, 7) for _ in range(14)]
        b = [rng.randrange(1, 7) for _ in range(6)] + [w for w in a[3:12] if rng.random() < 0.9] + [rng.randrange(1, 7) for _ in range(6)]
        span, bad = local_leak(np.array(a), np.array(b), 7, 0.15)
        assert (span >= 7) == brute(a, b, 7, 0.15) and bad <= 0.15 * span
        both.add(span >= 7)
    assert both == {True, False}


def test_a_leak_at_the_limit_is_kept_where_its_last_word_comes_again(spark):
    item = [f"w{k}" for k in range(90)]
    noise = lambda n, c: [f"{c}{k}" for k in range(n)]
    doc = noise(40, "x") + item[10:40] + noise(20, "y") + [item[39]] + noise(20, "z")
    code = {w: k for k, w in enumerate(item, 1)}
    a, b = np.arange(1, 91), np.array([code.get(w, 0) for w in doc])
    assert longest_leak(common_path(a, b), P.edits)[0] == 29 and local_leak(a, b, P.least_words, P.edits) == (30, 0)
    short = noise(40, "x") + item[10:39] + noise(20, "y") + [item[39]] + noise(20, "z")
    docs = spark.createDataFrame([(1, " ".join(doc)), (2, " ".join(short)), (3, " ".join(noise(60, "q")))], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(item), "none")], "item_id long, text string, answer string")
    got = leaked_items(docs, "doc_id", "text", items, "item_id", "text", "answer", Params(rank=8)).where("kind = 'passage'").collect()
    assert [(r["doc_id"], r["span_words"], r["span_edits"]) for r in got] == [(1, 30, 0)]


def test_every_leak_passes_the_count_of_triples():
    """Random leaks at the limit of edits: replaced, added and dropped words."""
    from strandwise.llm.leakage import may_leak, runs_of

    rng = random.Random(6)
    for _ in range(400):
        item = [rng.randrange(1, 60) for _ in range(rng.randrange(30, 100))]
        n = rng.randrange(30, min(len(item), 70) + 1)
        a = rng.randrange(len(item) - n + 1)
        leak, places = item[a : a + n], sorted(rng.sample(range(1, n - 1), int(n * P.edits)), reverse=True)
        for k in places:
            leak[k : k + 1] = rng.choice([[99], [leak[k], 98], []])
        doc = [rng.randrange(100, 200) for _ in range(9)] + leak + [rng.randrange(100, 200) for _ in range(9)]
        t = np.array(doc, np.int32)
        assert may_leak(runs_of(np.array(item, np.int32), 3), np.unique(runs_of(t, 3)), P)
    assert not may_leak(runs_of(np.arange(1, 90, dtype=np.int32), 3), np.unique(runs_of(np.arange(20, 38, dtype=np.int32), 3)), P)

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strandwise.llm import leakage
from strandwise.llm.leakage import GAP, Index, Params, common_path, encode, holds, leaked_items, longest_leak, words

VOCAB = [f"w{a}{b}" for a in "abcdefghijklmnop" for b in "qrstuvwxyz"]


def test_words_drop_case_accents_markup_and_citations():
    assert words('<p>Ça va</p>, STRASSE [12] "Straße"&nbsp;x-1') == ["ca", "va", "strasse", "strasse", "x", "1"]


@settings(max_examples=60)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_path_is_a_longest_common_subsequence(a, b):
    path = common_path(np.array(a, int), np.array(b, int))
    assert all(a[i] == b[j] != GAP for i, j in path) and (np.diff(path, axis=0) > 0).all()
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y != GAP else max(best[i][j + 1], best[i + 1][j])
    assert len(path) == best[-1][-1]


def test_longest_leak_counts_edits_between_matches():
    path = np.array([(i, i) for i in range(20)] + [(i, i) for i in range(21, 41)])
    assert longest_leak(path, 0.125) == (41, 1)
    assert longest_leak(np.array([(0, 0), (1, 10), (2, 20)]), 0.125)[0] == 1
    assert longest_leak(np.zeros((0, 2), int), 0.125) == (0, 0)


def planted(rng):
    items = [(i, " ".join(rng.choices(VOCAB, k=90)) + ".", f"answer{i}") for i in range(25)]
    docs, want = [], set()
    noise = lambda n: [f"n{rng.randint(0, 3000)}" for _ in range(n)]
    for d in range(240):
        text = noise(rng.randint(20, 200))
        kind = rng.choice(["none", "exact", "edited", "short", "long_edits"])
        i, t = rng.randrange(25), None
        if kind != "none":
            src = words(items[i][1])
            a = rng.randint(0, 40)
            t = src[a : a + (14 if kind == "short" else rng.randint(34, 48))]
            if kind == "edited":
                for k in range(5, len(t), 12):
                    t[k] = rng.choice(["plus", "then"])
            if kind == "long_edits":
                t = [w if k % 3 else "then" for k, w in enumerate(t)]
            if kind in ("exact", "edited"):
                want.add((d, i))
            t = [w.upper() + "," if rng.random() < 0.2 else w for w in t]
            text = text[: len(text) // 2] + t + text[len(text) // 2 :]
        docs.append((d, " ".join(text), i))
    return items, docs, want


def test_planted_passages_are_found_and_others_are_not(spark):
    items, docs, want = planted(random.Random(4))
    docs += [(1000, None, 0), (1001, "", 0), (1002, "<p></p>", 0), (1003, " ".join(f"z{i}" for i in range(60_000)) + " " + items[7][1], 0)]
    want.add((1003, 7))
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    q = spark.createDataFrame(items + items[:3], "item_id long, text string, answer string")
    out = leaked_items(d, "doc_id", "text", q, "item_id", "text", "answer", Params(rank=16)).where("kind = 'passage'")
    assert {(r["doc_id"], r["item_id"]) for r in out.collect()} == want


def with_noise(rng, docs, n=200):
    return docs + [(10_000 + d, " ".join(f"n{rng.randint(0, 3000)}" for _ in range(rng.randint(20, 150)))) for d in range(n)]


def run(spark, docs, items, p):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id long, text string, answer string")
    return leaked_items(d, "doc_id", "text", q, "item_id", "text", "answer", p).collect()


def test_paraphrase_needs_the_answer_as_it_stands(spark):
    """Gaps of one in every four words: no passage, much in common. The answer's words stand in no item text."""
    rng = random.Random(9)
    body = rng.choices(VOCAB, k=60)
    half = " ".join(w for k, w in enumerate(body) if k % 4)
    docs = with_noise(rng, [(1, half + " the Key"), (2, half), (3, half + " the foo bar key"), (4, "the key " + half), (5, half + " the keys")])
    got = run(spark, docs, [(1, " ".join(body), "The Key"), (2, " ".join(rng.choices(VOCAB, k=50)), "")], Params(rank=8, edits=0.05))
    assert {(r["doc_id"], r["item_id"], r["kind"], r["has_answer"]) for r in got} == {(1, 1, "paraphrase", True), (4, 1, "paraphrase", True)}


def test_planted_paraphrases_are_recalled(spark):
    """Two in five words of an item replaced, some parts swapped, the answer kept; compared with all documents by all items."""
    rng = random.Random(12)
    items = [(i, " ".join(rng.choices(VOCAB, k=80)), f"answer {i}") for i in range(20)]
    docs = []
    for d in range(120):
        i = rng.randrange(20)
        t = [w if rng.random() < 0.62 else f"s{rng.randint(0, 900)}" for w in items[i][1].split()]
        docs.append((d, " ".join([f"n{rng.randint(0, 3000)}" for _ in range(30)] + t + ["so", "answer", str(i)])))
    docs = with_noise(rng, docs)
    memo = {}
    want = set()
    for d, t in docs:
        a = encode(t, memo)
        for i, body, answer in items:
            b = encode(body, memo)
            if holds(a, encode(answer, memo)) and len(common_path(b, a)) >= 0.5 * len(b):
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in run(spark, docs, items, Params(rank=48))}
    assert len(want) > 90 and len(got & want) >= 0.9 * len(want) and got <= want


def test_items_in_one_block_or_many_give_equal_rows(spark, monkeypatch):
    items, docs, _ = planted(random.Random(5))
    docs = [x[:2] for x in docs]
    one = {tuple(r) for r in run(spark, docs, items, Params(rank=16))}
    monkeypatch.setattr(leakage, "BLOCK_WORDS", 800)
    assert {tuple(r) for r in run(spark, docs, items, Params(rank=16))} == one and len(one) > 50


def test_index_recall():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 32))
    x = np.repeat(base, 50, axis=0) + 0.5 * rng.standard_normal((3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = base + 0.5 * rng.standard_normal(base.shape)
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    want = set(zip(*np.nonzero(q @ x.T >= 0.6)))
    got = set(zip(*Index(x.astype(np.float32), 1).search(q.astype(np.float32), 12, 0.6)))
    assert len(want) > 1000 and len(got & want) >= 0.9 * len(want)


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([], "item_id long, text string, answer string")
    one = spark.createDataFrame([(1, "a b c", "b")], "item_id long, text string, answer string")
    assert leaked_items(d, "doc_id", "text", one, "item_id", "text", "answer").count() == 0
    assert leaked_items(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "doc_id", "text", q, "item_id", "text", "answer").count() == 0

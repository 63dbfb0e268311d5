import random

from pyspark.sql import functions as F

from strandwise.operators.orphans import orphan_references, orphan_report

REF = "ref_key string, ref_at timestamp, key string, born int"
PAR = "key string, born timestamp, gone timestamp, ref_key string"


def frames(spark, refs, parents):
    def stamp(df, cols):
        for c in cols:
            df = df.withColumn(c, F.to_timestamp(c))
        return df

    r = spark.createDataFrame(refs, "ref_key string, ref_at string, key string, born int") if refs else spark.createDataFrame([], "ref_key string, ref_at string, key string, born int")
    p = spark.createDataFrame(parents, "key string, born string, gone string, ref_key string") if parents else spark.createDataFrame([], "key string, born string, gone string, ref_key string")
    return stamp(r, ["ref_at"]), stamp(p, ["born", "gone"])


def test_kinds_nulls_repeats_and_clashing_columns(spark):
    refs = [("a", "2024-03-05", "x", 1), ("a", "2024-03-05", "x", 1), ("late", "2024-03-05 10:00:00", None, 2), ("late", "2024-03-05 12:00:00", None, 3), ("gone", "2024-03-05", None, 4),
            ("gone", "2024-03-04", None, 5), ("no", "2024-03-05", None, 6), ("no", None, None, 7), ("a", None, None, 8), (None, "2024-01-01", None, 9), ("", "2024-01-01", None, 10)]
    parents = [("a", "2020-01-01", None, "q"), ("late", "2024-03-05 11:00:00", None, "q"), ("late", "2024-03-05 13:00:00", None, "q"), ("gone", "2020-01-01", "2024-03-05", "q"), (None, None, None, None), ("", None, None, None)]
    got = sorted((r["born"], r["orphan_kind"]) for r in orphan_references(*frames(spark, refs, parents), ranges=3).collect())
    assert got == [(2, "late"), (4, "deleted"), (6, "missing"), (7, "missing")]


def test_empty_tables(spark):
    refs = [("a", "2024-03-05", None, 1)]
    assert orphan_references(*frames(spark, [], []), ranges=2).count() == 0
    assert [r["orphan_kind"] for r in orphan_references(*frames(spark, refs, []), ranges=2).collect()] == ["missing"]
    assert orphan_references(*frames(spark, [], [("a", "2020-01-01", None, None)]), ranges=2).count() == 0


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    day = lambda: f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    parents = [(f"k{i}", day(), day() if rng.random() < 0.3 else None, None) for i in range(60)]
    refs = [(("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 80)}"), day(), None, i) for i in range(500)]
    have = {p[0]: p for p in parents}
    want = []
    for k, at, _, i in refs:
        p = have.get(k)
        kind = "missing" if p is None else "late" if p[1] > at else "deleted" if p[2] and p[2] <= at else None
        if kind:
            want.append((i, kind))
    out = orphan_references(*frames(spark, refs, parents), ranges=5)
    assert sorted((r["born"], r["orphan_kind"]) for r in out.collect()) == sorted(want)
    report = orphan_report(out, [], "ref_at")
    assert report.agg(F.sum("n_orphans")).first()[0] == len(want)

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandwise.functions.ids import content_uuid, entity_key, json_uuid, python_json_uuid
from strandwise.operators import pick
from strandwise.operators.skew import hot_keys, join_unique


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_content_uuid_is_hyphenated_md5(spark):
    h = hashlib.md5("aé|b".encode()).hexdigest()
    got = spark.createDataFrame([("aé|b",), (None,)], "x string").select(content_uuid(F.col("x"))).collect()
    assert got[0][0] == f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}" and got[1][0] is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), max_size=8), min_size=1, max_size=4))
def test_json_uuid_equals_plain_python(spark, parts):
    df = spark.createDataFrame([tuple(parts)], [f"c{i}" for i in range(len(parts))])
    assert df.select(json_uuid(*[F.col(c) for c in df.columns])).first()[0] == python_json_uuid(parts)


def test_entity_key_without_taxonomy(spark):
    df = spark.createDataFrame([("Gene", None, "3", "7")], "a string, b long, c string, d string")
    assert df.select(entity_key(*[F.col(c) for c in "abcd"])).first()[0] == '["Gene","","3","7"]'


def test_top1_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 2, "z"), ("a", 2, "y"), (None, 1, "n"), ("a", 2, "y")], "k string, p int, v string")
    assert rows(pick.top1(df, ["k"], [("p", True), ("v", True)])) == [("a", 2, "y"), (None, 1, "n")]
    assert rows(pick.top1(df, ["k"], [("p", False), ("v", True)])) == [("a", 2, "y"), (None, 1, "n")]
    assert pick.top1(df.limit(0), ["k"], [("p", True)]).count() == 0


def test_ambiguity_split(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", None)], "k string, v string")
    one, many = pick.ambiguity_split(df, ["k"], ["v"])
    assert rows(one) == [("a", "1"), ("a", "1")] and rows(many) == [("b", "1"), ("b", "2")]


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.createDataFrame([(x,) for x in "hgfedcba"] + [(None,)], "k string")
    got = {r["k"]: r["dense_id"] for r in pick.dense_ids(df, "k").collect()}
    assert [got[x] for x in "abcdefgh"] == list(range(1, 9)) and got[None] == 9


def test_new_keys_and_cache_merge_with_null_keys(spark):
    known = spark.createDataFrame([("a", None, 1, 1, ["s"])], "k string, t long, f int, l int, s array<string>")
    batch = spark.createDataFrame([("a", None, 2, 2, ["r"]), ("b", None, 3, 3, ["r"])], known.schema)
    assert [r["k"] for r in pick.new_keys(batch, known, ["k", "t"]).collect()] == ["b"]
    got = rows(pick.merge_cache(known, batch, ["k", "t"], "f", "l", ["s"]))
    assert got == [("a", None, 1, 2, ["r", "s"]), ("b", None, 3, 3, ["r"])]


def test_join_unique_equals_plain_join_for_every_kind(spark):
    big = spark.createDataFrame([("hot", i) for i in range(300)] + [("c", -1), ("z", -2), (None, -3)], "k string, n int")
    small = spark.createDataFrame([("hot", "x"), ("c", "y"), ("other", "w")], "k string, v string")
    assert "hot" in hot_keys(big, "k") and hot_keys(big.limit(0), "k") == []
    for how in ("inner", "left", "left_semi", "left_anti"):
        a, b = join_unique(big, small, "k", how, ["hot"]), big.join(small, "k", how)
        assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(b.columns))), how

import gzip

import pytest
from pyspark.sql import functions as F

from strandwise.sources import files
from strandwise.streaming.key_cache import KeyCache, first_seen, windowed_counts


def test_catalog_selection(spark):
    c = files.Catalog()
    c.add("a", "x", lambda s: s.range(2).toDF("n"))
    c.add("a", "ids", lambda s: s.range(1).toDF("n"), kind="id_translation")
    c.add("b", "y", lambda s: s.range(3).toDF("n"))
    assert c.select() == [("a", "x"), ("b", "y")] and c.select(left_out=frozenset({"b"})) == [("a", "x")] and c.select(["b"]) == [("b", "y")]
    assert c.load(spark, "b", "y").count() == 3
    for bad in (lambda: c.select(["zzz"]), lambda: c.select(["a"], "nope")):
        with pytest.raises(ValueError):
            bad()


def test_shards_manifest_and_union_of_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    files.write_shards(spark.createDataFrame([(1, "x")], "a int, b string"), path, {"version": 1})
    spark.createDataFrame([(2, True)], "a int, c boolean").write.mode("append").parquet(path)
    assert files.cached_shards(spark, path, {"version": 2}) is None and files.cached_shards(spark, str(tmp_path / "no"), {}) is None
    got = files.cached_shards(spark, path, {"version": 1})
    assert set(got.columns) == {"a", "b", "c"} and got.count() == 2
    assert files.capped(got, 1, ["a"]).count() == 1 and files.capped(got, 0, ["a"]).count() == 2


def test_sdf_text_plain_and_gzip(spark, tmp_path):
    text = "mol\n\n> <CID>\n7\n\n> <KEY>\nAAA\nBBB\n\n> <CID>\n8\n\n$$$$\nmol\n\n>  <KEY>  (1)\nCCC\n\n$$$$\n"
    (tmp_path / "a.sdf").write_text(text)
    (tmp_path / "b.sdf.gz").write_bytes(gzip.compress(text.encode()))
    for name in ("a.sdf", "b.sdf.gz"):
        got = {tuple(r) for r in files.read_sdf(spark, str(tmp_path / name), ["CID", "KEY"]).collect()}
        assert got == {("7", "AAA\nBBB"), (None, "CCC")}, name


def test_replace_lookup_csv_and_sweep(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_parquet(spark.range(2).toDF("n"), path)
    files.replace_parquet(files.lookup(spark, [str(tmp_path / "none"), path]).union(spark.range(1).toDF("n")), path)
    assert spark.read.parquet(path).count() == 3 and files.lookup(spark, [str(tmp_path / "none")]) is None
    files.write_csv(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "csv"))
    assert spark.read.text(str(tmp_path / "csv")).first()[0] == "a,\\N"
    assert files.sweep(str(tmp_path), {"t"}) == ["csv"] and files.inline(spark, [(1,)], "a int").count() == 1


def test_key_cache_over_a_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "keys")
    cache = KeyCache(spark, out, ["k"])
    for part in (["a", "b", "a"], ["b", "c"]):
        spark.createDataFrame([(x,) for x in part], "k string").coalesce(1).write.mode("append").parquet(src)
        first_seen(spark.readStream.schema("k string").parquet(src), cache, str(tmp_path / "ck"))
    assert sorted(r["k"] for r in cache.known().collect()) == ["a", "b", "c"]
    n = cache.known().count()
    cache.add(spark.createDataFrame([("b",), ("c",)], "k string"), 1)  # the same batch again
    assert cache.known().count() == n


def test_windowed_counts(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([("2024-01-01 00:01:00", "x"), ("2024-01-01 00:02:00", "x"), ("2024-01-01 00:30:00", "y")], "t string, k string").select(F.to_timestamp("t").alias("t"), "k").write.parquet(src)
    q = windowed_counts(spark.readStream.schema("t timestamp, k string").parquet(src), "t", "k").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["k"], r["n"]) for r in spark.table("w").collect()) == [("x", 2), ("y", 1)]

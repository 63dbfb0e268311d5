import json

import pytest

from strandwise.functions.text import trigram_similarity
from strandwise.operators import derive, networks
from strandwise.operators.networks import View
from strandwise.sources import files
from strandwise.streaming.key_cache import KeyCache
from pyspark.sql import functions as F


def test_shards_hold_plain_types(spark):
    df = spark.sql("select cast('é' as binary) b, null n, named_struct('x', null, 'y', X'ff') s, array(X'61') a, 1 i")
    out = files.plain_types(df)
    assert dict(out.dtypes) == {"b": "string", "n": "string", "s": "struct<x:string,y:string>", "a": "array<string>", "i": "int"}
    assert tuple(out.first()) == ("é", None, (None, "�"), ["a"], 1)


def test_numbers_go_on_after_an_offset(spark):
    rows = files.numbered(spark.createDataFrame([("b",), ("a",), ("c",)], "k string"), "k", offset=10).collect()
    assert {r["k"]: r["row_id"] for r in rows} == {"a": 11, "b": 12, "c": 13}


def test_shard_names_of_a_listing():
    html = '<a href="/x/C_2.sdf.gz">2</a><A HREF=\'C_1.sdf.gz\'>1</A><a href="C_1.sdf.gz.md5">m</a><a href="C_1.sdf.gz">again</a>'
    assert files.shard_names(html) == ["C_1.sdf.gz", "C_2.sdf.gz"]


def test_finished_shards_are_not_loaded_again(spark, tmp_path):
    calls = []

    def load(s):
        calls.append(s)
        if s == "bad":
            raise RuntimeError(s)
        return spark.range(len(calls) + 2)

    with pytest.raises(RuntimeError):
        files.write_resumably(spark, ["one", "bad"], load, str(tmp_path))
    assert files.write_resumably(spark, ["one", "two"], load, str(tmp_path)) == {"one": 3, "two": 5} and calls == ["one", "bad", "two"]


def test_rules_and_probes(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"class": "drug", "source_id": 1}]))
    assert files.rules(str(tmp_path / "r.json")) == [{"class": "drug", "source_id": 1}]
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        files.rules(str(tmp_path / "bad.json"))
    spark.range(1).write.parquet(str(tmp_path / "t"))
    assert files.columns_of(spark, str(tmp_path / "t")) == ["id"] and files.columns_of(spark, str(tmp_path / "none")) == []
    got = files.by_case(spark.createDataFrame([("a",), ("z",), (None,)], "c string"), "c", {"a": 1}, 9).collect()
    assert [r["c"] for r in got] == [1, 9, 9]


def test_sources_are_discovered_and_broken_ones_reported(tmp_path, monkeypatch):
    pkg = tmp_path / "some_sources"
    pkg.mkdir()
    (pkg / "__init__.py").write_text("")
    (pkg / "good.py").write_text("def register(c):\n    c.add('good', 'x', lambda s: None)\n")
    (pkg / "broken.py").write_text("import no_such_module_anywhere\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    c = files.Catalog()
    assert list(c.discover("some_sources")) == ["some_sources.broken"] and c.select() == [("good", "x")]


def test_a_broken_cache_is_no_empty_cache(spark, tmp_path):
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017  whatever the reader says
        KeyCache(spark, str(tmp_path / "cache"), ["k"]).known().collect()
    with pytest.raises(Exception):  # noqa: B017
        files.lookup(spark, [str(tmp_path / "cache")]).collect()
    assert files.lookup(spark, [str(tmp_path / "none*")]) is None


def test_trigrams(spark):
    df = spark.createDataFrame([("word", "word"), ("word", "two words"), ("", "x"), (None, "x"), ("--", "..")], "a string, b string")
    assert [r[0] and round(r[0], 6) for r in df.select(trigram_similarity(F.col("a"), F.col("b"))).collect()] == [1.0, round(4 / 11, 6), 0.0, None, 0.0]


def test_bitmap_overlaps_count_all_pairs(spark):
    rows = [(k, v) for k, vs in {1: [1, 2, 70000], 2: [2, 70000], 3: [5], 4: [1]}.items() for v in vs]
    index = derive.bitmap_index(spark.createDataFrame(rows, "k long, v long"), ["k"], "v")
    assert {tuple(r) for r in derive.bitmap_overlaps(index, "k").collect()} == {(1, 2, 2), (1, 4, 1)}


def test_gates_of_views(spark):
    edges = spark.createDataFrame([(1, f"r{i}", f"v{i}", s, 7 if i < 4 else 3, o) for i, (s, o) in enumerate([("c", "p"), ("p", "c"), ("c", "u"), ("c", "m"), ("c", "p"), ("c", "c")])] + [(2, "x", "v0", "c", 7, "p")], "source_id long, relation_evidence_id string, entity_evidence_id string, subject_id string, predicate_id long, object_id string")
    nodes = spark.createDataFrame([("c", 1, None, 1), ("p", 2, 9606, 1), ("u", 2, 9606, 2), ("m", 2, 10090, 1)], "entity_id string, entity_type_id long, taxonomy_id long, resolution_status_id int")
    links = spark.createDataFrame([(1, "v0", "k0"), (1, "v0", "k1"), (1, "v2", "k2"), (1, "v4", "k3")], "source_id long, entity_evidence_id string, annotation_key string")
    notes = spark.createDataFrame([("k0", "P", "> 6.5e0"), ("k1", "T", "9606"), ("k2", "P", "5"), ("k3", "T", "10090|9606")], "annotation_key string, accession string, value string")
    piv = networks.annotation_pivot(links, notes, {"pchembl": "P"}, {"taxon": "T"}, {"flag": "F"}, ["yes"])
    views = [View("any", 1), View("turned", 1, flip=True), View("human", 1, taxon=("protein", 9606), resolved="protein"), View("said", 1, taxon=("evidence", 9606)), View("strong", 1, needs=("pchembl", 6.0)), View("seven", 1, resolved="both", predicates=(7,)), View("other", 2)]
    got = {}
    for r in networks.view_rows(edges, nodes, piv, views, [1, 3], 2).collect():
        got.setdefault(r["network"], set()).add(r["relation_evidence_id"])
        assert r["compound_id"] == "c" and r["protein_id"] in "pum"
    assert got == {"any": {"r0", "r2", "r3", "r4"}, "turned": {"r1"}, "human": {"r0", "r4"}, "said": {"r0", "r4"}, "strong": {"r0"}, "seven": {"r0", "r3"}, "other": {"x"}}

"""Rules that once were wrong in both the query and its SQL."""

import pytest

from strandwise.operators import derive, skew
from strandwise.operators.project import project
from strandwise.operators.wide import MAX_ATTRIBUTES, bounded
from strandwise.plans import relational
from strandwise.session import checkpoint_root


def test_numbers_keep_sign_and_exponent(spark, tmp_path):
    rows = [("a", "1.5e-3 nM"), ("b", "-7"), ("c", "> 5"), ("d", "none"), ("e", None), ("f", "1-2"), ("g", "")]
    spark.createDataFrame(rows, "annotation_key string, value string").write.parquet(f"{tmp_path}/annotation.parquet")
    # letters e of words stay in the class, as stated; what is no number then gives null
    got = {r["annotation_key"]: r["v"] for r in relational.p15(spark, str(tmp_path)).collect()}
    assert got == {"a": 0.0015, "b": -7.0, "c": 5.0, "d": None, "e": None, "f": None, "g": None}


def test_only_source_suffixes_leave_a_name(spark):
    rows = spark.createDataFrame([("a", 16, "reduced form (NADH)"), ("b", 16, "caffeine (PTF00012)"), ("c", 16, "iron (II)")], "k string, t int, v string")
    assert {r["k"]: r["label"] for r in derive.label_cascade(rows, "k", "t", "v", {16: 1}).collect()} == {"a": "reduced form (NADH)", "b": "caffeine", "c": "iron (II)"}


@pytest.mark.parametrize("role, noted", [("Catalyst", True), ("Enzyme", True), ("Transporter", False)])
def test_catalysis_is_noted_for_catalytic_roles_only(spark, role, noted):
    import json

    member = {"member": {"type": "Protein", "identifiers": [{"type": "Uniprot", "value": "P1"}]}, "annotations": [{"term": role}]}
    record = json.dumps({"type": "Reaction", "identifiers": [{"type": "x", "value": "1"}], "membership": [member]})
    rows = project(spark.createDataFrame([("s", "d", 1, record)], "source string, dataset string, row_id long, record string")).where("tag = 'relation_annotation' and term = 'Control Effect'")
    assert rows.count() == noted


def test_long_attribute_lists_are_refused(spark):
    assert len(bounded(spark.range(MAX_ATTRIBUTES))) == MAX_ATTRIBUTES
    with pytest.raises(ValueError):
        bounded(spark.range(MAX_ATTRIBUTES + 1))


@pytest.mark.parametrize("how", ["left", "left_anti", "inner", "left_semi"])
@pytest.mark.parametrize("hot", [[], ["h"]])
def test_joins_with_null_keys_and_a_hub(spark, how, hot):
    rows = [("h" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 7}", i) for i in range(600)]
    big, small = spark.createDataFrame(rows, "key string, x int"), spark.createDataFrame([("h", 1), ("k1", 2), (None, 3)], "key string, y int")
    want = sorted(map(tuple, big.join(small, "key", how).collect()), key=str)
    assert sorted(map(tuple, skew.join_unique(big, small, "key", how, hot).collect()), key=str) == want


def test_rows_without_a_key_meet_no_single_task(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(4000).select(F.when(F.col("id") % 10 > 6, F.col("id")).alias("key"), "id")
        joined = skew.join_unique(big, spark.range(50).withColumnRenamed("id", "key").withColumn("y", F.lit(1)), "key", "left", [])
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_no_machine_local_checkpoint_off_a_local_master():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())

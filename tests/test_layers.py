"""The overlay of reactions and complexes over the base resolution."""

from strandwise.operators import resolve


def test_signatures_of_reactions_come_before_complexes_and_both_before_the_base(spark):
    base = spark.createDataFrame([("both", 3, "17", 1, "resolver"), ("complex", 3, "27", 1, "resolver"), ("plain7", 3, "7", 1, "resolver"), ("none", None, "h", 2, "unresolved")], "evidence_id string, canonical_type long, canonical_id string, status int, mechanism string")
    signed = "parent_id string, signature string, n_members int, resolved boolean"
    complexes = spark.createDataFrame([("both", "c1", 2, True), ("complex", "c2", 2, True), ("no mention", "c3", 1, True)], signed)
    reactions = spark.createDataFrame([("both", "r1", 3, False)], signed)
    got = {r["evidence_id"]: tuple(r)[1:] for r in resolve.layered_resolution(base, complexes, reactions).collect()}
    assert got == {"both": ("r1", 2, "reaction"), "complex": ("c2", 1, "complex"), "plain7": ("7", 1, "resolver"), "none": ("h", 2, "unresolved")}


def test_the_tables_have_all_three_layers(spark):
    from strandwise.plans import composite, reference

    df = composite.QUERIES["n24_layered_resolution"](spark, "/root/testdata/sf0.01").cache()
    assert df.count() == reference.n21(spark, "/root/testdata/sf0.01").count() == df.select("evidence_id").distinct().count()
    assert {"reaction", "complex", "resolver"} <= {r[0] for r in df.select("mechanism").distinct().collect()}

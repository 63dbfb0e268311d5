"""Transports with the roles and compartments of their participants."""

from strandwise.operators import networks


def test_influx_and_efflux_stay_apart(spark):
    edges = [("c1", "P", 1, "in"), ("c2", "P", 1, "out"), ("c3", "P", 1, "one"), ("c4", "P", 1, "protein"), *[(f"{s}{i}", s, 2, "glc") for s in ("in", "out") for i in "rp"], ("one1", "one", 2, "glc"), ("one2", "one", 2, "na"), ("x", "protein", 2, "glc")]
    e = spark.createDataFrame([(7, *x) for x in edges] + [(8, "one1", "one", 2, "other")], "source_id long, relation_evidence_id string, subject_id string, predicate_id long, object_id string")
    nodes = spark.createDataFrame([("in", 5), ("out", 5), ("one", 5), ("protein", 2)], "entity_id string, entity_type_id long")
    R, P, L = "Reactant:OM:0310", "Product:OM:0311", "Subcellular Location:OM:0604"
    notes = [("inr", R, None), ("inr", L, "e"), ("inp", P, None), ("inp", L, "c"), ("outr", R, None), ("outr", L, "c"), ("outp", P, None), ("outp", L, "e"), ("one1", R, None), ("one1", L, "a"), ("one1", L, "m"), ("one1", "Note", "z")]
    a = spark.createDataFrame([(7, *x) for x in notes], "source_id long, relation_evidence_id string, term string, value string")
    got = {tuple(r)[2:] for r in networks.annotated_transports(e, nodes, a, "n", 5, 1, 2, [R], [P], [L]).collect()}
    assert got == {
        ("c1", "in", "P", "glc", True, True, "e", "c", "reactant_to_product"), ("c2", "out", "P", "glc", True, True, "c", "e", "reactant_to_product"),
        ("c3", "one", "P", "glc", True, False, "m", None, "reactant"), ("c3", "one", "P", "na", False, False, None, None, None),
    }

"""Canonical identifiers of clustered lookup rows."""

from strandwise.operators import chemicals
from strandwise.plans import composite

IK, IK2 = "AAAAAAAAAAAAAA-BBBBBBBBBB-N", "CCCCCCCCCCCCCC-DDDDDDDDDD-N"


def got(df):
    return {(r["key_type"], r["key_value"]): (r["canonical_type"], r["canonical_id"]) for r in df.collect()}


def test_clusters_take_the_one_structure_then_chebi_then_refmet_then_the_least_node(spark):
    rows = [("a", 24, "1-1"), ("a", 23, "C1"), ("b", 23, "C1"), ("b", 8, "CHEBI:9"), ("c", 8, "CHEBI:10"), ("c", 24, "2-2"), ("d", 24, "2-2"), ("d", 8, "CHEBI:9000"), ("e", 22, "RM2"), ("e", 24, "3-3"), ("f", 23, "C4"), ("f", 24, "4-4")]
    hits = [(24, "1-1", IK), (8, "CHEBI:10", IK), (24, "2-2", IK2), (23, "C99", IK)]
    df = chemicals.cluster_lookup(spark.createDataFrame(rows, "row_id string, key_type long, key_value string"), spark.createDataFrame(hits, "key_type long, key_value string, structure string"), 13, [8, 22])
    one, two = (13, IK), (8, "CHEBI:10")  # two structures reached: the least ChEBI id by number
    assert got(df) == {(24, "1-1"): one, (23, "C1"): one, (8, "CHEBI:9"): one, (8, "CHEBI:10"): two, (24, "2-2"): two, (8, "CHEBI:9000"): two, (22, "RM2"): (22, "RM2"), (24, "3-3"): (22, "RM2"), (23, "C4"): (23, "C4"), (24, "4-4"): (23, "C4")}


def test_chebi_records_get_one_canonical_id_per_cluster(spark, tmp_path):
    rows = [
        (13, IK, 8, "CHEBI:1"), (23, "c1", 8, "CHEBI:1"), (8, "11", 8, "CHEBI:1"),  # has a structure
        (23, "C1", 8, "CHEBI:2"),  # reaches it through KEGG
        (24, "9-9", 8, "CHEBI:100"), (24, "9-9", 8, "CHEBI:20"),  # shares a CAS number only
        (23, "C7", 8, "CHEBI:4"), (12, "77", 8, "CHEBI:4"),  # structural cross reference: not clustered
        (24, "9-9", 8, "CHEBI:5"), (9, "H5", 8, "CHEBI:5"),  # not clustered, but its CAS number is
        (17, "X", 8, "CHEBI:6"), (23, "C8", 12, "1"), (23, "C9", 8, "none"),
    ]
    spark.createDataFrame(rows, "key_identifier_type_id long, key_value string, canonical_identifier_type_id long, canonical_identifier string").write.parquet(str(tmp_path / "chemical_identifier_lookup.parquet"))
    assert got(composite.QUERIES["n45_chebi_canonical"](spark, str(tmp_path))) == {
        (8, "CHEBI:1"): (13, IK), (8, "CHEBI:11"): (13, IK), (8, "CHEBI:2"): (13, IK), (23, "C1"): (13, IK), (8, "CHEBI:100"): (8, "CHEBI:20"), (8, "CHEBI:20"): (8, "CHEBI:20"), (24, "9-9"): (8, "CHEBI:20"), (8, "CHEBI:4"): (8, "CHEBI:4"), (8, "CHEBI:6"): (8, "CHEBI:6"),
    }

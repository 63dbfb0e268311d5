from strandwise.operators import batch

EV = "evidence_id string, entity_type string, taxonomy_id long"
IDS = "evidence_id string, key_type long, key_value string"
LOOKUP = "entity_type string, taxonomy_id long, key_type long, key_value string, canonical_type long, canonical_id string"
A, B = "AAAAAAAAAAAAAA-AAAAAAAAAA-N", "BBBBBBBBBBBBBB-BBBBBBBBBB-N"


def resolved(spark, evidence, ids, lookup=(), fallback=None, genes=None):
    e, i, l = spark.createDataFrame(evidence, EV), spark.createDataFrame(ids, IDS), spark.createDataFrame(list(lookup), LOOKUP)
    direct = batch.direct_resolutions(e, i, ("Chemical", 13), ("Cv Term", 50), ("Pathway", {60: 1, 61: 2}))
    f = fallback and spark.createDataFrame(fallback, "evidence_id string, canonical_type long, canonical_id string, mechanism string")
    g = genes and spark.createDataFrame(genes, "evidence_id string, entity_type string, taxonomy_id long, canonical_type long, canonical_id string")
    rows = batch.resolution_base(e, i, direct, batch.lookup_candidates(e, i, l, [1]), f, g).collect()
    assert len(rows) == len(evidence)
    return {r["evidence_id"]: (r["entity_type"], r["taxonomy_id"], r["canonical_type"], r["canonical_id"], r["status"], r["mechanism"]) for r in rows}


def test_direct_terms_pathways_and_structures(spark):
    ev = [("t", "Cv Term", 9606), ("p", "Pathway", 9606), ("q", "Pathway", 1), ("s", "Chemical", None), ("two", "Chemical", None), ("bad", "Chemical", None), ("none", "Cv Term", None)]
    ids = [("t", 50, "GO:2"), ("t", 50, "GO:1"), ("t", 13, A), ("p", 61, "WP1"), ("p", 60, "R-1"), ("q", 60, "R-1"), ("q", 60, "R-2"), ("q", 61, "WP9"), ("s", 13, A), ("s", 13, A), ("two", 13, A), ("two", 13, B), ("bad", 13, "x"), ("none", 50, "")]
    got = resolved(spark, ev, ids)
    assert got["t"] == ("Cv Term", None, 50, "GO:1", 1, "cv_term") and got["p"] == ("Pathway", None, 60, "R-1", 1, "pathway") and got["q"] == ("Pathway", None, 61, "WP9", 1, "pathway")
    assert got["s"] == ("Chemical", None, 13, A, 1, "inchikey")
    assert all(got[e][4:] == (2, "unresolved") for e in ("two", "bad", "none"))


def test_one_candidate_several_and_the_fallback_gate(spark):
    lookup = [("Gene", 9606, 5, "TP53", 3, "7157"), ("Gene", 10090, 5, "TP53", 3, "22059"), ("Gene", 9606, 1, "P04637", 3, "7157"), ("Chemical", None, 16, "x", 8, "C1"), ("Chemical", None, 16, "y", 8, "C1"), ("Chemical", None, 16, "z", 8, "C2")]
    ev = [("one", "Protein", 9606), ("free", "Protein", None), ("tax", "Protein", None), ("many", "Chemical", None), ("back", "Chemical", None), ("lost", "Chemical", None), ("bare", "Chemical", 7)]
    ids = [("one", 5, "TP53"), ("one", 1, "P04637"), ("free", 1, "P04637"), ("tax", 5, "TP53"), ("many", 16, "x"), ("many", 16, "z"), ("back", 16, "nowhere"), ("lost", 16, "nowhere")]
    got = resolved(spark, ev, ids, lookup, [("many", 8, "F", "chebi"), ("back", 8, "F", "chebi"), ("one", 8, "F", "chebi")])
    assert got["one"] == ("Gene", 9606, 3, "7157", 1, "resolver")
    assert got["free"] == ("Gene", 9606, 3, "7157", 1, "resolver")  # an accession is clear without a taxonomy
    assert got["tax"][4:] == (2, "unresolved")  # a name is not
    assert got["many"][4:] == (2, "unresolved")  # several candidates never fall back
    assert got["back"] == ("Chemical", None, 8, "F", 1, "chebi") and got["lost"][4:] == (2, "unresolved")
    assert got["bare"][1:3] == (7, None) and got["bare"][3] != got["lost"][3]


def test_copies_for_several_genes(spark):
    got = resolved(spark, [("c1", "Protein", 9606), ("c2", "Protein", 9606)], [("c1", 1, "P1"), ("c2", 1, "P1")], (), None, [("c1", "Gene", 9606, 3, "1"), ("c2", "Gene", 9606, 3, "2")])
    assert got["c1"] == ("Gene", 9606, 3, "1", 1, "gene_anchor") and got["c2"][3] == "2"


def test_an_origin_adds_only_what_earlier_ones_lack(spark):
    schema = "entity_type string, taxonomy_id long, canonical_type long, canonical_id string, status int, mechanism string, source_id long, more int"
    first = spark.createDataFrame([("Chemical", None, 8, "C1", 1, "resolver", 2, 0), ("Chemical", None, 8, "C1", 1, "chebi", 1, 0)], schema)
    then = spark.createDataFrame([("Chemical", None, 8, "C1", 1, None, 3, 0), ("Chemical", None, 8, "C2", 1, None, None, 0), ("Chemical", None, 8, "", 1, None, 3, 0), ("Chemical", None, 8, None, 1, None, 3, 0)], schema)
    rows = {r["canonical_id"]: r for r in batch.entity_union([first, then], {"chebi": 4, "resolver": 6}).collect()}
    assert set(rows) == {"C1", "C2"}
    assert (rows["C1"]["mechanism"], rows["C1"]["origin"], rows["C1"]["sources"]) == ("chebi", 1, "000001,000002,000003") and (rows["C2"]["origin"], rows["C2"]["mechanism"], rows["C2"]["sources"]) == (2, None, None)
    assert batch.entity_union([first.limit(0)], {}).count() == 0


def test_complexes_within_complexes(spark):
    from strandwise.operators import resolve

    schema = "parent_id string, entity_type string, taxonomy_id long, canonical_id string, status int"
    inner = [("in", "Protein", 1, "a", 1), ("in", "Protein", 1, "b", 2)]
    got = {r["parent_id"]: r for r in resolve.nested_signature(spark.createDataFrame([*inner, ("out", "Complex", None, "in", 1), ("out", "Protein", 1, "c", 1), ("same", "Complex", None, "in", 1), ("same", "Protein", 1, "c", 1), ("other", "Complex", None, "elsewhere", 1), ("other", "Protein", 1, "c", 1)], schema)).collect()}
    flat = {r["parent_id"]: r for r in resolve.member_signature(spark.createDataFrame(inner, schema)).collect()}
    assert got["in"]["signature"] == flat["in"]["signature"] and not got["in"]["resolved"]
    assert got["out"]["signature"] == got["same"]["signature"] != got["other"]["signature"]
    assert not got["out"]["resolved"] and got["other"]["resolved"] and got["out"]["n_members"] == 2


def test_rows_follow_the_copies_of_their_mention(spark):
    from strandwise.operators import resolve

    parts = resolve.gene_parts(spark.createDataFrame([("m", "1"), ("m", "2"), ("m", "2"), ("n", "1")], "evidence_id string, canonical_id string"))
    rows = spark.createDataFrame([("m", "x"), ("n", "y"), (None, "z")], "evidence_id string, note string")
    got = sorted((r["note"], r["evidence_id"] in ("n", None)) for r in resolve.follow_parts(rows, parts, "evidence_id").collect())
    assert got == [("x", False), ("x", False), ("y", True), ("z", True)]

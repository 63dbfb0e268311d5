"""Resolution, chemicals, projection and storage on small tables with known answers."""

import hashlib
import json

from pyspark.sql import functions as F

from strandwise.operators import chemicals, derive, networks, project, resolve, store

MENTION = "evidence_id string, entity_type string, taxonomy_id long, key_type long, key_value string"
IK1, IK2 = "AAAAAAAAAAAAAA-BBBBBBBBBB-N", "CCCCCCCCCCCCCC-DDDDDDDDDD-N"
TYPES = {"InChIKey": 1, "ChEBI": 2, "PubChem": 3, "KEGG": 4, "FooDB": 5, "Name": 6, "SMILES": 7}
TIERS = {2: (2, "chebi"), 3: (4, "pubchem"), 4: (20, "original_id"), 5: (33, "original_id"), 6: (40, "name")}


def cu(text):
    h = hashlib.md5(text.encode()).hexdigest()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def test_multi_gene_split(spark):
    m = spark.createDataFrame([("M", "Protein", 9606, 10, "P1"), ("P2ev", "Protein", 9606, 10, "P2")], MENTION)
    found = spark.createDataFrame([("M", "100"), ("M", "200"), ("P2ev", "300")], "evidence_id string, canonical_id string")
    refs = spark.createDataFrame([("r1", "X", "M"), ("r2", "X", "P2ev"), ("r3", "M", "M")], "relation_evidence_id string, subject_id string, object_id string")
    mentions, links = resolve.split_multi_gene(m, found, refs)
    assert {r["evidence_id"] for r in mentions.collect()} == {cu("M#mg=100"), cu("M#mg=200"), "P2ev"}
    got = {tuple(r) for r in links.collect()}
    assert {("r2", "X", "P2ev"), (cu("r1#mgs=#mgo=100"), "X", cu("M#mg=100")), (cu("r1#mgs=#mgo=200"), "X", cu("M#mg=200"))} <= got and len(got) == 7
    one = found.where("canonical_id <> '200'")
    same, kept = resolve.split_multi_gene(m, one, refs)
    assert same.count() == 2 and {r[0] for r in kept.collect()} == {"r1", "r2", "r3"}


def fallback(spark, mentions):
    rows = [(e, TYPES[t], v) for e, ids in mentions.items() for t, v in ids]
    m = spark.createDataFrame(rows, "evidence_id string, key_type long, key_value string")
    picked = chemicals.fallback_pick(m, chemicals.anchor_map(m, 1, 2), chemicals.ambiguous_values(m, 1), TIERS, [6])
    return {r["evidence_id"]: (r["canonical_type"], r["canonical_id"], r["mechanism"]) for r in picked.collect()}


def test_chemical_fallback(spark):
    got = fallback(spark, {
        "m_chebi_pubchem": [("ChEBI", "15365"), ("PubChem", "2244")], "m_pubchem": [("PubChem", "999")], "m_foodb": [("FooDB", "FDB000123")], "m_smiles_only": [("SMILES", "CCO")], "m_name": [("Name", "aspirin")],
        "m_junk": [("Name", IK2)], "m_num": [("Name", "123")], "m_short": [("Name", "x")], "memb": [("FooDB", "FDB9")], "cmpd": [("FooDB", "FDB9"), ("InChIKey", IK1)], "keggonly": [("KEGG", "C1")], "keggchebi": [("KEGG", "C1"), ("ChEBI", "100")],
        "ambmemb": [("FooDB", "FDBX")], "amb1": [("FooDB", "FDBX"), ("InChIKey", IK1)], "amb2": [("FooDB", "FDBX"), ("InChIKey", IK2)], "alname": [("Name", "alanine")], "al1": [("Name", "Alanine"), ("InChIKey", IK1)], "al2": [("Name", "alanine"), ("InChIKey", IK2)],
    })
    assert got["m_chebi_pubchem"] == (2, "15365", "chebi") and got["m_pubchem"][2] == "pubchem" and got["m_foodb"][2] == "original_id" and got["m_name"] == (6, "aspirin", "name")
    assert not {"m_smiles_only", "m_junk", "m_num", "m_short", "alname"} & set(got)
    assert got["memb"] == (1, IK1, "anchored_structure") and got["keggonly"] == (2, "100", "anchored_chebi") and got["ambmemb"] == (5, "FDBX", "original_id")


def test_resolution_gate(spark):
    m = spark.createDataFrame([("one", "Gene", 9606, 1, "A"), ("two", "Gene", 9606, 1, "B"), ("none", "Gene", 9606, 1, "C"), ("bare", "Gene", None, 1, ""), ("far", "Gene", 10090, 1, "A")], MENTION)
    lookup = spark.createDataFrame([("Gene", 9606, 1, "A", 3, "10"), ("Gene", 9606, 1, "B", 3, "20"), ("Gene", 9606, 1, "B", 3, "21")], "entity_type string, taxonomy_id long, key_type long, key_value string, canonical_type long, canonical_id string")
    back = spark.createDataFrame([(e, 9, f"f-{e}", "original_id") for e in ("one", "two", "none")], "evidence_id string, canonical_type long, canonical_id string, mechanism string")
    needed = resolve.needed_lookup(resolve.identifier_keys(m), lookup, resolve.unambiguous_keys(lookup, [1]))
    got = {r["evidence_id"]: (r["canonical_id"], r["status"], r["mechanism"]) for r in resolve.resolve_entities(m, needed, back).collect()}
    assert got["one"] == ("10", 1, "resolver") and got["far"] == ("10", 1, "resolver") and got["none"] == ("f-none", 1, "original_id")
    assert got["two"] == (hashlib.md5(b"1=B").hexdigest(), 2, "unresolved") and got["bare"] == (hashlib.md5(b"bare").hexdigest(), 2, "unresolved")
    strict = resolve.needed_lookup(resolve.identifier_keys(m), lookup, resolve.unambiguous_keys(lookup, []))
    assert {r["evidence_id"] for r in resolve.resolve_entities(m, strict).where("status = 1").collect()} == {"one"}


def test_member_signature_puts_null_taxonomy_last(spark):
    df = spark.createDataFrame([("p", "Gene", None, 'q"', 1), ("p", "Gene", 9606, "a", 1), ("p", "Gene", 9606, "a", 1), ("x", "Gene", None, "a", 2)], "parent_id string, entity_type string, taxonomy_id long, canonical_id string, status int")
    got = {r["parent_id"]: r for r in resolve.member_signature(df).collect()}
    want = json.dumps([{"entity_type": "Gene", "taxonomy_id": "9606", "canonical_id": "a"}, {"entity_type": "Gene", "taxonomy_id": None, "canonical_id": 'q"'}], separators=(",", ":"))
    assert got["p"]["signature"] == hashlib.sha256(want.encode()).hexdigest() and got["p"]["n_members"] == 2 and not got["x"]["resolved"]


def test_structure_levels(spark):
    keys = {"l": "QNAYBMKLOCPYGJ-REOHCLBHSA-N", "d": "QNAYBMKLOCPYGJ-UWTATZPHSA-N", "dl": "QNAYBMKLOCPYGJ-UHFFFAOYSA-N", "b": "UCMIRNVEIXFBKS-UHFFFAOYSA-N", "bad": "not a key"}
    g = chemicals.structure_groups(spark.createDataFrame(list(keys.items()), "entity_id string, inchikey string"))
    by = {(r["level"], r["group_key"]): (r["n_members"], r["representative_id"]) for r in g.collect()}
    assert by["connectivity", "QNAYBMKLOCPYGJ"] == (3, "d") and sum(k[0] == "full" for k in by) == 4 and not any("not" in k[1] for k in by)


def test_components_of_a_chain_and_an_empty_table(spark):
    df = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)] + [("z", "z"), (None, "q")], "a string, b string")
    got = {r["node"]: r["root"] for r in resolve.lookup_components(df, "a", "b").collect()}
    assert len(got) == 122 and {got[k] for k in got if k != "z"} == {"n000"} and got["z"] == "z"
    assert resolve.lookup_components(df.limit(0), "a", "b").count() == 0


def node(kind, value, **x):
    return {"type": kind, "identifiers": [{"type": "Name", "value": value}], **x}


def project_one(spark, record):
    df = spark.createDataFrame([("s", "d", 1, record if isinstance(record, str) or record is None else json.dumps(record))], "source string, dataset string, row_id long, record string")
    return project.project(df).collect()


def test_reaction_projection(spark):
    member = lambda m, role: {"member": m, "annotations": [{"term": f"{role}:OM:0001"}]}
    rows = project_one(spark, node("Reaction:OM:0015", "r", membership=[member(node("Small Molecule", "a"), "Reactant"), member(node("Drug", "b"), "Product"), member(node("Protein", "c"), "Catalyst")]))
    ents = [r for r in rows if r["tag"] == "entity"]
    rels = [r for r in rows if r["tag"] == "relation"]
    assert len(ents) == 4 and {r["entity_type"] for r in ents} == {"reaction", "chemical", "protein"}
    assert sorted(r["predicate"] for r in rels) == ["controls", "has_participant", "has_participant"]
    ids = {r["evidence_id"] for r in ents}
    assert all(r["subject_id"] in ids and r["object_id"] in ids for r in rels)
    notes = {(r["scope"], r["term"], r["value"]) for r in rows if r["tag"] == "relation_annotation"}
    assert ("relation", "Control Effect", "catalysis") in notes and ("object", "Catalyst:OM:0001", None) in notes


def test_interactions_and_broken_records(spark):
    two = node("Interaction", "i", membership=[{"member": node("Protein", "a"), "annotations": [{"term": "Target"}]}, {"member": node("Protein", "b")}], annotations=[{"term": "Control Type", "value": "INHIBITION"}])
    rows = project_one(spark, two)
    rel = [r for r in rows if r["tag"] == "relation"]
    assert len(rel) == 1 and rel[0]["predicate"] == "negatively_regulates" and sum(r["tag"] == "entity" for r in rows) == 2
    names = {r["evidence_id"]: r["id_value"] for r in rows if r["tag"] == "identifier"}
    assert (names[rel[0]["subject_id"]], names[rel[0]["object_id"]]) == ("b", "a")
    assert project_one(spark, node("Interaction", "i", membership=[{"member": node("Protein", "a")}])) == []
    assert [r["tag"] for r in project_one(spark, "{oops")] == ["broken"] and [r["tag"] for r in project_one(spark, None)] == ["broken"]
    deep = node("Complex", "x")
    for _ in range(100):
        deep = node("Complex", "x", membership=[{"member": deep}])
    assert sum(r["tag"] == "cut" for r in project_one(spark, deep)) == 1


def test_labels(spark):
    rows = [("e", 1, "Aspirin"), ("e", 1, "aspirin"), ("e", 1, "Aspirin"), ("e", 2, "acetylsalicylic acid"), ("f", 2, "123"), ("f", 2, "caffeine (PTF00001)|x"), ("g", 2, IK1)]
    got = {r[0]: (r[1], r[2]) for r in derive.label_cascade(spark.createDataFrame(rows, "e string, k long, v string"), "e", "k", "v", {1: 1, 2: 5}).collect()}
    assert got == {"e": ("Aspirin", 1), "f": ("caffeine", 5)}
    ids = {r[0]: r[1] for r in derive.identifier_label(spark.createDataFrame([("a", 8, "CHEBI:1"), ("b", 12, "7"), ("b", 8, "9")], "e string, k long, v string"), "e", "k", "v", {8: (1, "CHEBI:"), 12: (3, "CID:")}).collect()}
    assert ids == {"a": "CHEBI:1", "b": "CHEBI:9"}


def test_bitmap_overlap_equals_sets(spark):
    rows = [(s, i) for s in (1, 2, 3) for i in range(0, 90_000, s)] + [(1, 0)]
    ix = derive.bitmap_index(spark.createDataFrame(rows, "s long, n long"), ["s"], "n")
    assert {r["s"]: r["n"] for r in derive.bitmap_sizes(ix, ["s"]).collect()} == {1: 90_000, 2: 45_000, 3: 30_000}
    assert {(r[0], r[1]): r[2] for r in derive.bitmap_overlaps(ix, "s").collect()} == {(1, 2): 45_000, (1, 3): 30_000, (2, 3): 15_000}


def test_store_round_trip_and_source_removal(spark, tmp_path):
    path = str(tmp_path / "links")
    assert not store.has_source(spark, path, 1)
    df = spark.createDataFrame([(1, "r1", "x1"), (2, "r1", "x2"), (1, "r2", "x3")], "source_id long, relation_id string, relation_evidence_id string")
    store.write_source(df, path)
    store.write_source(df.where("source_id = 2").withColumn("relation_id", F.lit("r9")), path)
    back = {tuple(r) for r in spark.read.parquet(path).select("source_id", "relation_id").collect()}
    assert back == {(1, "r1"), (1, "r2"), (2, "r9")} and store.has_source(spark, path, 2)
    graph = {
        "resolution": spark.createDataFrame([(1, "a"), (2, "b"), (1, "b"), (1, "c")], "source_id long, entity_id string"), "links": df, "evidence": df.select("source_id", "relation_evidence_id"),
        "relation": spark.createDataFrame([("r1", "a", "b"), ("r2", "c", "b")], "relation_id string, subject_entity_id string, object_entity_id string"), "entity": spark.createDataFrame([("a",), ("b",), ("c",), ("seed",)], "entity_id string"),
    }
    out = store.delete_source(graph, 1)
    assert {r[0] for r in out["relation"].collect()} == {"r1"} and {r[0] for r in out["entity"].collect()} == {"a", "b", "seed"}


def test_registry_goes_on_after_a_failure(spark, tmp_path):
    reg = networks.Registry()
    reg.add("good", lambda: spark.range(3).toDF("x"), str(tmp_path / "good"))
    reg.add("bad", lambda: spark.table("no_such_table"))
    assert reg.apply() == {"good": "ok", "bad": "failed: AnalysisException"} and spark.table("good").count() == 3


def test_gene_output_reads_no_more_than_it_needs(spark):
    from strandwise.plans.reference import QUERIES

    plan = QUERIES["n72_gene_output"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(entity_type_id)" in plan and "resolution_status_id" not in plan and "Exchange" in plan

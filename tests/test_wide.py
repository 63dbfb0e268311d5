import datetime

from strandwise.functions.typed import with_typed_text
from strandwise.operators.wide import filled_cells, wide_table

TYPES = [("OM:0001", "Charge", "integer", None), ("OM:0002", "Half Life", "quantity", "minute"), ("OM:0003", "Seen", "date", None), ("OM:0004", "Source Id", "text", None), ("OM:0005", "Ok", "boolean", None), ("OM:0006", "Score", "double", None)]


def types(spark):
    return spark.createDataFrame(TYPES, "accession string, attribute_name string, value_kind string, common_unit string")


def test_typed_readings(spark):
    cases = [
        ("quantity", "IC50 of 8.02×10^-4 µmol/l (single run)", "8.02e-4"), ("quantity", "pIC50 : 7.42", "7.42"), ("quantity", "1,830.0 Da", "1830.0"), ("quantity", "66,4", "66.4"), ("quantity", "IC50", None), ("quantity", "n.d.", None),
        ("double", "0,94", "0.94"), ("double", " .5", ".5"), ("double", "high", None), ("integer", " -1 ", "-1"), ("integer", "9606.0", "9606"), ("integer", "1.5", None),
        ("boolean", "Y", "true"), ("boolean", "FALSE", "false"), ("boolean", "maybe", None), ("date", "2021-02-30", None), ("date", "0000-00-00", None), ("date", "20210228", "2021-02-28"), ("date", "5 sep 2023", "2023-09-05"),
        ("date", "2021/2/3", "2021-02-03"), ("date", "3.2.2021", "2021-02-03"), ("date", "September 5, 2023", "2023-09-05"), ("date", "2021-02-03T10:11:12Z", "2021-02-03"), ("text", " N/A ", None), ("text", " ", None), ("text", " bone marrow", "bone marrow"), ("text", None, None),
    ]
    df = spark.createDataFrame(cases, "kind string, value string, want string")
    bad = [tuple(r) for r in with_typed_text(df, "kind", "value", "got").collect() if r["got"] != r["want"]]
    assert not bad


def test_wide_rows(spark):
    links = [(1, "e", "k1"), (1, "e", "k1"), (1, "e", "k2"), (1, "e", "k3"), (1, "e", "gone"), (2, "e", "k4"), (2, "f", "k5"), (2, "f", "k6"), (None, "n", "k1"), (3, "x", None)]
    notes = [("k1", "Charge:OM:0001", "-2", "u"), ("k1", "Charge:OM:0001", "-2", "u"), ("k2", " om:0003 ", "2020/01/05", None), ("k3", "source ID", "liver", None), ("k4", "OM:9999:Other", "5", None), ("k5", "HALF life", "ca. 3,5 h", None), ("k6", "Half Life:OM:0002", "2 h", None), (None, "Ok", "yes", None)]
    wide = wide_table(spark.createDataFrame(links, "source_id long, entity_evidence_id string, annotation_key string"), spark.createDataFrame(notes, "annotation_key string, term string, value string, unit string"), types(spark), ["source_id", "entity_evidence_id"])
    assert wide.columns == ["source_id", "entity_evidence_id", "charge", "half_life", "seen", "source_id_om_0004", "ok", "score"]
    got = {(r[0], r[1]): tuple(r)[2:] for r in wide.collect()}
    assert got == {(1, "e"): (-2, None, datetime.date(2020, 1, 5), "liver", None, None), (2, "f"): (None, 2.0, None, None, None, None), (None, "n"): (-2, None, None, None, None, None)}
    cells = {tuple(r) for r in filled_cells(wide, types(spark), ["source_id", "entity_evidence_id"]).collect()}
    assert (2, "f", "OM:0002") in cells and len(cells) == 5


def test_empty_tables(spark):
    links = spark.createDataFrame([], "source_id long, entity_evidence_id string, annotation_key string")
    notes = spark.createDataFrame([], "annotation_key string, term string, value string, unit string")
    assert wide_table(links, notes, types(spark), ["source_id", "entity_evidence_id"]).count() == 0
    assert wide_table(links, notes, types(spark).limit(0), ["source_id", "entity_evidence_id"]).columns == ["source_id", "entity_evidence_id"]


def test_hot_annotation_and_long_text(spark):
    links = spark.createDataFrame([(1, f"e{i}", "hot") for i in range(400)] + [(1, "z", "long")], "source_id long, entity_evidence_id string, annotation_key string")
    notes = spark.createDataFrame([("hot", "Ok", "T", None), ("long", "Source Id", "w " * 100_000, None)], "annotation_key string, term string, value string, unit string")
    wide = wide_table(links, notes, types(spark), ["source_id", "entity_evidence_id"])
    assert wide.where("ok").count() == 400 and wide.selectExpr("max(length(source_id_om_0004))").first()[0] == 199_999

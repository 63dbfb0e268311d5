"""Network views over the graph with their gates and annotation pivots, each with SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.text import accession_of, plain_id
from strandwise.functions.typed import TRUE_WORDS
from strandwise.operators import derive, networks
from strandwise.operators.networks import View
from strandwise.plans import reference as ref
from strandwise.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
HUMAN = 9606
COMPOUNDS, PROTEIN = [1, 3], 2

# A network reads one source of the tables; the numbers stand for the sources' names.
VIEWS = [
    View("chembl", 26, needs=("functional", None)),
    View("bindingdb", 20, resolved="protein", needs=("pchembl", 6.0)),
    View("cellinker", 13, taxon=("protein", HUMAN), resolved="protein"),
    View("guidetopharma", 28, taxon=("protein", HUMAN), resolved="protein"),
    View("mrclinksdb", 37, taxon=("protein", HUMAN), resolved="protein"),
    View("stitch", 9, taxon=("evidence", HUMAN)),
    View("tcdb", 12, flip=True, taxon=("protein", HUMAN)),
    View("cellphonedb", 17, resolved="both", predicates=(7, 8)),
    View("neuronchat", 7, resolved="both", predicates=(7, 8)),
]
NUMBERS = {"pchembl": "OM:0708", "ic50": "MI:0641", "ki": "MI:0643", "kd": "MI:0646", "ec50": "MI:0642", "confidence": "OM:0762"}
TEXTS = {"pubmed": "MI:0446", "comment": "MI:0612", "functional": "OM:0752", "taxon": "OM:0205"}
FLAGS = {"endogenous": "OM:9106", "reviewed": "OM:9105"}
# What each network shows beside the pair.
SHOWN = {
    "n76_chembl": ["functional", "pchembl", "ic50", "ki", "kd", "ec50", "endogenous", "reviewed", "pubmed"], "n77_bindingdb": ["pchembl", "ic50", "ki", "kd", "ec50", "pubmed"], "n78_cellinker": ["pubmed"],
    "n79_guidetopharma": ["pchembl", "ki", "endogenous", "functional"], "n80_mrclinksdb": ["pubmed", "comment"], "n81_stitch": ["confidence", "functional", "reviewed"], "n82_tcdb": [], "n86_cellphonedb": [], "n87_neuronchat": ["functional"],
}


def annotated_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges with the evidence of their subject, whose annotations count for the edge."""
    said = table(spark, d, "relation_evidence").select("source_id", "relation_evidence_id", plain_id(F.col("subject_entity_evidence_id")).alias("entity_evidence_id")).distinct()
    return ref.edges(spark, d).join(said, ["source_id", "relation_evidence_id"], "left")


def pivots(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "annotation").select("annotation_key", accession_of(F.col("term")).alias("accession"), "value").distinct()
    links = table(spark, d, "entity_evidence_annotation").where(F.col("source_id").isin([v.source_id for v in VIEWS])).select("source_id", "entity_evidence_id", "annotation_key").distinct()
    return networks.annotation_pivot(links, a, NUMBERS, TEXTS, FLAGS, TRUE_WORDS)


def rows(spark: SparkSession, d: str, views: list[View] = VIEWS) -> DataFrame:
    return networks.view_rows(annotated_edges(spark, d), ref.nodes(spark, d), pivots(spark, d), views, COMPOUNDS, PROTEIN)


_ACC = "upper(nullif(regexp_extract(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', 1), ''))"
_BARE = "nullif(lower(trim({0}, ' {{}}' || chr(9) || chr(10) || chr(13) || chr(160))), '')"
_NUM = "TRY_CAST(nullif(regexp_replace(value, '[^0-9.eE+-]', '', 'g'), '') AS DOUBLE)"
_TRUE = ", ".join(f"'{w}'" for w in TRUE_WORDS)
PIVOT = (
    f"an AS (SELECT DISTINCT annotation_key, {_ACC} acc, value FROM annotation), piv AS (SELECT source_id, entity_evidence_id, "
    + ", ".join([f"max({_NUM}) FILTER (acc = '{a}') {n}" for n, a in NUMBERS.items()] + [f"string_agg(DISTINCT trim(value), '|' ORDER BY trim(value)) FILTER (acc = '{a}') {n}" for n, a in TEXTS.items()] + [f"coalesce(bool_or(lower(trim(value)) IN ({_TRUE})) FILTER (acc = '{a}'), false) {n}" for n, a in FLAGS.items()])
    + " FROM (SELECT DISTINCT source_id, entity_evidence_id, annotation_key FROM entity_evidence_annotation) JOIN an USING (annotation_key) WHERE acc IN ("
    + ", ".join(f"'{a}'" for a in [*NUMBERS.values(), *TEXTS.values(), *FLAGS.values()])
    + ") GROUP BY 1, 2)"
)
ALL = f"""{ref.EDGES}, {ref.ENT}, {PIVOT}, se AS (SELECT DISTINCT source_id, relation_evidence_id, {_BARE.format('subject_entity_evidence_id')} entity_evidence_id FROM relation_evidence),
 met AS (SELECT e.*, entity_evidence_id, s.entity_type_id st, o.entity_type_id ot, s.taxonomy_id stax, o.taxonomy_id otax, s.resolution_status_id = 1 sres, o.resolution_status_id = 1 ores FROM edges e LEFT JOIN se USING (source_id, relation_evidence_id) JOIN ent s ON s.entity_id = e.subject_id JOIN ent o ON o.entity_id = e.object_id),
 dir AS (SELECT source_id, relation_evidence_id, entity_evidence_id, predicate_id, subject_id compound_id, object_id protein_id, true forward, otax ptax, ores pres, coalesce(sres AND ores, false) both_resolved FROM met WHERE st IN (1, 3) AND ot = 2
  UNION ALL SELECT source_id, relation_evidence_id, entity_evidence_id, predicate_id, object_id, subject_id, false, stax, sres, coalesce(sres AND ores, false) FROM met WHERE ot IN (1, 3) AND st = 2),
 al AS (SELECT dir.*, piv.* EXCLUDE (source_id, entity_evidence_id) FROM dir LEFT JOIN piv ON piv.source_id = dir.source_id AND piv.entity_evidence_id = dir.entity_evidence_id)"""


def _where(v: View) -> str:
    out = f"source_id = {v.source_id} AND {'NOT ' if v.flip else ''}forward"
    if v.taxon:
        out += f" AND ptax = {v.taxon[1]}" if v.taxon[0] == "protein" else f" AND list_contains(string_split(taxon, '|'), '{v.taxon[1]}')"
    if v.resolved:
        out += " AND pres" if v.resolved == "protein" else " AND both_resolved"
    if v.needs:
        out += f" AND {v.needs[0]} IS NOT NULL" if v.needs[1] is None else f" AND {v.needs[0]} >= {v.needs[1]}"
    return out + (f" AND predicate_id IN {v.predicates}" if v.predicates else "")


def _register(name: str, v: View, shown: list[str]) -> None:
    keep = ["source_id", "relation_evidence_id", "compound_id", "protein_id", "predicate_id", *shown]
    QUERIES[f"{name}_view"] = lambda spark, d: rows(spark, d, [v]).select("network", *keep)
    ORACLES[f"{name}_view"] = f"WITH {ALL} SELECT '{v.name}' network, {', '.join(keep)} FROM al WHERE {_where(v)}"


for _v, (_n, _s) in zip(VIEWS, SHOWN.items()):
    _register(_n, _v, _s)

COMBINED = [v for v in VIEWS if v.name != "bindingdb"]
_TRANSPORTS = [("recon3d", 2, 1, 2), ("rhea", 3, 3, 4), ("humangem", 1, 5, 6)]
_RULES = ", ".join(f"({i}, '{c}', {p})" for i, c, p in ref.CLASS_RULES)
_HOPS = " UNION ALL ".join(
    f"SELECT '{n}' network, p.object_id compound_id, c.subject_id protein_id, count(DISTINCT c.object_id) n_evidence FROM (SELECT DISTINCT subject_id, object_id FROM edges WHERE predicate_id = {a}) c JOIN (SELECT DISTINCT subject_id, object_id FROM edges WHERE predicate_id = {b}) p ON p.subject_id = c.object_id JOIN ent m ON m.entity_id = c.object_id AND m.entity_type_id = {t} JOIN ent x ON x.entity_id = c.subject_id AND x.entity_type_id = 2 AND x.resolution_status_id = 1 JOIN ent y ON y.entity_id = p.object_id AND y.entity_type_id IN (1, 3) AND y.resolution_status_id = 1 GROUP BY 2, 3"
    for n, t, a, b in _TRANSPORTS
)
ORACLES["n88_combined_view"] = f"""WITH {ALL}, rules(source_id, class, precedence) AS (VALUES {_RULES}), cls AS (SELECT entity_id, coalesce(arg_min(class, precedence) FILTER (class IS NOT NULL), 'metabolite') class FROM (SELECT DISTINCT entity_id, source_id FROM entity_evidence_resolution WHERE entity_id IS NOT NULL) LEFT JOIN rules USING (source_id) GROUP BY 1),
 pr AS ({' UNION ALL '.join(f"SELECT '{v.name}' network, compound_id, protein_id, count(*) n_evidence FROM al WHERE both_resolved AND {_where(v)} GROUP BY 2, 3" for v in COMBINED)} UNION ALL {_HOPS})
 SELECT compound_id, protein_id, count(DISTINCT network) n_networks, string_agg(DISTINCT network, '|' ORDER BY network) networks, sum(n_evidence)::BIGINT n_evidence FROM pr WHERE compound_id IN (SELECT entity_id FROM cls WHERE class = 'metabolite') GROUP BY 1, 2"""


def n88(spark: SparkSession, d: str) -> DataFrame:
    """All direct networks but bindingdb and the three of transports, metabolites only, both sides resolved."""
    direct = networks.view_pairs(rows(spark, d, COMBINED))
    n = ref.nodes(spark, d).where("resolution_status_id = 1")
    proteins, compounds = n.where(F.col("entity_type_id") == PROTEIN).select(F.col("entity_id").alias("protein_id")), n.where(F.col("entity_type_id").isin(COMPOUNDS)).select(F.col("entity_id").alias("compound_id"))
    hops = networks.transport_views(ref.edges(spark, d), ref.nodes(spark, d), _TRANSPORTS).join(proteins, "protein_id", "left_semi").join(compounds, "compound_id", "left_semi")
    rules = spark.createDataFrame(ref.CLASS_RULES, "source_id long, class string, precedence int")
    metabolites = derive.most_specific_class(table(spark, d, "entity_evidence_resolution").where("entity_id is not null"), rules, "entity_id", "source_id", "metabolite").where("class = 'metabolite'").select(F.col("entity_id").alias("compound_id"))
    return networks.combined_view(direct.unionByName(hops.withColumnRenamed("n_transports", "n_evidence")), metabolites)


QUERIES["n88_combined_view"] = n88

"""The batch of the evidence tables, resolved and merged as a whole, each query with SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.text import accession_of, no_text, outer_trim
from strandwise.operators import batch, chemicals
from strandwise.plans import reference as ref
from strandwise.session import Scratch, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Identifier types whose keys may be used without a taxonomy where they are unambiguous: UniProt, Ensembl, Entrez, HGNC.
ACCESSIONS = [1, 2, 3, 4]
KINDS = {1: "Chemical", 2: "Gene", 3: "Chemical", 4: "Complex"}
#: The type number of unresolved identifiers does not stand in the vocabulary; they carry none.
CV_TERM, PUBMED = 100, 101


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return keep


def evidence(spark: SparkSession, d: str) -> DataFrame:
    """Evidence records with the kind and taxonomy of the least entity they point to."""
    rows = table(spark, d, "entity_evidence_resolution").groupBy("source_id", "entity_evidence_id").agg(F.min("entity_id").alias("entity_id"))
    kind = F.lit("Entity")
    for n, k in KINDS.items():
        kind = F.when(F.col("entity_type_id") == n, k).otherwise(kind)
    e = table(spark, d, "entity").select("entity_id", "entity_type_id", "taxonomy_id", "canonical_identifier_type_id", "canonical_identifier", "label").distinct()
    return rows.join(e, "entity_id", "left").select(F.concat_ws(":", F.col("source_id").cast("string"), "entity_evidence_id").alias("evidence_id"), "source_id", kind.alias("entity_type"), "taxonomy_id", F.col("canonical_identifier_type_id").alias("t"), F.when(~no_text(F.col("canonical_identifier")), outer_trim(F.col("canonical_identifier"))).alias("v"), F.when(~no_text(F.col("label")), outer_trim(F.col("label"))).alias("name"))


def identifiers(rows: DataFrame) -> DataFrame:
    """The canonical identifier of the entity, and its name: as a gene name or a plain name by kind."""
    name_type = F.when(F.col("entity_type") == "Gene", F.lit(ref.GENE_NAME)).otherwise(F.lit(ref.NAME)).cast("bigint")
    two = F.array(F.struct(F.col("t").alias("key_type"), F.col("v").alias("key_value")), F.struct(name_type.alias("key_type"), F.col("name").alias("key_value")))
    return rows.select("evidence_id", F.explode(two).alias("i")).select("evidence_id", "i.key_type", "i.key_value").where("key_type is not null and key_value is not null").distinct()


def lookup(spark: SparkSession, d: str) -> DataFrame:
    """Gene names and Entrez ids to Entrez ids, chemical identifiers to canonical ones, InChIKeys to themselves."""
    genes = table(spark, d, "entity").where("entity_type_id = 2 and canonical_identifier_type_id = 3").select("taxonomy_id", outer_trim(F.col("label")).alias("name"), outer_trim(F.col("canonical_identifier")).alias("canonical_id")).where(~no_text(F.col("canonical_id")))
    keys = F.explode(F.array(F.struct(F.lit(ref.GENE_NAME).cast("bigint").alias("key_type"), F.col("name").alias("key_value")), F.struct(F.lit(ref.ENTREZ).cast("bigint").alias("key_type"), F.col("canonical_id").alias("key_value"))))
    genes = genes.select(F.lit("Gene").alias("entity_type"), "taxonomy_id", keys.alias("k"), F.lit(ref.ENTREZ).cast("bigint").alias("canonical_type"), "canonical_id").select("entity_type", "taxonomy_id", "k.key_type", "k.key_value", "canonical_type", "canonical_id").where(~no_text(F.col("key_value")))
    chem = ref.lookup(spark, d).where("entity_type = 'Chemical'")
    return genes.distinct().unionByName(chem)


_T = "trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"
_PLAIN = "CASE WHEN lower({0}) NOT IN ('', '-', '--', '?', '.', 'n/a', 'n.a.', 'na', 'none', 'null', 'nil', 'nan', 'unknown', 'not available') THEN {0} END"
_P = lambda c: _PLAIN.format(_T.format(c))
EVIDENCE = f"""{ref.COMPLETE}, ev AS (SELECT DISTINCT r.source_id::VARCHAR || ':' || r.entity_evidence_id evidence_id, r.source_id, CASE entity_type_id WHEN 1 THEN 'Chemical' WHEN 3 THEN 'Chemical' WHEN 2 THEN 'Gene' WHEN 4 THEN 'Complex' ELSE 'Entity' END entity_type, taxonomy_id, canonical_identifier_type_id t, {_P('canonical_identifier')} v, {_P('label')} n
  FROM (SELECT source_id, entity_evidence_id, min(entity_id) entity_id FROM entity_evidence_resolution GROUP BY 1, 2) r LEFT JOIN (SELECT DISTINCT * FROM entity) e USING (entity_id)),
 ids AS (SELECT evidence_id, t key_type, v key_value FROM ev WHERE t IS NOT NULL AND v IS NOT NULL UNION SELECT evidence_id, CASE entity_type WHEN 'Gene' THEN 5 ELSE 16 END, n FROM ev WHERE n IS NOT NULL)"""
LOOKED = f"""gl AS (SELECT DISTINCT taxonomy_id, {_P('label')} n, {_P('canonical_identifier')} c FROM entity WHERE entity_type_id = 2 AND canonical_identifier_type_id = 3),
 lk AS (SELECT 'Gene' entity_type, taxonomy_id, CAST(5 AS BIGINT) key_type, n key_value, CAST(3 AS BIGINT) canonical_type, c canonical_id FROM gl WHERE n IS NOT NULL AND c IS NOT NULL UNION SELECT 'Gene', taxonomy_id, 3, c, 3, c FROM gl WHERE c IS NOT NULL
  UNION SELECT 'Chemical', NULL, kt, kv, ct, cv FROM complete UNION SELECT 'Chemical', NULL, ct, cv, ct, cv FROM complete WHERE ct = 13),
 opt AS (SELECT entity_type, key_type, key_value FROM lk WHERE key_type IN (1, 2, 3, 4) GROUP BY ALL HAVING count(DISTINCT canonical_type::VARCHAR || '|' || canonical_id) = 1),
 cand AS (SELECT DISTINCT i.evidence_id, coalesce(l.taxonomy_id, e.taxonomy_id) tax, l.canonical_type ct, l.canonical_id cv FROM ids i JOIN ev e USING (evidence_id) JOIN lk l ON l.entity_type = e.entity_type AND l.key_type = i.key_type AND l.key_value = i.key_value
  LEFT JOIN opt o ON o.entity_type = l.entity_type AND o.key_type = l.key_type AND o.key_value = l.key_value WHERE e.entity_type IN ('Gene', 'Chemical') AND (l.taxonomy_id = e.taxonomy_id OR l.taxonomy_id IS NULL OR o.key_value IS NOT NULL)),
 one AS (SELECT evidence_id, count(*) k, min(tax) tax, min(ct) ct, min(cv) cv FROM cand GROUP BY 1)"""
DIRECT = f"direct AS (SELECT evidence_id, CAST(13 AS BIGINT) ct, min(key_value) cv FROM ids JOIN ev USING (evidence_id) WHERE entity_type = 'Chemical' AND key_type = 13 AND regexp_matches(key_value, {ref.IK}) GROUP BY 1 HAVING count(DISTINCT key_value) = 1)"
_TIERS = ", ".join(f"({t}, {n}, '{m}')" for t, (n, m) in ref.FALLBACK.items())
FALL = f"""ch AS (SELECT i.* FROM ids i JOIN ev USING (evidence_id) WHERE entity_type = 'Chemical'), iks AS (SELECT evidence_id, key_value a FROM ch WHERE key_type = 13 AND regexp_matches(key_value, {ref.IK})),
 kin AS (SELECT key_type, key_value, count(DISTINCT a) n, min(a) m FROM ch JOIN iks USING (evidence_id) WHERE key_type NOT IN (8, 13) GROUP BY 1, 2), kch AS (SELECT x.key_type, x.key_value, count(DISTINCT y.key_value) n, min(y.key_value) m FROM ch x JOIN ch y USING (evidence_id) WHERE x.key_type NOT IN (8, 13) AND y.key_type = 8 GROUP BY 1, 2),
 anc AS (SELECT key_type, key_value, 13 aty, m FROM kin WHERE n = 1 UNION ALL SELECT key_type, key_value, 8, m FROM kch WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM kin WHERE kin.key_type = kch.key_type AND kin.key_value = kch.key_value)),
 amb AS (SELECT key_type, lower(trim(key_value)) low FROM ch JOIN iks USING (evidence_id) WHERE key_type <> 13 GROUP BY 1, 2 HAVING count(DISTINCT a) > 1), tiers(key_type, tier, mechanism) AS (VALUES {_TIERS}),
 fown AS (SELECT * FROM ch JOIN tiers USING (key_type) WHERE NOT (key_type IN (16, 28) AND (regexp_matches(key_value, {ref.IK}) OR regexp_matches(key_value, '^[0-9]+$') OR length(key_value) < 2 OR EXISTS (SELECT 1 FROM amb WHERE amb.key_type = ch.key_type AND amb.low = lower(trim(ch.key_value)))))),
 fc AS (SELECT evidence_id, key_type t, key_value v, tier, mechanism, 0 hung FROM fown UNION ALL SELECT evidence_id, aty, m, CASE aty WHEN 13 THEN 0 ELSE 2 END, CASE aty WHEN 13 THEN 'anchored_structure' ELSE 'anchored_chebi' END, 1 FROM fown JOIN anc USING (key_type, key_value)),
 fall AS (SELECT evidence_id, t, v, mechanism FROM (SELECT *, row_number() OVER (PARTITION BY evidence_id ORDER BY tier, hung, v, t) r FROM fc) WHERE r = 1)"""
BASE = f"""{EVIDENCE}, {LOOKED}, {DIRECT}, {FALL}, un AS (SELECT evidence_id, md5(string_agg(key_type::VARCHAR || '=' || key_value, '|' ORDER BY key_type, key_value)) u FROM ids GROUP BY 1),
 base AS (SELECT e.evidence_id, e.source_id, e.entity_type, e.entity_type molecular_type, CASE WHEN d.cv IS NULL AND k = 1 THEN one.tax ELSE e.taxonomy_id END taxonomy_id, (CASE WHEN d.cv IS NOT NULL THEN d.ct WHEN k = 1 THEN one.ct WHEN k IS NULL AND f.v IS NOT NULL THEN f.t END)::BIGINT canonical_type,
  CASE WHEN d.cv IS NOT NULL THEN d.cv WHEN k = 1 THEN one.cv WHEN k IS NULL AND f.v IS NOT NULL THEN f.v ELSE coalesce(u, md5(e.evidence_id)) END canonical_id, CASE WHEN d.cv IS NOT NULL OR k = 1 OR (k IS NULL AND f.v IS NOT NULL) THEN 1 ELSE 2 END status,
  CASE WHEN d.cv IS NOT NULL THEN 'inchikey' WHEN k = 1 THEN 'resolver' WHEN k IS NULL AND f.v IS NOT NULL THEN f.mechanism ELSE 'unresolved' END mechanism
  FROM ev e LEFT JOIN direct d USING (evidence_id) LEFT JOIN one USING (evidence_id) LEFT JOIN fall f USING (evidence_id) LEFT JOIN un USING (evidence_id))"""


def base(spark: SparkSession, d: str) -> DataFrame:
    # both are read several times below
    scratch = Scratch(spark)
    rows = scratch.write(evidence(spark, d))
    ids = scratch.write(identifiers(rows))
    direct = batch.direct_resolutions(rows, ids, ("Chemical", ref.INCHIKEY))
    found = batch.lookup_candidates(rows, ids, lookup(spark, d), ACCESSIONS)
    own = ids.join(rows.where("entity_type = 'Chemical'").select("evidence_id"), "evidence_id", "left_semi")
    back = chemicals.fallback_pick(own, chemicals.anchor_map(own, ref.INCHIKEY, ref.CHEBI), chemicals.ambiguous_values(own, ref.INCHIKEY), ref.FALLBACK, [ref.NAME, ref.SYNONYM])
    return batch.resolution_base(rows, ids, direct, found, back)


@query("n12_type_matches", "SELECT * FROM (VALUES ('Protein', 'Gene'), ('Gene', 'Gene'), ('Chemical', 'Chemical')) t(evidence_type, lookup_type)")
def n12(spark, d):
    return spark.createDataFrame(list(batch.TYPE_MATCHES.items()), "evidence_type string, lookup_type string")


@query("n13_accession_keys", f"WITH {EVIDENCE}, {LOOKED} SELECT * FROM opt")
def n13(spark, d):
    from strandwise.operators.resolve import unambiguous_keys

    return unambiguous_keys(lookup(spark, d), ACCESSIONS)


@query("n20_direct_resolutions", f"WITH {EVIDENCE}, {DIRECT} SELECT evidence_id, ct canonical_type, cv canonical_id, 'inchikey' mechanism FROM direct")
def n20(spark, d):
    rows = evidence(spark, d)
    return batch.direct_resolutions(rows, identifiers(rows), ("Chemical", ref.INCHIKEY))


@query("n21_resolution_base", f"WITH {BASE} SELECT * EXCLUDE (source_id) FROM base")
def n21(spark, d):
    return base(spark, d)


MECHANISMS = {"inchikey": 1, "anchored_structure": 2, "smiles": 3, "chebi": 4, "anchored_chebi": 5, "resolver": 6, "cv_term": 7, "pathway": 8, "gene_anchor": 9, "complex": 10, "reaction": 11, "chembl": 12, "pubchem": 13, "swisslipids": 14, "hmdb": 15, "lipidmaps": 16, "original_id": 17, "name": 18, "unresolved": 19}
_M = " ".join(f"WHEN '{m}' THEN {p}" for m, p in MECHANISMS.items())
_PAPER = r"'^[0-9]{5,9}$'"
_ENTITY_KEY = "'[\"' || entity_type || '\",\"' || coalesce(taxonomy_id::VARCHAR, '') || '\",\"' || coalesce(canonical_type::VARCHAR, '') || '\",\"' || canonical_id || '\"]'"


@query("n26_entity_union", f"""WITH {BASE}, hard AS (SELECT DISTINCT source_id, entity_type, taxonomy_id, canonical_type, canonical_id, status, mechanism FROM base), res AS (SELECT DISTINCT entity_type, taxonomy_id, canonical_type, canonical_id FROM hard WHERE status = 1),
 ann AS (SELECT DISTINCT source_id, upper(nullif(regexp_extract(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', 1), '')) acc, {_T.format('value')} v FROM entity_evidence_annotation JOIN annotation USING (annotation_key)),
 onto AS (SELECT id, CASE WHEN n = 1 THEN t ELSE 8 END t, CASE WHEN n = 1 THEN c ELSE id END c FROM (SELECT DISTINCT {_T.format('canonical_identifier')} id FROM entity WHERE canonical_identifier LIKE '%CHEBI:%' AND canonical_identifier_type_id = 8) LEFT JOIN (SELECT kv id, count(*) n, min(ct) t, min(cv) c FROM complete WHERE kt = 8 GROUP BY 1) USING (id)),
 src AS (SELECT source_id, entity_type, taxonomy_id, canonical_type, canonical_id, status, mechanism, CASE status WHEN 1 THEN 1 ELSE 5 END origin FROM hard UNION ALL SELECT source_id, 'Cv Term', NULL, 100, acc, 1, NULL, 2 FROM ann WHERE acc IS NOT NULL
  UNION ALL SELECT source_id, 'Publication', NULL, 101, v, 1, NULL, 3 FROM ann WHERE acc = 'MI:0446' AND regexp_matches(v, {_PAPER}) UNION ALL SELECT NULL, 'Chemical', NULL, t, c, 1, NULL, 4 FROM onto),
 al AS (SELECT *, CASE WHEN origin = 1 OR NOT EXISTS (SELECT 1 FROM res WHERE res.entity_type = src.entity_type AND res.taxonomy_id IS NOT DISTINCT FROM src.taxonomy_id AND res.canonical_type IS NOT DISTINCT FROM src.canonical_type AND res.canonical_id = src.canonical_id) THEN origin ELSE 1 END o FROM src)
 SELECT {ref.UUID.format(f"md5({_ENTITY_KEY})")} entity_id, entity_type, taxonomy_id, canonical_type, canonical_id, arg_min(status, origin) status, arg_min(mechanism, CASE mechanism {_M} END) FILTER (mechanism IS NOT NULL) mechanism, min(o)::INT origin, string_agg(DISTINCT lpad(source_id::VARCHAR, 6, '0'), ',' ORDER BY lpad(source_id::VARCHAR, 6, '0')) sources
 FROM al GROUP BY entity_type, taxonomy_id, canonical_type, canonical_id""")
def n26(spark, d):
    """Resolved evidence, vocabulary terms of annotations, papers they name, ontology terms, unresolved evidence."""
    rows = base(spark, d).withColumn("source_id", F.split("evidence_id", ":")[0].cast("bigint"))
    said = table(spark, d, "entity_evidence_annotation").select("source_id", "annotation_key").distinct().join(table(spark, d, "annotation").select("annotation_key", accession_of(F.col("term")).alias("acc"), outer_trim(F.col("value")).alias("v")), "annotation_key")
    bare = lambda kind, t, v: [F.lit(kind).alias("entity_type"), F.lit(None).cast("bigint").alias("taxonomy_id"), t.cast("bigint").alias("canonical_type"), v.alias("canonical_id"), F.lit(1).alias("status"), F.lit(None).cast("string").alias("mechanism")]
    terms = said.select("source_id", *bare("Cv Term", F.lit(CV_TERM), F.col("acc"))).distinct()
    papers = said.where(F.col("v").rlike(r"^[0-9]{5,9}$") & (F.col("acc") == "MI:0446")).select("source_id", *bare("Publication", F.lit(PUBMED), F.col("v"))).distinct()
    ids = table(spark, d, "entity").where("canonical_identifier_type_id = 8").select(outer_trim(F.col("canonical_identifier")).alias("kv")).where(F.col("kv").contains("CHEBI:")).distinct()
    one = ref.complete(spark, d).where("kt = 8").groupBy("kv").agg(F.count(F.lit(1)).alias("n"), F.min("ct").alias("ct"), F.min("cv").alias("cv")).where("n = 1")
    onto = ids.join(one, "kv", "left").select(F.lit(None).cast("bigint").alias("source_id"), *bare("Chemical", F.coalesce("ct", F.lit(8)), F.coalesce("cv", "kv")))
    return batch.entity_union([rows.where("status = 1"), terms, papers, onto, rows.where("status = 2")], MECHANISMS)

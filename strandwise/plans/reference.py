"""Queries of the graph operators over the evidence tables, each with SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.ids import content_uuid, relation_key, sorted_text, unit_joined
from strandwise.functions.text import accession_of
from strandwise.operators import chemicals, derive, networks, pick, project, resolve, store
from strandwise.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


# Identifier types of the tables.
UNIPROT, GENE_NAME, ENTREZ, CHEBI, HMDB, PUBCHEM, INCHIKEY, NAME, CHEMBL, SYNONYM = 1, 5, 3, 8, 9, 12, 13, 16, 17, 28
# Tiers and mechanisms of fallback identities by identifier type.
FALLBACK = {8: (2, "chebi"), 17: (3, "chembl"), 12: (4, "pubchem"), 11: (6, "swisslipids"), 9: (7, "hmdb"), 10: (8, "lipidmaps"), 23: (20, "original_id"), 22: (24, "original_id"), 24: (25, "original_id"), 27: (29, "original_id"), 16: (40, "name"), 28: (41, "name")}
# Tiers and readable prefixes of identifier labels by identifier type.
LABEL_IDS = {8: (1, "CHEBI:"), 23: (2, ""), 12: (3, "CID:"), 9: (5, ""), 17: (6, ""), 10: (7, ""), 11: (8, ""), 22: (12, ""), 24: (15, "CAS:"), 27: (18, "BindingDB:"), 13: (99, "")}
# Order of mechanisms.
MECHANISMS = {"inchikey": 1, "anchored_structure": 2, "chebi": 4, "anchored_chebi": 5, "resolver": 6, "gene_anchor": 9, "chembl": 12, "pubchem": 13, "swisslipids": 14, "hmdb": 15, "lipidmaps": 16, "original_id": 17, "name": 18, "unresolved": 19}

# --- what stands for mentions, their identifiers, and the lookup -----------------------------------------------------


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct complete lookup rows, trimmed."""
    t = table(spark, sf_dir, "chemical_identifier_lookup")
    return t.select(F.col("key_identifier_type_id").alias("kt"), F.trim("key_value").alias("kv"), F.col("canonical_identifier_type_id").alias("ct"), F.trim("canonical_identifier").alias("cv")).where("kv <> '' and cv <> ''").distinct()


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes of entity by name, and every canonical chemical identifier, as mentions with one identifier each."""
    genes = table(spark, sf_dir, "entity").where("entity_type_id = 2 and trim(label) <> ''").select(F.col("entity_id").alias("evidence_id"), F.lit("Gene").alias("entity_type"), "taxonomy_id", F.lit(GENE_NAME).cast("bigint").alias("key_type"), F.trim("label").alias("key_value")).distinct()
    chem = complete(spark, sf_dir).select("ct", "cv").distinct()
    chem = chem.select(F.md5(F.concat_ws("|", F.col("ct").cast("string"), "cv")).alias("evidence_id"), F.lit("Chemical").alias("entity_type"), F.lit(None).cast("bigint").alias("taxonomy_id"), F.col("ct").alias("key_type"), F.col("cv").alias("key_value"))
    return genes.unionByName(chem)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene names to Entrez ids within a taxon, chemical identifiers to canonical ones, and InChIKeys to themselves."""
    genes = table(spark, sf_dir, "entity").where("entity_type_id = 2 and canonical_identifier_type_id = 3 and trim(label) <> '' and trim(canonical_identifier) <> ''")
    genes = genes.select(F.lit("Gene").alias("entity_type"), "taxonomy_id", F.lit(GENE_NAME).cast("bigint").alias("key_type"), F.trim("label").alias("key_value"), F.lit(ENTREZ).cast("bigint").alias("canonical_type"), F.trim("canonical_identifier").alias("canonical_id"))
    c = complete(spark, sf_dir)
    none = F.lit(None).cast("bigint").alias("taxonomy_id")
    chem = c.select(F.lit("Chemical").alias("entity_type"), none, F.col("kt").alias("key_type"), F.col("kv").alias("key_value"), F.col("ct").alias("canonical_type"), F.col("cv").alias("canonical_id"))
    own = c.where(F.col("ct") == INCHIKEY).select(F.lit("Chemical").alias("entity_type"), none, F.col("ct").alias("key_type"), F.col("cv").alias("key_value"), F.col("ct").alias("canonical_type"), F.col("cv").alias("canonical_id"))
    return genes.unionByName(chem).unionByName(own).distinct()


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each lookup row as a mention with two identifiers."""
    c = complete(spark, sf_dir).withColumn("evidence_id", F.md5(F.concat_ws("|", F.col("kt").cast("string"), "kv", F.col("ct").cast("string"), "cv")))
    two = F.explode(F.array(F.struct(F.col("kt").alias("key_type"), F.col("kv").alias("key_value")), F.struct(F.col("ct").alias("key_type"), F.col("cv").alias("key_value"))))
    return c.select("evidence_id", two.alias("i")).select("evidence_id", "i.key_type", "i.key_value").distinct()


COMPLETE = "complete AS (SELECT DISTINCT key_identifier_type_id kt, trim(key_value) kv, canonical_identifier_type_id ct, trim(canonical_identifier) cv FROM chemical_identifier_lookup WHERE trim(key_value) <> '' AND trim(canonical_identifier) <> '')"
MENTIONS = f"""{COMPLETE}, mentions AS (SELECT DISTINCT entity_id evidence_id, 'Gene' entity_type, taxonomy_id, CAST(5 AS BIGINT) key_type, trim(label) key_value FROM entity WHERE entity_type_id = 2 AND trim(label) <> ''
  UNION ALL SELECT DISTINCT md5(ct::VARCHAR || '|' || cv), 'Chemical', CAST(NULL AS BIGINT), ct, cv FROM complete)"""
LOOKUP = f"""{MENTIONS}, lookup AS (SELECT 'Gene' entity_type, taxonomy_id, CAST(5 AS BIGINT) key_type, trim(label) key_value, CAST(3 AS BIGINT) canonical_type, trim(canonical_identifier) canonical_id FROM entity
    WHERE entity_type_id = 2 AND canonical_identifier_type_id = 3 AND trim(label) <> '' AND trim(canonical_identifier) <> ''
  UNION SELECT 'Chemical', NULL, kt, kv, ct, cv FROM complete UNION SELECT 'Chemical', NULL, ct, cv, ct, cv FROM complete WHERE ct = 13)"""
OPTIONAL = "opt AS (SELECT entity_type, key_type, key_value FROM lookup WHERE key_type IN (5) GROUP BY ALL HAVING count(DISTINCT canonical_type::VARCHAR || '|' || canonical_id) = 1)"
NEEDED = f"""{LOOKUP}, {OPTIONAL}, keys AS (SELECT DISTINCT entity_type, taxonomy_id, key_type, key_value FROM mentions),
 needed AS (SELECT DISTINCT k.entity_type, k.key_type, k.key_value, k.taxonomy_id, l.canonical_type, l.canonical_id, o.key_value IS NOT NULL taxonomy_optional
  FROM keys k JOIN lookup l ON k.entity_type = l.entity_type AND k.key_type = l.key_type AND k.key_value = l.key_value
  LEFT JOIN opt o ON o.entity_type = k.entity_type AND o.key_type = k.key_type AND o.key_value = k.key_value
  WHERE k.taxonomy_id = l.taxonomy_id OR l.taxonomy_id IS NULL OR o.key_value IS NOT NULL)"""
CANDIDATES = f"""{NEEDED}, candidates AS (SELECT DISTINCT m.evidence_id, n.canonical_type, n.canonical_id FROM mentions m JOIN needed n
  ON m.entity_type = n.entity_type AND m.key_type = n.key_type AND m.key_value = n.key_value AND m.taxonomy_id IS NOT DISTINCT FROM n.taxonomy_id)"""
UUID = "substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12)"
RESOLUTION = f"""{CANDIDATES}, one AS (SELECT evidence_id, count(*) n, min(canonical_type) t, min(canonical_id) c FROM candidates GROUP BY 1),
 unresolved AS (SELECT evidence_id, md5(string_agg(key_type::VARCHAR || '=' || key_value, '|' ORDER BY key_type, key_value)) u FROM (SELECT DISTINCT evidence_id, key_type, key_value FROM mentions) GROUP BY 1),
 resolution AS (SELECT u.evidence_id, CASE WHEN n = 1 THEN t END canonical_type, CASE WHEN n = 1 THEN c ELSE u END canonical_id, CASE WHEN n = 1 THEN 1 ELSE 2 END status, CASE WHEN n = 1 THEN 'resolver' ELSE 'unresolved' END mechanism
  FROM unresolved u LEFT JOIN one o ON o.evidence_id = u.evidence_id)"""
PAIRS = f"""{COMPLETE}, pairs AS (SELECT md5(kt::VARCHAR || '|' || kv || '|' || ct::VARCHAR || '|' || cv) evidence_id, kt key_type, kv key_value FROM complete
  UNION SELECT md5(kt::VARCHAR || '|' || kv || '|' || ct::VARCHAR || '|' || cv), ct, cv FROM complete)"""
IK = "'^[A-Z]{14}-[A-Z]{10}-[A-Z]$'"


# --- lookups and resolution ------------------------------------------------------------------------------------------


@query("n11_identifier_keys", f"WITH {MENTIONS} SELECT DISTINCT entity_type, taxonomy_id, key_type, key_value FROM mentions")
def n11(spark, d):
    return resolve.identifier_keys(mentions(spark, d))


@query("n13_unambiguous_keys", f"WITH {LOOKUP}, {OPTIONAL} SELECT * FROM opt")
def n13(spark, d):
    return resolve.unambiguous_keys(lookup(spark, d), [GENE_NAME])


@query("n14_needed_lookup", f"WITH {NEEDED} SELECT * FROM needed")
def n14(spark, d):
    rows = lookup(spark, d)
    return resolve.needed_lookup(resolve.identifier_keys(mentions(spark, d)), rows, resolve.unambiguous_keys(rows, [GENE_NAME]))


@query("n19_unresolved_keys", f"WITH {PAIRS} SELECT evidence_id, md5(string_agg(key_type::VARCHAR || '=' || key_value, '|' ORDER BY key_type, key_value)) unresolved_id FROM pairs GROUP BY 1")
def n19(spark, d):
    return resolve.unresolved_key(pairs(spark, d))


@query("n20_direct_structures", f"WITH {PAIRS} SELECT evidence_id, CAST(13 AS BIGINT) canonical_type, min(key_value) canonical_id, 'inchikey' mechanism FROM pairs WHERE key_type = 13 AND regexp_matches(key_value, {IK}) GROUP BY 1 HAVING count(DISTINCT key_value) = 1")
def n20(spark, d):
    return resolve.direct_structures(pairs(spark, d), INCHIKEY)


@query("n21_entity_resolution", f"WITH {RESOLUTION} SELECT * FROM resolution")
def n21(spark, d):
    m, rows = mentions(spark, d), lookup(spark, d)
    return resolve.resolve_hits(m, resolve.lookup_hits(m, rows, resolve.unambiguous_keys(rows, [GENE_NAME])))


ENTITY_KEY = "'[\"' || m.entity_type || '\",\"' || coalesce(m.taxonomy_id::VARCHAR, '') || '\",\"' || coalesce(r.canonical_type::VARCHAR, '') || '\",\"' || r.canonical_id || '\"]'"


@query("n26_entities", f"""WITH {RESOLUTION}, x AS (SELECT {ENTITY_KEY} k, m.entity_type, m.taxonomy_id, r.canonical_type, r.canonical_id, r.mechanism, CASE r.mechanism WHEN 'resolver' THEN 6 ELSE 19 END p
  FROM resolution r JOIN (SELECT DISTINCT evidence_id, entity_type, taxonomy_id FROM mentions) m ON m.evidence_id = r.evidence_id)
 SELECT {UUID.format("md5(k)")} entity_id, entity_type, taxonomy_id, canonical_type, canonical_id, arg_min(mechanism, p) mechanism, count(*) n_mentions FROM x GROUP BY k, entity_type, taxonomy_id, canonical_type, canonical_id""")
def n26(spark, d):
    return resolve.entities(n21(spark, d), mentions(spark, d), MECHANISMS)


@query("n29_entity_identifiers", f"WITH {RESOLUTION} SELECT DISTINCT r.canonical_id, m.key_type, m.key_value FROM resolution r JOIN mentions m ON m.evidence_id = r.evidence_id WHERE status = 1 UNION SELECT DISTINCT canonical_id, canonical_type, canonical_id FROM resolution WHERE status = 1")
def n29(spark, d):
    r = n21(spark, d).where("status = 1")
    own = r.select("canonical_id", F.col("canonical_type").alias("key_type"), F.col("canonical_id").alias("key_value"))
    return r.join(mentions(spark, d), "evidence_id").select("canonical_id", "key_type", "key_value").unionByName(own).distinct()


REFS = f"refs AS (SELECT {UUID.format(chr(109) + 'd5(relation_id)')} relation_evidence_id, subject_entity_id subject_id, object_entity_id object_id FROM (SELECT DISTINCT relation_id, subject_entity_id, object_entity_id FROM relation))"
MULTI = f"""{CANDIDATES}, many AS (SELECT * FROM (SELECT DISTINCT evidence_id, canonical_id gene FROM candidates) WHERE evidence_id IN (SELECT evidence_id FROM candidates GROUP BY 1 HAVING count(DISTINCT canonical_id) > 1)),
 parts AS (SELECT evidence_id, gene, {UUID.format("md5(evidence_id || '#mg=' || gene)")} part_id FROM many)"""


@query("n15_multi_gene_mentions", f"WITH {MULTI} SELECT m.evidence_id, entity_type, taxonomy_id, key_type, key_value FROM mentions m WHERE evidence_id NOT IN (SELECT evidence_id FROM parts) UNION ALL SELECT part_id, entity_type, taxonomy_id, key_type, key_value FROM mentions m JOIN parts p ON p.evidence_id = m.evidence_id")
def n15(spark, d):
    return multi_gene(spark, d)[0]


@query("n15_multi_gene_references", f"""WITH {MULTI}, {REFS}, j AS (SELECT r.*, s.gene gs, s.part_id ps, o.gene go, o.part_id po FROM refs r LEFT JOIN parts s ON s.evidence_id = r.subject_id LEFT JOIN parts o ON o.evidence_id = r.object_id)
 SELECT CASE WHEN gs IS NULL AND go IS NULL THEN relation_evidence_id ELSE {UUID.format("md5(relation_evidence_id || '#mgs=' || coalesce(gs, '') || '#mgo=' || coalesce(go, ''))")} END relation_evidence_id, coalesce(ps, subject_id) subject_id, coalesce(po, object_id) object_id FROM j""")
def n15b(spark, d):
    return multi_gene(spark, d)[1]


@query("n15_multi_gene_annotations", f"WITH {MULTI}, a AS (SELECT DISTINCT r.entity_id evidence_id, annotation_key FROM entity_evidence_annotation JOIN entity_evidence_resolution r USING (source_id, entity_evidence_id)) SELECT coalesce(part_id, a.evidence_id) evidence_id, annotation_key FROM a LEFT JOIN parts p ON p.evidence_id = a.evidence_id")
def n15c(spark, d):
    """Annotations follow the copies of their mention."""
    m = mentions(spark, d)
    who = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", F.col("entity_id").alias("evidence_id")).distinct()
    said = table(spark, d, "entity_evidence_annotation").join(who, ["source_id", "entity_evidence_id"]).select("evidence_id", "annotation_key").distinct()
    return resolve.follow_parts(said, resolve.gene_parts(resolve.candidates(m, n14(spark, d))), "evidence_id")


def multi_gene(spark, d):
    m = mentions(spark, d)
    refs = table(spark, d, "relation").select("relation_id", "subject_entity_id", "object_entity_id").distinct()
    refs = refs.select(content_uuid(F.col("relation_id")).alias("relation_evidence_id"), F.col("subject_entity_id").alias("subject_id"), F.col("object_entity_id").alias("object_id"))
    return resolve.split_multi_gene(m, resolve.candidates(m, n14(spark, d)), refs)


@query("n41_lookup_unambiguous", f"WITH {COMPLETE} SELECT kt, kv, ct, cv FROM complete SEMI JOIN (SELECT kt, kv FROM complete GROUP BY ALL HAVING count(DISTINCT ct::VARCHAR || '|' || cv) = 1) USING (kt, kv)")
def n41(spark, d):
    return pick.ambiguity_split(complete(spark, d), ["kt", "kv"], ["ct", "cv"])[0]


@query("n43_lookup_ambiguous", f"WITH {COMPLETE} SELECT kt, kv, ct, cv FROM complete SEMI JOIN (SELECT kt, kv FROM complete GROUP BY ALL HAVING count(DISTINCT ct::VARCHAR || '|' || cv) > 1) USING (kt, kv)")
def n43(spark, d):
    return pick.ambiguity_split(complete(spark, d), ["kt", "kv"], ["ct", "cv"])[1]


@query("n44_components", f"""WITH RECURSIVE {COMPLETE}, e AS (SELECT kt::VARCHAR || ':' || kv a, ct::VARCHAR || ':' || cv b FROM complete), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 r(node, root, step) AS (SELECT a, least(a, min(b)), 1 FROM s GROUP BY a UNION ALL SELECT node, root, step + 1 FROM (SELECT s.a node, least(any_value(me.root), min(x.root)) root, any_value(x.step) step FROM s JOIN r x ON x.node = s.b JOIN r me ON me.node = s.a GROUP BY s.a) WHERE step < 400)
 SELECT node, min(root) root FROM r GROUP BY 1""")
def n44(spark, d):
    c = complete(spark, d)
    return resolve.lookup_components(c.select(F.concat_ws(":", F.col("kt").cast("string"), "kv").alias("a"), F.concat_ws(":", F.col("ct").cast("string"), "cv").alias("b")), "a", "b")


@query("n42_representatives", "SELECT taxonomy_id, label, min(CASE WHEN p = q THEN canonical_identifier END) canonical_identifier, q reviewed FROM (SELECT *, max(p) OVER (PARTITION BY taxonomy_id, label) q FROM (SELECT taxonomy_id, label, canonical_identifier, resolution_status_id = 1 p FROM entity WHERE entity_type_id = 2 AND label IS NOT NULL AND trim(canonical_identifier) <> '')) GROUP BY taxonomy_id, label, q")
def n42(spark, d):
    rows = table(spark, d, "entity").where("entity_type_id = 2 and label is not null and trim(canonical_identifier) <> ''").select("taxonomy_id", "label", "canonical_identifier", (F.col("resolution_status_id") == 1).alias("reviewed"))
    return resolve.best_representative_of(rows, ["taxonomy_id", "label"], "canonical_identifier", "reviewed")


# --- chemicals -------------------------------------------------------------------------------------------------------

ANCHORS = f"""{PAIRS}, own AS (SELECT * FROM pairs WHERE key_type NOT IN (8, 13)), ik AS (SELECT key_type, key_value, count(DISTINCT a) n, min(a) m FROM own JOIN (SELECT evidence_id, key_value a FROM pairs WHERE key_type = 13 AND regexp_matches(key_value, {IK})) USING (evidence_id) GROUP BY 1, 2),
 ch AS (SELECT key_type, key_value, count(DISTINCT a) n, min(a) m FROM own JOIN (SELECT evidence_id, key_value a FROM pairs WHERE key_type = 8) USING (evidence_id) GROUP BY 1, 2),
 anchors AS (SELECT key_type, key_value, CAST(13 AS BIGINT) anchor_type, m anchor_id FROM ik WHERE n = 1 UNION ALL SELECT key_type, key_value, CAST(8 AS BIGINT), m FROM ch WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM ik WHERE ik.key_type = ch.key_type AND ik.key_value = ch.key_value))"""


@query("n16_anchor_map", f"WITH {ANCHORS} SELECT * FROM anchors")
def n16(spark, d):
    return chemicals.anchor_map(pairs(spark, d), INCHIKEY, CHEBI)


AMBIGUOUS = f"ambiguous AS (SELECT key_type, lower(trim(key_value)) key_value, count(DISTINCT a) n_values FROM pairs JOIN (SELECT evidence_id, key_value a FROM pairs WHERE key_type = 13 AND regexp_matches(key_value, {IK})) USING (evidence_id) WHERE key_type <> 13 GROUP BY 1, 2 HAVING count(DISTINCT a) > 1)"


@query("n17_ambiguous_values", f"WITH {PAIRS}, {AMBIGUOUS} SELECT * FROM ambiguous")
def n17(spark, d):
    return chemicals.ambiguous_values(pairs(spark, d), INCHIKEY)


_T = ", ".join(f"({t}, {n}, '{m}')" for t, (n, m) in FALLBACK.items())


@query("n18_fallback_pick", f"""WITH {ANCHORS}, tiers(key_type, tier, mechanism) AS (VALUES {_T}), cand AS (
  SELECT evidence_id, key_type canonical_type, key_value canonical_id, tier, mechanism, 0 hung FROM pairs JOIN tiers USING (key_type)
  UNION ALL SELECT evidence_id, anchor_type, anchor_id, CASE WHEN anchor_type = 13 THEN 0 ELSE 2 END, CASE WHEN anchor_type = 13 THEN 'anchored_structure' ELSE 'anchored_chebi' END, 1 FROM pairs JOIN tiers USING (key_type) JOIN anchors USING (key_type, key_value))
 SELECT evidence_id, canonical_type, canonical_id, mechanism FROM (SELECT *, row_number() OVER (PARTITION BY evidence_id ORDER BY tier, hung, canonical_id, canonical_type) r FROM cand) WHERE r = 1""")
def n18(spark, d):
    p = pairs(spark, d)
    return chemicals.fallback_pick(p, chemicals.anchor_map(p, INCHIKEY, CHEBI), chemicals.ambiguous_values(p, INCHIKEY), FALLBACK, [NAME, SYNONYM])


STRUCT = f"""{PAIRS}, own AS (SELECT md5(ct::VARCHAR || '|' || cv) entity_id, ct canonical_type, cv canonical_id FROM complete GROUP BY ct, cv), attached AS (SELECT DISTINCT md5(ct::VARCHAR || '|' || cv) entity_id, kt key_type, kv key_value FROM complete),
 structures AS (SELECT entity_id, arg_min(k, (r, k)) inchikey FROM (SELECT entity_id, canonical_id k, 0 r FROM own WHERE canonical_type = 13 AND regexp_matches(canonical_id, {IK}) UNION ALL SELECT entity_id, key_value, 1 FROM attached WHERE key_type = 13 AND regexp_matches(key_value, {IK})) GROUP BY 1)"""


def chemical_entities(spark, d):
    c = complete(spark, d).withColumn("entity_id", F.md5(F.concat_ws("|", F.col("ct").cast("string"), "cv")))
    return c.select("entity_id", F.col("ct").alias("canonical_type"), F.col("cv").alias("canonical_id")).distinct(), c.select("entity_id", F.col("kt").alias("key_type"), F.col("kv").alias("key_value")).distinct()


@query("n68_primary_structure", f"WITH {STRUCT} SELECT * FROM structures")
def n68(spark, d):
    own, attached = chemical_entities(spark, d)
    return chemicals.primary_structure(own, attached, INCHIKEY)


@query("n69_structure_groups", f"WITH {STRUCT}, levels(level, k) AS (VALUES ('connectivity', 14), ('stereo', 25), ('full', 27)) SELECT level, substr(inchikey, 1, k) group_key, count(*) n_members, min(entity_id) representative_id FROM structures, levels GROUP BY 1, 2")
def n69(spark, d):
    return chemicals.structure_groups(n68(spark, d))


ENT_STRUCT = f"es AS (SELECT DISTINCT entity_id, trim(canonical_identifier) inchikey FROM entity WHERE canonical_identifier_type_id = 13 AND regexp_matches(trim(canonical_identifier), {IK}))"


@query("n70_collapsed_relations", f"""WITH {ENT_STRUCT}, levels(level, k) AS (VALUES ('connectivity', 14), ('stereo', 25), ('full', 27)), rel AS (SELECT DISTINCT relation_id, subject_entity_id, predicate_id, object_entity_id FROM relation),
 lifted AS (SELECT relation_id, level, coalesce(substr(s.inchikey, 1, k), subject_entity_id) subject_key, predicate_id, coalesce(substr(o.inchikey, 1, k), object_entity_id) object_key FROM rel LEFT JOIN es s ON s.entity_id = subject_entity_id LEFT JOIN es o ON o.entity_id = object_entity_id CROSS JOIN levels)
 SELECT level, subject_key, predicate_id, object_key, count(DISTINCT l.relation_id) n_relations, count(DISTINCT source_id) n_sources FROM lifted l LEFT JOIN relation_evidence_relation x ON x.relation_id = l.relation_id GROUP BY ALL""")
def n70(spark, d):
    es = table(spark, d, "entity").where((F.col("canonical_identifier_type_id") == INCHIKEY) & F.trim("canonical_identifier").rlike(resolve.INCHIKEY)).select("entity_id", F.trim("canonical_identifier").alias("inchikey")).distinct()
    rel = table(spark, d, "relation").select("relation_id", "subject_entity_id", "predicate_id", "object_entity_id").distinct()
    return chemicals.collapsed_relations(rel, es, table(spark, d, "relation_evidence_relation"))


@query("n71_ambiguous_names", "SELECT lower(trim(label)) name, count(DISTINCT trim(canonical_identifier)) n_structures FROM entity WHERE trim(label) <> '' AND canonical_identifier_type_id = 13 AND regexp_matches(trim(canonical_identifier), '^[A-Z]{14}-[A-Z]{10}-[A-Z]$') GROUP BY 1 HAVING count(DISTINCT trim(canonical_identifier)) > 1")
def n71(spark, d):
    rows = table(spark, d, "entity").where((F.trim("label") != "") & (F.col("canonical_identifier_type_id") == INCHIKEY)).select(F.lower(F.trim("label")).alias("name"), F.trim("canonical_identifier").alias("k")).where(F.col("k").rlike(resolve.INCHIKEY))
    return pick.value_counts(rows, ["name"], ["k"]).where("n_values > 1").withColumnRenamed("n_values", "n_structures")


@query("n67_identifier_labels", f"""WITH {COMPLETE}, tiers(kt, tier, prefix) AS (VALUES {", ".join(f"({t}, {n}, '{p}')" for t, (n, p) in LABEL_IDS.items())}), b AS (SELECT ct::VARCHAR || ':' || cv node, prefix, kv, row_number() OVER (PARTITION BY ct, cv ORDER BY tier, kv, prefix) r FROM complete JOIN tiers USING (kt))
 SELECT node, CASE WHEN prefix = '' OR starts_with(kv, prefix) THEN kv ELSE prefix || kv END AS label FROM b WHERE r = 1""")
def n67(spark, d):
    rows = complete(spark, d).select(F.concat_ws(":", F.col("ct").cast("string"), "cv").alias("node"), "kt", "kv")
    return derive.identifier_label(rows, "node", "kt", "kv", LABEL_IDS)


@query("n66_chemical_labels", r"""WITH p AS (SELECT identifier_id, identifier_type_id t, unnest(string_split(value, '|')) s FROM identifier_evidence WHERE identifier_type_id IN (16, 28)), n AS (SELECT identifier_id, t, trim(regexp_replace(s, '\s*\(PTF[0-9]+\)\s*$', '')) s FROM p),
 f AS (SELECT * FROM n WHERE length(s) BETWEEN 2 AND 120 AND NOT regexp_matches(s, '^\d+$') AND NOT regexp_matches(s, '^[A-Z]{14}-[A-Z]{10}-[A-Z]$')),
 sp AS (SELECT identifier_id, lower(s) low, s, count(*) c, min(CASE t WHEN 16 THEN 1 ELSE 5 END) tier FROM f GROUP BY 1, 2, 3), fo AS (SELECT identifier_id, low, sum(c) total, min(tier) tier, arg_min(s, (-c, s)) AS label FROM sp GROUP BY 1, 2)
 SELECT identifier_id, label, tier FROM (SELECT *, row_number() OVER (PARTITION BY identifier_id ORDER BY tier, total DESC, length(label), label) r FROM fo) WHERE r = 1""")
def n66(spark, d):
    return derive.label_cascade(table(spark, d, "identifier_evidence"), "identifier_id", "identifier_type_id", "value", {NAME: 1, SYNONYM: 5})


# --- derived tables --------------------------------------------------------------------------------------------------


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows of relations with their endpoints, delivered twice counting once."""
    r = table(spark, sf_dir, "relation").select("relation_id", F.col("subject_entity_id").alias("subject_id"), "predicate_id", F.col("object_entity_id").alias("object_id"), F.col("relation_category_id").alias("category_id")).distinct()
    x = table(spark, sf_dir, "relation_evidence_relation").select("source_id", "relation_id", "relation_evidence_id").distinct()
    return x.join(r, "relation_id")


EDGES = "edges AS (SELECT x.source_id, x.relation_evidence_id, r.* FROM (SELECT DISTINCT source_id, relation_id, relation_evidence_id FROM relation_evidence_relation) x JOIN (SELECT DISTINCT relation_id, subject_entity_id subject_id, predicate_id, object_entity_id object_id, relation_category_id category_id FROM relation) r USING (relation_id))"
ENT = "ent AS (SELECT DISTINCT * FROM entity)"
LIST = "string_agg(DISTINCT lpad(source_id::VARCHAR, 6, '0'), ',' ORDER BY lpad(source_id::VARCHAR, 6, '0'))"


def nodes(spark, d):
    return table(spark, d, "entity").distinct()


@query("n34_relations", f"""WITH {EDGES} SELECT subject_id, predicate_id, object_id, min(category_id) category_id, {LIST} sources, count(*) n_evidence, {UUID.format("md5(subject_id || '|' || predicate_id::VARCHAR || '|' || object_id)")} relation_id FROM edges GROUP BY subject_id, predicate_id, object_id""")
def n34(spark, d):
    return resolve.relations(edges(spark, d))


@query("n35_relation_links", f"WITH {EDGES} SELECT DISTINCT source_id, relation_evidence_id, {UUID.format("md5(subject_id || '|' || predicate_id::VARCHAR || '|' || object_id)")} relation_id FROM edges")
def n35(spark, d):
    return edges(spark, d).select("source_id", "relation_evidence_id", content_uuid(relation_key(F.col("subject_id"), F.col("predicate_id"), F.col("object_id"))).alias("relation_id")).distinct()


@query("n50_identifier_lookup", f"WITH {COMPLETE} SELECT DISTINCT ct::VARCHAR || ':' || cv entity, kt::VARCHAR || ':' || kv identifier FROM complete")
def n50(spark, d):
    c = complete(spark, d).select(F.concat_ws(":", F.col("ct").cast("string"), "cv").alias("entity"), F.concat_ws(":", F.col("kt").cast("string"), "kv").alias("identifier"))
    return derive.distinct_pairs(c, "entity", "identifier")


@query("n51_relation_counts", "WITH e AS (SELECT DISTINCT relation_id, subject_entity_id i FROM relation UNION SELECT DISTINCT relation_id, object_entity_id FROM relation), n AS (SELECT i, count(*) n FROM e GROUP BY 1) SELECT entity_id, coalesce(n, 0) relation_count FROM (SELECT DISTINCT entity_id FROM entity) LEFT JOIN n ON i = entity_id")
def n51(spark, d):
    return derive.relation_counts(table(spark, d, "entity"), table(spark, d, "relation"))


@query("n52_source_count", f"SELECT entity_id, count(DISTINCT source_id) source_count, {LIST} sources FROM entity_evidence_resolution WHERE status_id <> 2 AND entity_id IS NOT NULL GROUP BY 1")
def n52(spark, d):
    return derive.source_counts(table(spark, d, "entity_evidence_resolution"))


@query("n54_overlap", "WITH m AS (SELECT DISTINCT source_id s, entity_id i FROM entity_evidence_resolution WHERE entity_id IS NOT NULL) SELECT a.s a, b.s b, count(*) overlap FROM m a JOIN m b ON a.i = b.i AND a.s < b.s GROUP BY 1, 2")
def n54(spark, d):
    return derive.pair_overlaps(table(spark, d, "entity_evidence_resolution"), "entity_id", "source_id")


def numbered(spark, d):
    return pick.dense_ids(table(spark, d, "entity").select("entity_id").distinct(), "entity_id")


NUMBERED = "numbered AS (SELECT entity_id, row_number() OVER (ORDER BY entity_id) dense_id FROM (SELECT DISTINCT entity_id FROM entity))"


@query("n55_dense_ids", f"WITH {NUMBERED} SELECT * FROM numbered")
def n55(spark, d):
    return numbered(spark, d)


@query("a13_bitmap_overlap", f"WITH {NUMBERED}, m AS (SELECT DISTINCT source_id s, dense_id i FROM entity_evidence_resolution JOIN numbered USING (entity_id)) SELECT a.s a, b.s b, count(*) overlap FROM m a JOIN m b ON a.i = b.i AND a.s < b.s GROUP BY 1, 2")
def a13(spark, d):
    rows = table(spark, d, "entity_evidence_resolution").join(numbered(spark, d), "entity_id").select("source_id", "dense_id")
    return derive.bitmap_overlaps(derive.bitmap_index(rows, ["source_id"], "dense_id"), "source_id")


@query("n56_term_bitmap", f"""WITH {NUMBERED}, t AS (SELECT annotation_key, upper(nullif(regexp_extract(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', 1), '')) accession FROM annotation)
 SELECT accession, count(DISTINCT dense_id) n FROM t JOIN entity_evidence_annotation USING (annotation_key) JOIN entity_evidence_resolution r USING (source_id, entity_evidence_id) JOIN numbered USING (entity_id) WHERE accession IS NOT NULL GROUP BY 1""")
def n56(spark, d):
    terms = table(spark, d, "annotation").select("annotation_key", accession_of(F.col("term")).alias("accession")).where("accession is not null").distinct()
    ev = table(spark, d, "entity_evidence_annotation").join(terms, "annotation_key").select("source_id", "entity_evidence_id", "accession").distinct()
    who = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", "entity_id").distinct().join(numbered(spark, d), "entity_id")
    return derive.bitmap_sizes(derive.bitmap_index(ev.join(who, ["source_id", "entity_evidence_id"]), ["accession"], "dense_id"), ["accession"])


@query("n57_entity_relation_bitmap", "WITH e AS (SELECT DISTINCT relation_id, subject_entity_id i FROM relation UNION SELECT DISTINCT relation_id, object_entity_id FROM relation) SELECT i entity_id, count(*) n FROM e GROUP BY 1")
def n57(spark, d):
    ids = pick.dense_ids(table(spark, d, "relation").select("relation_id", "subject_entity_id", "object_entity_id").distinct(), "relation_id")
    ends = ids.select("dense_id", F.explode(F.array("subject_entity_id", "object_entity_id")).alias("entity_id"))
    return derive.bitmap_sizes(derive.bitmap_index(ends, ["entity_id"], "dense_id"), ["entity_id"])


@query("n58_term_relation_bitmap", "SELECT predicate_id, relation_category_id, count(DISTINCT relation_id) n FROM relation GROUP BY 1, 2")
def n58(spark, d):
    ids = pick.dense_ids(table(spark, d, "relation").select("relation_id", "predicate_id", "relation_category_id").distinct(), "relation_id")
    return derive.bitmap_sizes(derive.bitmap_index(ids, ["predicate_id", "relation_category_id"], "dense_id"), ["predicate_id", "relation_category_id"])


@query("n59_search_counts", "WITH e AS (SELECT DISTINCT relation_id, subject_entity_id i FROM relation UNION SELECT DISTINCT relation_id, object_entity_id FROM relation), n AS (SELECT i, count(*) n FROM e GROUP BY 1), m AS (SELECT entity_id i, count(DISTINCT source_id::VARCHAR || entity_evidence_id) n FROM entity_evidence_resolution GROUP BY 1) SELECT entity_id, coalesce(n.n, 0) + coalesce(m.n, 0) search_count FROM (SELECT DISTINCT entity_id FROM entity) x LEFT JOIN n ON n.i = entity_id LEFT JOIN m ON m.i = entity_id")
def n59(spark, d):
    m = table(spark, d, "entity_evidence_resolution").select("entity_id", "source_id", "entity_evidence_id").distinct().groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return n51(spark, d).join(m, "entity_id", "left").select("entity_id", (F.col("relation_count") + F.coalesce("n", F.lit(0))).alias("search_count"))


@query("n61_relation_facets", f"WITH {ENT}, r AS (SELECT DISTINCT relation_id, predicate_id, relation_category_id, subject_entity_id, object_entity_id FROM relation), f AS (SELECT relation_id, 'predicate' facet, predicate_id::VARCHAR || ':' || coalesce(relation_category_id::VARCHAR, '') v FROM r UNION SELECT relation_id, 'source', source_id::VARCHAR FROM relation_evidence_relation WHERE relation_id IS NOT NULL UNION SELECT relation_id, 'participant_type', entity_type_id::VARCHAR FROM r JOIN ent ON entity_id IN (subject_entity_id, object_entity_id) UNION SELECT relation_id, 'taxonomy_id', taxonomy_id::VARCHAR FROM r JOIN ent ON entity_id IN (subject_entity_id, object_entity_id)) SELECT facet, v AS value, count(*) n FROM f WHERE v IS NOT NULL GROUP BY 1, 2")
def n61(spark, d):
    r = table(spark, d, "relation").select("relation_id", "predicate_id", "relation_category_id", "subject_entity_id", "object_entity_id").distinct()
    own = derive.facets(r.withColumn("p", F.concat(F.col("predicate_id").cast("string"), F.lit(":"), F.coalesce(F.col("relation_category_id").cast("string"), F.lit("")))), "relation_id", {"predicate": "p"})
    src = derive.facets(table(spark, d, "relation_evidence_relation").where("relation_id is not null"), "relation_id", {"source": "source_id"})
    part = r.select("relation_id", F.explode(F.array("subject_entity_id", "object_entity_id")).alias("entity_id")).distinct().join(nodes(spark, d).select("entity_id", "entity_type_id", "taxonomy_id"), "entity_id")
    return own.unionByName(src).unionByName(derive.facets(part, "relation_id", {"participant_type": "entity_type_id", "taxonomy_id": "taxonomy_id"}))


@query("n53_ontology_terms", """WITH t AS (SELECT upper(nullif(regexp_extract(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', 1), '')) accession, trim(regexp_replace(regexp_replace(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', ''), '^[ :]+|[ :]+$', '', 'g')) name FROM annotation),
 n AS (SELECT accession, name, count(*) c FROM t WHERE accession IS NOT NULL GROUP BY 1, 2), l AS (SELECT accession, name, row_number() OVER (PARTITION BY accession ORDER BY c DESC, length(name), name) r FROM n WHERE name <> '')
 SELECT n.accession, any_value(l.name) AS label, sum(c)::BIGINT n_rows, count(*) FILTER (n.name <> '') n_spellings, string_agg(DISTINCT n.name, '|' ORDER BY n.name) FILTER (n.name <> '') spellings FROM n LEFT JOIN l ON l.accession = n.accession AND l.r = 1 GROUP BY 1""")
def n53(spark, d):
    acc = accession_of(F.col("term"))
    name = F.trim(F.regexp_replace(F.regexp_replace("term", r"([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])", ""), r"^[ :]+|[ :]+$", ""))
    return derive.term_table(table(spark, d, "annotation").select(acc.alias("accession"), name.alias("name")))


CLASS_RULES = [(i, c, p) for i in range(1, 41) for c, p in [(("drug", "food", "metabolite", "lipid")[i % 4], (1, 3, 4, 2)[i % 4])]]


@query("n62_class", f"WITH rules(source_id, class, precedence) AS (VALUES {', '.join(f'({i}, {chr(39)}{c}{chr(39)}, {p})' for i, c, p in CLASS_RULES)}), m AS (SELECT DISTINCT entity_id, source_id FROM entity_evidence_resolution WHERE entity_id IS NOT NULL), h AS (SELECT entity_id, arg_min(class, precedence) class FROM m JOIN rules USING (source_id) GROUP BY 1) SELECT entity_id, coalesce(class, 'metabolite') AS class FROM (SELECT DISTINCT entity_id FROM m) LEFT JOIN h USING (entity_id)")
def n62(spark, d):
    rules = spark.createDataFrame(CLASS_RULES, "source_id long, class string, precedence int")
    return derive.most_specific_class(table(spark, d, "entity_evidence_resolution").where("entity_id is not null"), rules, "entity_id", "source_id", "metabolite")


@query("n60_entity_facets", f"""WITH {ENT}, cl AS ({ORACLES['n62_class']}), f AS (SELECT DISTINCT entity_id, unnest([{{'f': 'entity_type', 'v': entity_type_id::VARCHAR}}, {{'f': 'taxonomy_id', 'v': taxonomy_id::VARCHAR}}, {{'f': 'identifier_type', 'v': canonical_identifier_type_id::VARCHAR}}, {{'f': 'status', 'v': resolution_status_id::VARCHAR}}, {{'f': 'ontology_id', 'v': CASE WHEN canonical_identifier_type_id = 8 AND starts_with(trim(canonical_identifier), 'CHEBI:') THEN trim(canonical_identifier) END}}]) x FROM ent
  UNION SELECT DISTINCT entity_id, {{'f': 'source', 'v': source_id::VARCHAR}} FROM entity_evidence_resolution WHERE entity_id IS NOT NULL UNION SELECT cl.entity_id, {{'f': 'chemical_class', 'v': class}} FROM cl WHERE entity_id IN (SELECT entity_id FROM ent WHERE entity_type_id IN (1, 3)))
 SELECT x.f facet, x.v AS value, count(*) n FROM f WHERE x.v IS NOT NULL GROUP BY 1, 2""")
def n60(spark, d):
    e = table(spark, d, "entity").withColumn("onto", F.when((F.col("canonical_identifier_type_id") == CHEBI) & F.startswith(F.trim("canonical_identifier"), F.lit("CHEBI:")), F.trim("canonical_identifier")))
    own = derive.facets(e, "entity_id", {"entity_type": "entity_type_id", "taxonomy_id": "taxonomy_id", "identifier_type": "canonical_identifier_type_id", "status": "resolution_status_id", "ontology_id": "onto"})
    src = derive.facets(table(spark, d, "entity_evidence_resolution").where("entity_id is not null"), "entity_id", {"source": "source_id"})
    chemicals_ = e.where("entity_type_id in (1, 3)").select("entity_id").distinct()
    return own.unionByName(src).unionByName(derive.facets(n62(spark, d).join(chemicals_, "entity_id", "left_semi"), "entity_id", {"chemical_class": "class"}))


KEYWORDS = {"blood": ["plasma", "marrow", "spleen"], "membrane": ["membrane", "junction", "reticulum"], "organ": ["liver", "kidney", "lung", "pancreas", "retina"]}
_KW = " ".join(f"WHEN {' OR '.join(f'contains(lower(value), {chr(39)}{w}{chr(39)})' for w in ws)} THEN {i}" for i, ws in enumerate(KEYWORDS.values()))


@query("n63_domain", f"WITH x AS (SELECT annotation_key, CASE WHEN term LIKE '%OM:0764%' THEN 1 WHEN term LIKE '%OM:0604%' THEN 2 ELSE 3 END p, CASE {_KW} END c FROM annotation), b AS (SELECT annotation_key, arg_min(c, p * 10 + c) FILTER (c IS NOT NULL) c FROM x GROUP BY 1) SELECT annotation_key, coalesce(['blood', 'membrane', 'organ'][c + 1], 'other') AS class FROM b")
def n63(spark, d):
    p = F.when(F.col("term").contains("OM:0764"), 1).when(F.col("term").contains("OM:0604"), 2).otherwise(3)
    return derive.keyword_class(table(spark, d, "annotation").withColumn("p", p), "annotation_key", "value", "p", KEYWORDS, "other")


PREDICATES = {1: "Signaling", 3: "Transport", 4: "Signaling", 6: "Maturation"}


@query("n64_interaction_class", "SELECT predicate_id, CASE predicate_id WHEN 1 THEN 'Signaling' WHEN 3 THEN 'Transport' WHEN 4 THEN 'Signaling' WHEN 6 THEN 'Maturation' ELSE 'Other' END AS class FROM (SELECT DISTINCT predicate_id FROM relation)")
def n64(spark, d):
    rules = spark.createDataFrame([(p, c, 1) for p, c in PREDICATES.items()], "predicate_id long, class string, precedence int")
    return derive.most_specific_class(table(spark, d, "relation"), rules, "predicate_id", "predicate_id", "Other")


@query("n65_labels", "SELECT k canonical, l AS label FROM (SELECT k, l, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, length(l), l) r FROM (SELECT coalesce(canonical_identifier_type_id::VARCHAR, '') || ':' || trim(canonical_identifier) k, trim(label) l FROM entity WHERE canonical_identifier IS NOT NULL AND trim(label) <> '') GROUP BY k, l) WHERE r = 1")
def n65(spark, d):
    rows = table(spark, d, "entity").where("canonical_identifier is not null").select(F.concat(F.coalesce(F.col("canonical_identifier_type_id").cast("string"), F.lit("")), F.lit(":"), F.trim("canonical_identifier")).alias("canonical"), "label")
    return derive.attested_label(rows, "canonical", "label")


@query("n72_gene_output", "SELECT DISTINCT entity_id, taxonomy_id, trim(canonical_identifier) entrez, label FROM entity WHERE entity_type_id = 2 AND canonical_identifier_type_id = 3")
def n72(spark, d):
    return table(spark, d, "entity").where("entity_type_id = 2 and canonical_identifier_type_id = 3").select("entity_id", "taxonomy_id", F.trim("canonical_identifier").alias("entrez"), "label").distinct()


@query("n73_resources", "WITH e AS (SELECT source_id, count(DISTINCT entity_id) a, count(DISTINCT entity_evidence_id) b FROM entity_evidence_resolution GROUP BY 1), r AS (SELECT source_id, count(DISTINCT relation_id) c FROM relation_evidence_relation GROUP BY 1) SELECT s.source_id, name, coalesce(a, 0) n_entities, coalesce(b, 0) n_mentions, coalesce(c, 0) n_relations, CASE WHEN coalesce(b, 0) + coalesce(c, 0) > 0 THEN 'built' ELSE 'not built' END AS status FROM data_source s LEFT JOIN e ON e.source_id = s.source_id LEFT JOIN r ON r.source_id = s.source_id")
def n73(spark, d):
    return derive.resource_table(table(spark, d, "data_source"), table(spark, d, "entity_evidence_resolution"), table(spark, d, "relation_evidence_relation"))


@query("n74_manifest", f"WITH r AS ({ORACLES['n73_resources']}) SELECT substr(sha256(string_agg(line, chr(10) ORDER BY line)), 1, 12) build_id, count(*) n_sources, count(*) FILTER (status = 'built') n_built, count(*) FILTER (status = 'built') < count(*) partial FROM (SELECT *, concat_ws('|', n_entities, n_mentions, n_relations, coalesce(name, ''), source_id, status) line FROM r)")
def n74(spark, d):
    return derive.build_manifest(n73(spark, d))


# --- members, states, caches, dimensions -----------------------------------------------------------------------------


@query("n22_member_signature", """WITH m AS (SELECT DISTINCT object_entity_id parent_id, e.entity_type_id, e.taxonomy_id, e.entity_id canonical_id, e.resolution_status_id s FROM relation r JOIN (SELECT DISTINCT * FROM entity) e ON e.entity_id = r.subject_entity_id WHERE r.predicate_id = 5)
 SELECT parent_id, sha256('[' || string_agg('{"entity_type":"' || entity_type_id::VARCHAR || '","taxonomy_id":' || coalesce('"' || taxonomy_id::VARCHAR || '"', 'null') || ',"canonical_id":"' || canonical_id || '"}', ',' ORDER BY entity_type_id::VARCHAR, taxonomy_id IS NULL, taxonomy_id::VARCHAR, canonical_id) || ']') signature, count(*)::INT n_members, bool_and(s = 1) resolved FROM m WHERE entity_type_id IS NOT NULL GROUP BY 1""")
def n22(spark, d):
    e = nodes(spark, d).select(F.col("entity_id").alias("canonical_id"), F.col("entity_type_id").alias("entity_type"), "taxonomy_id", F.col("resolution_status_id").alias("status")).where("entity_type is not null")
    r = table(spark, d, "relation").where("predicate_id = 5").select(F.col("object_entity_id").alias("parent_id"), F.col("subject_entity_id").alias("canonical_id")).distinct()
    return resolve.member_signature(r.join(e, "canonical_id"))


@query("n32_states", rf"WITH x AS (SELECT DISTINCT regexp_replace(value, '-\d+$', '') accession, nullif(regexp_extract(value, '-(\d+)$', 1), '') isoform FROM identifier_evidence WHERE identifier_type_id = 1 AND value <> '') SELECT {UUID.format('md5(' + chr(39) + 'state' + chr(39) + ' || chr(31) || ' + chr(39) + '2' + chr(39) + ' || chr(31) || accession || chr(31) || coalesce(isoform, ' + chr(39) * 2 + '))')} state_id, accession, isoform FROM x")
def n32(spark, d):
    return resolve.molecular_states(table(spark, d, "identifier_evidence").select(F.col("identifier_type_id").alias("key_type"), F.col("value").alias("key_value")), UNIPROT)


@query("n27_new_entities", "SELECT DISTINCT entity_type_id, taxonomy_id, canonical_identifier FROM entity WHERE created_at >= TIMESTAMPTZ '2024-01-01 00:00:00+00' EXCEPT SELECT entity_type_id, taxonomy_id, canonical_identifier FROM entity WHERE created_at < TIMESTAMPTZ '2024-01-01 00:00:00+00'")
def n27(spark, d):
    e, keys = table(spark, d, "entity"), ["entity_type_id", "taxonomy_id", "canonical_identifier"]
    cut = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return pick.new_keys(e.where(F.col("created_at") >= cut).select(*keys).distinct(), e.where(F.col("created_at") < cut), keys)


@query("n36_cache_merge", "SELECT relation_id, min(linked_at) AS first_seen, max(linked_at) AS last_seen, string_agg(DISTINCT lpad(source_id::VARCHAR, 6, '0'), ',' ORDER BY lpad(source_id::VARCHAR, 6, '0')) sources FROM relation_evidence_relation GROUP BY 1")
def n36(spark, d):
    x = table(spark, d, "relation_evidence_relation").select("relation_id", F.col("linked_at").alias("first_seen"), F.col("linked_at").alias("last_seen"), F.array(F.lpad(F.col("source_id").cast("string"), 6, "0")).alias("sources"))
    cut = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = pick.merge_cache(x.where(F.col("last_seen") < cut), x.where(F.col("last_seen") >= cut), ["relation_id"], "first_seen", "last_seen", ["sources"])
    return out.withColumn("sources", F.array_join("sources", ","))


@query("n37_dimension_upsert", "WITH k AS (SELECT resolution_mechanism, trust_rank FROM vocab_resolution_mechanism), f AS (SELECT DISTINCT resolution_mechanism FROM entity_evidence_resolution WHERE resolution_mechanism IS NOT NULL AND resolution_mechanism NOT IN (SELECT resolution_mechanism FROM k)) SELECT resolution_mechanism, (SELECT max(trust_rank) FROM k) + row_number() OVER (ORDER BY resolution_mechanism) trust_rank FROM f")
def n37(spark, d):
    return pick.missing_names(table(spark, d, "entity_evidence_resolution"), table(spark, d, "vocab_resolution_mechanism"), "resolution_mechanism", "trust_rank")


@query("n38_encoded_evidence", "SELECT e.source_id, entity_evidence_id, v.trust_rank resolution_mechanism FROM entity_evidence_resolution e LEFT JOIN vocab_resolution_mechanism v USING (resolution_mechanism)")
def n38(spark, d):
    rows = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", "resolution_mechanism")
    return store.encode(rows, {"resolution_mechanism": table(spark, d, "vocab_resolution_mechanism").select("resolution_mechanism", "trust_rank")})


def graph(spark, d):
    return {"resolution": table(spark, d, "entity_evidence_resolution"), "links": table(spark, d, "relation_evidence_relation"), "evidence": table(spark, d, "relation_evidence"), "relation": table(spark, d, "relation").distinct(), "entity": nodes(spark, d), "annotation_links": table(spark, d, "entity_evidence_annotation"), "annotation": table(spark, d, "annotation").distinct()}


LEFT = "res AS (SELECT * FROM entity_evidence_resolution WHERE source_id <> 3), lnk AS (SELECT * FROM relation_evidence_relation WHERE source_id <> 3), orphaned AS (SELECT DISTINCT relation_id FROM relation_evidence_relation WHERE source_id = 3 AND relation_id IS NOT NULL EXCEPT SELECT relation_id FROM lnk), rel AS (SELECT DISTINCT * FROM relation WHERE relation_id NOT IN (SELECT relation_id FROM orphaned))"


@query("m3_source_delete_relations", f"WITH {LEFT} SELECT relation_id, subject_entity_id, object_entity_id FROM rel")
def m3r(spark, d):
    return store.delete_source(graph(spark, d), 3)["relation"].select("relation_id", "subject_entity_id", "object_entity_id")


@query("m3_source_delete_entities", f"WITH {LEFT}, lost AS (SELECT DISTINCT entity_id FROM entity_evidence_resolution WHERE source_id = 3 AND entity_id IS NOT NULL EXCEPT (SELECT entity_id FROM res UNION SELECT subject_entity_id FROM rel UNION SELECT object_entity_id FROM rel)) SELECT DISTINCT entity_id, entity_type_id FROM entity WHERE entity_id NOT IN (SELECT entity_id FROM lost)")
def m3e(spark, d):
    return store.delete_source(graph(spark, d), 3)["entity"].select("entity_id", "entity_type_id")


@query("m3_source_delete_annotations", "WITH gone AS (SELECT DISTINCT annotation_key FROM entity_evidence_annotation WHERE source_id = 3 AND annotation_key IS NOT NULL EXCEPT SELECT annotation_key FROM entity_evidence_annotation WHERE source_id <> 3) SELECT DISTINCT annotation_key, term, value, unit FROM annotation WHERE annotation_key NOT IN (SELECT annotation_key FROM gone)")
def m3a(spark, d):
    return store.delete_source(graph(spark, d), 3)["annotation"].select("annotation_key", "term", "value", "unit")


@query("m8_upsert", "SELECT DISTINCT source_a_id, source_b_id, content_kind, CASE WHEN source_a_id = 1 THEN -1 ELSE overlap END AS overlap FROM resource_overlap_summary WHERE source_a_id <> 1 UNION SELECT DISTINCT source_a_id, source_b_id, content_kind, -1 FROM resource_overlap_summary WHERE source_a_id = 1")
def m8(spark, d):
    s, k = table(spark, d, "resource_overlap_summary").distinct(), ["source_a_id", "source_b_id", "content_kind"]
    return store.upsert(s, s.where("source_a_id = 1").select(*k).distinct().withColumn("overlap", F.lit(-1).cast("bigint")), k)


# --- network views ---------------------------------------------------------------------------------------------------

def _transport(name, mid, controls, part):
    sql = f"WITH {EDGES}, {ENT}, c AS (SELECT DISTINCT subject_id protein_id, object_id step FROM edges WHERE predicate_id = {controls}), p AS (SELECT DISTINCT subject_id step, object_id compound_id FROM edges WHERE predicate_id = {part}) SELECT '{name}' network, protein_id, compound_id, count(DISTINCT c.step) n_transports FROM c JOIN p ON p.step = c.step WHERE c.step IN (SELECT entity_id FROM ent WHERE entity_type_id = {mid}) GROUP BY 2, 3"
    query(name + "_view", sql)(lambda spark, d: networks.transport_view(edges(spark, d), nodes(spark, d), name, mid, controls, part))


for _t in (("n83_recon3d", 2, 1, 2), ("n84_rhea", 3, 3, 4), ("n85_humangem", 1, 5, 6)):
    _transport(*_t)

@query("n75_pairs_view", f"WITH {EDGES}, {ENT}, s AS (SELECT DISTINCT entity_id, CASE entity_type_id WHEN 1 THEN 'ligand' ELSE 'receptor' END side FROM ent WHERE entity_type_id IN (1, 2)), e AS (SELECT DISTINCT source_id, relation_evidence_id, subject_id, object_id FROM edges), p AS (SELECT DISTINCT source_id, relation_evidence_id, a.entity_id ligand_id, b.entity_id receptor_id FROM e JOIN s a ON a.entity_id IN (subject_id, object_id) AND a.side = 'ligand' JOIN s b ON b.entity_id IN (subject_id, object_id) AND b.side = 'receptor') SELECT ligand_id, receptor_id, count(*) n_evidence, count(DISTINCT source_id) n_sources, {LIST} sources FROM p GROUP BY 1, 2")
def n75(spark, d):
    sides = nodes(spark, d).where("entity_type_id in (1, 2)").select("entity_id", F.when(F.col("entity_type_id") == 1, "ligand").otherwise("receptor").alias("side")).distinct()
    return networks.pair_view(edges(spark, d).select("source_id", "relation_evidence_id", "subject_id", "object_id").distinct(), sides)


KINDS = {"inchikey": 13, "chebi": 8, "pubchem": 12}


@query("n90_compound_annotation", f"WITH {COMPLETE}, n AS (SELECT DISTINCT ct::VARCHAR || ':' || cv entity_id, cv AS label FROM complete) SELECT n.entity_id, label, " + ", ".join(f"string_agg(DISTINCT kv, '|' ORDER BY kv) FILTER (kt = {t}) {k}" for k, t in KINDS.items()) + " FROM n JOIN complete c ON n.entity_id = c.ct::VARCHAR || ':' || c.cv GROUP BY 1, 2")
def n90(spark, d):
    c = complete(spark, d).withColumn("entity_id", F.concat_ws(":", F.col("ct").cast("string"), "cv"))
    return networks.entity_annotations(c.withColumn("label", F.col("cv")), c.select("entity_id", F.col("kt").alias("key_type"), F.col("kv").alias("key_value")), KINDS)


@query("n01_projection")
def n01(spark, d):
    """Nested records made from the evidence rows, flattened again."""
    def member(side):
        return F.struct(F.struct(F.lit("Chemical").alias("type"), F.array(F.struct(F.lit("Entity").alias("type"), F.col(side).alias("value"))).alias("identifiers")).alias("member"))

    r = table(spark, d, "relation_evidence").where("coalesce(subject_entity_id, subject_entity_evidence_id) is not null and coalesce(object_entity_id, object_entity_evidence_id) is not null")
    r = r.withColumn("s", F.coalesce("subject_entity_id", "subject_entity_evidence_id")).withColumn("o", F.coalesce("object_entity_id", "object_entity_evidence_id"))
    rec = F.to_json(F.struct(F.lit("Interaction").alias("type"), F.array(F.struct(F.lit("Control Type").alias("term"), F.when(F.col("predicate_id") % 2 == 0, "activation").otherwise("inhibition").alias("value"))).alias("annotations"), F.array(member("s"), member("o")).alias("membership")))
    return project.project(r.select(F.col("source_id").cast("string").alias("source"), F.col("dataset_id").cast("string").alias("dataset"), "row_id", rec.alias("record")))

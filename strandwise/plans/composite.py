"""Further composite transforms of the graph build, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions.ids import content_uuid, unit_joined
from strandwise.operators import chemicals, pick, resolve, store
from strandwise.operators.skew import small
from strandwise.plans import reference as ref
from strandwise.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return keep


@query("n08_identifier_types", "WITH k AS (SELECT identifier_type_id, name FROM vocab_identifier_type), u AS (SELECT DISTINCT attribute_name AS name FROM annotation_term_type WHERE attribute_name NOT IN (SELECT name FROM k)) SELECT identifier_type_id, name FROM k UNION ALL SELECT (SELECT max(identifier_type_id) FROM k) + row_number() OVER (ORDER BY name), name FROM u")
def n08(spark, d):
    k = table(spark, d, "vocab_identifier_type").select("identifier_type_id", "name")
    fresh = pick.missing_names(table(spark, d, "annotation_term_type").select(F.col("attribute_name").alias("name")), k, "name", "identifier_type_id")
    return k.unionByName(fresh.select("identifier_type_id", "name"))


@query("n09_resolver_lookup", f"WITH {ref.LOOKUP} SELECT * FROM lookup")
def n09(spark, d):
    return ref.lookup(spark, d)


@query("n10_canonical_entities", f"WITH {ref.COMPLETE} SELECT ct, cv, string_agg(DISTINCT lpad(kt::VARCHAR, 3, '0'), ',' ORDER BY lpad(kt::VARCHAR, 3, '0')) key_types, count(*) n_keys FROM complete GROUP BY 1, 2")
def n10(spark, d):
    from strandwise.functions.ids import sorted_text

    return ref.complete(spark, d).groupBy("ct", "cv").agg(sorted_text(F.lpad(F.col("kt").cast("string"), 3, "0"), ",").alias("key_types"), F.count(F.lit(1)).alias("n_keys"))


SIG = """m AS (SELECT DISTINCT r.object_entity_id parent_id, e.entity_type_id, e.taxonomy_id, e.entity_id canonical_id, e.resolution_status_id s, CASE r.predicate_id WHEN 5 THEN 'reactant' ELSE 'product' END side FROM relation r JOIN (SELECT DISTINCT * FROM entity) e ON e.entity_id = r.subject_entity_id WHERE r.predicate_id IN (5, 6) AND e.entity_type_id IS NOT NULL)"""


@query("n23_reaction_signature", f"""WITH {SIG}, ok AS (SELECT parent_id FROM m GROUP BY 1 HAVING bool_or(side = 'reactant') AND bool_or(side = 'product')), u AS (SELECT DISTINCT parent_id, entity_type_id, taxonomy_id, canonical_id, s FROM m SEMI JOIN ok USING (parent_id))
 SELECT parent_id, sha256('[' || string_agg('{{"entity_type":"' || entity_type_id::VARCHAR || '","taxonomy_id":' || coalesce('"' || taxonomy_id::VARCHAR || '"', 'null') || ',"canonical_id":"' || canonical_id || '"}}', ',' ORDER BY entity_type_id::VARCHAR, taxonomy_id IS NULL, taxonomy_id::VARCHAR, canonical_id) || ']') signature, count(*)::INT n_members, bool_and(s = 1) resolved FROM u GROUP BY 1""")
def n23(spark, d):
    e = ref.nodes(spark, d).select(F.col("entity_id").alias("canonical_id"), F.col("entity_type_id").alias("entity_type"), "taxonomy_id", F.col("resolution_status_id").alias("status")).where("entity_type is not null")
    r = table(spark, d, "relation").where("predicate_id in (5, 6)").select(F.col("object_entity_id").alias("parent_id"), F.col("subject_entity_id").alias("canonical_id"), "predicate_id").distinct()
    m = r.join(e, "canonical_id")
    both = m.groupBy("parent_id").agg(F.bool_or(F.col("predicate_id") == 5).alias("a"), F.bool_or(F.col("predicate_id") == 6).alias("b")).where("a and b").select("parent_id")
    return resolve.member_signature(m.join(both, "parent_id", "left_semi").drop("predicate_id"))


# The members of complexes (n22) and reactions (n23), each parent with its signature.
_MEMBER = """'{"entity_type":"' || entity_type_id::VARCHAR || '","taxonomy_id":' || coalesce('"' || taxonomy_id::VARCHAR || '"', 'null') || ',"canonical_id":"' || canonical_id || '"}'"""
_SIGNED = f"SELECT parent_id, sha256('[' || string_agg({_MEMBER}, ',' ORDER BY entity_type_id::VARCHAR, taxonomy_id IS NULL, taxonomy_id::VARCHAR, canonical_id) || ']') signature, bool_and(s = 1) resolved FROM"


@query("n24_layered_resolution", f"""WITH {ref.RESOLUTION}, {SIG}, cm AS (SELECT DISTINCT parent_id, entity_type_id, taxonomy_id, canonical_id, s FROM m WHERE side = 'reactant'), cs AS ({_SIGNED} cm GROUP BY 1),
 rm AS (SELECT DISTINCT parent_id, entity_type_id, taxonomy_id, canonical_id, s FROM m SEMI JOIN (SELECT parent_id FROM m GROUP BY 1 HAVING bool_or(side = 'reactant') AND bool_or(side = 'product')) USING (parent_id)), rs AS ({_SIGNED} rm GROUP BY 1)
 SELECT r.evidence_id, coalesce(rs.signature, cs.signature, r.canonical_id) canonical_id, CASE WHEN coalesce(rs.resolved, cs.resolved, status = 1) THEN 1 ELSE 2 END status, CASE WHEN rs.signature IS NOT NULL THEN 'reaction' WHEN cs.signature IS NOT NULL THEN 'complex' ELSE mechanism END mechanism
 FROM resolution r LEFT JOIN rs ON rs.parent_id = r.evidence_id LEFT JOIN cs ON cs.parent_id = r.evidence_id""")
def n24_layered(spark, d):
    """Reaction over complex over base. Genes are mentioned under their entity's id, which the signatures have as parent_id."""
    return resolve.layered_resolution(ref.n21(spark, d), ref.n22(spark, d), n23(spark, d))


@query("n22_nested_signature", f"""WITH {SIG}, one AS (SELECT DISTINCT parent_id, entity_type_id, taxonomy_id, canonical_id, s FROM m WHERE side = 'reactant'), inn AS ({_SIGNED} one GROUP BY 1),
 two AS (SELECT DISTINCT one.parent_id, entity_type_id, taxonomy_id, coalesce(inn.signature, canonical_id) canonical_id, CASE WHEN inn.resolved IS NULL THEN s WHEN inn.resolved THEN 1 ELSE 2 END s FROM one LEFT JOIN inn ON inn.parent_id = canonical_id)
 SELECT parent_id, sha256('[' || string_agg({_MEMBER}, ',' ORDER BY entity_type_id::VARCHAR, taxonomy_id IS NULL, taxonomy_id::VARCHAR, canonical_id) || ']') signature, count(*)::INT n_members, bool_and(s = 1) resolved FROM (SELECT parent_id, entity_type_id, taxonomy_id, canonical_id, bool_and(s = 1)::INT s FROM two GROUP BY 1, 2, 3, 4) GROUP BY 1""")
def n22_nested(spark, d):
    """Complexes whose members may be complexes."""
    e = ref.nodes(spark, d).select(F.col("entity_id").alias("canonical_id"), F.col("entity_type_id").alias("entity_type"), "taxonomy_id", F.col("resolution_status_id").alias("status")).where("entity_type is not null")
    r = table(spark, d, "relation").where("predicate_id = 5").select(F.col("object_entity_id").alias("parent_id"), F.col("subject_entity_id").alias("canonical_id")).distinct()
    return resolve.nested_signature(r.join(e, "canonical_id"))


@query("n25_ontology_terms_resolved", "WITH t AS (SELECT DISTINCT trim(canonical_identifier) id FROM entity WHERE canonical_identifier LIKE 'CHEBI:%'), l AS (SELECT trim(key_value) k, min(trim(canonical_identifier)) c, count(DISTINCT trim(canonical_identifier)) n FROM chemical_identifier_lookup WHERE trim(canonical_identifier) <> '' GROUP BY 1) SELECT id term_id, CASE WHEN n = 1 THEN c ELSE id END canonical_id, coalesce(n, 0) = 1 by_lookup FROM t LEFT JOIN l ON k = id")
def n25(spark, d):
    t = table(spark, d, "entity").where(F.col("canonical_identifier").like("CHEBI:%")).select(F.trim("canonical_identifier").alias("term_id")).distinct()
    l = table(spark, d, "chemical_identifier_lookup").select(F.trim("key_value").alias("term_id"), F.trim("canonical_identifier").alias("c")).where("c <> ''")
    one = l.distinct().groupBy("term_id").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).where("n = 1")
    return t.join(one, "term_id", "left").select("term_id", F.coalesce("c", "term_id").alias("canonical_id"), F.col("c").isNotNull().alias("by_lookup"))


@query("n28_gene_representative", "WITH g AS (SELECT DISTINCT entity_id, taxonomy_id, label FROM entity WHERE entity_type_id = 2 AND label IS NOT NULL), r AS (SELECT taxonomy_id, label, min(trim(canonical_identifier)) representative, count(DISTINCT trim(canonical_identifier)) n_all FROM entity WHERE entity_type_id = 2 AND trim(canonical_identifier) <> '' GROUP BY 1, 2) SELECT entity_id, representative, n_all FROM g LEFT JOIN r ON g.taxonomy_id IS NOT DISTINCT FROM r.taxonomy_id AND g.label = r.label")
def n28(spark, d):
    e = table(spark, d, "entity").where("entity_type_id = 2")
    g = e.where("label is not null").select("entity_id", "taxonomy_id", "label").distinct()
    r = e.where("trim(canonical_identifier) <> ''").select(F.col("taxonomy_id").alias("t"), F.col("label").alias("l"), F.trim("canonical_identifier").alias("c")).distinct().groupBy("t", "l").agg(F.min("c").alias("representative"), F.count(F.lit(1)).alias("n_all"))
    return g.join(r, g.taxonomy_id.eqNullSafe(r.t) & (g.label == r.l), "left").select("entity_id", "representative", "n_all")


@query("n30_ontology_relations", f"WITH {ref.EDGES}, {ref.ENT} SELECT DISTINCT s.canonical_identifier subject_term, predicate_id, o.canonical_identifier object_term FROM edges JOIN ent s ON s.entity_id = subject_id JOIN ent o ON o.entity_id = object_id WHERE s.canonical_identifier_type_id = 8 AND o.canonical_identifier_type_id = 8 AND s.canonical_identifier IS NOT NULL AND o.canonical_identifier IS NOT NULL")
def n30(spark, d):
    terms = ref.nodes(spark, d).where("canonical_identifier_type_id = 8 and canonical_identifier is not null").select("entity_id", "canonical_identifier")
    s, o = terms.toDF("subject_id", "subject_term"), terms.toDF("object_id", "object_term")
    return ref.edges(spark, d).select("subject_id", "predicate_id", "object_id").distinct().join(s, "subject_id").join(o, "object_id").select("subject_term", "predicate_id", "object_term").distinct()


@query("n31_evidence_molecules", f"WITH {ref.ENT} SELECT DISTINCT r.source_id, r.entity_evidence_id, r.entity_id, CASE entity_type_id WHEN 2 THEN 1 WHEN 4 THEN 2 END molecular_type FROM entity_evidence_resolution r JOIN ent USING (entity_id)")
def n31(spark, d):
    e = ref.nodes(spark, d).select("entity_id", "entity_type_id")
    r = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", "entity_id").distinct().join(e, "entity_id")
    return r.select("source_id", "entity_evidence_id", "entity_id", F.when(F.col("entity_type_id") == 2, 1).when(F.col("entity_type_id") == 4, 2).alias("molecular_type")).distinct()


@query("n33_relation_candidates", "WITH r AS (SELECT DISTINCT source_id, lower(trim(subject_entity_id, ' {}')) s, predicate_id, lower(trim(object_entity_id, ' {}')) o, relation_category_id c FROM relation_evidence) SELECT source_id, s subject_id, predicate_id, o object_id, 'member' origin FROM r WHERE s IS NOT NULL AND o IS NOT NULL AND c <> 4 UNION SELECT source_id, o, predicate_id, s, 'annotation' FROM r WHERE s IS NOT NULL AND o IS NOT NULL AND c = 4")
def n33(spark, d):
    bare = lambda c: F.lower(F.regexp_replace(c, r"^[ {}]+|[ {}]+$", ""))
    r = table(spark, d, "relation_evidence").select("source_id", bare("subject_entity_id").alias("s"), "predicate_id", bare("object_entity_id").alias("o"), F.col("relation_category_id").alias("c")).where("s is not null and o is not null")
    swap = F.col("c") == 4
    return r.where("c is not null").select("source_id", F.when(swap, F.col("o")).otherwise(F.col("s")).alias("subject_id"), "predicate_id", F.when(swap, F.col("s")).otherwise(F.col("o")).alias("object_id"), F.when(swap, "annotation").otherwise("member").alias("origin")).distinct()


@query("n39_canonical_identifiers", f"WITH {ref.COMPLETE}, i AS (SELECT kt t, kv v FROM complete UNION SELECT ct, cv FROM complete) SELECT {ref.UUID.format(chr(109) + 'd5(' + chr(39) + 'identifier' + chr(39) + ' || chr(31) || t::VARCHAR || chr(31) || v)')} identifier_id, t, v FROM i")
def n39(spark, d):
    c = ref.complete(spark, d)
    i = c.select(F.col("kt").alias("t"), F.col("kv").alias("v")).unionByName(c.select(F.col("ct").alias("t"), F.col("cv").alias("v"))).distinct()
    return i.select(content_uuid(unit_joined(F.lit("identifier"), F.col("t"), F.col("v"))).alias("identifier_id"), "t", "v")


# From mem (row_id, t, v) and hits (t, v, ik): clusters (key_type, key_value, canonical_type, canonical_id).
CLUSTERS = """e AS (SELECT DISTINCT t::VARCHAR || ':' || v a, 'row ' || row_id b FROM mem), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
 r(node, root, step) AS (SELECT a, least(a, min(b)), 1 FROM s GROUP BY a UNION ALL SELECT node, root, step + 1 FROM (SELECT s.a node, least(any_value(me.root), min(x.root)) root, any_value(x.step) step FROM s JOIN r x ON x.node = s.b JOIN r me ON me.node = s.a GROUP BY s.a) WHERE step < 400),
 roots AS (SELECT node, min(root) root FROM r GROUP BY 1), nd AS (SELECT DISTINCT root, t, v, try_cast(regexp_replace(v, '^[A-Za-z]+:', '') AS HUGEINT) num FROM mem JOIN roots ON node = t::VARCHAR || ':' || v),
 choice AS (SELECT root, CASE WHEN count(DISTINCT ik) = 1 THEN min(ik) END ik, arg_min(v, (num IS NULL, coalesce(num, 0), v)) FILTER (t = 8) ch, arg_min(v, (num IS NULL, coalesce(num, 0), v)) FILTER (t = 22) rm, arg_min(t, (t, v)) ft, arg_min(v, (t, v)) fv FROM nd LEFT JOIN hits USING (t, v) GROUP BY 1),
 clusters AS (SELECT t key_type, v key_value, (CASE WHEN ik IS NOT NULL THEN 13 WHEN ch IS NOT NULL THEN 8 WHEN rm IS NOT NULL THEN 22 ELSE ft END)::BIGINT canonical_type, coalesce(ik, ch, rm, fv) canonical_id FROM nd JOIN choice USING (root))"""
REFMET, KEGG, CAS, LIPIDMAPS = 22, 23, 24, 10


@query("n44_cluster_identifiers", f"""WITH RECURSIVE {ref.COMPLETE}, mem AS (SELECT md5(kt::VARCHAR || '|' || kv || '|' || ct::VARCHAR || '|' || cv) row_id, unnest([kt, ct]) t, unnest([kv, cv]) v FROM complete WHERE kt <> 13 AND ct <> 13),
 hits AS (SELECT kt t, kv v, cv ik FROM complete WHERE kt <> 13 AND ct = 13 AND regexp_matches(cv, {ref.IK}) UNION SELECT ct, cv, kv FROM complete WHERE ct <> 13 AND kt = 13 AND regexp_matches(kv, {ref.IK})), {CLUSTERS} SELECT * FROM clusters""")
def n44(spark, d):
    """Rows without an InChIKey are clustered; those with one say which structure the other identifier reaches."""
    c, ik = ref.complete(spark, d), ref.INCHIKEY
    two = F.explode(F.array(F.struct(F.col("kt").alias("key_type"), F.col("kv").alias("key_value")), F.struct(F.col("ct").alias("key_type"), F.col("cv").alias("key_value"))))
    rows = c.where((F.col("kt") != ik) & (F.col("ct") != ik)).select(F.md5(F.concat_ws("|", F.col("kt").cast("string"), "kv", F.col("ct").cast("string"), "cv")).alias("row_id"), two.alias("i")).select("row_id", "i.*")
    hits = c.where((F.col("kt") != ik) & (F.col("ct") == ik)).select("kt", "kv", "cv").union(c.where((F.col("ct") != ik) & (F.col("kt") == ik)).select("ct", "cv", "kv")).toDF("key_type", "key_value", "structure")
    return chemicals.cluster_lookup(rows, hits.where(F.col("structure").rlike(resolve.INCHIKEY)), ik, [ref.CHEBI, REFMET])


@query("n45_chebi_canonical", f"""WITH RECURSIVE {ref.COMPLETE}, x AS (SELECT 'CHEBI:' || regexp_extract(cv, '^(?:CHEBI:)?([0-9]+)$', 1) chebi, kt t, CASE kt WHEN 8 THEN 'CHEBI:' || regexp_extract(kv, '^(?:CHEBI:)?([0-9]+)$', 1) WHEN 23 THEN upper(kv) ELSE kv END v FROM complete WHERE ct = 8),
 refs AS (SELECT chebi, t, v FROM x WHERE chebi <> 'CHEBI:' AND v <> 'CHEBI:' UNION SELECT chebi, 8, chebi FROM x WHERE chebi <> 'CHEBI:'), ks AS (SELECT * FROM refs WHERE t IN (8, 23, 24)), st AS (SELECT chebi, v ik FROM refs WHERE t = 13 AND regexp_matches(v, {ref.IK})), hits AS (SELECT DISTINCT t, v, ik FROM ks JOIN st USING (chebi)),
 bare AS (SELECT chebi, bool_or(t IN (23, 24)) AND NOT bool_or(t IN (9, 10, 12)) loose FROM refs ANTI JOIN st USING (chebi) GROUP BY 1), mem AS (SELECT chebi row_id, t, v FROM ks SEMI JOIN (SELECT chebi FROM bare WHERE loose) USING (chebi)), {CLUSTERS}
 SELECT * FROM clusters UNION SELECT 8, v, 13, ik FROM hits WHERE t = 8 UNION SELECT 8, v, 8, chebi FROM ks SEMI JOIN bare USING (chebi) WHERE t = 8 AND chebi NOT IN (SELECT chebi FROM ks JOIN clusters ON t = key_type AND v = key_value)""")
def n45_canonical(spark, d):
    c = ref.complete(spark, d).where(F.col("ct") == ref.CHEBI)
    chebi = lambda v: F.concat(F.lit("CHEBI:"), F.nullif(F.regexp_extract(v, r"^(?:CHEBI:)?([0-9]+)$", 1), F.lit("")))
    value = F.when(F.col("kt") == ref.CHEBI, chebi("kv")).when(F.col("kt") == KEGG, F.upper("kv")).otherwise(F.col("kv"))
    refs = c.select(chebi("cv").alias("chebi"), F.col("kt").alias("key_type"), value.alias("key_value"))
    return chemicals.chebi_clusters(refs, ref.CHEBI, ref.INCHIKEY, [KEGG, CAS], [ref.PUBCHEM, ref.HMDB, LIPIDMAPS])


@query("n89_protein_annotation", "SELECT entity_id, string_agg(DISTINCT label, '|' ORDER BY label) labels, max(CASE WHEN canonical_identifier_type_id = 3 THEN trim(canonical_identifier) END) entrez, bool_or(resolution_status_id = 1) resolved FROM entity WHERE entity_type_id = 2 AND taxonomy_id = 9606 GROUP BY 1")
def n89(spark, d):
    from strandwise.functions.ids import sorted_text

    e = table(spark, d, "entity").where("entity_type_id = 2 and taxonomy_id = 9606")
    return e.groupBy("entity_id").agg(sorted_text(F.col("label")).alias("labels"), F.max(F.when(F.col("canonical_identifier_type_id") == 3, F.trim("canonical_identifier"))).alias("entrez"), F.bool_or(F.col("resolution_status_id") == 1).alias("resolved"))


@query("j14_keyword_join", "SELECT DISTINCT annotation_key, kw FROM annotation, (VALUES ('membrane'), ('plasma'), ('gland')) k(kw) WHERE contains(lower(value), kw)")
def j14(spark, d):
    words = F.array(*[F.lit(w) for w in ("membrane", "plasma", "gland")])
    return table(spark, d, "annotation").where("value is not null").select("annotation_key", F.explode(F.filter(words, lambda w: F.lower(F.col("value")).contains(w))).alias("kw")).distinct()


@query("j17_split_names", "SELECT DISTINCT identifier_id, trim(s) part FROM (SELECT identifier_id, unnest(string_split(value, ';')) s FROM identifier_evidence) WHERE trim(s) <> ''")
def j17(spark, d):
    return table(spark, d, "identifier_evidence").select("identifier_id", F.explode(F.transform(F.split("value", ";"), lambda x: F.trim(x))).alias("part")).where("part <> ''").distinct()


@query("w5_nulls_last_pick", "SELECT source_id, entity_id FROM (SELECT source_id, entity_id, row_number() OVER (PARTITION BY source_id ORDER BY entity_id IS NULL, entity_id) r FROM entity_evidence_resolution) WHERE r = 1")
def w5(spark, d):
    return pick.top1(table(spark, d, "entity_evidence_resolution").select("source_id", "entity_id"), ["source_id"], [("entity_id", True)])


@query("u4_concat_unique", "SELECT k, min(v) v FROM (SELECT key_value k, canonical_identifier v FROM chemical_identifier_lookup UNION ALL SELECT canonical_identifier, key_value FROM chemical_identifier_lookup) WHERE k IS NOT NULL GROUP BY 1")
def u4(spark, d):
    t = table(spark, d, "chemical_identifier_lookup")
    both = t.select(F.col("key_value").alias("k"), F.col("canonical_identifier").alias("v")).unionByName(t.select(F.col("canonical_identifier").alias("k"), F.col("key_value").alias("v")))
    return both.where("k is not null").groupBy("k").agg(F.min("v").alias("v"))


@query("n40_merged_states", "SELECT DISTINCT entity_id, resolution_mechanism FROM entity_evidence_resolution WHERE entity_id IS NOT NULL")
def n40(spark, d):
    """The states of two shards, which hold the sources with even and odd numbers, merged."""
    r = table(spark, d, "entity_evidence_resolution").where("entity_id is not null")
    return store.merge_shards([r.where(F.col("source_id") % 2 == k).select("entity_id", "resolution_mechanism").distinct() for k in (0, 1)])


@query("n92_name_cascade", rf"""WITH m AS (SELECT DISTINCT entity_id, canonical_identifier_type_id t, nullif(trim(canonical_identifier), '') c, nullif(lower(trim(label)), '') n FROM entity), i AS (SELECT DISTINCT identifier_id, identifier_type_id t, trim(value) v FROM identifier_evidence WHERE trim(value) <> ''),
 s AS (SELECT DISTINCT identifier_id, lower(trim(p)) n FROM (SELECT identifier_id, unnest(string_split(v, '|')) p FROM i WHERE t IN (5, 6, 16, 28)) WHERE trim(p) <> ''), b AS (SELECT identifier_id, nullif(regexp_replace(n, '\s*[(\[][^()\[\]]*[)\]]$', ''), '') n FROM s),
 c AS (SELECT entity_id, 1 how, identifier_id target FROM m JOIN i ON i.t = m.t AND i.v = m.c UNION ALL SELECT entity_id, 2, identifier_id FROM m JOIN s USING (n) UNION ALL SELECT entity_id, 3, identifier_id FROM (SELECT entity_id, nullif(regexp_replace(n, '\s*[(\[][^()\[\]]*[)\]]$', ''), '') n FROM m) JOIN b USING (n))
 SELECT entity_id, min(how) how, arg_min(target, (how, target)) target FROM c GROUP BY 1""")
def n92(spark, d):
    """By identifier, then by exact name or split synonym, then by name without a closing remark; the earlier method wins."""
    m = table(spark, d, "entity").select("entity_id", F.col("canonical_identifier_type_id").alias("t"), F.nullif(F.trim("canonical_identifier"), F.lit("")).alias("v"), F.nullif(F.lower(F.trim("label")), F.lit("")).alias("n")).distinct()
    i = table(spark, d, "identifier_evidence").select("identifier_id", F.col("identifier_type_id").alias("t"), F.trim("value").alias("v")).where("v <> ''").distinct()
    s = i.where("t in (5, 6, 16, 28)").select("identifier_id", F.explode(F.split("v", "[|]")).alias("n")).select("identifier_id", F.lower(F.trim("n")).alias("n")).where("n <> ''").distinct()
    short = lambda df: df.withColumn("n", F.nullif(F.regexp_replace("n", r"\s*[(\[][^()\[\]]*[)\]]$", ""), F.lit("")))
    step = lambda df, k: df.select("entity_id", F.lit(k).alias("how"), F.col("identifier_id").alias("target"))
    return resolve.first_method([step(m.join(i, ["t", "v"]), 1), step(m.select("entity_id", "n").join(s, "n"), 2), step(short(m.select("entity_id", "n")).join(short(s), "n"), 3)], "entity_id")


@query("a16_any_value", "SELECT relation_id, any_value(predicate_id) predicate_id, any_value(subject_entity_id) subject_id, count(*) n_rows FROM relation GROUP BY 1")
def a16(spark, d):
    """Columns that the key determines need no order."""
    return table(spark, d, "relation").groupBy("relation_id").agg(F.any_value("predicate_id").alias("predicate_id"), F.any_value("subject_entity_id").alias("subject_id"), F.count(F.lit(1)).alias("n_rows"))


@query("f_time_known", "SELECT entity_id, created_at <= now() known, coalesce(deleted_at <= now(), false) gone FROM entity")
def f_time(spark, d):
    now = F.current_timestamp()
    return table(spark, d, "entity").select("entity_id", (F.col("created_at") <= now).alias("known"), F.coalesce(F.col("deleted_at") <= now, F.lit(False)).alias("gone"))


_TRI = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query("f_trigram_similarity", f"WITH t AS (SELECT DISTINCT entity_id, {_TRI.format('label')} a, {_TRI.format('canonical_identifier')} b FROM entity WHERE label IS NOT NULL AND canonical_identifier IS NOT NULL) SELECT entity_id, round(CASE WHEN len(a) + len(b) = 0 THEN 0 ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END, 9) similarity FROM t")
def f_trigram(spark, d):
    from strandwise.functions.text import trigram_similarity

    return table(spark, d, "entity").where("label is not null and canonical_identifier is not null").select("entity_id", "label", "canonical_identifier").distinct().select("entity_id", F.round(trigram_similarity(F.col("label"), F.col("canonical_identifier")), 9).alias("similarity"))


@query("x2_type_names", "SELECT identifier_id, i.identifier_type_id, name FROM identifier_evidence i LEFT JOIN vocab_identifier_type v ON v.identifier_type_id = i.identifier_type_id")
def x2(spark, d):
    """Numbers to names by a checked broadcast."""
    return table(spark, d, "identifier_evidence").select("identifier_id", "identifier_type_id").join(small(table(spark, d, "vocab_identifier_type").select("identifier_type_id", "name")), "identifier_type_id", "left").select("identifier_id", "identifier_type_id", "name")

"""Queries of the training-data operators over the evidence tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.text import no_text, outer_trim, plain_id, squeeze
from strandwise.llm import components, langid, leakage, mixing, overlap, survivor
from strandwise.operators.skew import join_unique, small
from strandwise.session import table


def lookup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete matches of chemical_identifier_lookup as node keys."""
    t = table(spark, sf_dir, "chemical_identifier_lookup")

    def key(kind: str, value: str):
        v = F.upper(outer_trim(F.col(value)))
        return F.when(v != "", F.concat(F.col(kind).cast("string"), F.lit(":"), v))

    return t.select(key("key_identifier_type_id", "key_value").alias("a"), key("canonical_identifier_type_id", "canonical_identifier").alias("b"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.connected_groups(lookup_pairs(spark, sf_dir), "a", "b")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source holds which entity and relation."""
    e = table(spark, sf_dir, "entity_evidence_resolution").select(F.lit("entity").alias("kind"), F.col("source_id").alias("set_id"), plain_id(F.col("entity_id")).alias("item"))
    r = table(spark, sf_dir, "relation_evidence_relation").select(F.lit("relation").alias("kind"), F.col("source_id").alias("set_id"), plain_id(F.col("relation_id")).alias("item"))
    return e.unionByName(r)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = overlap.overlapping_pairs(members(spark, sf_dir), 0.25)
    return out.select(F.col("a").alias("source_a_id"), F.col("b").alias("source_b_id"), F.col("kind").alias("content_kind"))


def p4_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlap of every pair of sources that share anything, as resource_overlap_summary should hold it; estimates with their interval."""
    out = overlap.overlap_report(members(spark, sf_dir), 0.25)
    return out.select(F.col("a").alias("source_a_id"), F.col("b").alias("source_b_id"), F.col("kind").alias("content_kind"), F.round("estimate").cast("bigint").alias("overlap"), F.col("low").alias("overlap_low"), F.col("high").alias("overlap_high"))


def evidence_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution rows as delivered with the usable fields of the entity they point to and their trust."""
    rows = table(spark, sf_dir, "entity_evidence_resolution").select("source_id", "entity_evidence_id", plain_id(F.col("entity_id")).alias("eid"), squeeze(F.regexp_replace("resolution_mechanism", "[-_]", "")).alias("mechanism"), "resolved_at")
    ranks = table(spark, sf_dir, "vocab_resolution_mechanism").select(squeeze(F.regexp_replace("resolution_mechanism", "[-_]", "")).alias("mechanism"), "trust_rank")
    ent = table(spark, sf_dir, "entity").select(plain_id(F.col("entity_id")).alias("eid"), F.col("canonical_identifier_type_id").alias("t"), F.when(~no_text(F.col("canonical_identifier")), outer_trim(F.col("canonical_identifier"))).alias("c"))
    ent = ent.where(F.col("eid").isNotNull()).groupBy("eid").agg(F.min("t").alias("canonical_identifier_type_id"), F.min("c").alias("canonical_identifier"))
    best = ranks.groupBy("mechanism").agg(F.min("trust_rank").alias("trust_rank"))
    return join_unique(rows, ent, "eid", "left").join(small(best), "mechanism", "left")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["canonical_identifier_type_id", "canonical_identifier"]
    out = survivor.best_representative(evidence_candidates(spark, sf_dir), ["source_id", "entity_evidence_id"], fields, "trust_rank", "resolved_at")
    return out.where("n_rows > 1 and canonical_identifier_type_id is not null and canonical_identifier is not null").select("source_id", "entity_evidence_id", *fields)


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_overlaps": p4_overlaps, "p6_found": p6_found}
_NODE = "{0}::VARCHAR || ':' || upper(trim({1}))"
_MEMBERS = """m AS (SELECT DISTINCT 'entity' k, source_id s, nullif(lower(trim(entity_id, ' {}')), '') i FROM entity_evidence_resolution WHERE nullif(lower(trim(entity_id, ' {}')), '') IS NOT NULL
  UNION ALL SELECT DISTINCT 'relation', source_id, nullif(lower(trim(relation_id, ' {}')), '') FROM relation_evidence_relation WHERE nullif(lower(trim(relation_id, ' {}')), '') IS NOT NULL), z AS (SELECT k, s, count(*) n FROM m GROUP BY 1, 2)"""
ORACLES: dict[str, str] = {
    "p2_found": f"""WITH RECURSIVE e AS (SELECT DISTINCT {_NODE.format('key_identifier_type_id', 'key_value')} a, {_NODE.format('canonical_identifier_type_id', 'canonical_identifier')} b FROM chemical_identifier_lookup WHERE trim(key_value) <> '' AND trim(canonical_identifier) <> ''),
 s AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, root, step) AS (SELECT a, least(a, min(b)), 1 FROM s GROUP BY a
  UNION ALL SELECT node, root, step + 1 FROM (SELECT s.a node, least(any_value(me.root), min(x.root)) root, any_value(x.step) step, any_value(me.root) was FROM s JOIN r x ON x.node = s.b JOIN r me ON me.node = s.a GROUP BY s.a) WHERE step < 400)
 SELECT node node_key, min(root) group_key FROM r GROUP BY 1""",
    "p4_found": f"WITH {_MEMBERS} SELECT a.s source_a_id, b.s source_b_id, a.k content_kind FROM m a JOIN m b ON a.k = b.k AND a.i = b.i AND a.s < b.s JOIN z x ON x.k = a.k AND x.s = a.s JOIN z y ON y.k = b.k AND y.s = b.s GROUP BY a.s, b.s, a.k, x.n, y.n HAVING count(*) >= 0.25 * least(x.n, y.n)",
    "p6_found": """WITH r AS (SELECT * FROM entity_evidence_resolution), e AS (SELECT lower(trim(entity_id, ' {}')) eid, min(canonical_identifier_type_id) t, min(CASE WHEN lower(trim(canonical_identifier)) NOT IN ('', '-', '--', '?', '.', 'n/a', 'n.a.', 'na', 'none', 'null', 'nil', 'nan', 'unknown', 'not available') THEN trim(canonical_identifier) END) c FROM entity GROUP BY 1),
 x AS (SELECT r.source_id, r.entity_evidence_id, t, c, coalesce(trust_rank, 99) k, resolved_at, count(*) OVER (PARTITION BY r.source_id, r.entity_evidence_id) n FROM r LEFT JOIN e ON e.eid = lower(trim(r.entity_id, ' {}')) LEFT JOIN vocab_resolution_mechanism v ON regexp_replace(lower(r.resolution_mechanism), '[-_ ]', '', 'g') = regexp_replace(lower(v.resolution_mechanism), '[-_ ]', '', 'g'))
 SELECT source_id, entity_evidence_id, arg_min(t, (k, -epoch_us(resolved_at), t)) FILTER (t IS NOT NULL) canonical_identifier_type_id, arg_min(c, (k, -epoch_us(resolved_at), c)) FILTER (c IS NOT NULL) canonical_identifier FROM x WHERE n > 1 GROUP BY 1, 2 HAVING count(t) > 0 AND count(c) > 0""",
}


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_item"), "item_id", "item_text", "answer_text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, sf_dir).where("kind = 'passage'").select("doc_id", "item_id").distinct()


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak with its length, edits, common share, answer check and kind."""
    return leaks(spark, sf_dir).distinct()


QUERIES |= {"p8_found": p8_found, "p8_report": p8_report}


#: Words that a language needs in a row to count as present.
LEAST_WORDS = 12


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.language_segments(docs, "doc_id", "text", langid.train(docs, "doc_id", "text", "lang"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, "doc_id", "text", "lang")
    labelled = docs.select(F.struct("doc_id", langid.named_language(F.col("lang")).alias("named")).alias("key"), "text")
    seg = langid.language_segments(labelled, "key", "text", model)
    return seg.where((F.col("n_words") >= LEAST_WORDS) & (F.col("lang_code") != langid.NONE) & ~F.col("lang_code").eqNullSafe(F.col("doc_id.named"))).select("doc_id.doc_id", "lang_code").distinct()


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir)


def p10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.document_languages(segments(spark, sf_dir))


QUERIES |= {"p10_found": p10_found, "p10_segments": p10_segments, "p10_documents": p10_documents}


def mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source", table(spark, sf_dir, "mix_target"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents taken and how often."""
    return mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixture(spark, sf_dir)[1]


QUERIES |= {"p9_mix": p9_mix, "p9_shares": p9_shares}

"""Queries of the general data-processing operators over the evidence tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.text import accession_of, plain_id, squeeze
from strandwise.operators import orphans, packed, units, wide
from strandwise.session import table

ENTITY = ["source_id", "entity_evidence_id"]


def p3_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.wide_table(table(spark, sf_dir, "entity_evidence_annotation"), table(spark, sf_dir, "annotation"), table(spark, sf_dir, "annotation_term_type"), ENTITY)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.filled_cells(p3_wide(spark, sf_dir), table(spark, sf_dir, "annotation_term_type"), ENTITY)


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference with the space of its key: evidence of the same source, entity, or relation."""
    ev, rel = table(spark, sf_dir, "relation_evidence"), table(spark, sf_dir, "relation_evidence_relation")

    def refs(df: DataFrame, table_name: str, field: str, at: str, *space) -> DataFrame:
        return df.select(
            F.lit(table_name).alias("table_name"), F.lit(field).alias("field_name"), "source_id", "relation_evidence_id",
            F.concat(*space, plain_id(F.col(field))).alias("ref_key"), F.col(at).alias("ref_at"),
        ).where("ref_key is not null")

    return (
        refs(ev, "relation_evidence", "subject_entity_evidence_id", "loaded_at", F.lit("v"), F.col("source_id").cast("string"), F.lit(":"))
        .unionByName(refs(ev, "relation_evidence", "subject_entity_id", "loaded_at", F.lit("e:")))
        .unionByName(refs(rel, "relation_evidence_relation", "relation_id", "linked_at", F.lit("r:")))
    )


def referred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("timestamp").alias("gone")
    v, e, r = (table(spark, sf_dir, t) for t in ("entity_evidence_resolution", "entity", "relation"))
    return (
        v.select(F.concat(F.lit("v"), F.col("source_id").cast("string"), F.lit(":"), plain_id(F.col("entity_evidence_id"))).alias("key"), F.col("resolved_at").alias("born"), none)
        .unionByName(e.select(F.concat(F.lit("e:"), plain_id(F.col("entity_id"))).alias("key"), F.col("created_at").alias("born"), F.col("deleted_at").alias("gone")))
        .unionByName(r.select(F.concat(F.lit("r:"), plain_id(F.col("relation_id"))).alias("key"), F.col("created_at").alias("born"), F.col("deleted_at").alias("gone")))
    )


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_references(references(spark, sf_dir), referred_records(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_rows(spark, sf_dir).select("table_name", "field_name", "source_id", "relation_evidence_id", "orphan_kind").distinct()


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per table, field and month; rows delivered twice count once."""
    return orphans.orphan_report(orphan_rows(spark, sf_dir).distinct(), ["table_name", "field_name"], "ref_at")


QUERIES = {"p3_found": p3_found, "p3_wide": p3_wide, "p5_found": p5_found, "p5_report": p5_report}


def with_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """annotation with the accession of its attribute, told by the term's accession or else its name."""
    types = wide.attribute_list(table(spark, sf_dir, "annotation_term_type"))
    names = [(acc, acc) for acc, _, _ in types] + [("name:" + "".join(n.lower().split()), acc) for acc, n, _ in types]
    lookup = spark.createDataFrame(list(dict(reversed(names)).items()), "attr string, accession string")
    a = table(spark, sf_dir, "annotation").withColumn("attr", F.coalesce(accession_of(F.col("term")), F.concat(F.lit("name:"), squeeze(F.col("term")))))
    return a.join(F.broadcast(lookup), "attr", "left")


# Attributes whose number may stand alone, and its scale.
BARE = {"temperature celsius": "unit", "pchembl value": "-log"}


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "annotation_term_type").where("accession is not null and value_kind = 'quantity' and common_unit is not null").select("accession", "attribute_name", "common_unit").distinct()
    types = wide.bounded(listed.orderBy("accession", "attribute_name", "common_unit"))
    fields = {r["accession"].upper(): units.Field(r["common_unit"], BARE.get((r["attribute_name"] or "").lower(), "")) for r in types}
    return units.convert_units(with_attribute(spark, sf_dir), ["annotation_key"], "accession", "term", "value", "unit", fields).distinct()


QUERIES["p7_found"] = p7_found


# Terms whose text is prose or a single code whatever it contains.
PROSE = ["OM:0613", "MI:0612", "OM:0206"]


def packed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of identifier_evidence and of text annotations with the kind of value they hold."""
    ids = table(spark, sf_dir, "identifier_evidence").select(F.lit("identifier_evidence").alias("table_name"), F.col("identifier_id").alias("record_id"), F.concat(F.lit("i"), F.col("identifier_type_id").cast("string")).alias("kind"), "value")
    text = [r[0].upper() for r in wide.bounded(table(spark, sf_dir, "annotation_term_type").where("accession is not null and value_kind = 'text'").select("accession").distinct())]
    notes = with_attribute(spark, sf_dir).where(F.col("accession").isin([a for a in text if a not in PROSE]))
    return ids.unionByName(notes.select(F.lit("annotation").alias("table_name"), F.col("annotation_key").alias("record_id"), F.col("accession").alias("kind"), "value"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.split_packed(packed_fields(spark, sf_dir), ["table_name", "record_id"], "kind", "value")


QUERIES["p1_found"] = p1_found
# SQL for the wide table and the orphans; it states the same results in another way.
_ACC = "upper(nullif(regexp_extract(term, '([A-Za-z][A-Za-z]+:[0-9][0-9][0-9][0-9])', 1), ''))"
_ATTR = f"attr AS (SELECT annotation_key, trim(value, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) v, coalesce({_ACC}, t.accession) acc FROM annotation a LEFT JOIN annotation_term_type t ON lower(replace(a.term, ' ', '')) = lower(replace(t.attribute_name, ' ', '')) AND {_ACC} IS NULL)"
_USABLE = r"""usable AS (SELECT annotation_key, acc FROM attr JOIN annotation_term_type t ON t.accession = acc WHERE CASE value_kind
  WHEN 'quantity' THEN regexp_matches(v, '(^|[^A-Za-z0-9.,])[-+]?[0-9]')
  WHEN 'double' THEN regexp_matches(v, '^[-+]?[0-9]+([.,][0-9]+)?$')
  WHEN 'integer' THEN regexp_matches(v, '^[-+]?[0-9]+([.]0*)?$')
  WHEN 'boolean' THEN lower(v) IN ('true', 't', 'yes', 'y', '1', 'on', 'false', 'f', 'no', 'n', '0', 'off')
  WHEN 'date' THEN coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y/%m/%d'), try_strptime(v, '%Y%m%d'), try_strptime(v, '%d %b %Y')) IS NOT NULL
  ELSE lower(v) NOT IN ('', '-', '--', '?', '.', 'n/a', 'n.a.', 'na', 'none', 'null', 'nil', 'nan', 'unknown', 'not available') END)"""


def _bare(c: str) -> str:
    return f"nullif(lower(trim({c}, ' {{}}' || chr(9) || chr(10))), '')"


def _orphan(table_name: str, field: str, at: str, parents: str, own_source: str) -> str:
    on = f"p.k = {_bare('r.' + field)}" + own_source
    return f"""SELECT DISTINCT '{table_name}' table_name, '{field}' field_name, r.source_id, r.relation_evidence_id, CASE WHEN p.k IS NULL THEN 'missing' WHEN p.born > r.{at} THEN 'late' WHEN p.gone <= r.{at} THEN 'deleted' END orphan_kind, r.{at} ref_at
 FROM (SELECT DISTINCT * FROM {table_name}) r LEFT JOIN {parents} p ON {on} WHERE {_bare('r.' + field)} IS NOT NULL AND orphan_kind IS NOT NULL"""


_ORPHANS = f"""v AS (SELECT source_id, {_bare('entity_evidence_id')} k, min(resolved_at) born, NULL::TIMESTAMPTZ gone FROM entity_evidence_resolution GROUP BY 1, 2),
 e AS (SELECT {_bare('entity_id')} k, min(created_at) born, CASE WHEN count(deleted_at) = count(*) THEN max(deleted_at) END gone FROM entity GROUP BY 1), r0 AS (SELECT {_bare('relation_id')} k, min(created_at) born, CASE WHEN count(deleted_at) = count(*) THEN max(deleted_at) END gone FROM relation GROUP BY 1),
 orphans AS ({_orphan('relation_evidence', 'subject_entity_evidence_id', 'loaded_at', 'v', ' AND p.source_id = r.source_id')} UNION ALL {_orphan('relation_evidence', 'subject_entity_id', 'loaded_at', 'e', '')} UNION ALL {_orphan('relation_evidence_relation', 'relation_id', 'linked_at', 'r0', '')})"""

ORACLES: dict[str, str] = {
    "p3_found": f"WITH {_ATTR}, {_USABLE} SELECT DISTINCT source_id, entity_evidence_id, acc accession FROM entity_evidence_annotation JOIN usable USING (annotation_key)",
    "p5_found": f"WITH {_ORPHANS} SELECT DISTINCT table_name, field_name, source_id, relation_evidence_id, orphan_kind FROM orphans",
    "p5_report": f"WITH {_ORPHANS} SELECT table_name, field_name, strftime(ref_at AT TIME ZONE 'UTC', '%Y-%m') period, orphan_kind, count(*) n_orphans FROM orphans GROUP BY ALL",
}

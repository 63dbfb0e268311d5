"""Relational building blocks of the graph operators: joins, aggregates, windows and set operations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwise.functions.ids import sorted_text
from strandwise.functions.text import no_text
from strandwise.operators import pick
from strandwise.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return keep


@query("a02_count_distinct", "SELECT source_id, count(*) n, count(DISTINCT relation_id) n_relations FROM relation_evidence_relation GROUP BY 1")
def a02(spark, d):
    return table(spark, d, "relation_evidence_relation").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("relation_id").alias("n_relations"))


@query("a04_distinct_tuple", "SELECT source_id, count(DISTINCT (dataset_id, relation_category_id)) n FROM relation_evidence GROUP BY 1")
def a04(spark, d):
    return table(spark, d, "relation_evidence").groupBy("source_id").agg(F.countDistinct(F.struct("dataset_id", "relation_category_id")).alias("n"))


@query("a05_ambiguity_gate", "SELECT label, count(DISTINCT canonical_identifier) n FROM entity WHERE label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT canonical_identifier) > 1")
def a05(spark, d):
    return pick.value_counts(table(spark, d, "entity").where("label is not null"), ["label"], ["canonical_identifier"]).where("n_values > 1").withColumnRenamed("n_values", "n")


@query("a07_filtered_agg", "SELECT predicate_id, count(*) FILTER (relation_category_id = 1) n_one, min(created_at) FILTER (deleted_at IS NULL) first_live, max(deleted_at) last_gone FROM (SELECT DISTINCT * FROM relation) GROUP BY 1")
def a07(spark, d):
    r = table(spark, d, "relation").distinct()
    return r.groupBy("predicate_id").agg(F.count(F.when(F.col("relation_category_id") == 1, 1)).alias("n_one"), F.min(F.when(F.col("deleted_at").isNull(), F.col("created_at"))).alias("first_live"), F.max("deleted_at").alias("last_gone"))


@query("a08_ordered_listagg", "SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) line_list FROM lineitem GROUP BY 1")
def a08(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("x"))
    return g.select("l_orderkey", F.array_join(F.transform("x", lambda v: v.cast("string")), ",").alias("line_list"))


@query("a09_distinct_listagg", "SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) flags, string_agg(DISTINCT l_linestatus, '|' ORDER BY l_linestatus) FILTER (l_quantity > 25) big FROM lineitem GROUP BY 1")
def a09(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(sorted_text(F.col("l_returnflag")).alias("flags"), sorted_text(F.when(F.col("l_quantity") > 25, F.col("l_linestatus"))).alias("big"))


@query("a11_eav_pivot", "SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) click, max(CASE WHEN event_type = 'view' THEN value END) AS view, bool_or(event_type = 'error') has_error FROM events GROUP BY 1")
def a11(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("click"), F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("view"), F.bool_or(F.col("event_type") == "error").alias("has_error"))


@query("a12_bool_agg", "SELECT source_id, entity_evidence_id, bool_and(status_id = 1) every_one, bool_or(status_id = 1) any_one FROM entity_evidence_resolution GROUP BY 1, 2 HAVING bool_or(status_id > 1)")
def a12(spark, d):
    g = table(spark, d, "entity_evidence_resolution").groupBy("source_id", "entity_evidence_id").agg(F.bool_and(F.col("status_id") == 1).alias("every_one"), F.bool_or(F.col("status_id") == 1).alias("any_one"), F.bool_or(F.col("status_id") > 1).alias("x"))
    return g.where("x").drop("x")


@query("a15_best_mechanism", "SELECT source_id, entity_evidence_id, arg_min(resolution_mechanism, trust_rank) mechanism FROM entity_evidence_resolution JOIN vocab_resolution_mechanism USING (resolution_mechanism) GROUP BY 1, 2")
def a15(spark, d):
    e = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", "resolution_mechanism").join(F.broadcast(table(spark, d, "vocab_resolution_mechanism")), "resolution_mechanism")
    return e.groupBy("source_id", "entity_evidence_id").agg(F.min_by("resolution_mechanism", "trust_rank").alias("mechanism"))


@query("a20_sum_of_distinct", "SELECT source_id, sum(n)::BIGINT n FROM (SELECT source_id, dataset_id, count(DISTINCT predicate_id) n FROM relation_evidence GROUP BY 1, 2) GROUP BY 1")
def a20(spark, d):
    return table(spark, d, "relation_evidence").groupBy("source_id", "dataset_id").agg(F.countDistinct("predicate_id").alias("n")).groupBy("source_id").agg(F.sum("n").alias("n"))


@query("w1_top1_pick", "SELECT source_id, entity_evidence_id, entity_id, resolved_at FROM (SELECT *, row_number() OVER (PARTITION BY source_id, entity_evidence_id ORDER BY status_id NULLS LAST, resolved_at NULLS LAST, entity_id NULLS LAST) r FROM entity_evidence_resolution) WHERE r = 1")
def w1(spark, d):
    rows = table(spark, d, "entity_evidence_resolution").select("source_id", "entity_evidence_id", "status_id", "resolved_at", "entity_id")
    return pick.top1(rows, ["source_id", "entity_evidence_id"], [("status_id", True), ("resolved_at", True), ("entity_id", True)]).drop("status_id")


@query("w4_dense_ids", "SELECT relation_id, row_number() OVER (ORDER BY relation_id) dense_id FROM (SELECT DISTINCT relation_id FROM relation)")
def w4(spark, d):
    return pick.dense_ids(table(spark, d, "relation").select("relation_id").distinct(), "relation_id")


@query("w6_top_k", "SELECT entity_id, relation_count FROM (SELECT i entity_id, count(*) relation_count FROM (SELECT DISTINCT relation_id, unnest([subject_entity_id, object_entity_id]) i FROM relation) GROUP BY 1) ORDER BY relation_count DESC, entity_id LIMIT 25")
def w6(spark, d):
    ends = table(spark, d, "relation").select("relation_id", F.explode(F.array("subject_entity_id", "object_entity_id")).alias("entity_id")).distinct()
    return ends.groupBy("entity_id").agg(F.count(F.lit(1)).alias("relation_count")).orderBy(F.desc("relation_count"), "entity_id").limit(25)


_USABLE = "SELECT DISTINCT entity_id, entity_type_id, taxonomy_id, trim(canonical_identifier) c FROM entity WHERE lower(trim(canonical_identifier)) NOT IN ('', '-', '--', '?', '.', 'n/a', 'n.a.', 'na', 'none', 'null', 'nil', 'nan', 'unknown', 'not available')"


@query("j03_null_safe_join", f"SELECT a.entity_id, b.entity_id same_as FROM ({_USABLE}) a JOIN ({_USABLE}) b ON a.c = b.c AND a.taxonomy_id IS NOT DISTINCT FROM b.taxonomy_id AND a.entity_type_id IS NOT DISTINCT FROM b.entity_type_id")
def j03(spark, d):
    e = table(spark, d, "entity").select("entity_id", "entity_type_id", "taxonomy_id", F.trim("canonical_identifier").alias("c")).where(~no_text(F.col("c"))).distinct()
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, (F.col("a.c") == F.col("b.c")) & F.col("a.taxonomy_id").eqNullSafe(F.col("b.taxonomy_id")) & F.col("a.entity_type_id").eqNullSafe(F.col("b.entity_type_id"))).select("a.entity_id", F.col("b.entity_id").alias("same_as"))


@query("j05_new_keys_anti", "SELECT DISTINCT annotation_key FROM entity_evidence_annotation WHERE annotation_key NOT IN (SELECT annotation_key FROM annotation)")
def j05(spark, d):
    return table(spark, d, "entity_evidence_annotation").select("annotation_key").distinct().join(table(spark, d, "annotation").select("annotation_key"), "annotation_key", "left_anti")


@query("j07_semi_join", "SELECT source_id, relation_evidence_id FROM relation_evidence WHERE lower(trim(subject_entity_id)) IN (SELECT entity_id FROM entity WHERE entity_type_id = 2)")
def j07(spark, d):
    genes = table(spark, d, "entity").where("entity_type_id = 2").select("entity_id").distinct()
    return table(spark, d, "relation_evidence").select("source_id", "relation_evidence_id", F.lower(F.trim("subject_entity_id")).alias("entity_id")).join(genes, "entity_id", "left_semi").drop("entity_id")


@query("j15_unpivot_sides", "SELECT relation_id, 'subject' side, subject_entity_id entity_id FROM relation UNION ALL SELECT relation_id, 'object', object_entity_id FROM relation")
def j15(spark, d):
    side = F.explode(F.array(F.struct(F.lit("subject").alias("side"), F.col("subject_entity_id").alias("entity_id")), F.struct(F.lit("object").alias("side"), F.col("object_entity_id").alias("entity_id"))))
    return table(spark, d, "relation").select("relation_id", side.alias("x")).select("relation_id", "x.side", "x.entity_id")


@query("j18_two_hops", "SELECT DISTINCT a.subject_entity_id first_id, b.object_entity_id last_id FROM relation a JOIN relation b ON a.object_entity_id = b.subject_entity_id WHERE a.predicate_id = 1 AND b.predicate_id = 2")
def j18(spark, d):
    r = table(spark, d, "relation")
    a = r.where("predicate_id = 1").select(F.col("subject_entity_id").alias("first_id"), F.col("object_entity_id").alias("mid")).distinct()
    b = r.where("predicate_id = 2").select(F.col("subject_entity_id").alias("mid"), F.col("object_entity_id").alias("last_id")).distinct()
    return a.join(b, "mid").select("first_id", "last_id").distinct()


@query("u1_union_all", "SELECT entity_id id, 'entity' kind FROM entity UNION ALL SELECT relation_id, 'relation' FROM relation")
def u1(spark, d):
    return table(spark, d, "entity").select(F.col("entity_id").alias("id"), F.lit("entity").alias("kind")).unionByName(table(spark, d, "relation").select(F.col("relation_id").alias("id"), F.lit("relation").alias("kind")))


@query("u2_union_distinct", "SELECT subject_entity_id entity_id FROM relation UNION SELECT object_entity_id FROM relation")
def u2(spark, d):
    r = table(spark, d, "relation")
    return r.select(F.col("subject_entity_id").alias("entity_id")).unionByName(r.select(F.col("object_entity_id").alias("entity_id"))).distinct()


@query("p14_numeric_filter", "SELECT annotation_key, CAST(value AS DOUBLE) v FROM annotation WHERE regexp_matches(value, '^[0-9]+([.][0-9]+)?$') AND CAST(value AS DOUBLE) >= 6")
def p14(spark, d):
    return table(spark, d, "annotation").where(F.col("value").rlike(r"^[0-9]+([.][0-9]+)?$")).select("annotation_key", F.expr("try_cast(value as double)").alias("v")).where("v >= 6")


@query("p15_numeric_scrub", "SELECT annotation_key, TRY_CAST(nullif(regexp_replace(value, '[^0-9.eE+-]', '', 'g'), '') AS DOUBLE) v FROM annotation")
def p15(spark, d):
    return table(spark, d, "annotation").select("annotation_key", F.expr("try_cast(nullif(regexp_replace(value, '[^0-9.eE+-]', ''), '') as double)").alias("v"))

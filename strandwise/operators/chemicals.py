"""Fallback identities, labels and structural groups of chemicals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.pick import top1, value_counts
from strandwise.operators.resolve import INCHIKEY, lookup_components
from strandwise.operators.skew import join_unique
from strandwise.session import Scratch

#: Prefix lengths of an InChIKey that keep connectivity, stereochemistry, and everything.
LEVELS = {"connectivity": 14, "stereo": 25, "full": 27}


def anchor_map(mentions: DataFrame, inchikey_type: int, chebi_type: int) -> DataFrame:
    """(key_type, key_value, anchor_type, anchor_id): what an identifier stands for by the company it keeps.

    Exactly one InChIKey among all mentions it occurs in, else, without any InChIKey, exactly one ChEBI id.
    """
    filled = mentions.where("key_value <> ''").select("evidence_id", "key_type", "key_value").distinct()
    own = filled.where(~F.col("key_type").isin(inchikey_type, chebi_type))
    ik = filled.where((F.col("key_type") == inchikey_type) & F.col("key_value").rlike(INCHIKEY)).select("evidence_id", F.col("key_value").alias("a"))
    ch = filled.where(F.col("key_type") == chebi_type).select("evidence_id", F.col("key_value").alias("a"))
    keys = ["key_type", "key_value"]

    def company(anchors: DataFrame, name: str) -> DataFrame:
        met = own.join(anchors, "evidence_id").select(*keys, "a").distinct()
        return met.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.min("a").alias(name))

    both = company(ik, "ik").join(company(ch, "ch"), keys, "full")
    one_ik = F.col("n_ik") == 1
    one_ch = F.col("n_ik").isNull() & (F.col("n_ch") == 1)
    return both.where(one_ik | one_ch).select(*keys, F.when(one_ik, inchikey_type).otherwise(chebi_type).cast("bigint").alias("anchor_type"), F.when(one_ik, F.col("ik")).otherwise(F.col("ch")).alias("anchor_id"))


def ambiguous_values(mentions: DataFrame, inchikey_type: int) -> DataFrame:
    """(key_type, key_value, n_values): identifiers that keep company with more than one InChIKey, apart from case."""
    filled = mentions.where("key_value <> ''").select("evidence_id", "key_type", F.lower(F.trim("key_value")).alias("key_value")).distinct()
    ik = mentions.where((F.col("key_type") == inchikey_type) & F.col("key_value").rlike(INCHIKEY)).select("evidence_id", F.col("key_value").alias("a")).distinct()
    return value_counts(filled.where(F.col("key_type") != inchikey_type).join(ik, "evidence_id"), ["key_type", "key_value"], ["a"]).where("n_values > 1")


def fallback_pick(mentions: DataFrame, anchors: DataFrame, ambiguous: DataFrame, tiers: dict[int, tuple[int, str]], name_types: list[int]) -> DataFrame:
    """(evidence_id, canonical_type, canonical_id, mechanism): the best identity of mentions that no lookup resolves.

    Candidates are the mention's identifiers at the tier of their type, and the anchors of those at tier 0 (structure) or 2. Names
    that are InChIKeys, numbers, shorter than two signs or ambiguous do not count. Order: tier, own before anchored, identifier.
    """
    tier = F.create_map(*[F.lit(x) for t, (n, _) in tiers.items() for x in (t, n)])
    how = F.create_map(*[F.lit(x) for t, (_, m) in tiers.items() for x in (t, m)])
    own = mentions.where("key_value <> ''").select("evidence_id", "key_type", "key_value").distinct().where(F.col("key_type").isin(list(tiers)))
    name = F.col("key_type").isin(name_types)
    junk = name & (F.col("key_value").rlike(INCHIKEY) | F.col("key_value").rlike(r"^\d+$") | (F.length("key_value") < 2))
    own = own.where(~junk)
    taken = ambiguous.select("key_type", F.col("key_value").alias("low")).where(F.col("key_type").isin(name_types))
    own = own.withColumn("low", F.lower(F.trim("key_value"))).join(taken, ["key_type", "low"], "left_anti")
    plain = own.select("evidence_id", F.col("key_type").alias("canonical_type"), F.col("key_value").alias("canonical_id"), tier[F.col("key_type").cast("int")].alias("tier"), how[F.col("key_type").cast("int")].alias("mechanism"), F.lit(0).alias("hung"))
    hung = own.join(anchors, ["key_type", "key_value"]).select("evidence_id", F.col("anchor_type").alias("canonical_type"), F.col("anchor_id").alias("canonical_id"), F.when(F.col("anchor_id").rlike(INCHIKEY), 0).otherwise(2).alias("tier"), F.when(F.col("anchor_id").rlike(INCHIKEY), "anchored_structure").otherwise("anchored_chebi").alias("mechanism"), F.lit(1).alias("hung"))
    best = top1(hung.unionByName(plain), ["evidence_id"], [("tier", True), ("hung", True), ("canonical_id", True)])
    return best.select("evidence_id", "canonical_type", "canonical_id", "mechanism")


def level_key(key, length: int):
    """The prefix of a well-formed InChIKey; null for anything else."""
    return F.when(key.rlike(INCHIKEY), F.substring(key, 1, length))


def structure_groups(structures: DataFrame) -> DataFrame:
    """(level, group_key, n_members, representative_id) from (entity_id, inchikey): groups at every level of LEVELS."""
    levels = F.array(*[F.struct(F.lit(n).alias("level"), level_key(F.col("inchikey"), k).alias("group_key")) for n, k in LEVELS.items()])
    rows = structures.select("entity_id", F.explode(levels).alias("g")).where("g.group_key is not null").select("entity_id", "g.level", "g.group_key").distinct()
    return rows.groupBy("level", "group_key").agg(F.count(F.lit(1)).alias("n_members"), F.min("entity_id").alias("representative_id"))


def primary_structure(entities: DataFrame, attached: DataFrame, inchikey_type: int) -> DataFrame:
    """(entity_id, inchikey): the canonical InChIKey, else the smallest well-formed one attached."""
    own = entities.where((F.col("canonical_type") == inchikey_type) & F.col("canonical_id").rlike(INCHIKEY)).select("entity_id", F.col("canonical_id").alias("inchikey"), F.lit(0).alias("r"))
    near = attached.where((F.col("key_type") == inchikey_type) & F.col("key_value").rlike(INCHIKEY)).select("entity_id", F.col("key_value").alias("inchikey"), F.lit(1).alias("r"))
    return top1(own.unionByName(near).distinct(), ["entity_id"], [("r", True), ("inchikey", True)]).select("entity_id", "inchikey")


def collapsed_relations(relations: DataFrame, structures: DataFrame, sources: DataFrame) -> DataFrame:
    """Relations with their endpoints lifted to each level: (level, subject_key, predicate_id, object_key, n_relations, n_sources).

    Endpoints without a structure stay themselves. sources: (relation_id, source_id).
    """
    levels = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(k).alias("k")) for n, k in LEVELS.items()]))
    s = structures.select(F.col("entity_id").alias("subject_entity_id"), F.col("inchikey").alias("s_key"))
    o = structures.select(F.col("entity_id").alias("object_entity_id"), F.col("inchikey").alias("o_key"))
    lifted = relations.join(s, "subject_entity_id", "left").join(o, "object_entity_id", "left").select("*", levels.alias("l"))

    def key(k: str, own: str):
        return F.coalesce(F.expr(f"case when {k} rlike '{INCHIKEY}' then substring({k}, 1, l.k) end"), F.col(own))

    rows = lifted.select("relation_id", "l.level", key("s_key", "subject_entity_id").alias("subject_key"), "predicate_id", key("o_key", "object_entity_id").alias("object_key"))
    keys = ["level", "subject_key", "predicate_id", "object_key"]
    n = rows.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_relations"))
    src = rows.join(sources.select("relation_id", "source_id").distinct(), "relation_id").select(*keys, "source_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_sources"))
    return n.join(src, keys, "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0)))


def number_first(value: Column) -> Column:
    """Sort key of an identifier: numbers, also behind a prefix such as CHEBI:, by size and before all others."""
    bare = F.regexp_replace(value, r"^[A-Za-z]+:", "")
    number, digits = bare.rlike(r"^[0-9]+$"), F.regexp_replace(bare, r"^0+(?=.)", "")
    return F.struct(F.when(number, 0).otherwise(1), F.when(number, F.length(digits)).otherwise(0), F.when(number, digits).otherwise(value), value.alias("v"))


def cluster_lookup(rows: DataFrame, hits: DataFrame, structure_type: int, preferred: list[int]) -> DataFrame:
    """(key_type, key_value, canonical_type, canonical_id): one canonical identifier for all that share rows, directly or through others.

    rows: row_id, key_type, key_value; hits: key_type, key_value, structure. A component that reaches exactly one structure gets that, else its
    least identifier of the first of the preferred types that it has (numbers by size), else its least identifier by type and value.
    """
    label = F.concat_ws(":", F.col("key_type").cast("string"), "key_value")
    scratch = Scratch(rows.sparkSession)
    members = scratch.write(rows.where("key_value <> ''").select("row_id", "key_type", "key_value", label.alias("node")).distinct())
    # the identifiers of a row hang on its least one, so n of them need n edges, and the rows themselves are no nodes
    links = join_unique(members.select("row_id", "node"), members.groupBy("row_id").agg(F.min("node").alias("least")), "row_id")
    roots = lookup_components(links, "node", "least")
    nodes = scratch.write(members.select("node", "key_type", "key_value").distinct().join(roots, "node"))
    met = nodes.select("node", "root").join(hits.where("structure <> ''").select(label.alias("node"), "structure").distinct(), "node")
    structures = met.groupBy("root").agg(F.min("structure").alias("s"), F.max("structure").alias("other")).where("s = other").select("root", "s")
    least = [F.min(F.when(F.col("key_type") == t, number_first(F.col("key_value"))))["v"].alias(f"p{i}") for i, t in enumerate(preferred)]
    picks = nodes.groupBy("root").agg(F.min(F.struct("key_type", "key_value")).alias("any"), *least).join(structures, "root", "left")
    kind = F.when(F.col("s").isNotNull(), structure_type)
    for i, t in enumerate(preferred):
        kind = kind.when(F.col(f"p{i}").isNotNull(), t)
    picks = picks.select("root", kind.otherwise(F.col("any.key_type")).cast("bigint").alias("canonical_type"), F.coalesce("s", *[f"p{i}" for i in range(len(preferred))], "any.key_value").alias("canonical_id"))
    return join_unique(nodes.select("root", "key_type", "key_value"), picks, "root").drop("root")


def chebi_clusters(references: DataFrame, chebi_type: int, structure_type: int, shared_types: list[int], structural_types: list[int]) -> DataFrame:
    """(key_type, key_value, canonical_type, canonical_id) of ChEBI records by their cross references.

    references: chebi, key_type, key_value (a record's own and secondary ids, its InChIKey, and its cross references). A record with an InChIKey leads
    to that. Records without, that have a reference of the shared types and none of the structural ones, are clustered through their ChEBI ids and
    shared references; structures of records with an InChIKey count as reached by theirs. All other records whose
    identifiers are in no cluster stand for themselves.
    """
    t = F.col("key_type")
    own = references.select("chebi", F.lit(chebi_type).cast("bigint").alias("key_type"), F.col("chebi").alias("key_value"))
    # read several times below
    refs = Scratch(references.sparkSession).write(references.where("chebi is not null and key_value <> ''").select("chebi", "key_type", "key_value").unionByName(own.where("chebi is not null")).distinct())
    keys = refs.where(t.isin(chebi_type, *shared_types))
    structures = refs.where((t == structure_type) & F.col("key_value").rlike(INCHIKEY)).select("chebi", F.col("key_value").alias("structure"))
    known = keys.join(structures, "chebi")
    kinds = refs.groupBy("chebi").agg(F.bool_or(t.isin(shared_types)).alias("shares"), F.bool_or(t.isin(structural_types)).alias("structural")).join(structures.select("chebi").distinct(), "chebi", "left_anti")
    loose = kinds.where("shares and not structural").select("chebi")
    clusters = Scratch(references.sparkSession).write(cluster_lookup(keys.join(loose, "chebi", "left_semi").withColumnRenamed("chebi", "row_id"), known, structure_type, [chebi_type]))
    touched = keys.join(clusters.select("key_type", "key_value"), ["key_type", "key_value"], "left_semi").select("chebi").distinct()
    rest = keys.where(t == chebi_type).join(kinds.select("chebi"), "chebi", "left_semi").join(touched, "chebi", "left_anti")
    out = clusters.unionByName(known.where(t == chebi_type).select("key_type", "key_value", F.lit(structure_type).cast("bigint").alias("canonical_type"), F.col("structure").alias("canonical_id")))
    return out.unionByName(rest.select("key_type", "key_value", F.lit(chebi_type).cast("bigint").alias("canonical_type"), F.col("chebi").alias("canonical_id"))).distinct()

"""Resolution of evidence mentions against a lookup of identifiers, and the graph built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.ids import content_uuid, entity_key, relation_key, sorted_text, unit_joined
from strandwise.operators.components import connected_groups
from strandwise.operators.pick import top1, value_counts

INCHIKEY = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"
KEY = ["entity_type", "key_type", "key_value"]


def identifier_keys(mentions: DataFrame) -> DataFrame:
    """Distinct keys to look up: (entity_type, taxonomy_id, key_type, key_value) without blanks."""
    return mentions.where("key_value is not null and key_value <> ''").select("entity_type", "taxonomy_id", "key_type", "key_value").distinct()


def unambiguous_keys(lookup: DataFrame, optional_types: list[int]) -> DataFrame:
    """Keys of the listed types that lead to exactly one canonical identifier in all taxa: usable without a taxonomy."""
    rows = lookup.where(F.col("key_type").isin(optional_types))
    return value_counts(rows, KEY, ["canonical_type", "canonical_id"]).where("n_values = 1").select(*KEY)


def needed_lookup(keys: DataFrame, lookup: DataFrame, optional: DataFrame) -> DataFrame:
    """The lookup cut down to keys of the batch.

    The join runs on type and value; the taxonomy rule (equal, none in the lookup, or a key that is unambiguous without one) is a
    further condition on joined rows, never part of the key.
    """
    marked = lookup.join(optional.withColumn("optional", F.lit(True)), KEY, "left").withColumnRenamed("taxonomy_id", "lookup_taxonomy")
    fits = (F.col("taxonomy_id") == F.col("lookup_taxonomy")) | F.col("lookup_taxonomy").isNull() | F.col("optional").isNotNull()
    joined = keys.join(marked, KEY).where(fits)
    return joined.select(*KEY, "taxonomy_id", "canonical_type", "canonical_id", F.col("optional").isNotNull().alias("taxonomy_optional")).distinct()


def candidates(mentions: DataFrame, needed: DataFrame) -> DataFrame:
    """(evidence_id, entity_type, taxonomy_id, canonical_type, canonical_id): what each mention may be."""
    n = needed.withColumnRenamed("taxonomy_id", "needed_taxonomy")
    joined = mentions.join(n, KEY).where(F.col("taxonomy_id").eqNullSafe(F.col("needed_taxonomy")))
    return joined.select("evidence_id", "entity_type", "taxonomy_id", "canonical_type", "canonical_id").distinct()


def unresolved_key(mentions: DataFrame) -> DataFrame:
    """(evidence_id, unresolved_id): MD5 of a mention's identifiers in order of type and value, or of its own id where it has none."""
    filled = F.when(F.col("key_value") != "", F.struct(F.col("key_type").alias("t"), F.col("key_value").alias("v")))
    ids = mentions.groupBy("evidence_id").agg(F.array_sort(F.collect_set(filled)).alias("ids"))
    text = F.array_join(F.transform("ids", lambda x: F.concat(x["t"].cast("string"), F.lit("="), x["v"])), "|")
    return ids.select("evidence_id", F.md5(F.when(F.size("ids") > 0, text).otherwise(F.col("evidence_id"))).alias("unresolved_id"))


def lookup_hits(mentions: DataFrame, lookup: DataFrame, optional: DataFrame) -> DataFrame:
    """(evidence_id, n, t, c): of each mention that the lookup answers 1 or 2 for one or several candidates, the least type and identifier.

    The same candidates as needed_lookup and candidates give, in one join by key: whether there are several is told by minimum and maximum, which
    are formed in part before the shuffle by mention.
    """
    marked = lookup.join(optional.withColumn("optional", F.lit(True)), KEY, "left").withColumnRenamed("taxonomy_id", "lookup_taxonomy")
    fits = (F.col("taxonomy_id") == F.col("lookup_taxonomy")) | F.col("lookup_taxonomy").isNull() | F.col("optional").isNotNull()
    c = F.struct("canonical_type", "canonical_id")
    met = mentions.where("key_value <> ''").join(marked, KEY).where(fits).groupBy("evidence_id").agg(F.min(c).alias("least"), F.max(c).alias("most"))
    return met.select("evidence_id", F.when(F.col("least").eqNullSafe(F.col("most")), 1).otherwise(2).alias("n"), F.col("least.canonical_type").alias("t"), F.col("least.canonical_id").alias("c"))


def resolve_entities(mentions: DataFrame, needed: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """(evidence_id, canonical_type, canonical_id, status, mechanism) of every mention.

    Exactly one candidate: resolved by the lookup. None, with a fallback (evidence_id, canonical_type, canonical_id, mechanism):
    resolved by that. All others, also those with several candidates, stay unresolved under a hash of their identifiers.
    """
    found = candidates(mentions, needed)
    one = found.groupBy("evidence_id").agg(F.count(F.lit(1)).alias("n"), F.min("canonical_type").alias("t"), F.min("canonical_id").alias("c"))
    return resolve_hits(mentions, one, fallback)


def resolve_hits(mentions: DataFrame, hits: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """resolve_entities with the answers of lookup_hits."""
    rows = unresolved_key(mentions).join(hits, "evidence_id", "left")
    if fallback is None:
        rows = rows.select("*", F.lit(None).cast("bigint").alias("ft"), F.lit(None).cast("string").alias("fc"), F.lit(None).cast("string").alias("fm"))
    else:
        rows = rows.join(fallback.select("evidence_id", F.col("canonical_type").alias("ft"), F.col("canonical_id").alias("fc"), F.col("mechanism").alias("fm")), "evidence_id", "left")
    hit = F.col("n") == 1
    back = F.col("n").isNull() & F.col("fc").isNotNull()
    return rows.select(
        "evidence_id",
        F.when(hit, F.col("t")).when(back, F.col("ft")).alias("canonical_type"),
        F.when(hit, F.col("c")).when(back, F.col("fc")).otherwise(F.col("unresolved_id")).alias("canonical_id"),
        F.when(hit | back, 1).otherwise(2).alias("status"),
        F.when(hit, "resolver").when(back, F.col("fm")).otherwise("unresolved").alias("mechanism"),
    )


def direct_structures(mentions: DataFrame, inchikey_type: int) -> DataFrame:
    """Mentions with exactly one well-formed InChIKey among their identifiers."""
    keys = mentions.where((F.col("key_type") == inchikey_type) & F.col("key_value").rlike(INCHIKEY)).select("evidence_id", "key_value").distinct()
    one = keys.groupBy("evidence_id").agg(F.count(F.lit(1)).alias("n"), F.min("key_value").alias("canonical_id"))
    return one.where("n = 1").select("evidence_id", F.lit(inchikey_type).cast("bigint").alias("canonical_type"), "canonical_id", F.lit("inchikey").alias("mechanism"))


def entities(resolution: DataFrame, mentions: DataFrame, priority: dict[str, int]) -> DataFrame:
    """One row per natural key: content id, best mechanism by priority, number of mentions."""
    who = mentions.select("evidence_id", "entity_type", "taxonomy_id").distinct()
    rank = F.coalesce(*[F.when(F.col("mechanism") == m, F.lit(p)) for m, p in priority.items()], F.lit(99))
    rows = resolution.join(who, "evidence_id").withColumn("rank", rank)
    group = ["entity_type", "taxonomy_id", "canonical_type", "canonical_id"]
    out = rows.groupBy(*group).agg(F.min(F.struct("rank", "mechanism"))["mechanism"].alias("mechanism"), F.count(F.lit(1)).alias("n_mentions"))
    key = entity_key(F.col("entity_type"), F.col("taxonomy_id"), F.coalesce(F.col("canonical_type").cast("string"), F.lit("")), F.col("canonical_id"))
    return out.withColumn("entity_id", content_uuid(key)).select("entity_id", *group, "mechanism", "n_mentions")


def relations(edges: DataFrame) -> DataFrame:
    """One row per (subject, predicate, object): content id, least category, its sources in order, evidence rows.

    Sources are a dimension of bounded size, so their list is.
    """
    filled = edges.where("subject_id is not null and object_id is not null and predicate_id is not null")
    out = filled.groupBy("subject_id", "predicate_id", "object_id").agg(F.min("category_id").alias("category_id"), sorted_text(F.lpad(F.col("source_id").cast("string"), 6, "0"), ",").alias("sources"), F.count(F.lit(1)).alias("n_evidence"))
    return out.withColumn("relation_id", content_uuid(relation_key(F.col("subject_id"), F.col("predicate_id"), F.col("object_id"))))


def member_signature(members: DataFrame, min_members: int = 1) -> DataFrame:
    """(parent_id, signature, n_members, resolved): SHA-256 of the sorted distinct members of a complex.

    members: parent_id, entity_type, taxonomy_id?, canonical_id, status. A null taxonomy sorts last and stays in the JSON. A
    parent is resolved when all its members are. Distinct members of one parent are bounded by the size of a complex.
    """
    m = F.struct(F.col("entity_type").cast("string").alias("entity_type"), F.col("taxonomy_id").isNull().alias("none"), F.col("taxonomy_id").cast("string").alias("taxonomy_id"), "canonical_id")
    g = members.groupBy("parent_id").agg(F.array_sort(F.collect_set(m)).alias("m"), F.bool_and(F.col("status") == 1).alias("resolved"))
    plain = F.transform("m", lambda x: F.struct(x["entity_type"].alias("entity_type"), x["taxonomy_id"].alias("taxonomy_id"), x["canonical_id"].alias("canonical_id")))
    return g.where(F.size("m") >= min_members).select("parent_id", F.sha2(F.to_json(plain, {"ignoreNullFields": "false"}), 256).alias("signature"), F.size("m").alias("n_members"), "resolved")


def nested_signature(members: DataFrame, min_members: int = 1) -> DataFrame:
    """member_signature with complexes among the members: such a member stands under its own signature, and counts as resolved when its members are.

    Two passes, so complexes within complexes are told one level deep.
    """
    inner = member_signature(members, min_members).select(F.col("parent_id").alias("canonical_id"), "signature", F.col("resolved").alias("inner"))
    own = members.join(inner, "canonical_id", "left")
    told = own.select("parent_id", "entity_type", "taxonomy_id", F.coalesce("signature", "canonical_id").alias("canonical_id"), F.when(F.col("inner").isNull(), F.col("status")).when(F.col("inner"), 1).otherwise(2).alias("status"))
    return member_signature(told, min_members)


def gene_parts(found: DataFrame) -> DataFrame:
    """(evidence_id, gene, part_id): the copies of each mention that several genes answer. found: (evidence_id, canonical_id)."""
    many = found.select("evidence_id", "canonical_id").distinct()
    many = many.join(many.groupBy("evidence_id").count().where("count > 1").select("evidence_id"), "evidence_id")
    return many.select("evidence_id", F.col("canonical_id").alias("gene"), content_uuid(F.concat("evidence_id", F.lit("#mg="), "canonical_id")).alias("part_id"))


def follow_parts(rows: DataFrame, parts: DataFrame, mention: str) -> DataFrame:
    """Rows that refer to a mention (annotations, annotation relations, ontology rows), once per copy where the mention was split.

    Rows of other mentions, and those without one, stay as they are.
    """
    p = parts.select(F.col("evidence_id").alias(mention), F.col("part_id").alias("__part"))
    return rows.join(p, mention, "left").withColumn(mention, F.coalesce("__part", mention)).select(rows.columns)


def split_multi_gene(mentions: DataFrame, found: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mentions that several canonical genes answer become one mention per gene; referring rows follow.

    found: (evidence_id, canonical_id). references: relation_evidence_id, subject_id, object_id (mentions). Returns mentions and
    references with new ids: `id#mg=gene` hashed, and `id#mgs=..#mgo=..` hashed where an endpoint was split.
    """
    parts = gene_parts(found)
    kept = mentions.join(parts.select("evidence_id").distinct(), "evidence_id", "left_anti")
    split = mentions.join(parts, "evidence_id").withColumn("evidence_id", F.col("part_id")).drop("part_id", "gene")
    s = parts.select(F.col("evidence_id").alias("subject_id"), F.col("gene").alias("gs"), F.col("part_id").alias("ps"))
    o = parts.select(F.col("evidence_id").alias("object_id"), F.col("gene").alias("go"), F.col("part_id").alias("po"))
    r = references.join(s, "subject_id", "left").join(o, "object_id", "left")
    touched = F.col("gs").isNotNull() | F.col("go").isNotNull()
    new_id = content_uuid(F.concat("relation_evidence_id", F.lit("#mgs="), F.coalesce("gs", F.lit("")), F.lit("#mgo="), F.coalesce("go", F.lit(""))))
    refs = r.select(F.when(touched, new_id).otherwise(F.col("relation_evidence_id")).alias("relation_evidence_id"), F.coalesce("ps", "subject_id").alias("subject_id"), F.coalesce("po", "object_id").alias("object_id"))
    return kept.unionByName(split), refs


def molecular_states(mentions: DataFrame, accession_type: int) -> DataFrame:
    """(state_id, accession, isoform): base accession and isoform of protein identifiers such as P12345-2."""
    rows = mentions.where((F.col("key_type") == accession_type) & (F.col("key_value") != ""))
    base, iso = F.regexp_replace("key_value", r"-\d+$", ""), F.nullif(F.regexp_extract("key_value", r"-(\d+)$", 1), F.lit(""))
    return rows.select(base.alias("accession"), iso.alias("isoform")).distinct().withColumn("state_id", content_uuid(unit_joined(F.lit("state"), F.lit("2"), F.col("accession"), F.col("isoform")))).select("state_id", "accession", "isoform")


def lookup_components(rows: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): connected components of cross references by their bytewise least label, in rounds that grow with the logarithm of the longest chain."""
    return connected_groups(rows, left, right).toDF("node", "root")


def best_representative_of(rows: DataFrame, keys: list[str], value: str, preferred: str) -> DataFrame:
    """Per key the preferred (true first), then smallest value, and whether it was preferred."""
    return top1(rows.select(*keys, value, (~F.col(preferred)).cast("int").alias("__rank")).distinct(), keys, [("__rank", True), (value, True)]).select(*keys, value, (F.col("__rank") == 0).alias(preferred))


def overlay(resolutions: list[DataFrame], key: str = "evidence_id") -> DataFrame:
    """One row per mention: that of the first frame that has it. The frames have equal columns and unique keys."""
    out = None
    for i, r in enumerate(resolutions):
        part = r.withColumn("__order", F.lit(i))
        out = part if out is None else out.unionByName(part)
    rest = [c for c in resolutions[0].columns if c != key]
    best = out.groupBy(key).agg(F.min(F.struct("__order", F.struct(*rest).alias("r")))["r"].alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def layered_resolution(base: DataFrame, complexes: DataFrame, reactions: DataFrame) -> DataFrame:
    """(evidence_id, canonical_id, status, mechanism) of every mention of `base`: its reaction's signature, else its complex's, else its own.

    complexes, reactions: parent_id, signature, resolved (see member_signature). Parents that are no mentions are left out.
    """
    out = base.select("evidence_id", *[F.col(c).alias(f"base_{c}") for c in ("canonical_id", "status", "mechanism")])
    for signed, name in ((reactions, "reaction"), (complexes, "complex")):
        own = signed.select(F.col("parent_id").alias("evidence_id"), F.struct(F.col("signature").alias("canonical_id"), F.when(F.col("resolved"), 1).otherwise(2).alias("status"), F.lit(name).alias("mechanism")).alias(name))
        out = out.join(own, "evidence_id", "left")
    return out.select("evidence_id", *[F.coalesce(f"reaction.{c}", f"complex.{c}", f"base_{c}").alias(c) for c in ("canonical_id", "status", "mechanism")])


def first_method(steps: list[DataFrame], key: str) -> DataFrame:
    """(key, how, target): of the answers of several methods that of the earliest, then the smallest."""
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return top1(out, [key], [("how", True), ("target", True)])

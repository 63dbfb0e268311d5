"""Resolution of a whole batch of evidence, and the union of everything in it that is an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.functions.ids import content_uuid, entity_key, sorted_text
from strandwise.operators.resolve import INCHIKEY, KEY, unambiguous_keys

#: Kinds of evidence and the kind under which the lookup lists them.
TYPE_MATCHES = {"Protein": "Gene", "Gene": "Gene", "Chemical": "Chemical"}
RESOLUTION = ["evidence_id", "entity_type", "molecular_type", "taxonomy_id", "canonical_type", "canonical_id", "status", "mechanism"]
NATURAL_KEY = ["entity_type", "taxonomy_id", "canonical_type", "canonical_id"]


def _mapped(c: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for a, b in names.items():
        out = F.when(c == a, F.lit(b)).otherwise(out)
    return out


def direct_resolutions(evidence: DataFrame, ids: DataFrame, structure: tuple[str, int], term: tuple[str, int] | None = None, pathway: tuple[str, dict[int, int]] | None = None) -> DataFrame:
    """(evidence_id, canonical_type, canonical_id, mechanism) of evidence that names itself.

    evidence: evidence_id, entity_type; ids: evidence_id, key_type, key_value. structure: the kind and identifier type of chemicals with exactly
    one well-formed InChIKey; term: those of vocabulary terms (the least accession counts); pathway: the kind, and the
    identifier types with their order, of which one counts if the evidence has exactly one of it. A term comes before a pathway, a pathway
    before a structure. Blank identifiers count for nothing. One aggregation per evidence with partial minima.
    """
    kinds = [(structure[0], [structure[1]])] + ([(term[0], [term[1]])] if term else []) + ([(pathway[0], list(pathway[1]))] if pathway else [])
    right = F.lit(False)
    for kind, types in kinds:
        right = right | ((F.col("entity_type") == kind) & F.col("key_type").isin(types))
    formed = (F.col("key_type") != structure[1]) | (F.col("entity_type") != structure[0]) | F.col("key_value").rlike(INCHIKEY)
    rows = ids.where("key_value <> ''").join(evidence.select("evidence_id", "entity_type"), "evidence_id").where(right & formed)
    per = rows.groupBy("evidence_id", "entity_type", "key_type").agg(F.min("key_value").alias("least"), F.max("key_value").alias("most"))
    is_term = F.col("entity_type") == (term[0] if term else None)
    is_pathway = F.col("entity_type") == (pathway[0] if pathway else None)
    order = F.lit(100)
    for t, n in (pathway[1] if pathway else {}).items():
        order = F.when(F.col("key_type") == t, n).otherwise(order)
    ranked = per.where(F.coalesce(is_term, F.lit(False)) | (F.col("least") == F.col("most")))
    ranked = ranked.withColumn("order", F.when(is_term, 0).when(is_pathway, order).otherwise(1000)).withColumn("mechanism", F.when(is_term, "cv_term").when(is_pathway, "pathway").otherwise("inchikey"))
    best = ranked.groupBy("evidence_id").agg(F.min(F.struct("order", "least", "key_type", "mechanism")).alias("b"))
    return best.select("evidence_id", F.col("b.key_type").cast("bigint").alias("canonical_type"), F.col("b.least").alias("canonical_id"), "b.mechanism")


def lookup_candidates(evidence: DataFrame, ids: DataFrame, lookup: DataFrame, optional_types: list[int], matches: dict[str, str] = TYPE_MATCHES) -> DataFrame:
    """(evidence_id, least, most): the least and the greatest of the candidates (taxonomy, type, identifier) that the lookup has for evidence.

    They are equal where there is exactly one. The join runs on kind, type and value; the taxonomy rule (equal, none in the lookup, or a key of the
    listed types that is unambiguous in all taxa) is a further condition. Minima and maxima are formed in part before
    the only shuffle by evidence, so evidence with any number of candidates weighs one row.
    """
    optional = unambiguous_keys(lookup, optional_types).withColumn("optional", F.lit(True))
    listed = lookup.join(optional, KEY, "left").withColumnRenamed("taxonomy_id", "listed_taxonomy")
    own = ids.where("key_value <> ''").join(evidence.select("evidence_id", "taxonomy_id", _mapped(F.col("entity_type"), matches).alias("entity_type")).where("entity_type is not null"), "evidence_id")
    fits = (F.col("taxonomy_id") == F.col("listed_taxonomy")) | F.col("listed_taxonomy").isNull() | F.col("optional").isNotNull()
    candidate = F.struct(F.coalesce("listed_taxonomy", "taxonomy_id").alias("taxonomy_id"), "canonical_type", "canonical_id")
    return own.join(listed, KEY).where(fits).groupBy("evidence_id").agg(F.min(candidate).alias("least"), F.max(candidate).alias("most"))


def resolution_base(evidence: DataFrame, ids: DataFrame, direct: DataFrame, found: DataFrame, fallback: DataFrame | None = None, genes: DataFrame | None = None, matches: dict[str, str] = TYPE_MATCHES) -> DataFrame:
    """Every evidence with its canonical identity: RESOLUTION.

    evidence: evidence_id, entity_type, taxonomy_id; direct: see direct_resolutions; found: see lookup_candidates; fallback: evidence_id,
    canonical_type, canonical_id, mechanism; genes: evidence_id, entity_type, taxonomy_id, canonical_type, canonical_id of copies made for
    several genes. In this order: direct, copies, exactly one candidate, no candidate but a fallback. The rest, also evidence with several
    candidates whatever its fallback, stays unresolved under the MD5 of its identifiers in order (of its own id where it has none).
    Terms and pathways lose their taxonomy; one candidate brings its own and the lookup's kind.
    """
    filled = F.when(F.col("key_value") != "", F.struct(F.col("key_type").alias("t"), F.col("key_value").alias("v")))
    named = ids.groupBy("evidence_id").agg(F.array_sort(F.collect_set(filled)).alias("ids"))
    text = F.array_join(F.transform("ids", lambda x: F.concat(x["t"].cast("string"), F.lit("="), x["v"])), "|")
    none = evidence.limit(0).select("evidence_id", F.lit(0).cast("bigint").alias("canonical_type"), F.lit("").alias("canonical_id"), F.lit("").alias("mechanism"))
    d = direct.select("evidence_id", F.struct("canonical_type", "canonical_id", "mechanism").alias("d"))
    f = (fallback if fallback is not None else none).select("evidence_id", F.struct("canonical_type", "canonical_id", "mechanism").alias("f"))
    g = (genes if genes is not None else none.select("evidence_id", F.lit("").alias("entity_type"), F.lit(0).cast("bigint").alias("taxonomy_id"), "canonical_type", "canonical_id")).select("evidence_id", F.struct("entity_type", "taxonomy_id", "canonical_type", "canonical_id").alias("g"))
    rows = evidence.select("evidence_id", "entity_type", "taxonomy_id").join(named, "evidence_id", "left").join(d, "evidence_id", "left").join(g, "evidence_id", "left").join(found, "evidence_id", "left").join(f, "evidence_id", "left")
    is_d, is_g = F.col("d").isNotNull(), F.col("g").isNotNull()
    is_one = F.col("least").isNotNull() & F.col("least").eqNullSafe(F.col("most"))
    is_f = F.col("least").isNull() & F.col("f.canonical_id").isNotNull()
    own = F.md5(F.when(F.size(F.coalesce("ids", F.array())) > 0, text).otherwise(F.col("evidence_id")))
    kind = _mapped(F.col("entity_type"), matches)

    def pick(direct, copy, one, back, rest) -> Column:
        return F.when(is_d, direct).when(is_g, copy).when(is_one, one).when(is_f, back).otherwise(rest)

    free = F.col("d.mechanism").isin("cv_term", "pathway")
    return rows.select(
        "evidence_id",
        pick(F.col("entity_type"), F.col("g.entity_type"), F.coalesce(kind, F.col("entity_type")), F.col("entity_type"), F.col("entity_type")).alias("entity_type"),
        F.col("entity_type").alias("molecular_type"),
        pick(F.when(~free, F.col("taxonomy_id")), F.col("g.taxonomy_id"), F.col("least.taxonomy_id"), F.col("taxonomy_id"), F.col("taxonomy_id")).alias("taxonomy_id"),
        pick(F.col("d.canonical_type"), F.col("g.canonical_type"), F.col("least.canonical_type"), F.col("f.canonical_type"), F.lit(None)).cast("bigint").alias("canonical_type"),
        pick(F.col("d.canonical_id"), F.col("g.canonical_id"), F.col("least.canonical_id"), F.col("f.canonical_id"), own).alias("canonical_id"),
        F.when(is_d | is_g | is_one | is_f, 1).otherwise(2).alias("status"),
        pick(F.col("d.mechanism"), F.lit("gene_anchor"), F.lit("resolver"), F.col("f.mechanism"), F.lit("unresolved")).alias("mechanism"),
    )


def entity_union(origins: list[DataFrame], priority: dict[str, int]) -> DataFrame:
    """One row per natural key of all origins: (entity_id, natural key, status, mechanism, origin, sources).

    origins, the most authoritative first: the natural key, status, mechanism? and source of everything that is an entity: resolved evidence,
    vocabulary terms and other objects of annotations, ontology terms, ends of ontology relations, complexes and reactions, unresolved
    evidence. An origin adds only keys that no earlier one has; null taxonomies are equal. Keys without an identifier are left out. The best mechanism by
    `priority` is kept, and the sources of all origins in order. One shuffle by key takes the place of an anti join per origin, of one join for the sources,
    and of one for the mechanisms; sources are a dimension of bounded size.
    """
    rows = None
    for i, o in enumerate(origins):
        part = o.select(*NATURAL_KEY, "status", "mechanism", F.col("source_id").cast("string").alias("source"), F.lit(i + 1).alias("origin"))
        rows = part if rows is None else rows.unionByName(part)
    rank = F.coalesce(*[F.when(F.col("mechanism") == m, F.lit(p)) for m, p in priority.items()], F.when(F.col("mechanism").isNotNull(), F.lit(99)))
    rows = rows.where("canonical_id is not null and canonical_id <> ''").withColumn("rank", rank)
    out = rows.groupBy(*NATURAL_KEY).agg(F.min(F.struct("origin", "status")).alias("first"), F.min(F.when(F.col("rank").isNotNull(), F.struct("rank", "mechanism"))).alias("m"), sorted_text(F.lpad("source", 6, "0"), ",").alias("sources"))
    key = entity_key(F.col("entity_type"), F.col("taxonomy_id"), F.coalesce(F.col("canonical_type").cast("string"), F.lit("")), F.col("canonical_id"))
    return out.select(content_uuid(key).alias("entity_id"), *NATURAL_KEY, "first.status", "m.mechanism", "first.origin", "sources")

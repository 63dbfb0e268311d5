"""Query-ready tables derived from the stored graph: counts, facets, bitmaps, term tables, classes and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.ids import sorted_text
from strandwise.operators.pick import top1
from strandwise.operators.skew import small

BITS = 32768


def relation_counts(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(entity_id, relation_count): distinct relations at either end, zero-filled. A relation of an entity with itself counts once."""
    ends = relations.select("relation_id", F.explode(F.array("subject_entity_id", "object_entity_id")).alias("entity_id")).distinct()
    n = ends.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    return entities.select("entity_id").distinct().join(n, "entity_id", "left").select("entity_id", F.coalesce("n", F.lit(0)).alias("relation_count"))


def source_counts(resolution: DataFrame, unresolved: int = 2) -> DataFrame:
    """(entity_id, source_count, sources) of entities that a resolved mention leads to."""
    rows = resolution.where((F.col("status_id") != unresolved) & F.col("entity_id").isNotNull()).select("entity_id", "source_id").distinct()
    return rows.groupBy("entity_id").agg(F.count(F.lit(1)).alias("source_count"), sorted_text(F.lpad(F.col("source_id").cast("string"), 6, "0"), ",").alias("sources"))


def distinct_pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()


def pair_overlaps(members: DataFrame, item: str, group: str) -> DataFrame:
    """(a, b, overlap): exact shared items of groups a < b. An item's groups are a bounded dimension, pairs are summed before the shuffle."""
    sets = members.where(F.col(item).isNotNull()).groupBy(item).agg(F.sort_array(F.collect_set(group)).alias("g")).where(F.size("g") > 1)
    one = sets.select("g", F.explode("g").alias("a"))
    two = one.select("a", F.explode(F.filter("g", lambda x: x > F.col("a"))).alias("b"))
    return two.groupBy("a", "b").agg(F.count(F.lit(1)).alias("overlap"))


def bitmap_index(rows: DataFrame, key: list[str], number: str) -> DataFrame:
    """(key, bucket, bits): a compressed-by-block bitmap of dense numbers per key; blocks of 32 768 numbers.

    Each block is built with partial aggregation, so a key with any number of members never meets one task.
    """
    n = F.col(number)
    return rows.where(n.isNotNull()).groupBy(*key, F.shiftright(n, 15).alias("bucket")).agg(F.bitmap_construct_agg(n % BITS).alias("bits"))


def bitmap_sizes(index: DataFrame, key: list[str]) -> DataFrame:
    return index.groupBy(*key).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def bitmap_overlaps(index: DataFrame, key: str) -> DataFrame:
    """(a, b, overlap) of the keys whose bitmaps have a common bit, a < b, by AND of the bitmaps of each block.

    Each bitmap travels once, to its block; a block holds one of 4 KB per key, and keys are a bounded dimension. There
    all pairs are counted together, some thousand places at a time.
    """
    kind = dict(index.dtypes)[key]

    def count(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values(key)
        bits, keys = np.stack([np.frombuffer(x, np.uint8) for x in pdf["bits"]]), pdf[key].to_numpy()
        both = np.zeros((len(keys), len(keys)), np.float64)
        for at in range(0, bits.shape[1], 512):
            some = np.unpackbits(bits[:, at : at + 512], axis=1).astype(np.float32)
            both += some @ some.T
        i, j = np.nonzero(np.triu(both, 1))
        return pd.DataFrame({"a": keys[i], "b": keys[j], "n": both[i, j].astype(np.int64)})

    return index.select(key, "bucket", "bits").groupBy("bucket").applyInPandas(count, f"a {kind}, b {kind}, n long").groupBy("a", "b").agg(F.sum("n").alias("overlap"))


def facets(rows: DataFrame, item: str, columns: dict[str, str]) -> DataFrame:
    """(facet, value, n): distinct items per value of each column; one pass over the rows for all facets. Null values are left out."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value")) for f, c in columns.items()]))
    return rows.select(item, each.alias("f")).where("f.value is not null").select(item, "f.facet", "f.value").distinct().groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def term_table(terms: DataFrame) -> DataFrame:
    """(accession, label, n_rows, n_spellings, spellings) of controlled terms from (accession, name) rows.

    The label is the most frequent name, of equal ones the shortest, then the first bytewise.
    """
    names = terms.where("accession is not null").groupBy("accession", "name").agg(F.count(F.lit(1)).alias("n"))
    labels = top1(names.where("name <> ''").withColumn("len", F.length("name")), ["accession"], [("n", False), ("len", True), ("name", True)]).select("accession", F.col("name").alias("label"))
    total = names.groupBy("accession").agg(F.sum("n").alias("n_rows"), F.count(F.when(F.col("name") != "", 1)).alias("n_spellings"), sorted_text(F.when(F.col("name") != "", F.col("name"))).alias("spellings"))
    return total.join(labels, "accession", "left").select("accession", "label", "n_rows", "n_spellings", "spellings")


def most_specific_class(rows: DataFrame, rules: DataFrame, item: str, by: str, default: str) -> DataFrame:
    """(item, class): of the classes that rules (by, class, precedence) give an item's rows the one of least precedence, else the default."""
    hit = rows.select(item, by).distinct().join(small(rules), by).groupBy(item).agg(F.min(F.struct("precedence", "class"))["class"].alias("class"))
    return rows.select(item).distinct().join(hit, item, "left").select(item, F.coalesce("class", F.lit(default)).alias("class"))


def keyword_class(rows: DataFrame, item: str, text: str, priority: str, keywords: dict[str, list[str]], default: str) -> DataFrame:
    """(item, class): the first class, in the order of `keywords`, with a keyword inside the text of least priority that has any.

    All keywords are folded into one expression per class; nothing is joined.
    """
    low = F.lower(text)
    place = F.lit(None).cast("int")
    for i, (_, words) in reversed(list(enumerate(keywords.items()))):
        place = F.when(F.greatest(*[low.contains(w) for w in words], F.lit(False)), F.lit(i)).otherwise(place)
    best = rows.select(item, F.col(priority).alias("p"), place.alias("c")).groupBy(item).agg(F.min(F.when(F.col("c").isNotNull(), F.struct("p", "c"))).alias("b"))
    names = F.array(*[F.lit(k) for k in keywords])
    return best.select(item, F.coalesce(F.get(names, F.col("b.c")), F.lit(default)).alias("class"))


def attested_label(rows: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label): the label most attested, of equal ones the shortest, then the first bytewise."""
    n = rows.where(F.trim(label) != "").groupBy(key, F.trim(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    return top1(n.withColumn("len", F.length(label)), [key], [("n", False), ("len", True), (label, True)]).select(key, label)


def label_cascade(rows: DataFrame, key: str, kind: str, value: str, tiers: dict[int, int]) -> DataFrame:
    """(key, label, tier): readable names. Values split at |, lose a trailing (PTF and digits), and count apart from case.

    The best tier wins, then attestation, length and bytewise order; the display form is the most frequent spelling. Identifiers,
    numbers and texts shorter than 2 or longer than 120 signs are no names.
    """
    parts = rows.where(F.col(kind).isin(list(tiers))).select(key, kind, F.explode(F.split(value, r"\|")).alias("name"))
    names = parts.select(key, kind, F.trim(F.regexp_replace("name", r"\s*\(PTF[0-9]+\)\s*$", "")).alias("name"))
    names = names.where(F.length("name").between(2, 120) & ~F.col("name").rlike(r"^\d+$") & ~F.col("name").rlike(r"^[A-Z]{14}-[A-Z]{10}-[A-Z]$"))
    tier = F.create_map(*[F.lit(x) for t, n in tiers.items() for x in (t, n)])
    names = names.withColumn("tier", tier[F.col(kind).cast("int")]).withColumn("low", F.lower("name"))
    spelled = names.groupBy(key, "low", "name").agg(F.count(F.lit(1)).alias("n"), F.min("tier").alias("tier"))
    folded = spelled.groupBy(key, "low").agg(F.sum("n").alias("total"), F.min("tier").alias("tier"), F.min(F.struct((-F.col("n")).alias("m"), "name"))["name"].alias("label"))
    return top1(folded.withColumn("len", F.length("label")), [key], [("tier", True), ("total", False), ("len", True), ("label", True)]).select(key, "label", "tier")


def identifier_label(rows: DataFrame, key: str, kind: str, value: str, tiers: dict[int, tuple[int, str]]) -> DataFrame:
    """(key, label): the identifier of the best tier behind its readable prefix, unless it carries that already."""
    order = F.create_map(*[F.lit(x) for t, (n, _) in tiers.items() for x in (t, n)])
    prefix = F.create_map(*[F.lit(x) for t, (_, p) in tiers.items() for x in (t, p)])
    r = rows.where(F.col(kind).isin(list(tiers)) & (F.trim(value) != "")).select(key, order[F.col(kind).cast("int")].alias("tier"), prefix[F.col(kind).cast("int")].alias("prefix"), F.trim(value).alias("v"))
    best = top1(r, [key], [("tier", True), ("v", True)])
    return best.select(key, F.when((F.col("prefix") == "") | F.startswith(F.col("v"), F.col("prefix")), F.col("v")).otherwise(F.concat("prefix", "v")).alias("label"))


def resource_table(sources: DataFrame, resolution: DataFrame, links: DataFrame) -> DataFrame:
    """(source_id, name, n_entities, n_mentions, n_relations, status) per source; status tells whether anything was built."""
    e = resolution.groupBy("source_id").agg(F.countDistinct("entity_id").alias("n_entities"), F.countDistinct("entity_evidence_id").alias("n_mentions"))
    r = links.groupBy("source_id").agg(F.countDistinct("relation_id").alias("n_relations"))
    out = sources.join(e, "source_id", "left").join(r, "source_id", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("n_entities", "n_mentions", "n_relations")}
    return out.select("source_id", "name", *[v.alias(c) for c, v in n.items()], F.when(n["n_mentions"] + n["n_relations"] > 0, "built").otherwise("not built").alias("status"))


def build_manifest(resources: DataFrame) -> DataFrame:
    """One row (build_id, n_sources, n_built, partial): an id that depends on the content of the resource table alone."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(resources.columns)])
    g = resources.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("h"), F.count(F.lit(1)).alias("n_sources"), F.count(F.when(F.col("status") == "built", 1)).alias("n_built"))
    return g.select(F.substring("h", 1, 12).alias("build_id"), "n_sources", "n_built", (F.col("n_built") < F.col("n_sources")).alias("partial"))

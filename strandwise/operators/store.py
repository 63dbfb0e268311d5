"""The graph on disk: tables partitioned by source, dictionary encoding, and removal of one source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.operators.skew import small
from strandwise.session import exists


def encode(df: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Replaces each named text column by its number: column name -> dictionary (name, number). Unknown names give null."""
    for c, d in dictionaries.items():
        name, number = d.columns[:2]
        df = df.join(small(d.select(F.col(name).alias(c), F.col(number).alias("__n"))), c, "left").withColumn(c, F.col("__n")).drop("__n")
    return df


def write_source(df: DataFrame, path: str) -> None:
    """Writes rows into their source partitions and replaces those partitions only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(path)


def has_source(spark: SparkSession, path: str, source_id: int) -> bool:
    """Whether the table holds rows of a source; reads the partition's listing at most."""
    return exists(spark, path) and not spark.read.parquet(path).where(F.col("source_id") == source_id).limit(1).isEmpty()


def assert_empty(df: DataFrame, what: str) -> None:
    if not df.limit(1).isEmpty():
        raise ValueError(f"{what} holds rows already")


def upsert(stored: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows with those of the same key replaced; null keys compare as equal. `rows` must be unique by key."""
    fresh = rows.select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return stored.join(fresh, on, "left_anti").unionByName(rows)


def merge_shards(shards: list[DataFrame]) -> DataFrame:
    """One table of the states of several shards; a state that several hold comes once."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s)
    return out.distinct()


def delete_source(graph: dict[str, DataFrame], source_id: int) -> dict[str, DataFrame]:
    """The graph without one source and without what only that source held up.

    graph: resolution (source_id, entity_id), links (source_id, relation_id, relation_evidence_id), evidence (source_id,
    relation_evidence_id), relation (relation_id, subject_entity_id, object_entity_id), entity (entity_id). The order matters: rows of the source go first,
    then relations without a link, then entities that neither a mention nor a remaining relation holds. Where the graph has annotation_links
    (source_id, annotation_key) and annotation (annotation_key), annotations that only the source referred to go as well; those nobody referred to stay.
    """
    gone = F.col("source_id").eqNullSafe(F.lit(source_id))
    out = {n: graph[n].where(~gone) for n in ("resolution", "links", "evidence")}
    touched = graph["links"].where(gone).select("relation_id").where("relation_id is not null").distinct()
    orphaned = touched.join(out["links"].select("relation_id").distinct(), "relation_id", "left_anti")
    out["relation"] = graph["relation"].join(orphaned, "relation_id", "left_anti")
    lost = graph["resolution"].where(gone).select("entity_id").where("entity_id is not null").distinct()
    ends = out["relation"].select(F.explode(F.array("subject_entity_id", "object_entity_id")).alias("entity_id"))
    held = out["resolution"].select("entity_id").unionByName(ends).distinct()
    out["entity"] = graph["entity"].join(lost.join(held, "entity_id", "left_anti"), "entity_id", "left_anti")
    if "annotation_links" in graph:
        said = graph["annotation_links"]
        out["annotation_links"] = said.where(~gone)
        mute = said.where(gone).select("annotation_key").where("annotation_key is not null").distinct().join(out["annotation_links"].select("annotation_key").distinct(), "annotation_key", "left_anti")
        out["annotation"] = graph["annotation"].join(mute, "annotation_key", "left_anti")
    return out

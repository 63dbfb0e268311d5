"""Entity-attribute-value rows as one wide, typed row per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.text import accession_of, squeeze
from strandwise.functions.typed import SQL_TYPES, with_typed_text
from strandwise.operators.skew import join_unique

#: An attribute list longer than this is refused: every attribute becomes a column.
MAX_ATTRIBUTES = 5000


def bounded(attributes: DataFrame) -> list:
    """The rows of an attribute list; one that is longer than MAX_ATTRIBUTES is refused, never cut."""
    rows = attributes.limit(MAX_ATTRIBUTES + 1).collect()
    if len(rows) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    return rows


def attribute_list(types: DataFrame) -> list[tuple[str, str, str]]:
    """(accession, name, kind) of every attribute, in order of accession; the fixed columns of the wide table."""
    rows = bounded(types.select("accession", "attribute_name", "value_kind").where("accession is not null").distinct().orderBy("accession", "attribute_name"))
    first: dict[str, tuple[str, str, str]] = {}
    for r in rows:
        first.setdefault(r[0].upper(), (r[0].upper(), r[1] or r[0], r[2] or "text"))
    return list(first.values())


def usable_cells(annotation: DataFrame, attributes: list[tuple[str, str, str]]) -> DataFrame:
    """(annotation_key, pos, cell): annotations of an attribute with a value that its kind can read.

    The attribute is told by the accession in the term or, without one, by its name apart from case and blanks.
    """
    spark = annotation.sparkSession
    names = [(acc, i, kind) for i, (acc, _, kind) in enumerate(attributes)] + [("name:" + "".join(name.lower().split()), i, kind) for i, (_, name, kind) in enumerate(attributes)]
    first = {attr: (attr, i, kind) for attr, i, kind in reversed(names)}
    lookup = spark.createDataFrame(list(first.values()), "attr string, pos int, kind string")
    term = annotation.select("annotation_key", "value", F.coalesce(accession_of(F.col("term")), F.concat(F.lit("name:"), squeeze(F.col("term")))).alias("attr"))
    typed = with_typed_text(term.join(F.broadcast(lookup), "attr"), "kind", "value", "cell")
    # explode, not a filter: a filter would be pushed down and evaluate the whole reading twice
    return typed.where("annotation_key is not null").select("annotation_key", "pos", F.explode(F.array_compact(F.array("cell"))).alias("cell"))


def column_names(attributes: list[tuple[str, str, str]], taken: list[str]) -> list[str]:
    """A column name per attribute; one that is taken already gets its accession appended."""
    used, out = {t.lower() for t in taken}, []
    for acc, name, _ in attributes:
        c = "_".join("".join(ch if ch.isalnum() else " " for ch in name.lower()).split())
        c = c if c and c not in used else f"{c}_{acc.lower().replace(':', '_')}"
        used.add(c)
        out.append(c)
    return out


def wide_table(links: DataFrame, annotation: DataFrame, types: DataFrame, entity: list[str]) -> DataFrame:
    """One row per entity that has a usable cell: its key columns and one typed column per attribute.

    links: the `entity` columns and annotation_key. Of several usable values in one cell the smallest text is
    kept (a defined choice; repeats therefore change nothing). Links without an annotation row, terms that are
    no attribute, and unreadable values leave the cell null. Extra columns are ignored.

    The joined values are reduced to one per entity and attribute (partial aggregation first, so neither a hot
    annotation nor a hot entity meets one task), collected per entity into an array of at most as many cells as
    attributes, laid onto the complete grid of positions, and projected by fixed index through try_cast. The
    grid is completed inside each entity's array; a shuffled entity x attribute table would hold mostly nulls.
    """
    attributes = attribute_list(types)
    cells = usable_cells(annotation, attributes).repartition("annotation_key").distinct()
    linked = join_unique(links.select(*entity, "annotation_key").where("annotation_key is not null"), cells, "annotation_key")
    best = linked.groupBy(*entity, "pos").agg(F.min("cell").alias("cell"))
    rows = best.groupBy(*entity).agg(F.map_from_entries(F.collect_list(F.struct("pos", "cell"))).alias("cells"))
    names = column_names(attributes, entity)
    if not attributes:
        return rows.select(*entity)
    grid = F.transform(F.sequence(F.lit(0), F.lit(len(attributes) - 1)), lambda p: F.try_element_at(F.col("cells"), p))
    wide = rows.select(*entity, grid.alias("grid"))
    return wide.select(*entity, *[F.expr(f"try_cast(grid[{i}] as {SQL_TYPES.get(kind, 'string')}) as `{names[i]}`") for i, (_, _, kind) in enumerate(attributes)])


def filled_cells(wide: DataFrame, types: DataFrame, entity: list[str]) -> DataFrame:
    """(entity columns, accession) of every cell of the wide table that is not null."""
    attributes = attribute_list(types)
    names = column_names(attributes, entity)
    filled = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(a)) for n, (a, _, _) in zip(names, attributes)])) if attributes else F.array().cast("array<string>")
    return wide.select(*entity, F.explode(filled).alias("accession"))

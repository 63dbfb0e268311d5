"""Network views over the graph: direct pairs, two-hop transport, ligand-receptor pairs, and their union."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.ids import sorted_text


@dataclass(frozen=True)
class View:
    """What a network takes from the graph. Pairs run from compound to protein; `flip`: the edge runs from protein to compound.

    taxon: of the protein ("protein") or stated by the evidence ("evidence"); resolved: which ends must be resolved ("", "protein", "both");
    needs: a pivot that must be filled, with the least value if it is a number; predicates: those counted, or all.
    """

    name: str
    source_id: int
    flip: bool = False
    taxon: tuple[str, int] | None = None
    resolved: str = ""
    needs: tuple[str, float | None] | None = None
    predicates: tuple[int, ...] = ()


def annotation_pivot(links: DataFrame, annotation: DataFrame, numbers: dict[str, str], texts: dict[str, str], flags: dict[str, str], true_words: list[str]) -> DataFrame:
    """One row per (source_id, entity_evidence_id) with a column per listed accession.

    annotation: annotation_key, accession, value. numbers: the greatest number left when all but digits, signs, points and exponents is
    taken out; texts: the distinct texts in order; flags: whether any value is a word for true. Values per evidence are bounded by
    its annotations. Evidence without a listed annotation has no row.
    """
    acc, value = F.col("accession"), F.col("value")
    wanted = annotation.where(acc.isin([*numbers.values(), *texts.values(), *flags.values()]))
    scrubbed = F.expr("try_cast(nullif(regexp_replace(value, '[^0-9.eE+-]', ''), '') as double)")
    cols = [F.max(F.when(acc == a, scrubbed)).alias(n) for n, a in numbers.items()]
    cols += [sorted_text(F.when(acc == a, F.trim(value))).alias(n) for n, a in texts.items()]
    cols += [F.coalesce(F.bool_or(F.when(acc == a, F.lower(F.trim(value)).isin(true_words))), F.lit(False)).alias(n) for n, a in flags.items()]
    return links.join(wanted, "annotation_key").groupBy("source_id", "entity_evidence_id").agg(*cols)


def view_rows(edges: DataFrame, nodes: DataFrame, pivots: DataFrame, views: list[View], compound_types: list[int], protein_type: int) -> DataFrame:
    """(network, source_id, relation_evidence_id, compound_id, protein_id, predicate_id, both_resolved, pivots) of all views in one pass.

    edges: source_id, relation_evidence_id, entity_evidence_id (of the subject), subject_id, predicate_id, object_id; nodes: entity_id,
    entity_type_id, taxonomy_id, resolution_status_id; pivots: source_id, entity_evidence_id and a column `taxon` beside the others. The types of both ends
    and the pivots are joined once; then every edge is told the views whose gates it passes.
    """
    some = edges.where(F.col("source_id").isin([v.source_id for v in views]))
    n = nodes.select("entity_id", "entity_type_id", "taxonomy_id", "resolution_status_id").where(F.col("entity_type_id").isin([*compound_types, protein_type]))
    side = lambda p: n.select(F.col("entity_id").alias(f"{p}_id"), F.col("entity_type_id").alias(f"{p}_type"), F.col("taxonomy_id").alias(f"{p}_taxon"), (F.col("resolution_status_id") == 1).alias(f"{p}_resolved"))
    met = some.join(side("subject"), "subject_id").join(side("object"), "object_id")
    forward = F.col("subject_type").isin(compound_types) & (F.col("object_type") == protein_type)
    back = F.col("object_type").isin(compound_types) & (F.col("subject_type") == protein_type)
    whole = met.where(forward | back).join(pivots, ["source_id", "entity_evidence_id"], "left")
    turned = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    rows = whole.select(
        "source_id", "relation_evidence_id", "predicate_id", turned("subject_id", "object_id").alias("compound_id"), turned("object_id", "subject_id").alias("protein_id"), forward.alias("forward"),
        turned("object_taxon", "subject_taxon").alias("protein_taxon"), turned("object_resolved", "subject_resolved").alias("protein_resolved"), F.coalesce(F.col("subject_resolved") & F.col("object_resolved"), F.lit(False)).alias("both_resolved"),
        *[c for c in pivots.columns if c not in ("source_id", "entity_evidence_id")],
    )

    def gate(v: View):
        ok = (F.col("source_id") == v.source_id) & (~F.col("forward") if v.flip else F.col("forward"))
        if v.taxon:
            ok = ok & (F.col("protein_taxon") == v.taxon[1] if v.taxon[0] == "protein" else F.array_contains(F.split("taxon", "[|]"), str(v.taxon[1])))
        if v.resolved:
            ok = ok & F.col(f"{v.resolved}_resolved")
        if v.needs:
            ok = ok & (F.col(v.needs[0]).isNotNull() if v.needs[1] is None else F.col(v.needs[0]) >= v.needs[1])
        return ok & F.col("predicate_id").isin(list(v.predicates)) if v.predicates else ok

    named = F.array_compact(F.array(*[F.when(gate(v), F.lit(v.name)) for v in views]))
    return rows.withColumn("network", F.explode(named)).drop("forward", "protein_taxon", "protein_resolved")


def view_pairs(rows: DataFrame) -> DataFrame:
    """(network, compound_id, protein_id, n_evidence) of view_rows whose ends are both resolved."""
    return rows.where("both_resolved").groupBy("network", "compound_id", "protein_id").agg(F.count(F.lit(1)).alias("n_evidence"))


def transport_view(edges: DataFrame, nodes: DataFrame, name: str, middle_type: int, controls: int, takes_part: int) -> DataFrame:
    """(network, protein_id, compound_id, n_transports): who controls a step that a compound takes part in; two joins through the step."""
    mid = nodes.where(F.col("entity_type_id") == middle_type).select(F.col("entity_id").alias("step_id")).distinct()
    c = edges.where(F.col("predicate_id") == controls).select(F.col("subject_id").alias("protein_id"), F.col("object_id").alias("step_id")).distinct()
    p = edges.where(F.col("predicate_id") == takes_part).select(F.col("subject_id").alias("step_id"), F.col("object_id").alias("compound_id")).distinct()
    hops = c.join(mid, "step_id", "left_semi").join(p, "step_id")
    return hops.groupBy("protein_id", "compound_id").agg(F.countDistinct("step_id").alias("n_transports")).select(F.lit(name).alias("network"), "protein_id", "compound_id", "n_transports")


def transport_views(edges: DataFrame, nodes: DataFrame, networks: list[tuple[str, int, int, int]]) -> DataFrame:
    """The columns of transport_view of several networks (name, type of the step, predicate of control, of participation)."""
    out = None
    for n in networks:
        one = transport_view(edges, nodes, *n)
        out = one if out is None else out.unionByName(one)
    return out


def annotated_transports(edges: DataFrame, nodes: DataFrame, annotations: DataFrame, name: str, middle_type: int, controls: int, takes_part: int, reactant: list[str], product: list[str], compartment: list[str]) -> DataFrame:
    """(network, source_id, relation_evidence_id, step_id, protein_id, compound_id, is_reactant, is_product, compartment_from, compartment_to, direction).

    edges: source_id, relation_evidence_id, subject_id, predicate_id, object_id; annotations: source_id, relation_evidence_id, term, value, of
    which the lists name the terms of roles and compartments. One row per control of a step and compound of that step, within a source. A participation
    has its roles and its greatest compartment; the compound comes from the greatest compartment of those as a reactant, and goes to that as a product.
    """
    mid = nodes.where(F.col("entity_type_id") == middle_type).select(F.col("entity_id").alias("step_id")).distinct()
    key = ["source_id", "relation_evidence_id"]
    c = edges.where(F.col("predicate_id") == controls).select(*key, F.col("subject_id").alias("protein_id"), F.col("object_id").alias("step_id")).distinct().join(mid, "step_id", "left_semi")
    p = edges.where(F.col("predicate_id") == takes_part).select(*key, F.col("subject_id").alias("step_id"), F.col("object_id").alias("compound_id")).distinct().join(mid, "step_id", "left_semi")
    term = F.col("term")
    says = annotations.groupBy(*key).agg(F.bool_or(term.isin(reactant)).alias("r"), F.bool_or(term.isin(product)).alias("p"), F.max(F.when(term.isin(compartment), F.col("value"))).alias("place"))
    flag = lambda n: F.coalesce(F.bool_or(n), F.lit(False))
    taken = p.join(says, key, "left").groupBy("source_id", "step_id", "compound_id").agg(
        flag("r").alias("is_reactant"), flag("p").alias("is_product"), F.max(F.when(F.col("r"), F.col("place"))).alias("compartment_from"), F.max(F.when(F.col("p"), F.col("place"))).alias("compartment_to")
    )
    left, arrives = F.col("compartment_from").isNotNull(), F.col("compartment_to").isNotNull()
    direction = F.when(left & arrives, "reactant_to_product").when(left, "reactant").when(arrives, "product").alias("direction")
    return c.join(taken, ["source_id", "step_id"]).select(F.lit(name).alias("network"), *key, "step_id", "protein_id", "compound_id", "is_reactant", "is_product", "compartment_from", "compartment_to", direction)


def pair_view(evidence: DataFrame, sides: DataFrame) -> DataFrame:
    """(ligand_id, receptor_id, n_evidence, n_sources, sources): evidence with a ligand at one end and a receptor at the other.

    evidence: source_id, relation_evidence_id, subject_id, object_id; sides: entity_id, side (ligand or receptor). Both ends are
    unpivoted, told their side, and met again within (source, evidence) on different sides.
    """
    ends = F.explode(F.array(F.struct(F.lit(1).alias("end"), F.col("subject_id").alias("entity_id")), F.struct(F.lit(2).alias("end"), F.col("object_id").alias("entity_id"))))
    told = evidence.select("source_id", "relation_evidence_id", ends.alias("e")).select("source_id", "relation_evidence_id", "e.end", "e.entity_id").join(sides, "entity_id").distinct()
    key = ["source_id", "relation_evidence_id"]
    a = told.where("side = 'ligand'").select(*key, F.col("end").alias("ea"), F.col("entity_id").alias("ligand_id"))
    b = told.where("side = 'receptor'").select(*key, F.col("end").alias("eb"), F.col("entity_id").alias("receptor_id"))
    pairs = a.join(b, key).where("ea <> eb").select(*key, "ligand_id", "receptor_id").distinct()
    return pairs.groupBy("ligand_id", "receptor_id").agg(F.count(F.lit(1)).alias("n_evidence"), F.countDistinct("source_id").alias("n_sources"), sorted_text(F.lpad(F.col("source_id").cast("string"), 6, "0"), ",").alias("sources"))


def combined_view(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per pair over all networks, of compounds in `kept` (compound_id): (compound_id, protein_id, n_networks, networks, n_evidence).

    pairs: network, compound_id, protein_id, n_evidence. Networks are a short list, so their text is.
    """
    some = pairs.join(kept.select("compound_id").distinct(), "compound_id", "left_semi")
    return some.groupBy("compound_id", "protein_id").agg(F.countDistinct("network").alias("n_networks"), sorted_text(F.col("network")).alias("networks"), F.sum("n_evidence").alias("n_evidence"))


def entity_annotations(nodes: DataFrame, attached: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """One row per node and for each kind its distinct values in order: (entity_id, label, kinds...). Values per node are bounded by the caller's kinds."""
    cols = [sorted_text(F.when(F.col("key_type") == t, F.col("key_value"))).alias(n) for n, t in kinds.items()]
    ids = attached.groupBy("entity_id").agg(*cols)
    return nodes.select("entity_id", "label").distinct().join(ids, "entity_id", "left")


class Registry:
    """Named views that are built on demand and, if materialised, written to a folder and read back."""

    def __init__(self):
        self.builders: dict[str, tuple[Callable[[], DataFrame], str | None]] = {}

    def add(self, name: str, build: Callable[[], DataFrame], path: str | None = None) -> None:
        if name in self.builders:
            raise ValueError(f"view {name} exists")
        self.builders[name] = (build, path)

    def apply(self, names: list[str] | None = None) -> dict[str, str]:
        """Registers temporary views; a view that fails is reported and the rest go on."""
        state = {}
        for n in names or list(self.builders):
            build, path = self.builders[n]
            try:
                df = build()
                if path:
                    df.write.mode("overwrite").parquet(path)
                    df = df.sparkSession.read.parquet(path)
                df.createOrReplaceTempView(n)
                state[n] = "ok"
            except Exception as e:  # noqa: BLE001
                state[n] = f"failed: {type(e).__name__}"
        return state

    refresh = apply

"""Nested source records flattened into evidence tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions.ids import python_json_uuid

# Kinds of records whose members are related to each other, and what relates them.
PAIR_KINDS = {"interaction": "interacts_with", "association": "associated_with", "control": "controls", "catalysis": "controls", "degradation": "controls", "reaction": "interacts_with", "transport": "transports"}
STEPS = {"reaction", "transport"}
CONTROL_ROLES = {"catalyst", "enzyme", "controller", "transporter"}
SOURCE_ROLES, TARGET_ROLES = {"source", "regulator", "ligand", "effector"}, {"target", "substrate", "receptor"}
POSITIVE, NEGATIVE = ("activ", "positive", "stimul"), ("inhib", "negative", "repress")
#: Control roles that also state the effect; transporters do not.
CATALYTIC_ROLES = {"catalyst", "enzyme", "controller"}
ALIASES = {"small molecule": "chemical", "drug": "chemical", "lipid": "chemical", "compound": "chemical"}

SCHEMA = (
    "tag string, source string, dataset string, row_id long, evidence_id string, parent_id string, entity_role string, entity_type string, "
    "taxonomy_id string, id_type string, id_value string, scope string, term string, value string, unit string, subject_id string, predicate string, object_id string, category string"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Records nested deeper than this are cut and tagged, so a cyclic record ends.
MAX_DEPTH = 64


def normal_type(name: str | None) -> str | None:
    """The kind of a record in lower case without accession, aliases folded."""
    if not name:
        return None
    base = name.split(":")[0].strip().lower()
    return ALIASES.get(base, base)


def roles(node: dict) -> set[str]:
    return {str(a.get("term") or "").split(":")[0].strip().lower() for a in node.get("annotations") or []}


def sign(annotations: list[dict]) -> int:
    """1, -1 or 0 by the first annotation that states an effect; the record's come before a participant's."""
    for a in annotations or []:
        text = f"{a.get('term') or ''} {a.get('value') or ''}".lower()
        if any(w in text for w in POSITIVE):
            return 1
        if any(w in text for w in NEGATIVE):
            return -1
    return 0


def pair_predicate(kind: str, effect: int) -> str:
    if kind == "interaction" and effect:
        return "positively_regulates" if effect > 0 else "negatively_regulates"
    return PAIR_KINDS.get(kind, "related_to")


def membership_predicate(parent: str, role: set[str]) -> tuple[str, bool]:
    """(predicate, whether it runs from member to parent)."""
    if parent in STEPS and role & CONTROL_ROLES:
        return "controls", True
    if parent in STEPS:
        return "has_participant", False
    if parent == "cv term":
        return "associated_with", False
    return "has_member", False


def taxonomy(node: dict) -> str | None:
    """From an identifier, else an annotation, else the one taxonomy that all members share; digits only."""
    for key, name, val in (("identifiers", "type", "value"), ("annotations", "term", "value")):
        for x in node.get(key) or []:
            if "tax" in str(x.get(name) or "").lower() and str(x.get(val) or "").strip().isdigit():
                return str(x[val]).strip()
    found = {taxonomy(m.get("member") or {}) for m in node.get("membership") or []}
    return found.pop() if len(found) == 1 else None


def flatten(record: dict, source: str, dataset: str, row_id: int) -> list[dict]:
    """Tagged rows (entity, identifier, annotation, relation, relation_annotation) of one nested record.

    An interaction with two members becomes a relation between them; one with fewer is dropped; larger ones, reactions and
    all other records become an entity with its members below, joined by membership relations. A controller points
    at its step, with an annotation that says catalysis. Occurrence ids name the path, so equal records stay apart.
    """
    out: list[dict] = []
    seen: set[tuple] = set()

    def emit(tag: str, **x) -> None:
        out.append({"tag": tag, "source": source, "dataset": dataset, "row_id": row_id, **x})

    def notes(tag: str, owner: str, rows: list[dict], scope: str | None = None) -> None:
        for a in rows or []:
            if a.get("term"):
                emit(tag, evidence_id=owner, scope=scope, term=a["term"], value=a.get("value"), unit=a.get("unit"))

    def relate(path: str, subject: str, predicate: str, obj: str, category: str) -> str:
        rid = python_json_uuid([source, dataset, str(row_id), path])
        emit("relation", evidence_id=rid, subject_id=subject, predicate=predicate, object_id=obj, category=category)
        return rid

    def visit(node: dict, path: str, parent: str | None, depth: int) -> str | None:
        kind = normal_type(node.get("type"))
        members = [m for m in node.get("membership") or [] if m.get("member")]
        me = python_json_uuid([source, dataset, str(row_id), path])
        if depth > MAX_DEPTH:
            emit("cut", evidence_id=me, parent_id=parent)
            return None
        if kind in PAIR_KINDS and kind != "reaction" and parent is None:
            if len(members) < 2:
                return None
            carriers = sum(bool(roles(m) & {"transporter"}) for m in members)
            if len(members) == 2 and (kind != "transport" or carriers == 1):
                ends = members
                if roles(ends[1]) & (SOURCE_ROLES | {"transporter"}) or roles(ends[0]) & TARGET_ROLES:
                    ends = ends[::-1]
                ids = [visit(m["member"], f"{path}:member:{i}", None, depth + 1) for i, m in enumerate(ends)]
                if all(ids):
                    effect = sign(node.get("annotations")) or sign([a for m in ends for a in m.get("annotations") or []])
                    rid = relate(f"{path}:relation", ids[0], pair_predicate(kind, effect), ids[1], "interaction")
                    notes("relation_annotation", rid, node.get("annotations"), "relation")
                    notes("relation_annotation", rid, ends[0].get("annotations"), "subject")
                    notes("relation_annotation", rid, ends[1].get("annotations"), "object")
                return None
        emit("entity", evidence_id=me, parent_id=parent, entity_role="parent" if parent is None else "member", entity_type=kind, taxonomy_id=taxonomy(node))
        for i in node.get("identifiers") or []:
            if i.get("value") and "standard inchi:" not in f"{i.get('type')}:".lower():
                emit("identifier", evidence_id=me, id_type=i.get("type"), id_value=str(i["value"]))
        notes("annotation", me, node.get("annotations"))
        for i, m in enumerate(members):
            child = visit(m["member"], f"{path}:member:{i}", me, depth + 1)
            if child is None:
                continue
            role = roles(m)
            predicate, upward = membership_predicate(kind or "", role)
            rid = relate(f"{path}:membership:{i}", child if upward else me, predicate, me if upward else child, "membership")
            notes("relation_annotation", rid, m.get("annotations"), "object")
            if upward and role & CATALYTIC_ROLES:
                notes("relation_annotation", rid, [{"term": "Control Effect", "value": "catalysis"}], "relation")
        for a in node.get("associations") or []:
            key = (me, a.get("predicate"), a.get("object_type"), a.get("object_id"))
            if a.get("object_id") and key not in seen:
                seen.add(key)
                emit("association", evidence_id=python_json_uuid([source, dataset, str(row_id), *map(str, key)]), subject_id=me, predicate=a.get("predicate") or "associated_with", id_type=a.get("object_type"), id_value=str(a["object_id"]), category="annotation")
        return me

    visit(record, f"{dataset}:{row_id}", None, 0)
    return out


def project(records: DataFrame) -> DataFrame:
    """Tagged evidence rows of (source, dataset, row_id, record), where record is a JSON text of any depth.

    Text that is null or no JSON object gives one row tagged broken, so nothing is lost silently. Split the result by tag.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[dict] = []
            for s, d, i, r in zip(pdf["source"], pdf["dataset"], pdf["row_id"], pdf["record"]):
                try:
                    node = json.loads(r)
                    if not isinstance(node, dict):
                        raise ValueError
                except (TypeError, ValueError):
                    rows.append({"tag": "broken", "source": s, "dataset": d, "row_id": i})
                    continue
                rows += flatten(node, s, d, int(i))
            yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    return records.select("source", "dataset", "row_id", "record").mapInPandas(run, SCHEMA)


def table_of(projected: DataFrame, tag: str, columns: list[str]) -> DataFrame:
    return projected.where(F.col("tag") == tag).select("source", "dataset", "row_id", *columns)
